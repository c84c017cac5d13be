"""Catalog-table sinks on plain file tables: append with new columns, overwrite, merge, views.

File tables have no transactions, so the writes are arranged to publish complete data only: new data
goes to a new folder and the catalog is switched to it afterwards. The exception is a merge that stays within
partitions: it replaces the files of the touched partitions where they are, so a reader of those may have to start
again. One writer per table is assumed.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.operators.upsert import (
    Match,
    ambiguous_matches,
    as_inserts,
    named_as,
    repeated_keys,
    upserted,
)
from stratum.quoting import quoted, ref
from stratum.scratch import remove, staged

TRANSACTIONAL = ("delta", "iceberg", "hudi")
_VERSION = re.compile(r"__v[0-9a-f]{32}$")


class AmbiguousMerge(ValueError):
    """Several source rows would update the same target row."""


class EmptyResult(ValueError):
    """A target that must not be empty would be."""


@dataclass(frozen=True)
class Buckets:
    """Rows with equal values of the columns share one of ``number`` files, sorted by them. Joins and groupings on the
    columns need no shuffle of the table."""

    number: int
    columns: tuple[str, ...]


@dataclass(frozen=True)
class TableInfo:
    name: str
    provider: str
    location: str
    partitions: tuple[str, ...]
    buckets: Buckets | None = None

    @property
    def transactional(self) -> bool:
        return self.provider.lower() in TRANSACTIONAL


def table_info(spark: SparkSession, table: str) -> TableInfo:
    details = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])
    number = int(details.get("num_buckets") or 0)
    return TableInfo(table, details.get("provider") or "", details.get("location") or "",
                     tuple(details.get("partition_columns") or ()),
                     Buckets(number, tuple(details["bucket_columns"])) if number else None)


def create(df: DataFrame, table: str, partition_by: Sequence[str] = (), location: str | None = None,
           buckets: Buckets | None = None) -> None:
    if buckets:
        # One task a bucket, so that a bucket is one file. A table is dealt once like this; merges then keep the deal.
        df = df.repartition(buckets.number, *[ref(c) for c in buckets.columns])
    writer = _balanced(df, () if buckets else partition_by).write.format("parquet").partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets.number, *buckets.columns).sortBy(*buckets.columns)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def append(df: DataFrame, table: str, partition_by: Sequence[str] = (), location: str | None = None,
           evolve: bool = True) -> None:
    """Append by column name. New columns are added to the table, missing ones become NULL."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        create(df, table, partition_by, location)
        return
    info = table_info(spark, table)
    if info.transactional:
        df.write.format(info.provider).mode("append").option("mergeSchema", str(evolve)).saveAsTable(table)
        return
    add_missing_columns(df, table, evolve)
    if info.buckets:
        df = df.repartition(info.buckets.number, *[ref(c) for c in info.buckets.columns])
    aligned(df if info.buckets else _balanced(df, info.partitions), spark.table(table).schema).write.insertInto(table)


def add_missing_columns(df: DataFrame, table: str, evolve: bool = True) -> None:
    spark = df.sparkSession
    known = {c.lower() for c in spark.table(table).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new and not evolve:
        raise ValueError(f"columns not in {table}: {', '.join(f.name for f in new)}")
    if new:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def aligned(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the order of ``schema``; those ``df`` lacks are NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select([
        ref(have[f.name.lower()]).alias(f.name) if f.name.lower() in have
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def overwrite(df: DataFrame, table: str, partition_by: Sequence[str] = (), location: str | None = None,
              on_empty: str = "write") -> int:
    """Replace the table's rows and return their number. The table may itself be read by ``df``.

    The new rows are written to a new folder first; the old folder stays, so running readers finish.
    ``on_empty`` decides what an empty result does: ``write``, ``skip`` (keep the old rows) or ``fail``.
    """
    spark = df.sparkSession
    written = Observation()
    df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if not spark.catalog.tableExists(table):
        fresh = _new_version(location or _default_location(spark, table))
        partitions = tuple(partition_by)
        _balanced(df, partitions).write.partitionBy(*partitions).parquet(fresh)
    else:
        info = table_info(spark, table)
        if info.transactional:
            df.write.format(info.provider).mode("overwrite").option("mergeSchema", "true").saveAsTable(table)
            return written.get["rows"]
        partitions = tuple(partition_by) or info.partitions
        fresh = _new_version(info.location)
        if info.buckets:
            return _overwrite_buckets(df, info, fresh, partitions, written, on_empty)
        _balanced(df, partitions).write.partitionBy(*partitions).parquet(fresh)
    rows = written.get["rows"]
    if rows == 0 and on_empty != "write":
        remove(spark, fresh)
        if on_empty == "fail":
            raise EmptyResult(f"nothing to write to {table}")
        return 0
    _switch(spark, table, fresh, df.schema, partitions)
    return rows


def _overwrite_buckets(df: DataFrame, info: TableInfo, fresh: str, partitions: Sequence[str], written: Observation,
                       on_empty: str) -> int:
    """The new rows go to a table of their own with the same buckets, which then takes the name over.

    Rows are not shuffled for this: a merge into the buckets' columns leaves them dealt as they were.
    """
    spark = df.sparkSession
    new = sibling(info.name, f"__v{uuid.uuid4().hex}")
    (df.write.format("parquet").partitionBy(*partitions).option("path", fresh)
     .bucketBy(info.buckets.number, *info.buckets.columns).sortBy(*info.buckets.columns).saveAsTable(new))
    rows = written.get["rows"]
    if rows == 0 and on_empty != "write":
        spark.sql(f"DROP TABLE {new}")
        remove(spark, fresh)
        if on_empty == "fail":
            raise EmptyResult(f"nothing to write to {info.name}")
        return 0
    _take_over(spark, new, info.name)
    return rows


def _switch(spark: SparkSession, table: str, location: str, schema: StructType,
            partitions: Sequence[str]) -> None:
    """Point the catalog at the new folder.

    With equal columns and no partitions this is a single catalog change. Otherwise a new table takes
    the name over and the old one is dropped last; a reader may see the name missing for a moment.
    """
    if spark.catalog.tableExists(table) and not partitions:
        info = table_info(spark, table)
        known = [(f.name.lower(), f.dataType) for f in spark.table(table).schema.fields]
        if not info.partitions and known == [(f.name.lower(), f.dataType) for f in schema.fields]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{_sql_text(location)}'")
            spark.catalog.refreshTable(table)
            return
    new = sibling(table, f"__v{uuid.uuid4().hex}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({', '.join(quoted(p) for p in partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {new} ({columns}) USING parquet {by} LOCATION '{_sql_text(location)}'")
    if partitions:
        spark.catalog.recoverPartitions(new)
    if not spark.catalog.tableExists(table):
        _rename(spark, new, table)
        return
    _take_over(spark, new, table)


def _take_over(spark: SparkSession, new: str, table: str) -> None:
    """Give ``table``'s name to ``new``; what had it before is dropped last."""
    old = sibling(table, f"__old{uuid.uuid4().hex}")
    _rename(spark, table, old)
    try:
        _rename(spark, new, table)
    except Exception:
        _rename(spark, old, table)
        raise
    spark.sql(f"DROP TABLE {old}")


def _rename(spark: SparkSession, table: str, new: str) -> None:
    # The new name may not repeat the catalog.
    spark.sql(f"ALTER TABLE {table} RENAME TO {'.'.join(quoted(p) for p in _parts(new)[-2:])}")


def _parts(table: str) -> list[str]:
    """The parts of a dotted, possibly quoted name."""
    return [p[1:-1].replace("``", "`") if p[0] == "`" else p
            for p in re.findall(r"`(?:[^`]|``)+`|[^.`]+", table)]


def sibling(table: str, suffix: str) -> str:
    """The name of a table beside ``table``: its name with a suffix."""
    *qualifier, name = _parts(table)
    return ".".join(quoted(p) for p in [*qualifier, name + suffix])


def merge(
    source: DataFrame,
    table: str,
    on: str | Sequence[str],
    update: Mapping[str, str] | None = None,
    insert: Mapping[str, str] | None = None,
    update_condition: str | None = None,
    stage: bool = True,
    evolve: bool = True,
) -> bool:
    """Merge into a table; True if anything was written. An empty source changes nothing.

    The source is staged once, because several steps read it; pass ``stage=False`` for a source that is
    a written table already. If the table is partitioned by merge
    keys, only the partitions the source touches are rewritten, and only those within the range of its values are
    read. Columns that only the source has are added to the table, or refused without ``evolve``; they are left out
    where ``update`` and ``insert`` both say what is written.
    """
    spark = source.sparkSession
    if stage:
        source = staged(source, "merge-source")
    if source.isEmpty():
        return False
    info = table_info(spark, table)
    if info.transactional:
        _merge_natively(source, table, on, update, insert, update_condition)
        return True
    if update is None or insert is None:
        add_missing_columns(source, table, evolve)
    target = spark.table(table)
    source = named_as(source, target)
    match = Match.on(on)
    staged_source, loose, one_match = source, None, False
    repeated = repeated_keys(source, match.source_keys)
    if not repeated.isEmpty():
        repeated = staged(repeated, "merge-repeated")
        if not ambiguous_matches(target, source, on, update_condition, repeated).isEmpty():
            raise AmbiguousMerge(f"several source rows match one row of {table}")
        if match.only_pairs and update_condition is None:
            # Keys that repeat are now known to be new: their rows, however many, need no join with the target.
            loose = source.join(repeated, match.source_keys, "left_semi")
            source = source.join(repeated, match.source_keys, "left_anti")
        else:
            one_match = True

    def merged(rows: DataFrame) -> DataFrame:
        result = upserted(rows, source, on, update, insert, update_condition, one_match)
        inserting = loose is not None and (insert is None or insert)
        return result.unionByName(as_inserts(target, loose, insert)) if inserting else result

    if info.partitions and all(_stays_in_place(p, match, update, insert) for p in info.partitions):
        part = _touched(target, staged_source, info.partitions)
        rewritten = staged(merged(part), "merge-result")
        # By path: an insert by table name ignores the option and would empty the other partitions.
        (_balanced(rewritten, info.partitions)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*info.partitions).parquet(info.location))
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
    else:
        overwrite(merged(target), table, info.partitions)
    return True


def _stays_in_place(partition: str, match: Match, update, insert) -> bool:
    """True if merged rows land in the partition of the source row: the column is a merge key, no update
    changes it, and inserts take it from the source."""
    own = (f"src.{partition}", f"src.{quoted(partition)}")
    kept = update is None or update.get(partition, own[0]) in own
    taken = insert is None or not insert or insert.get(partition) in own
    return (partition, partition) in match.pairs and kept and taken


def _merge_natively(source, table, on, update, insert, update_condition) -> None:
    view = f"stratum_merge_{uuid.uuid4().hex}"
    source.createOrReplaceTempView(view)
    try:
        spark = source.sparkSession
        spark.sql(merge_text(spark.table(table).columns, source.columns, table, view, on, update, insert, update_condition))
    finally:
        source.sparkSession.catalog.dropTempView(view)


def merge_text(columns: Sequence[str], source_columns: Sequence[str], table: str, view: str, on: str | Sequence[str],
               update: Mapping[str, str] | None = None, insert: Mapping[str, str] | None = None,
               update_condition: str | None = None) -> str:
    """The merge as one SQL statement, in which the conditions' names for both sides are the statement's own."""
    have = {c.lower(): c for c in source_columns}
    shared = {c: f"src.{quoted(have[c.lower()])}" for c in columns if c.lower() in have}
    update, insert = (shared if m is None else m for m in (update, insert))
    text = f"MERGE INTO {table} AS tgt USING {quoted(view)} AS src ON {Match.on(on).condition}"
    if update:
        condition = f" AND ({update_condition})" if update_condition else ""
        text += f" WHEN MATCHED{condition} THEN UPDATE SET " + ", ".join(
            f"tgt.{quoted(c)} = {value}" for c, value in update.items())
    if insert:
        text += (f" WHEN NOT MATCHED THEN INSERT ({', '.join(map(quoted, insert))}) "
                 f"VALUES ({', '.join(insert.values())})")
    return text


def _touched(target: DataFrame, source: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The target's rows in the partitions the source has rows for, a NULL partition among them.

    The range of each column prunes partitions before reading; the join with the distinct values is exact.
    """
    values = source.select([ref(p).cast(target.schema[p].dataType).alias(f"__t{i}") for i, p in enumerate(partitions)])
    ends = values.agg(*[f(f"__t{i}").alias(f"{name}{i}") for i in range(len(partitions))
                        for name, f in (("low", F.min), ("high", F.max), ("known", F.count))],
                      F.count(F.lit(1)).alias("rows")).first()
    part = target
    for i, name in enumerate(partitions):
        inside = F.lit(False) if ends[f"low{i}"] is None else ref(name).between(ends[f"low{i}"], ends[f"high{i}"])
        part = part.where(inside | ref(name).isNull() if ends[f"known{i}"] < ends["rows"] else inside)
    same = [ref(p).eqNullSafe(F.col(f"__t{i}")) for i, p in enumerate(partitions)]
    return part.join(values.distinct(), same, "left_semi")


def replace_view(spark: SparkSession, view: str, select: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {select}")


def _balanced(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """For partitioned output bring equal partition values together, so that each task writes few
    files; adaptive execution splits the values that are too large for one task."""
    return df.hint("rebalance", *[ref(p) for p in partitions]) if partitions else df


def drop_old_versions(spark: SparkSession, table: str, older_than: dt.timedelta = dt.timedelta(days=7)) -> list[str]:
    """Remove the folders that overwrites of ``table`` left behind, if nothing was written there for so long.

    The age has to exceed the longest run that may still read an earlier version.
    """
    current = table_info(spark, table).location.rstrip("/")
    if not _VERSION.search(current):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(current)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    limit = (dt.datetime.now(dt.timezone.utc) - older_than).timestamp() * 1000
    base = _VERSION.sub("", path.getName())
    gone = []
    for status in files.listStatus(path.getParent()):
        name = status.getPath().getName()
        # The first copy has the bare name.
        version = _VERSION.sub("", name) == base and name != path.getName()
        if version and status.getModificationTime() < limit:
            remove(spark, status.getPath().toString())
            gone.append(name)
    return gone


def _new_version(location: str) -> str:
    return _VERSION.sub("", location.rstrip("/")) + f"__v{uuid.uuid4().hex}"


def _default_location(spark: SparkSession, table: str) -> str:
    *qualifier, name = _parts(table)
    database = qualifier[-1] if qualifier else spark.catalog.currentDatabase()
    folder = spark.sql(f"DESCRIBE DATABASE {quoted(database)}").where("info_name = 'Location'").first()[1]
    return f"{folder.rstrip('/')}/{name}"


def _sql_text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")
