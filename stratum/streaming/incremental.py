"""Incremental file ingest: each run takes the files it has not seen before, then stops."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.operators.columns import RunInfo
from stratum.operators.upsert import Match
from stratum.plans.frames import bronze_frame, silver_frame
from stratum.plans.runs import (
    Batch,
    RunResult,
    checked_batch,
    prepare_merge,
    publish_masks,
    record_batch_history,
    record_status,
)
from stratum.quoting import quoted, ref
from stratum.scratch import staged
from stratum.sinks import tables
from stratum.sources.listing import exists, names_in, source_columns, touched
from stratum.spec import PipelineSpec, SourceSpec, TargetSpec

BATCH = "ingest_batch"
DAY = "ingest_day"


def new_files(spark: SparkSession, path: str, file_format: str, schema: StructType | str,
              options: Mapping[str, object] | None = None, path_column: str = "") -> DataFrame:
    """Streaming file scan with the file name attached, and the file's path if a column is named for it.

    Reader options such as ``maxFilesPerTrigger`` and ``pathGlobFilter`` pass through.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**dict(options or {}))
    return reader.load(path).select("*", *source_columns(path_column))


def drain(stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None]) -> None:
    """Hand all new files to ``each_batch``, one micro-batch after the other, and stop."""
    query = (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_name(batch: DataFrame, number: int) -> str:
    """Unique among all batches of all streams, and the same when a batch is replayed."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    return f"{stream}-{number}"


def batch_writer(spec: PipelineSpec, info: RunInfo, started: dt.datetime, ledger: str) -> Callable[[DataFrame, int], None]:
    """Loads one batch as the spec says: rows, failures of the rules and load history, each once.

    The ``ledger`` is a folder with a mark for each batch that was begun and each that is done. One that is done is left
    alone. One that was begun, in a run that failed, is loaded again: its rows replace themselves, and what it had recorded
    in the audit tables, where its name stands beside its rows, is not recorded twice.
    """
    target, current = spec.target, []

    def transform(rows: DataFrame) -> DataFrame:
        if spec.layer == "bronze":
            return bronze_frame(rows, spec, info)
        return checked_batch(silver_frame(rows, spec), spec, info, current[-1])

    if target.mode == "merge":
        writer = merge_batches(target.table, target.on, transform, target.location, update=target.update,
                               insert=target.insert, update_condition=target.update_condition,
                               evolve=target.schema_evolution)
    elif target.mode == "append" and target.location:
        writer = append_batches(target.location, transform)
    else:
        raise ValueError("an incremental run appends to a location or merges into a table")

    def write(rows: DataFrame, number: int) -> None:
        spark, name = rows.sparkSession, batch_name(rows, number)
        begun, done = f"{ledger}/{name}.begun", f"{ledger}/{name}.done"
        if exists(spark, done):
            return
        batch = Batch(name, BATCH, exists(spark, begun))
        touched(spark, begun)
        current[:] = [batch]
        writer(rows, number)
        if spec.audit.load_history:
            loaded = spark.read.option("basePath", target.location).parquet(f"{target.location}/{BATCH}={name}") if exists(
                spark, f"{target.location}/{BATCH}={name}") else rows.limit(0)
            record_batch_history(spec, started, rows, loaded, batch)
        touched(spark, done)

    return write


def compacted(spark: SparkSession, path: str, day_column: str, into: str) -> int:
    """Bring the batches of a folder that ``append_batches`` fills into ``into``, partitioned by day; their number.

    A partition of a day is rewritten with the rows it had and those of the new batches, whose names stay beside the rows.
    Batches that are in are marked beside the days. A run that ended before that is repeated: the rows of its batches
    replace those it had written. Days without new rows keep their files. Batches stay in ``path``; drop the partitions
    that are marked when no reader needs them any more.
    """
    marks = f"{into.rstrip('/')}/_compacted"
    known = set(names_in(spark, marks)) if exists(spark, marks) else set()
    names = [n for n in (unquote(f.removeprefix(f"{BATCH}=")) for f in names_in(spark, path) if f.startswith(f"{BATCH}=")) if n not in known]
    if not names:
        return 0
    taken = spark.createDataFrame([(n,) for n in names], f"{BATCH} string")
    day = F.coalesce(F.to_date(ref(day_column)).cast("string"), F.lit("unknown")).alias(DAY)
    batches = spark.read.option("mergeSchema", "true").parquet(path)
    new = staged(batches.where(ref(BATCH).isin(names)).select("*", day), "new-batches")
    rows = new
    if exists(spark, into) and any(f.startswith(f"{DAY}=") for f in names_in(spark, into)):
        days = [r[0] for r in new.select(DAY).distinct().collect()]  # days with new rows
        kept = spark.read.option("mergeSchema", "true").parquet(into).withColumn(DAY, ref(DAY).cast("string"))
        kept = kept.where(ref(DAY).isin(days)).join(taken, BATCH, "left_anti")
        rows = staged(kept.unionByName(new, allowMissingColumns=True), "days")
    (rows.hint("rebalance", ref(DAY)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY).parquet(into))
    for name in names:
        touched(spark, f"{marks}/{name}")
    return len(names)


def append_batches(path: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                   ) -> Callable[[DataFrame, int], None]:
    """Batch writer that appends to a folder partitioned by stream and batch number.

    A batch that is replayed after a failure overwrites its own partition, so no row is written twice.
    The stream's id is kept in its checkpoint: a stream with a new checkpoint starts new partitions.
    """
    def write(batch: DataFrame, number: int) -> None:
        (transform(batch).withColumn(BATCH, F.lit(batch_name(batch, number)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH).parquet(path))

    return write


def merge_batches(table: str, on, transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                  location: str | None = None, **merge_options) -> Callable[[DataFrame, int], None]:
    """Batch writer that merges by key; replaying a batch changes nothing. The first batch creates the
    table if there is none, at ``location`` if given, and is merged into it.

    A row with a NULL key matches nothing, so a replay would insert it again: such a batch is refused.
    """
    keys = Match.on(on).source_keys
    shape = TargetSpec(table, mode="merge", insert=merge_options.get("insert"), location=location)

    def write(batch: DataFrame, number: int) -> None:
        rows = staged(transform(batch), "merge-batch")
        if not rows.where(" OR ".join(f"{quoted(k)} IS NULL" for k in keys)).isEmpty():
            raise ValueError(f"NULL in {', '.join(keys)}: an incremental merge into {table} needs complete keys")
        prepare_merge(rows, shape)
        tables.merge(rows, table, on, stage=False, **merge_options)

    return write


def kept_schema(spark: SparkSession, source: SourceSpec, checkpoint: str) -> StructType:
    """The schema of the files present at the first run, kept beside the checkpoint for all further runs."""
    place = f"{checkpoint.rstrip('/')}_schema"
    if not exists(spark, place):
        found = spark.read.format(source.format).options(**source.options).load(source.path).schema
        spark.createDataFrame([(found.json(),)], "schema string").coalesce(1).write.text(place)
    return StructType.fromJson(json.loads(spark.read.text(place, wholetext=True).where("value <> ''").first()[0]))


def run_incremental(spark: SparkSession, spec: PipelineSpec, info: RunInfo, checkpoint: str) -> None:
    """Run a bronze or silver spec over the files that are new since the last run.

    Append targets are folders of batches (``destination.location``), registered as a table; merge
    targets are tables. Silver rules are applied to each batch. A replayed batch changes no table (``batch_writer``);
    the ledger for that is kept beside the checkpoint. Without a schema in the spec, so is that of the files present at
    the first run. Settings an incremental run cannot honour are refused.
    """
    source, target = spec.source, spec.target
    if source.kind != "incremental":
        raise ValueError("an incremental run needs an incremental source")
    unsupported = {"audit.load_history of merges": spec.audit.load_history if target.mode == "merge" else None,
                   "destination.corrupt_record": target.corrupt_record,
                   "destination.enable_soft_deletes": target.soft_deletes}
    refused = [name for name, value in unsupported.items() if value]
    if refused:
        raise ValueError(f"not possible in an incremental run: {', '.join(refused)}")

    started = info.started or dt.datetime.now(dt.timezone.utc)
    writer = batch_writer(spec, info, started, f"{checkpoint.rstrip('/')}_ledger")
    schema = source.schema or kept_schema(spark, source, checkpoint)
    stream = new_files(spark, source.path, source.format, schema, source.options, spec.lineage.path)
    try:
        drain(stream, checkpoint, writer)
        if target.mode == "append" and exists(spark, target.location):
            _register(spark, target.table, target.location)
        if spark.catalog.tableExists(target.table):
            # Batches are written by a session of their own; this one may hold the table's earlier location.
            spark.catalog.refreshTable(target.table)
            publish_masks(spark, spec)
    except Exception as problem:
        record_status(spark, spec, info, started, RunResult("failed"), str(problem))
        raise
    record_status(spark, spec, info, started, RunResult("success"), None)


def _register(spark: SparkSession, table: str, location: str) -> None:
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=location, source="parquet")
    spark.catalog.recoverPartitions(table)
