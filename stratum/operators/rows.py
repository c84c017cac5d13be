"""Row filters, deduplication and union."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from stratum.quoting import ref, refs


def where_all(df: DataFrame, conditions: Iterable[str]) -> DataFrame:
    """Rows for which every SQL condition is true."""
    return reduce(lambda acc, sql: acc.filter(F.expr(sql)), conditions, df)


def where_in(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    return df.filter(ref(column).isin(list(values)))


def where_run(df: DataFrame, run_id: str | None, column: str = "run_id") -> DataFrame:
    return df.filter(ref(column).eqNullSafe(F.lit(run_id)))


def where_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(ref(column).isNull())


def where_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(ref(column).isNotNull())


def deduplicated(df: DataFrame, keys: Sequence[str] | None = None,
                 order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Distinct rows, or one row per key: the first by ``order_by``, ties broken by the other columns
    that can be sorted.

    ``row_number() = 1`` keeps one row per key on the map side before the shuffle (Spark's window group
    limit), so a key with a third of all rows costs at most one row per input task.
    """
    if not keys:
        return df.dropDuplicates()
    rank = "__rank"
    order = [_sort_key(o) if isinstance(o, str) else o for o in order_by]
    order += refs(f.name for f in df.schema.fields if f.name not in keys and _sortable(f.dataType))
    window = Window.partitionBy(refs(keys)).orderBy(order or refs(keys))
    return df.withColumn(rank, F.row_number().over(window)).where(ref(rank) == 1).drop(rank)


def _sortable(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return False
    if isinstance(kind, ArrayType):
        return _sortable(kind.elementType)
    return all(_sortable(f.dataType) for f in kind.fields) if isinstance(kind, StructType) else True


def _sort_key(text: str) -> Column:
    """A SQL expression, optionally followed by ``asc`` or ``desc``."""
    direction = re.search(r"\s+(asc|desc)\s*$", text, re.IGNORECASE)
    if not direction:
        return F.expr(text)
    value = F.expr(text[: direction.start()])
    return value.desc() if direction[1].lower() == "desc" else value.asc()


class RemovedRows:
    """Rows dropped between two points of one plan; known after the plan's first action."""

    def __init__(self) -> None:
        self.before = Observation()
        self.after = Observation()

    @property
    def value(self) -> int:
        return self.before.get["rows"] - self.after.get["rows"]


def deduplicated_counted(df: DataFrame, keys: Sequence[str] | None = None,
                         order_by: Sequence[str | Column] = ()) -> tuple[DataFrame, RemovedRows]:
    """As ``deduplicated``, counting the removed rows inside the job that uses the result."""
    removed = RemovedRows()
    seen = df.observe(removed.before, F.count(F.lit(1)).alias("rows"))
    result = deduplicated(seen, keys, order_by)
    return result.observe(removed.after, F.count(F.lit(1)).alias("rows")), removed


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; a column missing on one side is an error."""
    return reduce(DataFrame.unionByName, frames)
