"""The order rows are written in, so that filters on any of several columns skip most row groups.

Each column is cut into intervals that hold about equally many rows. The bits of a row's interval numbers are interleaved
into one key, and rows are range-partitioned and sorted by it: rows near each other in all columns land in the same row
groups, whose least and largest values Spark's reader compares with a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from stratum.quoting import resolve

_KEY = "__place"
#: Bytes of a text that decide its interval.
_PREFIX = 6


def clustered(df: DataFrame, columns: Sequence[str], bits: int = 8) -> DataFrame:
    """``df`` in the order of the interleaved key of ``columns``; rows and columns stay as they are.

    The intervals' ends come from one aggregate over ``df``, at most 2^bits - 1 numbers a column; write ``df`` out first
    if it is costly. NULLs come first. Texts are told apart by their first bytes.
    """
    if not columns or bits < 1 or bits * len(columns) > 62:
        raise ValueError("clustering needs columns, and no more than 62 bits for all of them")
    measures = [_number(df, c) for c in columns]
    steps = [F.lit(i / 2 ** bits) for i in range(1, 2 ** bits)]
    ends = df.agg(*(F.percentile_approx(m, F.array(*steps), 100 * 2 ** bits).alias(f"e{i}") for i, m in enumerate(measures))).first()
    key = F.lit(0).cast("bigint")
    for i, measure in enumerate(measures):
        number = _interval(measure, sorted(set(ends[f"e{i}"] or ())))
        for bit in range(bits):
            key = key + F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(measures) + i)
    return df.withColumn(_KEY, key).repartitionByRange(_KEY).sortWithinPartitions(_KEY).drop(_KEY)


def _number(df: DataFrame, name: str) -> Column:
    """The column as a number in the same order."""
    kind, value = df.select(resolve(df, name)).schema[0].dataType, resolve(df, name)
    if isinstance(kind, (NumericType, BooleanType)):
        return value.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, _PREFIX)), 2 * _PREFIX, "0"), 16, 10).cast("double")
    raise ValueError(f"rows cannot be clustered by {name}, a {kind.simpleString()}")


def _interval(value: Column, ends: Sequence[float]) -> Column:
    """How many of the sorted ``ends`` the value has reached, by a tree of comparisons."""
    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < ends[middle], tree(low, middle)).otherwise(tree(middle + 1, high))

    return F.when(value.isNull(), 0).otherwise(tree(0, len(ends)))
