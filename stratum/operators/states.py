"""Aggregates kept as states that later rows can be merged into.

A metric is ``{name, function, of}``: ``sum``, ``count``, ``min``, ``max``, ``avg`` or ``approx_distinct`` of an expression
(``count`` without one counts rows). Its state is one or two columns; states of two sets of rows merge into that of both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.quoting import ref, resolve

# For each function: its state's columns as (suffix, over rows, over states), and the value of a state.
_FUNCTIONS = {
    "sum": ((("", F.sum, F.sum),), lambda s: s[0]),
    "count": ((("", F.count, F.sum),), lambda s: F.coalesce(s[0], F.lit(0).cast("bigint"))),
    "min": ((("", F.min, F.min),), lambda s: s[0]),
    "max": ((("", F.max, F.max),), lambda s: s[0]),
    "avg": ((("__sum", F.sum, F.sum), ("__count", F.count, F.sum)), lambda s: s[0] / F.nullif(s[1], F.lit(0))),
    "approx_distinct": ((("__sketch", F.hll_sketch_agg, F.hll_union_agg),),
                        lambda s: F.coalesce(F.hll_sketch_estimate(s[0]), F.lit(0).cast("bigint"))),
}

Metric = Mapping[str, str]


def _parts(metric: Metric):
    function = metric["function"]
    if function not in _FUNCTIONS:
        raise ValueError(f"no mergeable state for {function}; known are {', '.join(_FUNCTIONS)}")
    return _FUNCTIONS[function]


def state_columns(metrics: Sequence[Metric]) -> list[str]:
    return [m["name"] + suffix for m in metrics for suffix, *_ in _parts(m)[0]]


def states(df: DataFrame, group_by: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """The states of the rows of ``df``, one row per group."""
    def value(metric: Metric) -> Column:
        return F.expr(metric["of"]) if metric.get("of") else F.lit(1)

    return df.groupBy([resolve(df, c).alias(c) for c in group_by]).agg(*(
        over_rows(value(m)).alias(m["name"] + suffix) for m in metrics for suffix, over_rows, _ in _parts(m)[0]))


def merged_states(df: DataFrame, group_by: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """States of the same groups as one; the columns keep their types."""
    merged = df.groupBy([ref(c) for c in group_by]).agg(*(
        over_states(ref(m["name"] + suffix)).alias(m["name"] + suffix) for m in metrics for suffix, _, over_states in _parts(m)[0]))
    return merged.select([ref(f.name).cast(f.dataType).alias(f.name) for f in df.schema.fields])


def values(df: DataFrame, group_by: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """The metrics of states."""
    return df.select(*(ref(c) for c in group_by), *(
        finish([ref(m["name"] + suffix) for suffix, *_ in columns]).alias(m["name"])
        for m in metrics for columns, finish in [_parts(m)]))
