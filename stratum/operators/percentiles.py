"""Exact percentiles of groups of any size.

Spark's exact percentile holds a group's values in one task. Here a sketch bounds each percentile first: it tells two
values between which the wanted ranks must lie, a fixed share of the group apart. Rows are then counted per value inside
these bounds and as one number below them, on the map side, and only the counts of one narrow interval are put in order
by one task, whatever share of all rows the group or a single value holds. Groups up to a size need no sketch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.quoting import ref, resolve
from stratum.scratch import staged

_GROUP, _VALUE, _WHICH, _LOW, _HIGH, _ROWS, _SEEN = "__g", "__v", "__p", "__lo", "__hi", "__n", "__cum"


def percentiles(df: DataFrame, group_by: Sequence[str], column: str, fractions: Mapping[str, float],
                whole_group: int = 100_000, accuracy: int = 100_000) -> DataFrame:
    """One row per group with a double column for each name in ``fractions``, interpolated between neighbouring values.

    NULLs do not count; a group without other values gets NULLs. NULL is a group. Without ``group_by`` the table is one
    group. Groups of more than ``whole_group`` values are narrowed by a sketch of the given accuracy: an interval then
    holds about eight rows in ``accuracy``. Where counting shows that a sketch was too far off, the whole group is counted
    by value. The group and value columns are written once, as they are read several times.
    """
    if not fractions or not all(0 <= p <= 1 for p in fractions.values()):
        raise ValueError("percentiles need fractions between 0 and 1")
    names, shares = list(fractions), [float(p) for p in fractions.values()]
    keys = [resolve(df, c) for c in group_by]
    group = F.struct(*(k.alias(f"k{i}") for i, k in enumerate(keys))) if keys else F.struct(F.lit(0).alias("k0"))
    rows = staged(df.select(group.alias(_GROUP), resolve(df, column).alias(_VALUE)), "percentile-values")
    bounds = staged(_bounds(rows, shares, whole_group, accuracy), "percentile-bounds")
    found = staged(_chosen(rows, bounds), "percentile-places")
    missed = found.where("not __inside").select(_GROUP, _WHICH)
    if not missed.isEmpty():
        wider = bounds.join(missed, [_GROUP, _WHICH], "left_semi").withColumns({_LOW: ref("__min"), _HIGH: ref("__max")})
        found = found.where("__inside").unionByName(_chosen(rows, wider))
    wide = found.groupBy(_GROUP).agg(*(
        F.max(F.when(ref(_WHICH) == i, ref("__value"))).alias(f"__r{i}") for i in range(len(names))))
    groups = rows.groupBy(_GROUP).agg(F.count(F.lit(1)).alias(_ROWS))
    kept = [ref(_GROUP)[f"k{i}"].alias(c) for i, c in enumerate(group_by)]
    result = groups.select(_GROUP).join(wide, _GROUP, "left")
    if not keys:
        result = wide.groupBy().agg(*(F.max(ref(f"__r{i}")).alias(f"__r{i}") for i in range(len(names))))
    return result.select(*kept, *(ref(f"__r{i}").alias(name) for i, name in enumerate(names)))


def _bounds(rows: DataFrame, shares: Sequence[float], whole_group: int, accuracy: int) -> DataFrame:
    """(group, which, n, low, high): values between which the wanted ranks of each group lie."""
    known = rows.where(ref(_VALUE).isNotNull())
    sizes = known.groupBy(_GROUP).agg(F.count(F.lit(1)).alias(_ROWS), F.min(_VALUE).alias("__min"), F.max(_VALUE).alias("__max"))
    sizes = staged(sizes, "percentile-groups")
    # A sketch's ranks are off by one row in ``accuracy``, and by more after merging.
    margin = 4 / accuracy
    ends = [min(1.0, max(0.0, p + d)) for p in shares for d in (-margin, margin)]
    large = known.join(sizes.where(ref(_ROWS) > whole_group).select(_GROUP), _GROUP, "left_semi")
    sketch = large.groupBy(_GROUP).agg(F.percentile_approx(_VALUE, ends, accuracy).alias("__ends"))
    low = F.when(ref("__ends").isNull(), ref("__min")).otherwise(ref("__ends")[2 * ref(_WHICH)])
    high = F.when(ref("__ends").isNull(), ref("__max")).otherwise(ref("__ends")[2 * ref(_WHICH) + 1])
    place = F.array(*map(F.lit, shares))[ref(_WHICH)] * (ref(_ROWS) - 1)
    return (
        sizes.join(sketch, _GROUP, "left").withColumn(_WHICH, F.explode(F.sequence(F.lit(0), F.lit(len(shares) - 1))))
        .select(_GROUP, _WHICH, place.alias("__place"), low.alias(_LOW), high.alias(_HIGH), "__min", "__max")
    )


def _chosen(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """(group, which, value, inside): the values at the wanted places, and whether the bounds held them."""
    met = rows.where(ref(_VALUE).isNotNull()).join(bounds, _GROUP).where(ref(_VALUE) <= ref(_HIGH))
    # All rows below the interval are one count, under NULL, which comes first.
    inside = F.when(ref(_VALUE) >= ref(_LOW), ref(_VALUE))
    counts = met.groupBy(_GROUP, _WHICH, "__place", inside.alias(_VALUE)).agg(F.count(F.lit(1)).alias(_ROWS))
    in_order = Window.partitionBy(_GROUP, _WHICH).orderBy(ref(_VALUE).asc_nulls_first())
    counts = counts.withColumn(_SEEN, F.sum(_ROWS).over(in_order))
    lower, upper = F.floor("__place"), F.ceil("__place")

    def at(rank: Column) -> Column:
        return F.min(F.when(ref(_SEEN) > rank, F.struct(ref(_SEEN), ref(_VALUE))))[_VALUE].cast("double")

    ends = counts.groupBy(_GROUP, _WHICH, "__place").agg(at(lower).alias("__a"), at(upper).alias("__b"))
    part = ref("__place") - lower
    return ends.select(_GROUP, _WHICH, (ref("__a") + (ref("__b") - ref("__a")) * part).alias("__value"),
                       (ref("__a").isNotNull() & ref("__b").isNotNull()).alias("__inside"))
