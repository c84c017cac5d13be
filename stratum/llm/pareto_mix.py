"""Mixing sources to target weights by Pareto order sampling.

Each source has a target number of words. Whole copies that every document is sure of are allotted first; for the
rest, documents are ranked by their random odds divided by their inclusion odds and taken in that order until the
words are reached; the last one is taken in part. The cut in the order is found by counting words per interval of the rank, twice, and by ordering
only the documents of the last interval, so no source is ordered as a whole.

The decision on a document depends on its own values and its source's cut alone, so it can be applied to any copy of
the table without row numbers. Random numbers are hashes of seed, id and text: reruns agree.

Defined results: a NULL text has size 0; documents of size 0 take 0 words. A NULL source is a source of its own and
comes last. Rows alike in id and text are taken alike. If all sizes are 0, all targets are 0. An empty table gives an
empty result. A weight that is NULL or not positive counts as 0: the document is never taken. Extra columns are kept by
``mixed``; one that has the name of a result column gives way to it.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratum.llm.common import WORD_SQL
from stratum.scratch import staged

INTERVALS = 1024
LEVELS = 2


@dataclasses.dataclass(frozen=True)
class Plan:
    """Weights are dealt to the sources in their order, repeating; ``share`` of all words is mixed."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.0
    most_copies: int = 3
    seed: int = 7


def described(docs: DataFrame, source: str, weight: str | None, plan: Plan) -> DataFrame:
    """(__source, __size, __weight, __u) beside the columns of ``docs``."""
    # 52 bits of a hash, as a number strictly between 0 and 1.
    digest = F.md5(F.concat_ws("|", F.lit(str(plan.seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                               F.coalesce("text", F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    own = F.lit(1.0) if weight is None else F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    return docs.withColumns({
        "__source": F.col(source), "__weight": own, "__u": u,
        "__size": F.coalesce(F.regexp_count("text", F.lit(WORD_SQL)), F.lit(0)).cast("long")})


def ordered_numbers(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``number``, its rows' places from 0 in the order given; written. No task orders it all."""
    ordered = staged(df.orderBy(*order).withColumns(
        {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "ordered")
    parts = ordered.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first")).orderBy("part").collect()
    before, offsets = 0, []
    for row in parts:  # one row for each partition
        offsets.append((row.part, row.first, before))
        before += row.n
    table = df.sparkSession.createDataFrame(offsets, "part int, first long, before long")
    return ordered.join(table, "part").withColumn("number", F.col("at") - F.col("first") + F.col("before")).drop(
        "part", "at", "first", "before")


def targets(narrow: DataFrame, plan: Plan) -> DataFrame:
    """(of_source, source_size, target): shares by weight, none above its limit, the excess reshared by weight."""
    sums = narrow.groupBy(F.col("__source").alias("of_source")).agg(F.sum("__size").alias("source_size"))
    numbered = ordered_numbers(sums, F.col("of_source").asc_nulls_last())
    weights = F.array(*map(F.lit, plan.weights))
    sources = staged(numbered.select(
        "of_source", "source_size",
        F.element_at(weights, (F.col("number") % len(plan.weights) + 1).cast("int")).cast("double").alias("weight")), "sources")
    limit = F.col("source_size") * float(plan.most_copies)
    first = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total = (first["size"] or 0) * plan.share
    level, full = (total / first["weight"] if first["weight"] else 0.0), -1
    while True:  # each round fills at least one more source
        above = F.col("weight") * level > limit
        row = sources.agg(F.count_if(above).alias("full"), F.sum(F.when(above, limit)).alias("used"),
                          F.sum(F.when(~above, F.col("weight"))).alias("free")).first()
        if row.full == full or not row.free:
            break
        full, level = row.full, (total - (row.used or 0.0)) / row.free
    return sources.select("of_source", "source_size", F.least(F.col("weight") * level, limit).alias("target"))


def with_source(df: DataFrame, sources: DataFrame) -> DataFrame:
    return df.join(sources, F.col("__source").eqNullSafe(F.col("of_source")), "left").drop("of_source")


def expected_copies(plan: Plan) -> Column:
    return F.least(F.col("factor") * F.col("__weight"), F.lit(float(plan.most_copies)))


def factors(narrow: DataFrame, sources: DataFrame, weighted: bool, plan: Plan) -> DataFrame:
    """``sources`` with ``factor``: expected copies of a document are factor times weight, at most the limit."""
    plain = sources.withColumn("factor", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                               .otherwise(0.0))
    if not weighted:
        return plain
    most, current, full = float(plan.most_copies), plain.withColumn("factor", F.lit(0.0)), -1
    while True:
        above = F.col("factor") * F.col("__weight") >= most
        sums = with_source(narrow, current).groupBy(F.col("__source").alias("s")).agg(
            F.sum(F.when(above, F.col("__size") * most).otherwise(0.0)).alias("used"),
            F.sum(F.when(above, 0.0).otherwise(F.col("__size") * F.col("__weight"))).alias("free"),
            F.count_if(above).alias("full"))
        current = staged(
            current.join(sums, F.col("of_source").eqNullSafe(F.col("s")))
            .withColumn("factor", F.when(F.col("free") > 0, (F.col("target") - F.col("used")) / F.col("free"))
                        .otherwise(F.col("factor")))
            .select("of_source", "source_size", "target", "factor", "full"), "factors")
        now = current.agg(F.sum("full")).first()[0] or 0
        current = current.drop("full")
        if now == full:
            return current
        full = now


def rank_columns(df: DataFrame, plan: Plan) -> DataFrame:
    """Certain copies, and the Pareto rank among the others scaled to 0..1 (1: not to be taken)."""
    copies = expected_copies(plan)
    p = copies - F.floor(copies)
    odds = F.col("__u") * (1 - p)
    return df.withColumns({"whole": F.floor(copies), "rank": F.when(p > 0, odds / (odds + (1 - F.col("__u")) * p))
                           .otherwise(1.0)})


def cuts(narrow: DataFrame, sources: DataFrame, plan: Plan) -> DataFrame:
    """(of_source, low, cut, last): documents ranked below ``low`` or ``cut`` get one more copy, that at ``cut`` so many words."""
    ranked = staged(rank_columns(with_source(narrow, sources), plan)
                    .select("__source", "__size", "whole", "rank", "target"), "ranked")
    wanted = (
        ranked.groupBy("__source").agg(F.first("target").alias("target"),
                                       F.sum(F.col("whole") * F.col("__size")).alias("certain"))
        .select(F.col("__source").alias("of_source"), (F.col("target") - F.col("certain")).alias("wanted"),
                F.lit(0.0).alias("low"), F.lit(1.0).alias("width"), F.lit(0).cast("long").alias("before"))
    )
    open_part = ranked.filter("rank < 1").drop("target")
    for level in range(LEVELS):
        wanted = staged(wanted, f"cut-{level}")
        inside = with_source(open_part, wanted).filter("rank >= low and rank < low + width")
        step = F.col("width") / INTERVALS
        sums = (
            inside.withColumn("interval", F.least(F.floor((F.col("rank") - F.col("low")) / step), F.lit(INTERVALS - 1)))
            .groupBy("__source", "interval").agg(F.sum("__size").alias("words"))
        )
        running = F.sum("words").over(W.partitionBy("__source").orderBy("interval"))
        crossing = (
            with_source(sums.withColumn("running", running), wanted)
            .filter(F.col("before") + F.col("running") > F.col("wanted"))
            .groupBy("__source").agg(F.min_by(F.struct("interval", (F.col("running") - F.col("words")).alias("earlier")),
                                              "interval").alias("at"))
        )
        wanted = (
            wanted.join(crossing, F.col("of_source").eqNullSafe(F.col("__source")), "left")
            .select("of_source", "wanted",
                    F.when(F.col("at").isNull(), F.col("low") + F.col("width"))
                    .otherwise(F.col("low") + F.col("at.interval") * step).alias("low"),
                    F.when(F.col("at").isNull(), 0.0).otherwise(step).alias("width"),
                    (F.col("before") + F.coalesce("at.earlier", F.lit(0))).alias("before"))
        )
    wanted = staged(wanted, "cuts")
    inside = with_source(open_part, wanted).filter("rank >= low and rank < low + width")
    by_source = W.partitionBy("__source").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    taken = (
        inside.withColumn("earlier", F.col("before") + F.coalesce(F.sum("__size").over(by_source), F.lit(0)))
        .filter(F.col("earlier") < F.round("wanted"))
        .groupBy("__source").agg(F.max_by(F.struct(
            "rank", F.least(F.col("__size"), (F.round("wanted") - F.col("earlier")).cast("long")).alias("words")), "rank")
            .alias("cut"))
    )
    return staged(wanted.join(taken, F.col("of_source").eqNullSafe(F.col("__source")), "left")
                  .select("of_source", "low", F.col("cut.rank").alias("cut"), F.col("cut.words").alias("last")), "cut")


def mixed(docs: DataFrame, source: str = "source", weight: str | None = None, plan: Plan = Plan()) -> DataFrame:
    """``docs`` with size, source_size, target and taken (words taken of the document, copies counted)."""
    narrow = ["__source", "__size", "__weight", "__u"]
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")  # apart from the names used here
    every = described(docs, source, weight, plan).select(own, *narrow)
    found = decided(every, staged(every.select(*narrow), "sizes"), weight is not None, plan)
    return found.select(*(F.col("__row").getField(c).alias(c) for c in docs.columns if c not in RESULT), *RESULT)


RESULT = ("size", "source_size", "target", "taken")


def decided(every: DataFrame, narrow: DataFrame, weighted: bool, plan: Plan) -> DataFrame:
    sources = staged(factors(narrow, targets(narrow, plan), weighted, plan), "mix-sources")
    found = cuts(narrow, sources, plan)
    ranked = rank_columns(with_source(every, sources), plan)
    cut = F.coalesce("cut", F.lit(-1.0))
    one_more = (F.col("rank") < 1) & ((F.col("rank") < F.col("low")) | (F.col("rank") < cut))
    more = F.when(one_more, F.col("__size")).when(F.col("rank") == cut, F.col("last")).otherwise(0)
    return with_source(ranked, found).withColumns({"size": F.col("__size"), "taken": F.col("__size") * F.col("whole") + more})


def report(docs: DataFrame, source: str = "source", weight: str | None = None, plan: Plan = Plan()) -> DataFrame:
    """doc_id, size, source_size, target and taken of each row."""
    kept = ["doc_id", "__source", "__size", "__weight", "__u"]
    narrow = staged(described(docs, source, weight, plan).select(*kept), "sizes")
    return decided(narrow, narrow, weight is not None, plan).select(F.col("doc_id").cast("long").alias("doc_id"), *RESULT)
