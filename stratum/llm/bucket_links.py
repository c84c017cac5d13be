"""Links between members of buckets, without forming all pairs of a bucket.

Members that an operator wants compared meet in buckets. Each round, some members of a bucket are its centres; a centre
is compared with the members not connected with it yet, and then leaves the bucket. A bucket is done when its members are
all connected, or have all been centres: then every pair of them was compared or had no need to be. There is one centre
in the first round, and sixteen times as many in each further one. In the second round they are members of the bucket's
largest component, which others are most likely to be linked with; after it those of the smallest components, which are
done soonest. Components are brought up to date after each round, so members that are connected are not compared again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratum.llm.common import mapped_rows
from stratum.llm.components import components, few
from stratum.scratch import staged


#: Times as many centres in each round as in the one before.
STEP = 16


def first_round(buckets: DataFrame) -> DataFrame:
    """(bucket, member, n, centre, of_n): members that are no centres, each with the one centre of its bucket."""
    centres = buckets.groupBy("bucket").agg(F.min(F.struct("member", "n")).alias("first")).select(
        F.col("bucket").alias("of_bucket"), F.col("first.member").alias("centre"), F.col("first.n").alias("of_n"))
    return buckets.join(centres, F.col("bucket") == F.col("of_bucket")).filter("member != centre").drop("of_bucket")


def ranked(members: DataFrame, largest: bool) -> DataFrame:
    """``members`` of the buckets that are not done, with their rank among those that may become centres."""
    bucket = W.partitionBy("bucket")
    order = F.desc("size") if largest else F.asc("size")
    return (
        members.withColumn("low", F.min("label").over(bucket)).withColumn("high", F.max("label").over(bucket))
        .filter("low != high").withColumn("size", F.count("*").over(W.partitionBy("bucket", "label")))
        .withColumn("rank", F.row_number().over(bucket.orderBy(order, "label", "member")))
        .select("bucket", "member", "n", "label", "rank")
    )


def connected(buckets: DataFrame, texts: DataFrame, near: Callable[[Column, Column], Column],
              confirm: Callable) -> DataFrame:
    """(member, label) for buckets (bucket, member, n): the smallest member each is connected with.

    ``near`` says of two values of n whether members can be linked at all; ``confirm(a, b, text_a, text_b)`` gives
    (a, b) if they are. ``texts`` has member and text.
    """
    labels = staged(buckets.select("member", F.col("member").alias("label")).distinct(), "labels")
    tested, count = None, 1
    while True:
        if count == 1:
            open_ = staged(first_round(buckets), "members")
            met = open_.filter(near(F.col("n"), F.col("of_n")))
        else:
            members = staged(ranked(open_.select("bucket", "member", "n").join(labels, "member"), count == STEP), "members")
            centres = members.filter(F.col("rank") <= count).select(
                F.col("bucket").alias("of_bucket"), F.col("member").alias("centre"), F.col("n").alias("of_n"),
                F.col("label").alias("of_label"), F.col("rank").alias("of_rank"))
            # Two centres meet once.
            apart = (F.col("bucket") == F.col("of_bucket")) & (F.col("label") != F.col("of_label")) & (
                F.col("rank") > F.col("of_rank"))
            met = members.join(centres, apart & near(F.col("n"), F.col("of_n")))
            open_ = members.filter(F.col("rank") > count)
        pairs = met.select(F.least("member", "centre").alias("a"), F.greatest("member", "centre").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        if not pairs.isEmpty():
            full = pairs.join(texts.withColumnsRenamed({"member": "a", "text": "text_a"}), "a").join(
                texts.withColumnsRenamed({"member": "b", "text": "text_b"}), "b").select("a", "b", "text_a", "text_b")
            found = staged(mapped_rows(full, "a long, b long", confirm), "confirmed")
            links = found.count()
            labels = joined(labels, found, links) if links else labels
            tested = pairs if tested is None else tested.unionByName(pairs)
        if open_.isEmpty():
            return labels
        count *= STEP


def joined(labels: DataFrame, links: DataFrame, count: int) -> DataFrame:
    """Labels after ``count`` ``links``: the components of what was connected before are the nodes."""
    of = labels.select(F.col("member").alias("a"), F.col("label").alias("label_a"))
    other = labels.select(F.col("member").alias("b"), F.col("label").alias("label_b"))
    between = few(few(links, count).join(of, "a"), count).join(other, "b").select(
        F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    moved = few(components(between), 2 * count)
    return staged(labels.join(moved, F.col("label") == F.col("node"), "left").select(
        "member", F.coalesce("component", "label").alias("label")), "labels")
