import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.operators.upsert import (
    Match,
    ambiguous_matches,
    bound_of,
    changes_composed,
    diff_applied,
    repeated_keys,
    snapshot_applied,
    snapshot_diff,
    upserted,
)

SCHEMA = "k int, v int, s string"
SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def both_ways(spark, make):
    """Run with the source within and beyond the broadcast threshold: the plans differ, the rows may not."""
    small = values(make())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert values(make()) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return small


def test_default_updates_and_inserts_everything(spark):
    tgt = frame(spark, [(1, 1, "a"), (2, 2, "b"), (None, 3, "c")])
    src = frame(spark, [(2, 20, "B"), (3, 30, "C"), (None, 40, "D")])
    got = both_ways(spark, lambda: upserted(tgt, src, ["k"]))
    # A NULL key matches nothing: the target row stays, the source row is inserted.
    assert got == sorted([(1, 1, "a"), (2, 20, "B"), (3, 30, "C"), (None, 3, "c"), (None, 40, "D")], key=repr)


def test_partial_maps(spark):
    tgt = frame(spark, [(1, 1, "a"), (2, 2, "b")])
    src = frame(spark, [(2, 20, "B"), (3, 30, "C")])
    assert values(upserted(tgt, src, ["k"], update={"v": "tgt.v + src.v"}, insert={})) == [(1, 1, "a"), (2, 22, "b")]
    assert values(upserted(tgt, src, ["k"], update={}, insert={"k": "src.k"})) == [(1, 1, "a"), (2, 2, "b"), (3, None, None)]
    with pytest.raises(ValueError):
        upserted(tgt, src, ["k"], update={"zz": "1"})


def test_source_lacking_a_column(spark):
    tgt = frame(spark, [(1, 1, "a")])
    src = frame(spark, [(1, 10), (2, 20)], "k int, v int")
    assert values(upserted(tgt, src, ["k"])) == [(1, 10, "a"), (2, 20, None)]


def test_update_condition_keeps_the_target_row_and_inserts_nothing(spark):
    tgt = frame(spark, [(1, 1, "a"), (2, 5, "b")])
    src = frame(spark, [(1, 3, "A"), (2, 3, "B")])
    got = both_ways(spark, lambda: upserted(tgt, src, "tgt.k = src.k", update_condition="src.v > tgt.v"))
    assert got == [(1, 3, "A"), (2, 5, "b")]


def test_one_source_row_updates_many_target_rows(spark):
    tgt = frame(spark, [(1, i, "a") for i in range(50)])
    src = frame(spark, [(1, 7, "z")])
    got = both_ways(spark, lambda: upserted(tgt, src, ["k"], update={"s": "src.s"}))
    assert got == sorted([(1, i, "z") for i in range(50)], key=repr)


def test_unmatched_duplicates_are_all_inserted(spark):
    tgt = frame(spark, [(1, 1, "a")])
    src = frame(spark, [(2, 1, "x"), (2, 2, "y")])
    assert ambiguous_matches(tgt, src, ["k"]).isEmpty()
    assert both_ways(spark, lambda: upserted(tgt, src, ["k"])) == [(1, 1, "a"), (2, 1, "x"), (2, 2, "y")]


def test_ambiguity_depends_on_the_update_condition(spark):
    tgt = frame(spark, [(1, 5, "a")])
    src = frame(spark, [(1, 3, "x"), (1, 9, "y")])
    assert not ambiguous_matches(tgt, src, ["k"]).isEmpty()
    assert ambiguous_matches(tgt, src, "tgt.k = src.k", "src.v > tgt.v").isEmpty()
    assert values(upserted(tgt, src, ["k"], update_condition="src.v > tgt.v")) == [(1, 9, "y")]


def test_ambiguous_keys_with_hot_groups_form_no_pairs(spark):
    tgt = spark.range(3000).selectExpr("1 as k", "id as v")
    src = spark.range(3000).selectExpr("1 as k", "id as v").unionByName(spark.range(2).selectExpr("5 as k", "id as v"))
    got = both_ways(spark, lambda: ambiguous_matches(tgt, src, ["k"]))
    assert got == [(1, 3000)]


def test_null_keys_are_never_repeated_keys(spark):
    assert repeated_keys(frame(spark, [(None, 1, "a"), (None, 2, "b")]), ["k"]).isEmpty()


@pytest.mark.parametrize("condition,pairs", [
    ("tgt.a = src.b", (("a", "b"),)),
    ("SRC.b == TGT.a and tgt.x > src.y", (("a", "b"),)),
    ("tgt.`a b` = src.`c``d` AND tgt.e = src.e", (("a b", "c`d"), ("e", "e"))),
    ("tgt.a = src.a AND (tgt.x = 1 OR src.y = 2)", (("a", "a"),)),
    ("(tgt.a = src.a) AND tgt.n <> 'x or (y and z' AND tgt.end = src.end", (("a", "a"), ("end", "end"))),
])
def test_equalities(condition, pairs):
    assert Match.on(condition).pairs == pairs


@pytest.mark.parametrize("condition", ["tgt.a > src.a", "tgt.a = src.a OR tgt.b = src.b", "tgt.a = tgt.b", "tgt.a = 1",
                                       "(tgt.x = 1) OR (tgt.y = 2) AND tgt.a = src.a",
                                       "if(tgt.x = 1 AND tgt.a = src.a AND tgt.y = 2, true, false)",
                                       "case when tgt.x = 1 AND tgt.a = src.a AND tgt.y = 2 then true end"])
def test_conditions_without_equality_are_refused(condition):
    with pytest.raises(ValueError):
        Match.on(condition)


def test_small_source_leaves_the_target_unshuffled(spark):
    tgt = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    src = spark.range(5).selectExpr("id as l_orderkey", "'X' as l_returnflag")
    plan = upserted(tgt, src, ["l_orderkey"], insert={})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_insert_side_reads_only_the_target_keys(spark):
    tgt = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    src = spark.range(5).selectExpr("id as l_orderkey", "'X' as l_returnflag")
    plan = upserted(tgt, src, ["l_orderkey"], update={})._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan


keyed = st.dictionaries(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 3)), max_size=6)


@SLOW
@given(keyed, keyed)
def test_upsert_twice_is_upsert_once(spark, old, new):
    tgt = frame(spark, list(old.items()), "k int, v int")
    src = frame(spark, list(new.items()), "k int, v int")
    once = upserted(tgt, src, ["k"])
    assert values(once) == sorted({**old, **new}.items(), key=repr)
    assert values(upserted(once, src, ["k"])) == values(once)


@SLOW
@given(keyed, keyed)
def test_diff_replays_to_the_new_snapshot(spark, old, new):
    before = frame(spark, list(old.items()), "k int, v int")
    after = frame(spark, list(new.items()), "k int, v int")
    changes = snapshot_diff(before, after, ["k"])
    kinds = {r.k: r.change for r in changes.collect()}
    assert kinds == {
        **{k: "insert" for k in new if k not in old},
        **{k: "delete" for k in old if k not in new},
        **{k: "update" for k in new if k in old and old[k] != new[k]},
    }
    assert values(diff_applied(before, changes, ["k"])) == values(after)


def test_diff_with_null_key_new_column_and_stored_hash(spark):
    before = frame(spark, [(None, 1), (1, 1)], "k int, v int")
    after = frame(spark, [(None, 2), (1, 1)], "k int, v int")
    assert values(snapshot_diff(before, after, ["k"])) == [("update", None, 2)]
    before = frame(spark, [(1, 1, "h"), (2, 1, "h")])
    after = frame(spark, [(1, 9, "h"), (2, 1, "i")])
    assert values(snapshot_diff(before, after, ["k"], hash_column="s")) == [("update", 2, 1, "i")]
    before = frame(spark, [(None, 1, "h"), (3, 1, "gone")])
    after = frame(spark, [(None, 2, "i"), (4, 1, "new")])
    assert values(snapshot_diff(before, after, ["k"], hash_column="s")) == [
        ("delete", 3, 1, "gone"), ("insert", 4, 1, "new"), ("update", None, 2, "i")]
    before = frame(spark, [(1, 1, "h"), (2, 1, "h")])
    wider = frame(spark, [(1, 1, "x"), (2, 1, None)])
    assert values(snapshot_diff(before.drop("s"), wider, ["k"])) == [("update", 1, 1, "x")]


def test_soft_delete_and_return(spark):
    day = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    target = frame(spark, [(1, 1), (2, 2)], "k int, v int")
    first = snapshot_applied(target, frame(spark, [(1, 10), (3, 30)], "k int, v int"), ["k"], day[0])
    assert values(first) == [(1, 10, False, None), (2, 2, True, day[0]), (3, 30, False, None)]
    second = snapshot_applied(first, frame(spark, [(3, 31)], "k int, v int"), ["k"], day[1])
    assert values(second) == [(1, 10, True, day[1]), (2, 2, True, day[0]), (3, 31, False, None)]
    third = snapshot_applied(second, frame(spark, [(2, 22)], "k int, v int"), ["k"], day[2])
    assert values(third) == [(1, 10, True, day[1]), (2, 22, False, None), (3, 31, True, day[2])]


@pytest.mark.parametrize("hash_column", [None, "s"])
@pytest.mark.parametrize("side", [0, 1])
def test_repeated_keys_fail_a_diff(spark, hash_column, side):
    frames = [frame(spark, [(1, 1, "h"), (2, 1, "h")]), frame(spark, [(1, 1, "h"), (2, 2, "i")])]
    frames[side] = frames[side].unionByName(frame(spark, [(2, 5, "j")]))
    with pytest.raises(Exception, match="repeated key"):
        snapshot_diff(*frames, ["k"], hash_column).collect()


def test_diff_shuffles_each_side_once_and_limits_hot_keys_first(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = snapshot_diff(orders, orders.where("o_custkey > 5"), ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2
    assert plan.count("row_number(), 2, Partial") == 2


CONDITIONS = [
    ("tgt.k = src.k", "src.v > tgt.v"), ("tgt.k = src.k AND (tgt.v >= src.v)", None), ("tgt.k = src.k", "tgt.v < src.v AND src.w = 1"),
    ("tgt.k = src.k AND src.v <= tgt.v AND tgt.w <> 2", "src.w < 3"), ("tgt.k = src.k", "src.v + 0 > tgt.v"),
    ("tgt.k = src.k", "src.v > tgt.v OR src.w = 9"),
]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sampled_from(CONDITIONS), st.integers(0, 10 ** 6))
def test_conditions_on_repeated_keys(spark, conditions, seed):
    import random
    on, update_condition = conditions
    rng = random.Random(seed)

    def rows(n, spread):
        return [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(spread)]), rng.randrange(4)) for _ in range(n)]

    target = spark.createDataFrame(rows(8, 5), "k int, v int, w int")
    source = spark.createDataFrame(rows(6, 7), "k int, v int, w int")
    match = target.alias("tgt").withColumn("row", F.monotonically_increasing_id()).alias("tgt").join(
        source.alias("src"), F.expr(on if update_condition is None else f"({on}) AND ({update_condition})"))
    counts = {r.k: r.n for r in match.groupBy(F.col("src.k").alias("k"), "row").count().groupBy("k").agg(F.max("count").alias("n")).collect()}
    found = {r.k: r.source_rows for r in ambiguous_matches(target, source, on, update_condition).collect()}
    assert found == {k: n for k, n in counts.items() if n > 1}
    if not found:
        plain = upserted(target, source, on, update_condition=update_condition)
        quick = upserted(target, source, on, update_condition=update_condition, one_match=True)
        assert sorted(map(str, plain.collect())) == sorted(map(str, quick.collect()))
    fresh = source.alias("src").join(target.alias("tgt"), F.expr(on), "left_anti").count()
    assert upserted(target, source, on, update={}).count() == target.count() + fresh


def test_a_hot_key_with_a_condition_needs_no_pairs(spark, tmp_path):
    import time
    from stratum.sinks import tables
    n = 100_000
    target = spark.range(n).selectExpr("'hot' as k", "id + 1000000 as at", "'old' as v")
    source = spark.range(n).selectExpr("'hot' as k", "if(id = 7, 2000000, id) as at", "'new' as v")
    tables.create(target, "hot_key", location=f"{tmp_path}/hot")
    start = time.time()
    tables.merge(source, "hot_key", ["k"], update_condition="src.at > tgt.at")
    assert time.time() - start < 60
    assert [tuple(r) for r in spark.table("hot_key").groupBy("v", "at").count().collect()] == [("new", 2000000, n)]
    twice = spark.range(n).selectExpr("'hot' as k", "if(id < 2, 3000000, id) as at", "'newer' as v")
    with pytest.raises(tables.AmbiguousMerge):
        tables.merge(twice, "hot_key", ["k"], update_condition="src.at > tgt.at")


SNAPSHOT = st.dictionaries(st.sampled_from([None, 1, 2, 3]), st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "x"])), max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(SNAPSHOT, min_size=3, max_size=4))
def test_composed_changes_are_those_of_the_ends(spark, snapshots):
    frames = [frame(spark, [(k, v, s) for k, (v, s) in snapshot.items()]) for snapshot in snapshots]
    feeds = [snapshot_diff(a, b, ["k"], keep_before=True).withColumn("at", F.lit(n)) for n, (a, b) in enumerate(zip(frames, frames[1:]))]
    every = feeds[0]
    for feed in feeds[1:]:
        every = every.unionByName(feed)
    net = changes_composed(every, ["k"], "at")
    wanted = snapshot_diff(frames[0], frames[-1], ["k"], keep_before=True)
    assert sorted(map(str, net.collect())) == sorted(map(str, wanted.collect()))
    assert sorted(map(str, diff_applied(frames[0], net.drop("before"), ["k"]).collect())) == sorted(map(str, frames[-1].collect()))


def test_comparisons_across_types_keep_their_order(spark):
    target = spark.createDataFrame([(1, 9, "old")], "k int, v int, s string")
    source = spark.createDataFrame([(1, "10", "ten"), (1, "9", "nine"), (1, "8", "eight")], "k int, v string, s string")
    assert ambiguous_matches(target, source, ["k"], "src.v > tgt.v").collect() == []
    rows = upserted(target, source, ["k"], update={"s": "src.s"}, insert={}, update_condition="src.v > tgt.v", one_match=True)
    assert [r.s for r in rows.collect()] == ["ten"]
    wide = source.selectExpr("k", "cast(v as bigint) v", "s")
    rows = upserted(target, wide, ["k"], update={"s": "src.s"}, insert={}, update_condition="src.v > tgt.v", one_match=True)
    assert [r.s for r in rows.collect()] == ["ten"]


@pytest.mark.parametrize("source_type, target_type, quick", [
    ("double", "bigint", True), ("bigint", "double", True), ("float", "int", True), ("decimal(10,2)", "double", True),
    ("decimal(10,2)", "bigint", True), ("decimal(38,0)", "decimal(38,18)", False), ("string", "int", False)])
def test_comparisons_of_numbers_of_two_types_need_no_pairs(spark, source_type, target_type, quick):
    target = spark.sql(f"select k, cast(v as {target_type}) v, 'old' s from values (1, 9), (1, 11), (2, 3), (2, null), (null, 1) t(k, v)")
    source = spark.sql(f"select k, cast(v as {source_type}) v, s from values (1, 10, 'ten'), (1, 9, 'nine'), (1, null, 'none'), "
                       "(2, 2, 'two'), (null, 9, 'null') t(k, v, s)")
    assert (bound_of(target, source, Match.on(["k"]), "src.v > tgt.v") is not None) == quick
    assert ambiguous_matches(target, source, ["k"], "src.v > tgt.v").collect() == []
    rows = upserted(target, source, ["k"], update={"s": "src.s"}, insert={}, update_condition="src.v > tgt.v", one_match=True)
    found = sorted(str((r.k, None if r.v is None else int(r.v), r.s)) for r in rows.collect())
    assert found == sorted(["(1, 9, 'ten')", "(1, 11, 'old')", "(2, 3, 'old')", "(2, None, 'old')", "(None, 1, 'old')"])
    twice = source.unionByName(source.where("s = 'ten'"))
    assert [r.k for r in ambiguous_matches(target, twice, ["k"], "src.v > tgt.v").collect()] == [1]


def test_large_numbers_that_a_cast_makes_equal_are_ambiguous(spark):
    """2^53 and 2^53 + 1 are one number as doubles."""
    target = spark.createDataFrame([(1, float(2 ** 53 - 1))], "k int, v double")
    source = spark.createDataFrame([(1, 2 ** 53), (1, 2 ** 53 + 1), (1, 0)], "k int, v bigint")
    assert [r.source_rows for r in ambiguous_matches(target, source, ["k"], "src.v > tgt.v").collect()] == [2]
