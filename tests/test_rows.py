import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException

from stratum.functions.hashing import detokenized, token_table, with_row_hash, with_token
from stratum.operators.aggregate import aggregated
from stratum.operators.percentiles import percentiles
from stratum.operators.reconcile import loaded_per_file, parsed_log, reconciled
from stratum.operators.rows import deduplicated, deduplicated_counted, union_all, where_all


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    df = where_all(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), ["l_quantity < 5", "l_tax > 0.01"])
    plan = plan_of(df.select("l_orderkey"))
    assert "LessThan(l_quantity,5.0)" in plan
    schema = plan.split("ReadSchema: ")[1]
    assert "l_orderkey" in schema and "l_comment" not in schema and "l_shipdate" not in schema


def test_keyed_dedup_limits_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lines = plan_of(deduplicated(df, ["l_orderkey"], ["l_shipdate desc"])).splitlines()
    partial = next(i for i, text in enumerate(lines) if "Partial" in text and "WindowGroupLimit" in text)
    exchange = next(i for i, text in enumerate(lines) if "Exchange" in text)
    assert exchange < partial


def test_keyed_dedup_is_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 4, "c"), (2, None, "d"), (2, 1, "e"), (None, 1, "f"), (None, 0, "g")],
                               "k int, v int, s string")
    best = {r.k: r.s for r in deduplicated(df, ["k"], ["v desc"]).collect()}
    assert best == {1: "a", 2: "e", None: "f"}
    first = {r.k: r.s for r in deduplicated(df, ["k"], ["abs(v) asc"]).collect()}
    assert first == {1: "c", 2: "d", None: "g"}


def test_removed_rows_are_counted_in_the_same_job(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c")], "k int, s string")
    exact, removed = deduplicated_counted(df)
    assert exact.count() == 3 and removed.value == 1
    keyed, removed = deduplicated_counted(df, ["k"])
    assert keyed.count() == 2 and removed.value == 2


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 4)))))
def test_keyed_dedup_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    expected = {}
    for k, v in rows:
        rank = -1 if v is None else v
        expected[k] = max(expected.get(k, -2), rank)
    got = {r.k: -1 if r.v is None else r.v for r in deduplicated(df, ["k"], ["v desc"]).collect()}
    assert got == expected


def test_union_needs_equal_columns(spark):
    with pytest.raises(AnalysisException):
        union_all([spark.sql("select 1 a, 2 b"), spark.sql("select 1 a")]).collect()


def test_aggregate_edges(spark):
    df = spark.sql("select * from values (1, null, 'x'), (1, 2, 'y'), (null, 3, 'z') as t(g, v, s)")
    rows = aggregated(df, ["g"], [{"name": "n", "expr": "count(v)"}, {"name": "no_expr"}, {"expr": "count(*)"}]).collect()
    assert sorted((str(r.g), r.n) for r in rows) == [("1", 1), ("None", 1)]
    assert aggregated(df, [], [{"name": "n", "expr": "count(*)"}]) is df
    assert aggregated(df, ["g"], []) is df
    assert aggregated(df, [], [{"name": "n", "expr": "count(*)"}], whole_table=True).first().n == 3


def test_aggregate_nested_and_dotted_groups(spark):
    df = spark.sql("select named_struct('b', 1) a, 2 as `x.y`")
    assert aggregated(df, ["a.b", "x.y"], [{"name": "n", "expr": "count(*)"}]).columns == ["b", "x.y", "n"]


def test_distinct_count_of_a_hot_group_is_spread(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = plan_of(aggregated(df, ["o_orderstatus"], [{"name": "c", "expr": "count(distinct o_custkey)"}]))
    # The first shuffle is keyed by group and value, so no task holds all values of one group.
    assert "hashpartitioning(o_orderstatus" in plan and "o_custkey" in plan.split("hashpartitioning")[-1]


def test_row_hash_modes(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a||b", "c"), ("a", "b||c"), (None, None)], "a string, b string")
    compat = [r.row_hash for r in with_row_hash(df).collect()]
    assert compat[0] == compat[1] and compat[2] == compat[3] and compat[4] is not None
    strict = [r.row_hash for r in with_row_hash(df, mode="strict").collect()]
    assert len(set(strict)) == 5
    with pytest.raises(ValueError):
        with_row_hash(df, mode="x")


def test_tokens(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    tokens = with_token(df, "v", "salt").collect()
    assert tokens[2].v_token is not None and tokens[0].v_token != tokens[2].v_token
    table = token_table(df, "v", "salt")
    assert table.count() == 1
    back = detokenized(with_token(df, "v", "salt").drop("v"), table, "v")
    assert sorted(str(r.v) for r in back.collect()) == ["None", "a", "a"]


def test_reconcile(spark):
    totals = spark.createDataFrame([("a", 3), ("b", 3), ("c", 2)], "file_name string, records_total bigint")
    done = spark.createDataFrame([("a", 3), ("b", 2)], "file_name string, records_succeeded bigint")
    files = spark.createDataFrame([("a", "/x/a"), ("a", "/y/a")], "file_name string, path string")
    rows = {r.source_name: (r.records_succeeded, r.load_status) for r in reconciled(totals, done, files).collect()}
    assert rows == {"/x/a": (3, "Success"), "b": (2, "Failed"), "c": (0, "Failed")}
    files = spark.createDataFrame([("/x/a", "/x/a"), ("/y/a", "/y/a"), ("/y/void", "/y/void")], "file_name string, path string")
    totals = spark.createDataFrame([("/x/a", 3), ("/y/a", 4)], "file_name string, records_total bigint")
    done = spark.createDataFrame([("/x/a", 3), ("/y/a", 1)], "file_name string, records_succeeded bigint")
    rows = {r.source_name: tuple(r)[1:] for r in reconciled(totals, done, files).collect()}
    assert rows == {"/x/a": (3, 3, "Success"), "/y/a": (4, 1, "Failed"), "/y/void": (0, 0, "Success")}


def test_counts_of_a_load_read_its_partition_only(spark):
    name = "loads_by_partition"
    df = spark.range(40).selectExpr("id", "concat('run-', id % 4) as run_id", "'p' as source_path")
    df.write.partitionBy("run_id").saveAsTable(name)
    counts = loaded_per_file(spark.table(name), "run-1", "run_id", "source_path")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert counts.collect()[0].records_succeeded == 10
    assert "run_id" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_log_lines(spark):
    line = "2024-05-01 06:00:00,123 - ERROR - pkg.mod.Class:run() - it - failed:\n  here"
    row = parsed_log(spark.createDataFrame([(line,)], "code_message string")).first()
    assert (row.level, row.logger, row.function, row.text) == ("ERROR", "pkg.mod.Class", "run", "it - failed:\n  here")


@pytest.mark.parametrize("whole_group, accuracy", [(100_000, 100_000), (5, 50), (0, 10)])
def test_percentiles(spark, whole_group, accuracy):
    import random
    rng = random.Random(accuracy)
    rows = [(g, rng.choice([7.5, rng.gauss(0, 100), float(rng.randrange(5))])) for g in "aaaaaab" for _ in range(120)]
    rows += [(None, 1.0), (None, 4.0), ("only nulls", None), ("a", None), ("one", -3.0)] + [("same", 2.0)] * 300
    df = spark.createDataFrame(rows, "g string, `v v` double").repartition(5)
    wanted = {"first": 0.0, "low": 0.13, "median": 0.5, "high": 0.987, "last": 1.0}
    got = {r.g: tuple(r)[1:] for r in percentiles(df, ["g"], "v v", wanted, whole_group, accuracy).collect()}
    for g in {r[0] for r in rows}:
        values = [v for k, v in rows if k == g and v is not None]
        expected = np.percentile(values, [100 * p for p in wanted.values()]) if values else [None] * 5
        assert got[g] == (pytest.approx(tuple(expected)) if values else tuple(expected))
    total = percentiles(df, [], "v v", {"median": 0.5}, whole_group, accuracy).collect()
    assert [tuple(r) for r in total] == [(pytest.approx(np.median([v for _, v in rows if v is not None])),)]
    assert [tuple(r) for r in percentiles(df.limit(0), [], "v v", {"median": 0.5}).collect()] == [(None,)]
    assert percentiles(df.limit(0), ["g"], "v v", {"median": 0.5}).collect() == []


def test_percentiles_count_rows_on_the_map_side(spark):
    from stratum.operators import percentiles as module
    df = spark.range(2000).selectExpr("'hot' as g", "id % 1000 as v")
    assert percentiles(df, ["g"], "v", {"p": 0.25}, whole_group=10, accuracy=100).collect()[0].p == 249.75
    rows = df.selectExpr("struct(g as k0) as __g", "v as __v")
    plan = module._chosen(rows, module._bounds(rows, [0.25], 10, 100))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "collect_" not in plan
    with pytest.raises(ValueError):
        percentiles(df, ["g"], "v", {"p": 25})
