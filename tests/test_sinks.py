import uuid

import pytest
from pyspark.sql import functions as F

from stratum.sinks import tables


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def name(spark):
    return f"t_{uuid.uuid4().hex[:10]}"


def frame(spark, rows, schema="k int, v string"):
    return spark.createDataFrame(rows, schema)


def test_append_creates_evolves_and_aligns(spark, name):
    tables.append(frame(spark, [(1, "a")]), name)
    tables.append(frame(spark, [("b", 2, 1.5)], "V string, K int, w double"), name)
    tables.append(frame(spark, [(3,)], "k int"), name)
    assert spark.table(name).columns == ["k", "v", "w"]
    assert values(spark.table(name)) == [(1, "a", None), (2, "b", 1.5), (3, None, None)]
    with pytest.raises(ValueError):
        tables.append(frame(spark, [(1, 2)], "k int, zz int"), name, evolve=False)


def test_append_to_partitions(spark, name):
    tables.append(frame(spark, [(1, "a"), (2, "b")]), name, ["v"])
    tables.append(frame(spark, [(3, "b", 7)], "k int, v string, w int"), name)
    assert tables.table_info(spark, name).partitions == ("v",)
    assert spark.table(name).columns == ["k", "w", "v"]
    assert values(spark.table(name)) == [(1, None, "a"), (2, None, "b"), (3, 7, "b")]


def test_overwrite_from_itself_and_with_new_columns(spark, name):
    tables.overwrite(frame(spark, [(1, "a"), (2, "b")]), name)
    assert tables.overwrite(spark.table(name).where("k = 2"), name) == 1
    before = tables.table_info(spark, name).location
    tables.overwrite(spark.table(name).selectExpr("k", "v", "k + 1 as w"), name)
    assert values(spark.table(name)) == [(2, "b", 3)]
    assert tables.table_info(spark, name).location != before
    # The next version's folder does not grow the previous version's name.
    assert tables.table_info(spark, name).location.count("__v") == 1


def test_overwrite_partitioned_from_itself(spark, name):
    tables.create(frame(spark, [(1, "a"), (2, "b"), (3, "b")]), name, ["v"])
    tables.overwrite(spark.table(name).where("k > 1"), name)
    assert values(spark.table(name)) == [(2, "b"), (3, "b")]
    assert tables.table_info(spark, name).partitions == ("v",)


def test_empty_results(spark, name):
    tables.overwrite(frame(spark, [(1, "a")]), name)
    empty = spark.table(name).where("k > 5")
    assert tables.overwrite(empty, name, on_empty="skip") == 0
    assert spark.table(name).count() == 1
    with pytest.raises(tables.EmptyResult):
        tables.overwrite(empty, name, on_empty="fail")
    assert tables.overwrite(frame(spark, []), name) == 0
    assert spark.table(name).count() == 0


def test_merge_is_repeatable(spark, name):
    tables.create(frame(spark, [(1, "a"), (2, "b")]), name)
    source = frame(spark, [(2, "B"), (3, "C")])
    for _ in range(2):
        assert tables.merge(source, name, ["k"])
        assert values(spark.table(name)) == [(1, "a"), (2, "B"), (3, "C")]
    assert not tables.merge(frame(spark, []), name, ["k"])


def test_merge_from_the_target_itself(spark, name):
    tables.create(frame(spark, [(1, "a"), (2, "b")]), name)
    tables.merge(spark.table(name).selectExpr("k + 1 as k", "upper(v) as v"), name, ["k"])
    assert values(spark.table(name)) == [(1, "a"), (2, "A"), (3, "B")]


def test_ambiguous_merge_leaves_the_table_alone(spark, name):
    tables.create(frame(spark, [(1, "a")]), name)
    with pytest.raises(tables.AmbiguousMerge):
        tables.merge(frame(spark, [(1, "x"), (1, "y")]), name, ["k"])
    assert values(spark.table(name)) == [(1, "a")]
    tables.merge(frame(spark, [(5, "x"), (5, "y")]), name, ["k"])
    assert values(spark.table(name)) == [(1, "a"), (5, "x"), (5, "y")]


@pytest.mark.parametrize("parts", [[], ["k"]])
def test_repeated_new_keys_beside_updates_and_nulls(spark, name, parts):
    tables.create(frame(spark, [(1, "a"), (2, "b"), (None, "n")]), name, parts)
    source = [(1, "A"), (7, "x"), (7, "y"), (7, "z"), (None, "m"), (None, "m"), (3, "c")]
    tables.merge(frame(spark, source), name, ["k"])
    assert sorted((str(r.k), r.v) for r in spark.table(name).collect()) == sorted(
        [("1", "A"), ("2", "b"), ("None", "n"), ("7", "x"), ("7", "y"), ("7", "z"), ("None", "m"), ("None", "m"), ("3", "c")])


def test_merge_rewrites_touched_partitions_only(spark, name):
    schema = "k int, v string, p string"
    tables.create(frame(spark, [(1, "a", "x"), (2, "b", "y"), (3, "c", None)], schema), name, ["p"])

    def files(part):
        return sorted(r[0] for r in spark.table(name).where(part).select("_metadata.file_path").distinct().collect())

    untouched = files("p = 'x'")
    tables.merge(frame(spark, [(2, "B", "y"), (9, "n", "z"), (3, "c2", None)], schema), name, ["k", "p"])
    assert values(spark.table(name)) == sorted(
        [(1, "a", "x"), (2, "B", "y"), (3, "c", None), (3, "c2", None), (9, "n", "z")], key=repr)
    assert files("p = 'x'") == untouched


def test_merge_that_moves_rows_between_partitions(spark, name):
    schema = "k int, v string, p string"
    tables.create(frame(spark, [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], schema), name, ["p"])
    # Both maps send rows to partitions the source does not name: their other rows must survive.
    tables.merge(frame(spark, [(1, "A", "x"), (7, "n", "x")], schema), name, ["k", "p"],
                 update={"p": "'y'"}, insert={"k": "src.k", "p": "'z'"})
    assert values(spark.table(name)) == sorted(
        [(1, "a", "y"), (2, "b", "y"), (3, "c", "z"), (7, None, "z")], key=repr)


def test_merge_partitions_of_another_type(spark, name):
    tables.create(frame(spark, [(1, "a", 1), (2, "b", 2)], "k int, v string, p int"), name, ["p"])
    tables.merge(frame(spark, [(2, "B", "02"), (3, "c", "01")], "k int, v string, p string"), name, ["k", "p"])
    assert values(spark.table(name)) == [(1, "a", 1), (2, "B", 2), (3, "c", 1)]


def test_merge_with_two_partition_columns(spark, name):
    schema = "k int, v string, p string, q int"
    tables.create(frame(spark, [(1, "a", "x", 1), (2, "b", "x", 2), (3, "c", "y", 1)], schema), name, ["p", "q"])
    tables.merge(frame(spark, [(2, "B", "x", 2), (4, "d", "y", 2)], schema), name, ["k", "p", "q"])
    assert values(spark.table(name)) == [(1, "a", "x", 1), (2, "B", "x", 2), (3, "c", "y", 1), (4, "d", "y", 2)]


def test_unkeyed_partitions_fall_back_to_a_full_rewrite(spark, name):
    schema = "k int, v string, p string"
    tables.create(frame(spark, [(1, "a", "x"), (2, "b", "y")], schema), name, ["p"])
    tables.merge(frame(spark, [(2, "B", "x")], schema), name, ["k"])
    assert values(spark.table(name)) == [(1, "a", "x"), (2, "B", "x")]


@pytest.mark.parametrize("prefix", ["spark_catalog.default.", "default.", "`default`."])
@pytest.mark.parametrize("parts", [[], ["v"]])
def test_qualified_names(spark, name, prefix, parts):
    table = prefix + name
    tables.append(frame(spark, [(1, "a"), (2, "b")]), table, parts)
    tables.overwrite(spark.table(table).where("k > 1"), table)
    tables.overwrite(spark.table(table).selectExpr("k", "k * 2 as w", "v"), table)
    tables.merge(frame(spark, [(2, "x"), (9, "y")]), table, ["k"])
    assert values(spark.table(name).select("k", "w", "v")) == [(2, 4, "x"), (9, None, "y")]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]


def test_failed_switch_leaves_the_table(spark, name, monkeypatch):
    tables.create(frame(spark, [(1, "a")]), name, ["v"])
    rename = tables._rename

    def failing(session, table, new):
        if "__v" in table:
            raise RuntimeError("no rename")
        rename(session, table, new)

    monkeypatch.setattr(tables, "_rename", failing)
    with pytest.raises(RuntimeError):
        tables.overwrite(frame(spark, [(5, "z")]), name)
    assert values(spark.table(name)) == [(1, "a")]


def test_merge_over_many_combinations_of_two_partition_columns(spark, tmp_path):
    """More combinations than any list in a condition could hold, among them NULL ones; others keep their files."""
    rows = spark.range(900).selectExpr("id", "cast(id % 30 as int) as a", "if(id % 7 = 0, null, cast(id div 30 as int)) as b",
                                       "'old' as v")
    name = "many_partitions"
    tables.create(rows, name, ["a", "b"], f"{tmp_path}/{name}")
    source = rows.where("a < 29").withColumn("v", F.lit("new"))
    tables.merge(source, name, "tgt.id = src.id AND tgt.a = src.a AND tgt.b = src.b")
    found = spark.table(name).groupBy("v").count().collect()
    nulls = rows.where("a < 29 and b is null").count()
    assert {r["v"]: r["count"] for r in found} == {"new": rows.where("a < 29").count(),
                                                   "old": 30 + nulls}


def test_native_merge_is_one_statement():
    text = tables.merge_text(["id", "V"], ["id", "v", "x"], "db.t", "s", "TGT.id = src.id AND tgt.v <> 'tgt.x'",
                             update={"V": "tgt.V + src.v"}, update_condition="src.x > 0")
    assert text == ("MERGE INTO db.t AS tgt USING `s` AS src ON TGT.id = src.id AND tgt.v <> 'tgt.x' "
                    "WHEN MATCHED AND (src.x > 0) THEN UPDATE SET tgt.`V` = tgt.V + src.v "
                    "WHEN NOT MATCHED THEN INSERT (`id`, `V`) VALUES (src.`id`, src.`v`)")


def test_merge_refuses_new_columns_without_evolution(spark, tmp_path):
    name = "merge_refused"
    tables.create(spark.createDataFrame([(1, "a")], "k int, v string"), name, location=f"{tmp_path}/{name}")
    source = spark.createDataFrame([(1, "b", 2)], "k int, v string, w int")
    with pytest.raises(ValueError, match="columns not in"):
        tables.merge(source, name, ["k"], evolve=False)


def test_old_versions_go(spark, tmp_path):
    import datetime as dt
    name = "versions"
    for number in range(4):
        tables.overwrite(spark.createDataFrame([(number,)], "k int"), name, location=f"{tmp_path}/{name}")
    folders = lambda: [p.name for p in tmp_path.iterdir() if p.is_dir()]
    assert len(folders()) == 4
    assert tables.drop_old_versions(spark, name) == [] and len(folders()) == 4
    assert len(tables.drop_old_versions(spark, name, dt.timedelta(0))) == 3 and len(folders()) == 1
    assert [tuple(r) for r in spark.table(name).collect()] == [(3,)]


def _shuffled_scans(plan):
    """Lines of the scans below an exchange."""
    lines, found, depths = plan.split("\n"), [], []
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        depths = [d for d in depths if d < depth]
        if "Exchange" in line:
            depths.append(depth)
        elif "FileScan" in line and depths:
            found.append(line)
    return found


def test_merge_into_buckets_does_not_shuffle_the_target(spark, tmp_path):
    from stratum.operators.upsert import upserted
    name = "dealt"
    rows = spark.range(5000).selectExpr("id", "id % 7 as v", "cast(id as string) as s")
    tables.create(rows, name, location=f"{tmp_path}/{name}", buckets=tables.Buckets(6, ("id",)))
    source = spark.range(4000, 9000).selectExpr("id", "cast(-1 as bigint) as v", "'new' as s")
    source.write.parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for _ in range(2):  # the second merge reads what the first one wrote
            plan = upserted(spark.table(name), source, ["id"])._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Bucketed: true") == 2 and [s for s in _shuffled_scans(plan) if "Bucketed: true" in s] == []
            assert len(_shuffled_scans(plan)) == 2  # the source, for updates and for inserts
            assert tables.merge(source, name, ["id"])
            assert tables.table_info(spark, name).buckets == tables.Buckets(6, ("id",))
            assert sorted(tuple(r) for r in spark.table(name).collect()) == [
                (i, i % 7, str(i)) if i < 4000 else (i, -1, "new") for i in range(9000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    tables.append(spark.createDataFrame([(10 ** 6, 1, "x")], "id long, v long, s string"), name)
    tables.overwrite(spark.table(name).where("id >= 8999"), name)
    assert tables.overwrite(spark.table(name).where("false"), name, on_empty="skip") == 0
    assert {r.id for r in spark.table(name).collect()} == {8999, 10 ** 6}
    assert tables.table_info(spark, name).buckets.number == 6


def test_buckets_by_spec(spark, tmp_path):
    from stratum.operators.columns import RunInfo
    from stratum.plans.runs import run
    from stratum.spec import PipelineSpec
    spark.range(100).selectExpr("id as k", "1 as v").write.saveAsTable("bucket_source")
    spec = {"pipeline_metadata": {"name": "b", "layer": "silver"},
            "source": {"type": "table", "properties": {"table": "bucket_source"}},
            "destination": {"table": "bucket_target", "mode": "merge", "primary_keys": ["k"], "buckets": 3,
                            "location": f"{tmp_path}/t"}}
    for _ in range(2):
        run(spark, PipelineSpec.of(spec), RunInfo())
    assert tables.table_info(spark, "bucket_target").buckets == tables.Buckets(3, ("k",))
    assert spark.table("bucket_target").count() == 100
    del spec["destination"]["primary_keys"]
    spec["destination"]["merge_condition"] = "tgt.k = src.k"
    with pytest.raises(ValueError, match="buckets"):
        PipelineSpec.of(spec)


def test_first_copies_and_skipped_versions_go(spark, tmp_path):
    import datetime as dt
    name = "first_copy"
    tables.create(spark.createDataFrame([(0,)], "k int"), name, location=f"{tmp_path}/{name}")
    tables.overwrite(spark.createDataFrame([(1,)], "k int"), name)
    assert tables.overwrite(spark.createDataFrame([], "k int"), name, on_empty="skip") == 0
    assert len(list(tmp_path.iterdir())) == 2
    assert tables.drop_old_versions(spark, name, dt.timedelta(0)) == [name]
    assert len(list(tmp_path.iterdir())) == 1 and [r.k for r in spark.table(name).collect()] == [1]


def test_clustered_rows_let_filters_skip_files(spark, tmp_path):
    import pyarrow.parquet as pq
    from stratum.sinks.clustering import clustered
    df = spark.range(40_000).selectExpr(
        "id % 200 as a", "cast(hash(id) % 1000 as double) as b", "if(id % 50 = 0, null, concat('s', hash(id, 1) % 100)) as s",
        "date_add(date'2020-01-01', cast(id % 300 as int)) as d", "id as `the id`")
    ordered = clustered(df, ["a", "b"], bits=6)
    assert ordered.columns == df.columns and ordered.exceptAll(df).count() == 0 and ordered.count() == 40_000
    ordered.write.option("parquet.block.size", 16 * 1024).parquet(f"{tmp_path}/z")
    limits = []
    for file in (tmp_path / "z").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            limits.append([(c.statistics.min, c.statistics.max) for c in (meta.row_group(g).column(i) for i in (0, 1))])
    assert len(limits) >= 8
    for column, value in ((0, 17), (1, 100.0)):
        assert sum(low <= value <= high for low, high in (limit[column] for limit in limits)) <= 0.7 * len(limits)
    assert clustered(df, ["s", "d", "the id"]).count() == 40_000 and clustered(df.limit(0), ["a"]).count() == 0
    with pytest.raises(ValueError):
        clustered(df.withColumn("m", F.create_map("a", "b")), ["m"])


def test_clustering_by_spec(spark, tmp_path):
    from stratum.operators.columns import RunInfo
    from stratum.plans.runs import run
    from stratum.spec import PipelineSpec
    spark.range(100).selectExpr("id as k", "id % 3 as v").write.saveAsTable("cluster_source")
    spec = {"pipeline_metadata": {"name": "c", "layer": "silver"},
            "source": {"type": "table", "properties": {"table": "cluster_source"}},
            "destination": {"table": "cluster_target", "mode": "overwrite", "cluster_by": ["v", "k"], "location": f"{tmp_path}/t"}}
    assert run(spark, PipelineSpec.of(spec), RunInfo()).rows == 100 and spark.table("cluster_target").count() == 100
    spec["destination"] |= {"mode": "merge", "primary_keys": ["k"]}
    with pytest.raises(ValueError, match="cluster_by"):
        PipelineSpec.of(spec)
