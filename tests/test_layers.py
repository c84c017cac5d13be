import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from stratum.operators.columns import RunInfo
from stratum.plans.frames import bronze_frame, extracted
from stratum.plans.runs import run
from stratum.sinks import tables
from stratum.spec import PipelineSpec
from stratum.streaming.incremental import append_batches, drain, merge_batches, new_files, run_incremental

INFO = RunInfo("c", "j", "r1", "u", dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc))
DAY = dt.date(2024, 5, 1)


@pytest.fixture
def name(spark):
    return f"l_{uuid.uuid4().hex[:10]}"


def again(run_id):
    return RunInfo("c", "j", run_id, "u", INFO.started)


def write(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for file, text in files.items():
        (folder / file.replace("__", ".")).write_text(text)
    return str(folder)


def bronze(path, name, mode="append", **extra):
    config = {
        "pipeline_metadata": {"name": "b", "layer": "bronze"},
        "source": {"type": "file", "properties": {"source_path": path, "format": "csv", "extension": ".csv",
                                                  "options": {"header": True}}},
        "transform": {"standardize": {"case": "upper"}},
        "destination": {"table": name, "mode": mode},
        "audit": {"load_history": f"{name}_h", "run_status": f"{name}_s"},
    }
    for key, value in extra.items():
        config[key] = {**config.get(key, {}), **value} if isinstance(value, dict) else value
    return PipelineSpec.of(config)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bronze_append_and_history(spark, tmp_path, name):
    path = write(tmp_path / "in", x_1__csv="id,v\n1,a\n2,b\n", x_2__csv="3,c\n")
    spec = bronze(path, name)
    assert run(spark, spec, INFO, DAY).rows == 3
    assert spark.table(name).columns[-1] == "row_hash"
    assert values(spark.table(name).select("id", "v", "file_name", "run_id")) == [
        ("1", "A", "x_1.csv", "r1"), ("2", "B", "x_1.csv", "r1"), ("3", "C", "x_2.csv", "r1")]
    history = spark.table(f"{name}_h").select("source_name", "records_total", "records_succeeded", "load_status")
    assert [(r[0].rsplit("/")[-1], *r[1:]) for r in values(history)] == [
        ("x_1.csv", 2, 2, "Success"), ("x_2.csv", 1, 1, "Success")]
    run(spark, spec, again("r2"), DAY)
    assert spark.table(name).count() == 6 and spark.table(f"{name}_h").count() == 4
    assert [r.status for r in spark.table(f"{name}_s").collect()] == ["success"] * 2


def test_reused_run_id_shows_as_failed_counts(spark, tmp_path, name):
    spec = bronze(write(tmp_path / "in", x_1__csv="id,v\n1,a\n"), name)
    run(spark, spec, INFO, DAY)
    run(spark, spec, INFO, DAY)
    assert values(spark.table(f"{name}_h").select("records_total", "records_succeeded", "load_status")) == [
        (1, 1, "Success"), (1, 2, "Failed")]


def test_bronze_reads_the_source_once(spark, tmp_path, name):
    path = write(tmp_path / "in", x_1__csv="id,v\n1,a\n2,b\n")
    spec = bronze(path, name)
    counter = spark.sparkContext.accumulator(0)
    frame, files = extracted(spark, spec, DAY)
    # A scan that counts its rows: each further execution of the source would count them again.
    counted = spark.createDataFrame(frame.rdd.map(lambda row: (counter.add(1), row)[1]), frame.schema)
    from stratum.plans import runs

    original = runs.extracted
    runs.extracted = lambda *_: (counted, files)
    try:
        run(spark, spec, INFO, DAY)
    finally:
        runs.extracted = original
    assert counter.value == 2


def test_row_hash_covers_business_columns(spark, tmp_path, name):
    path = write(tmp_path / "in", x_1__csv="id,v\n1,a\n", y_2__csv="1,a\n")
    spec = bronze(path, name)
    df, _ = extracted(spark, spec, DAY)
    assert bronze_frame(df, spec, INFO).select("row_hash").distinct().count() == 1
    spec = bronze(path, name, transform={"hash_all_columns": True})
    assert bronze_frame(df, spec, INFO).select("row_hash").distinct().count() == 2


def test_no_files_is_skipped(spark, tmp_path, name):
    os.makedirs(tmp_path / "none")
    assert run(spark, bronze(str(tmp_path / "none"), name), INFO, DAY).status == "skipped"
    assert spark.table(f"{name}_s").first().status == "skipped"


def test_failure_is_recorded_and_raised(spark, tmp_path, name):
    spec = bronze(write(tmp_path / "in", x_1__csv="id,v\n1,a\n"), name,
                  transform={"with_columns": [{"name": "n", "expr": "nope"}]})
    with pytest.raises(Exception):
        run(spark, spec, INFO, DAY)
    status = spark.table(f"{name}_s").first()
    assert status.status == "failed" and "nope" in status.error
    assert spark.table(f"{name}_h").first().load_status == "Failed"


def test_bronze_corrupt_records(spark, tmp_path, name):
    path = write(tmp_path / "in", x__csv="1,2\nx,3\n")
    spec = bronze(path, name, destination={"table": name, "corrupt_record": f"{name}_bad"},
                  source={"type": "file", "properties": {"source_path": path, "format": "csv", "schema": "id int, v int"}})
    assert run(spark, spec, INFO, DAY).rows == 1
    assert values(spark.table(f"{name}_bad")) == [("x.csv", "x,3")]


def test_bronze_merge_and_soft_delete(spark, tmp_path, name):
    keyed = {"destination": {"table": name, "mode": "merge", "primary_keys": ["id"], "enable_soft_deletes": True}}
    run(spark, bronze(write(tmp_path / "a", x__csv="id,v\n1,a\n2,b\n"), name, **keyed), INFO, DAY)
    run(spark, bronze(write(tmp_path / "b", x__csv="id,v\n2,B2\n3,c\n"), name, **keyed), again("r2"), DAY)
    got = values(spark.table(name).select("id", "v", "run_id", "is_deleted"))
    assert got == [("1", "A", "r1", True), ("2", "B2", "r2", False), ("3", "C", "r2", False)]


def silver(source_table, name, **extra):
    return PipelineSpec.of({
        "pipeline_metadata": {"name": "s", "layer": "silver"},
        "source": {"type": "table", "properties": {"table": source_table}},
        "transform": {"casts": [{"column": "v", "to_type": "int"}], "standardize": {"trim_strings": True}},
        "data_quality": [
            {"check": {"function": "sql_expression", "arguments": {"expression": "v > 0", "name": "pos", "msg": "m"}}},
            {"check": {"function": "sql_expression", "criticality": "warn",
                       "arguments": {"expression": "v < 9", "name": "low", "msg": "m"}}}],
        "destination": {"table": name, "mode": "overwrite"},
        "audit": {"exceptions": f"{name}_e", "summary": f"{name}_q"},
        **extra})


@pytest.mark.parametrize("mode", ["overwrite", "append", "merge"])
@pytest.mark.parametrize("on_fail", ["record", "drop"])
def test_silver_checks_in_every_mode(spark, name, mode, on_fail):
    tables.create(spark.createDataFrame([(1, " 5"), (2, "0 "), (3, "12"), (4, None)], "k int, v string"), f"{name}_in")
    target = {"table": name, "mode": mode, "primary_keys": ["k"]}
    result = run(spark, silver(f"{name}_in", name, destination=target, on_fail=on_fail), INFO)
    kept = [(1, 5), (3, 12), (4, None)] + ([(2, 0)] if on_fail == "record" else [])
    assert values(spark.table(name)) == sorted(kept, key=repr)
    assert (result.rows, result.failing_rows) == (4, 2)
    assert values(spark.table(f"{name}_q").select("quality_check_type", "name", "count")) == [("error", "pos", 1), ("warn", "low", 1)]
    assert spark.table(f"{name}_e").count() == 2


def test_silver_without_failures_writes_no_quality_tables(spark, name):
    tables.create(spark.createDataFrame([(1, "5")], "k int, v string"), f"{name}_in")
    assert run(spark, silver(f"{name}_in", name), INFO).failing_rows == 0
    assert not spark.catalog.tableExists(f"{name}_e") and not spark.catalog.tableExists(f"{name}_q")


def test_silver_bad_rule_stops_before_writing(spark, name):
    tables.create(spark.createDataFrame([(1, "5")], "k int, v string"), f"{name}_in")
    rule = {"check": {"function": "sql_expression", "arguments": {"expression": "zz > 1"}}}
    with pytest.raises(ValueError):
        run(spark, silver(f"{name}_in", name, data_quality=[rule]), INFO)
    assert not spark.catalog.tableExists(name)


def test_silver_empty_source(spark, name):
    tables.create(spark.createDataFrame([], "k int, v string"), f"{name}_in")
    assert run(spark, silver(f"{name}_in", name), INFO).rows == 0


def test_masked_view_follows_the_table(spark, name):
    tables.create(spark.createDataFrame([(1, "5")], "k int, v string"), f"{name}_in")
    spec = silver(f"{name}_in", name, transform={}, data_quality=[], security={"masking": [{"column": "v", "policy": "mask_text"}]})
    run(spark, spec, INFO)
    tables.append(spark.createDataFrame([(2, "77")], "k int, v string"), f"{name}_in")
    run(spark, spec, INFO)
    assert values(spark.table(f"{name}_masked")) == [(1, "n"), (2, "nn")]


def test_gold_fail_on_empty(spark, name):
    tables.create(spark.createDataFrame([(1, "5")], "k int, v string"), f"{name}_in")
    for mode in ("overwrite", "append"):
        spec = PipelineSpec.of({
            "pipeline_metadata": {"name": "g", "layer": "gold"},
            "source": {"type": "table", "properties": {"table": f"{name}_in"}},
            "transform": {"filters": ["k > 5"], "aggregations": {"group_by": ["v"], "metrics": [{"name": "n", "expr": "count(*)"}]}},
            "destination": {"table": name, "mode": mode, "empty_result": "fail"}})
        with pytest.raises(tables.EmptyResult):
            run(spark, spec, INFO)


def test_bronze_to_gold(spark, tmp_path, name):
    path = write(tmp_path / "in", x_1__csv="id,v\n1,5\n2,0\n", x_2__csv="3,7\n")
    run(spark, bronze(path, f"{name}_b"), INFO, DAY)
    run(spark, silver(f"{name}_b", f"{name}_s2", on_fail="drop"), INFO)
    gold = PipelineSpec.of({
        "pipeline_metadata": {"name": "g", "layer": "gold"},
        "source": {"type": "table", "properties": {"table": f"{name}_s2"}},
        "transform": {"aggregations": {"group_by": ["file_name"], "metrics": [{"name": "total", "expr": "sum(v)"}]}},
        "destination": {"table": f"{name}_g", "mode": "overwrite"}})
    run(spark, gold, INFO)
    assert values(spark.table(f"{name}_g")) == [("x_1.csv", 5), ("x_2.csv", 7)]


def test_incremental_takes_new_files_once(spark, tmp_path):
    base = str(tmp_path)
    seen = []

    def round_trip(value):
        if value is not None:
            spark.createDataFrame([(value,)], "v int").write.mode("append").parquet(f"{base}/in")
        drain(new_files(spark, f"{base}/in", "parquet", "v int"), f"{base}/cp", append_batches(f"{base}/out"))
        seen.append(spark.read.parquet(f"{base}/out").count())

    for value in (1, 2, None):
        round_trip(value)
    assert seen == [1, 2, 2]


def test_replayed_batches_change_nothing(spark, tmp_path, name):
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    appended = append_batches(str(tmp_path / "out"))
    for number in (0, 1, 1):
        appended(batch, number)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    merged = merge_batches(name, ["k"])
    for number in (0, 1, 1):
        merged(batch, number)
    assert values(spark.table(name)) == [(1, "a"), (2, "b")]


def test_incremental_append_run(spark, tmp_path, name):
    base = str(tmp_path)
    spec = PipelineSpec.of({
        "pipeline_metadata": {"name": "i", "layer": "bronze"},
        "source": {"type": "cloudfiles", "properties": {"source_path": f"{base}/in", "format": "json", "schema": "v int"}},
        "destination": {"table": name, "mode": "append", "location": f"{base}/out"}})
    os.makedirs(f"{base}/in")
    run_incremental(spark, spec, INFO, f"{base}/cp")
    assert not spark.catalog.tableExists(name)
    for n in (1, 2):
        spark.createDataFrame([(n,)], "v int").write.mode("append").json(f"{base}/in")
        run_incremental(spark, spec, INFO, f"{base}/cp")
    rows = values(spark.table(name).select("v", "run_id", "ingest_batch"))
    assert [r[:2] for r in rows] == [(1, "r1"), (2, "r1")]
    (first, zero), (second, one) = (r[2].rsplit("-", 1) for r in rows)
    assert first == second and len(first) == 36 and (zero, one) == ("0", "1")
    # A new checkpoint is a new stream: it reads all files again and overwrites none of the old batches.
    run_incremental(spark, spec, INFO, f"{base}/cp2")
    assert spark.table(name).count() == 4


def test_incremental_silver_applies_the_rules(spark, tmp_path, name):
    base = str(tmp_path)
    spec = silver("unused", name, on_fail="drop",
                  source={"type": "incremental", "properties": {
                      "source_path": f"{base}/in", "format": "json", "schema": "k int, v string"}},
                  destination={"table": name, "mode": "merge", "primary_keys": ["k"]},
                  security={"masking": [{"column": "k", "policy": "mask_null"}]})
    for rows in ([(1, "5"), (2, "0")], [(1, "6"), (3, "12")]):
        spark.createDataFrame(rows, "k int, v string").write.mode("append").json(f"{base}/in")
        run_incremental(spark, spec, INFO, f"{base}/cp")
    assert values(spark.table(name).select("k", "v")) == [(1, 6), (3, 12)]
    assert values(spark.table(f"{name}_q").select("name", "count")) == [("low", 1), ("pos", 1)]
    assert spark.table(f"{name}_masked").where("k is null").count() == 2


@pytest.mark.parametrize("mode,on_fail,reads", [("overwrite", "record", 1), ("merge", "drop", 1), ("append", "record", 2)])
def test_silver_source_reads(spark, name, mode, on_fail, reads):
    data = [(i, str(i - 2)) for i in range(5)]
    counter = spark.sparkContext.accumulator(0)
    source = spark.createDataFrame(
        spark.sparkContext.parallelize(data, 2).map(lambda row: (counter.add(1), row)[1]), "k int, v string")
    source.createOrReplaceTempView(f"{name}_in")
    spec = silver(f"{name}_in", name, on_fail=on_fail, destination={"table": name, "mode": mode, "primary_keys": ["k"]})
    assert run(spark, spec, INFO).failing_rows == 3
    assert spark.table(f"{name}_e").count() == 3
    assert counter.value == reads * len(data)


def test_incremental_schema_from_the_files(spark, tmp_path, name):
    base = str(tmp_path)
    write(tmp_path / "in", a__csv="id,v\n1,x\n")
    spec = PipelineSpec.of({
        "pipeline_metadata": {"name": "i", "layer": "bronze"},
        "source": {"type": "cloudfiles", "properties": {"source_path": f"{base}/in", "format": "csv", "options": {"header": "true"}}},
        "destination": {"table": name, "mode": "append", "location": f"{base}/out"}})
    run_incremental(spark, spec, INFO, f"{base}/cp")
    assert values(spark.table(name).select("id", "v", "file_name")) == [("1", "x", "a.csv")]


def test_date_folders_as_of_the_start_of_the_run(spark, tmp_path, name):
    for day in ("2024/04/29", "2024/04/30", "2024/05/01"):
        write(tmp_path / "in" / day, a__csv=f"day\n{day}\n")
    props = {"source_path": str(tmp_path / "in"), "format": "csv", "extension": ".csv", "options": {"header": True},
             "discover": {"type": "date_hierarchy", "last_n_days": 2}}
    run(spark, bronze("", name, source={"type": "file", "properties": props}), INFO)
    assert values(spark.table(name).select("day")) == [("2024/04/30",), ("2024/05/01",)]


def test_a_run_removes_what_it_staged(spark, name):
    import os
    tables.create(spark.createDataFrame([(1, "5"), (2, "0")], "k int, v string"), f"{name}_in")
    base = spark.conf.get("spark.checkpoint.dir") + "/stratum"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    run(spark, silver(f"{name}_in", name, destination={"table": name, "mode": "merge", "primary_keys": ["k"]}), INFO)
    assert spark.table(name).count() == 2 and spark.table(f"{name}_e").count() == 1
    assert set(os.listdir(base)) == before


def test_incremental_gold_reads_new_loads_only(spark, tmp_path):
    from stratum.operators.states import states
    from stratum.plans.incremental_gold import _of_loads, refreshed
    metrics = [{"name": "n", "function": "count"}, {"name": "total", "function": "sum", "of": "v"},
               {"name": "kinds", "function": "approx_distinct", "of": "v"}, {"name": "mean", "function": "avg", "of": "v"}]
    raw, gold = "loads_of_gold", "gold_of_loads"
    seen = []
    for load in ("a/b=1+2 é", None, "c"):
        rows = [(g, v) for g in ("x", None) for v in (1, 2, None)] + ([("new", 7)] if load == "c" else [])
        df = spark.createDataFrame(rows, "g string, v int").selectExpr("*", f"cast({load!r} as string) as load" if load else "cast(null as string) as load")
        tables.append(df, raw, ["load"], f"{tmp_path}/raw")
        assert refreshed(spark, raw, "load", gold, ["g"], metrics, f"{tmp_path}/gold") == [load or ""]
        assert refreshed(spark, raw, "load", gold, ["g"], metrics, f"{tmp_path}/gold") == []
        seen.append(load)
        again = spark.table(raw).groupBy("g").agg(
            *(F.expr(e) for e in ("count(*)", "sum(v)", "approx_count_distinct(v)", "avg(v)")))
        assert sorted(map(repr, map(tuple, spark.table(gold).collect()))) == sorted(map(repr, map(tuple, again.collect())))
    plan = states(_of_loads(spark.table(raw), "load", ["c"]), ["g"], metrics)._jdf.queryExecution().executedPlan().toString()
    assert "load" in plan.split("PartitionFilters: [")[1].split("]")[0]
    spark.sql(f"DROP TABLE {gold}")  # as if a run had ended before the target was written
    assert refreshed(spark, raw, "load", gold, ["g"], metrics, f"{tmp_path}/gold") == [] and spark.table(gold).count() == 3
    with pytest.raises(ValueError, match="not partitioned"):
        refreshed(spark, gold, "g", "other", ["g"], metrics)
    with pytest.raises(ValueError, match="mergeable"):
        states(spark.table(raw), ["g"], [{"name": "m", "function": "median", "of": "v"}])


def _batch_spec(name, base, **audit):
    return PipelineSpec.of({
        "pipeline_metadata": {"name": "b", "layer": "silver"},
        "source": {"type": "cloudfiles", "properties": {"source_path": f"{base}/in", "format": "parquet", "schema": "v int, at date"}},
        "data_quality": [{"check": {"function": "sql_expression", "arguments": {"name": "big", "expression": "v > 1", "msg": "small"}}}],
        "destination": {"table": name, "mode": "append", "location": f"{base}/out"},
        "audit": {"exceptions": f"{name}_rows", "summary": f"{name}_counts", "load_history": f"{name}_files", "location": base, **audit}})


def test_batches_record_everything_once(spark, tmp_path, name, monkeypatch):
    from stratum.streaming import incremental
    base = str(tmp_path)
    writer = incremental.batch_writer(_batch_spec(name, base), INFO, INFO.started, f"{base}/ledger")
    batch = spark.createDataFrame([(1, DAY, "f1"), (2, DAY, "f2"), (1, None, "f2")], "v int, at date, file_name string")

    def state():
        return [spark.table(f"{name}_{t}").count() for t in ("rows", "counts", "files")] + [spark.read.parquet(f"{base}/out").count()]

    writer(batch, 0)
    assert state() == [2, 1, 2, 3]
    writer(batch, 0)  # replayed after it was done
    assert state() == [2, 1, 2, 3]

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:  # the run ends after rows and failures were written
        broken.setattr(incremental, "record_batch_history", fails)
        with pytest.raises(RuntimeError):
            writer(batch, 1)
    assert state() == [4, 2, 2, 6]
    writer(batch, 1)
    assert state() == [4, 2, 4, 6]
    history = spark.table(f"{name}_files").where("ingest_batch = 'batch-1'").collect()
    assert sorted((r.source_name, r.records_total, r.records_succeeded, r.load_status) for r in history) == [
        ("f1", 1, 1, "Success"), ("f2", 2, 2, "Success")]


def test_batches_are_compacted_into_days(spark, tmp_path, name):
    from stratum.streaming.incremental import compacted
    out, days = f"{tmp_path}/out", f"{tmp_path}/days"
    writer = append_batches(out)
    for number in range(4):
        writer(spark.createDataFrame([(number, DAY), (10 + number, DAY + dt.timedelta(number)), (20, None)], "v int, at date"), number)
        if number % 2:
            assert compacted(spark, out, "at", days) == 2 and compacted(spark, out, "at", days) == 0
            os.remove(f"{days}/_compacted/batch-{number}")  # as if the run had ended before its last mark
            assert compacted(spark, out, "at", days) == 1
    found = spark.read.parquet(days)
    assert sorted(map(tuple, found.select("v", "ingest_batch").collect())) == sorted(
        map(tuple, spark.read.parquet(out).select("v", "ingest_batch").collect()))
    assert len([p for p in (tmp_path / "days").iterdir() if p.name.startswith("ingest_day=")]) == 5


def test_incremental_runs_keep_history(spark, tmp_path, name):
    base = str(tmp_path)
    spec = _batch_spec(name, base)
    for n in (1, 2):
        spark.createDataFrame([(n, DAY), (5, DAY)], "v int, at date").coalesce(1).write.mode("append").parquet(f"{base}/in")
        run_incremental(spark, spec, again(f"r{n}"), f"{base}/cp")
    assert spark.table(name).count() == 4 and spark.table(f"{name}_rows").count() == 1
    assert [(r.records_total, r.load_status) for r in spark.table(f"{name}_files").collect()] == [(2, "Success")] * 2
