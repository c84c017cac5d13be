"""Whole layer runs, read back from their tables."""

from pyspark.sql import functions as F

from stratum.operators.aggregate import aggregated
from stratum.operators.columns import RunInfo
from stratum.plans.incremental_gold import refreshed
from stratum.plans.runs import run
from stratum.queries import query, table
from stratum.queries.fixtures import AS_OF, RUN, folder, fresh_table, write_parts
from stratum.sinks import tables
from stratum.spec import PipelineSpec
from stratum.streaming.incremental import append_batches, compacted, drain, new_files, run_incremental

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _bronze_spec(spark, sf, name, base):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    write_parts(events.where("event_type = 'error'"), f"{base}/in", "err", "_1.csv", header=True)
    write_parts(events.where("event_type <> 'error'"), f"{base}/in", "rest", "_2.csv", header=False)
    return PipelineSpec.of({
        "pipeline_metadata": {"name": "events_bronze", "layer": "bronze"},
        "source": {"type": "file", "properties": {
            "source_path": f"{base}/in", "format": "csv", "extension": ".csv"}},
        "transform": {"with_columns": [{"name": "kind", "expr": "' ' || event_type"}],
                      "standardize": {"case": "upper", "trim_strings": True, "lowercase": ["event_type"]}},
        "destination": {"table": name, "mode": "append", "location": f"{base}/table"},
        "audit": {"load_history": f"{name}_history", "run_status": f"{name}_status", "location": base},
    })


@query("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, upper(props) AS props, upper(event_type) AS kind,
           'run-1' AS run_id, CASE WHEN event_type = 'error' THEN 'err' ELSE 'rest' END AS file_name,
           sha256(concat_ws('||', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type, props)) AS row_hash
    FROM events
""")
def bronze_load(spark, sf):
    name, base = fresh_table("bronze"), folder(spark, "bronze")
    run(spark, _bronze_spec(spark, sf, name, base), RUN, AS_OF)
    return spark.table(name).selectExpr("event_id", "event_type", "props", "kind", "run_id",
                                        "regexp_extract(file_name, '^([a-z]+)', 1) as file_name", "row_hash")


@query("""
    SELECT CASE WHEN event_type = 'error' THEN 'err' ELSE 'rest' END AS file_kind, 'append' AS operation_type,
           count(*) AS records_total, count(*) AS records_succeeded, 'Success' AS load_status
    FROM events GROUP BY 1
""")
def bronze_load_history(spark, sf):
    name, base = fresh_table("bronze"), folder(spark, "bronze")
    run(spark, _bronze_spec(spark, sf, name, base), RUN, AS_OF)
    return spark.table(f"{name}_history").groupBy("source_name", "operation_type", "load_status").sum(
        "records_total", "records_succeeded").toDF("source_name", "operation_type", "load_status", "t", "s").selectExpr(
        "regexp_extract(source_name, '([a-z]+)[0-9]+_[0-9].csv$', 1) as file_kind", "*").groupBy(
        "file_kind", "operation_type", "load_status").sum("t", "s").toDF(
        "file_kind", "operation_type", "load_status", "records_total", "records_succeeded")


@query("""
    SELECT CASE WHEN event_type = 'error' THEN '09/part0.csv' ELSE '10/part0.csv' END AS file, count(*) AS records_total,
           count(*) AS records_succeeded, 'Success' AS load_status
    FROM events GROUP BY 1
    UNION ALL SELECT '10/void0.csv', 0, 0, 'Success'
""")
def bronze_history_by_path(spark, sf):
    """Files of one name in two day folders, and one without a row, in a raw table partitioned by load."""
    name, base = fresh_table("bronze"), folder(spark, "bronze")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    for day, rows in (("09", events.where("event_type = 'error'")), ("10", events.where("event_type <> 'error'"))):
        write_parts(rows.coalesce(1), f"{base}/in/2024/05/{day}", "part", ".csv", header=True)
    write_parts(events.limit(0), f"{base}/in/2024/05/10", "void", ".csv", header=True)
    spec = PipelineSpec.of({
        "pipeline_metadata": {"name": "events_by_path", "layer": "bronze"},
        "source": {"type": "file", "properties": {
            "source_path": f"{base}/in", "format": "csv", "extension": ".csv", "options": {"header": True},
            "discover": {"type": "date_hierarchy", "last_n_days": 2}, "multi_split": {"enabled": False}}},
        "transform": {},
        "lineage": {"path": "source_path"},
        "destination": {"table": name, "mode": "append", "location": f"{base}/table", "partition_by": ["run_id"]},
        "audit": {"load_history": f"{name}_history", "location": base},
    })
    for run_id in ("run-0", "run-1"):
        run(spark, spec, RunInfo("corr-1", "job-1", run_id, "loader", RUN.started), AS_OF)
    history = spark.table(f"{name}_history")
    assert history.count() == 6
    return history.selectExpr("regexp_extract(source_name, '([0-9]+/[a-z]+[0-9]+.csv)$', 1) as file", "records_total",
                              "records_succeeded", "load_status").distinct()


@query("""
    SELECT 'run-1' AS run_id, 'events_bronze' AS pipeline, 'bronze' AS layer, 'success' AS status, count(*) AS rows,
           '2024-05-01 06:00:00' AS start_dtm, CAST(NULL AS VARCHAR) AS error
    FROM events
""")
def run_status_rows(spark, sf):
    name, base = fresh_table("bronze"), folder(spark, "bronze")
    run(spark, _bronze_spec(spark, sf, name, base), RUN, AS_OF)
    return spark.table(f"{name}_status").selectExpr(
        "run_id", "pipeline", "layer", "status", "rows", "cast(start_dtm as string) as start_dtm", "error")


def _silver_spec(source, name, base, **extra):
    return PipelineSpec.of({
        "pipeline_metadata": {"name": "orders_silver", "layer": "silver"},
        "source": {"type": "table", "properties": {"table": source}},
        "transform": {
            "with_columns": [{"name": "year", "expr": "cast(year(o_orderdate) as string)"}],
            "standardize": {"trim_strings": True, "lowercase": ["o_orderpriority"]},
            "casts": [{"column": "year", "to_type": "int"}]},
        "data_quality": [
            {"check": {"function": "sql_expression", "arguments": {
                "name": "price", "expression": "o_totalprice >= 20000", "msg": "cheap"}}, "criticality": "error"},
            {"check": {"function": "sql_expression", "arguments": {
                "name": "year", "expression": "year >= 1996", "msg": "old"}, "criticality": "warn"}}],
        "destination": {"table": name, "mode": "overwrite", "location": f"{base}/table"},
        "security": {"masking": [{"column": "o_orderpriority", "policy": "mask_text"}]},
        "audit": {"exceptions": f"{name}_exceptions", "summary": f"{name}_summary", "location": base},
        **extra,
    })


def _silver(spark, sf, destination_mode="overwrite", empty_result="write", **extra):
    name, base = fresh_table("silver"), folder(spark, "silver")
    tables.create(table(spark, sf, "orders"), f"{name}_in", location=f"{base}/in")
    target = {"table": name, "mode": destination_mode, "location": f"{base}/table", "empty_result": empty_result}
    run(spark, _silver_spec(f"{name}_in", name, base, destination=target, **extra), RUN)
    return name


@query("""
    SELECT o_orderkey, regexp_replace(regexp_replace(lower(o_orderpriority), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS o_orderpriority,
           CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders
""")
def silver_refine(spark, sf):
    """All rows are kept, failures are recorded, readers see the masked view."""
    return spark.table(f"{_silver(spark, sf)}_masked").select("o_orderkey", "o_orderpriority", "year")


@query("SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_totalprice >= 20000")
def silver_refine_dropping(spark, sf):
    return spark.table(_silver(spark, sf, on_fail="drop")).select("o_orderkey", "o_totalprice", "year")


@query("""
    SELECT 'error' AS quality_check_type, 'price' AS name, count(*) AS "count" FROM orders WHERE o_totalprice < 20000
    UNION ALL SELECT 'warn', 'year', count(*) FROM orders WHERE year(o_orderdate) < 1996
""")
def silver_summary(spark, sf):
    return spark.table(f"{_silver(spark, sf)}_summary").select("quality_check_type", "name", "count")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 20000 OR year(o_orderdate) < 1996
""")
def silver_exceptions(spark, sf):
    rows = spark.table(f"{_silver(spark, sf, on_fail='drop')}_exceptions")
    return rows.selectExpr("variant_get(exception_record, '$.o_orderkey', 'bigint') as o_orderkey",
                           "variant_get(exception_record, '$.o_totalprice', 'double') as o_totalprice")


@query("""
    SELECT 'by_status' AS target, o_orderstatus AS key, count(*) AS orders FROM orders GROUP BY o_orderstatus
    UNION ALL SELECT 'by_year', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders GROUP BY 2
    UNION ALL SELECT 'kept', 'old', count(*) FROM orders
""")
def gold_multi_target(spark, sf):
    """A table, a view, and a target whose empty result leaves the old rows in place."""
    name, base = fresh_table("gold"), folder(spark, "gold")
    orders = table(spark, sf, "orders")
    tables.create(orders, f"{name}_in", location=f"{base}/in")
    count = [{"name": "orders", "expr": "count(*)"}]
    old = aggregated(orders, [], count, whole_table=True).selectExpr("'old' as o_orderstatus", "orders")
    tables.create(old, f"{name}_kept", location=f"{base}/kept")
    run(spark, PipelineSpec.of({
        "pipeline_metadata": {"name": "orders_gold", "layer": "gold"},
        "source": {"type": "delta_table", "properties": {"table": f"{name}_in"}},
        "transform": {"with_columns": [{"name": "year", "expr": "year(o_orderdate)"}]},
        "target": [
            {"name": "status", "target": f"{name}_status", "write_mode": "overwrite", "location": f"{base}/status",
             "aggregations": {"group_by": ["o_orderstatus"], "metrics": count}},
            {"name": "year", "target": f"{name}_year", "materialization": "view",
             "aggregations": {"group_by": ["year"], "metrics": count}},
        ],
    }), RUN)
    run(spark, PipelineSpec.of({
        "pipeline_metadata": {"name": "orders_gold_empty", "layer": "gold"},
        "source": {"type": "delta_table", "properties": {"table": f"{name}_in"}},
        "transform": {"filters": ["o_totalprice < 0"],
                      "aggregations": {"group_by": ["o_orderstatus"], "metrics": count}},
        "target": {"table": f"{name}_kept", "mode": "overwrite", "empty_result": "skip"},
    }), RUN)
    return (
        spark.table(f"{name}_status").selectExpr("'by_status' as target", "o_orderstatus as key", "orders")
        .unionByName(spark.table(f"{name}_year").selectExpr("'by_year' as target", "cast(year as string) as key", "orders"))
        .unionByName(spark.table(f"{name}_kept").selectExpr("'kept' as target", "o_orderstatus as key", "orders"))
    )


@query("SELECT event_id, event_type, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS second_run FROM events")
def incremental_ingest(spark, sf):
    """Two runs over a growing folder; the second takes the new files only."""
    base = folder(spark, "stream")
    events = table(spark, sf, "events")
    for number, condition in enumerate(["event_type <> 'view'", "event_type = 'view'"]):
        events.where(condition).write.mode("append").parquet(f"{base}/in")
        marked = append_batches(f"{base}/out", lambda df, n=number: df.selectExpr("event_id", "event_type", f"{n} as second_run"))
        drain(new_files(spark, f"{base}/in", "parquet", EVENT_SCHEMA), f"{base}/checkpoint", marked)
    return spark.read.parquet(f"{base}/out").select("event_id", "event_type", "second_run")


@query("SELECT event_id, upper(event_type) AS event_type, value + 1 AS value, 'run-2' AS run_id FROM events")
def incremental_merge(spark, sf):
    """The same rows arrive again with new values: the second run updates them by key."""
    base, name = folder(spark, "stream"), fresh_table("stream")
    spec = PipelineSpec.of({
        "pipeline_metadata": {"name": "events_stream", "layer": "bronze"},
        "source": {"type": "cloudfiles", "properties": {"source_path": f"{base}/in", "format": "parquet", "schema": EVENT_SCHEMA}},
        "transform": {"standardize": {"uppercase": ["event_type"]}},
        "destination": {"table": name, "mode": "merge", "primary_keys": ["event_id"], "location": f"{base}/table"},
    })
    for run_id, shift in (("run-1", 0), ("run-2", 1)):
        table(spark, sf, "events").selectExpr("* except (value)", f"value + {shift} as value").select(
            "event_id", "ts", "user_id", "event_type", "value", "props").write.mode("append").parquet(f"{base}/in")
        run_incremental(spark, spec, RunInfo("corr-1", "job-1", run_id, "loader", RUN.started), f"{base}/checkpoint")
    return spark.table(name).select("event_id", "event_type", "value", "run_id")


@query("""
    SELECT 'rows' AS part, count(*) AS n FROM orders
    UNION ALL SELECT 'exceptions', count(*) FROM orders WHERE o_totalprice < 20000 OR year(o_orderdate) < 1996
""")
def silver_append_fail_on_empty(spark, sf):
    """An append that must not be empty still records every failing row."""
    name = _silver(spark, sf, destination_mode="append", empty_result="fail")
    count = F.count(F.lit(1)).alias("n")
    return spark.table(name).select(F.lit("rows").alias("part")).groupBy("part").agg(count).unionByName(
        spark.table(f"{name}_exceptions").select(F.lit("exceptions").alias("part")).groupBy("part").agg(count))


@query("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_totalprice * 2 + 1 AS next FROM orders WHERE o_totalprice * 2 > 50000")
def gold_view_replaced_column(spark, sf):
    """A derived column that replaces one of the source's, in a target published as a view."""
    name, base = fresh_table("gold_view"), folder(spark, "gold_view")
    tables.create(table(spark, sf, "orders"), f"{name}_in", location=f"{base}/in")
    run(spark, PipelineSpec.of({
        "pipeline_metadata": {"name": "orders_view", "layer": "gold"},
        "source": {"type": "table", "properties": {"table": f"{name}_in"}},
        "transform": {"with_columns": [{"name": "o_totalprice", "expr": "o_totalprice * 2"},
                                       {"name": "next", "expr": "o_totalprice + 1"},
                                       {"name": "lost", "expr": "no_such_column"}],
                      "on_column_error": "skip", "filters": ["o_totalprice > 50000"]},
        "target": {"table": name, "materialization": "view"},
    }), RUN)
    return spark.table(name).select("o_orderkey", "o_totalprice", "next")


@query("""
    SELECT 'good' AS part, CAST(event_id AS VARCHAR) AS value FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'corrupt', 'x' || event_id || ',' || event_type FROM events WHERE event_type = 'error'
""")
def bronze_corrupt_records(spark, sf):
    """Malformed records of a split delivery with header lines, kept beside the table."""
    name, base = fresh_table("corrupt"), folder(spark, "corrupt")
    events = table(spark, sf, "events")
    lines = events.selectExpr("if(event_type = 'error', concat('x', event_id), cast(event_id as string)) as event_id", "event_type")
    write_parts(lines.where("event_type = 'error'"), f"{base}/in", "bad", "_1.csv", header=True)
    write_parts(lines.where("event_type <> 'error'"), f"{base}/in", "good", "_2.csv", header=False)
    run(spark, PipelineSpec.of({
        "pipeline_metadata": {"name": "events_bronze", "layer": "bronze"},
        "source": {"type": "file", "properties": {"source_path": f"{base}/in", "format": "csv", "extension": ".csv",
                                                  "schema": "event_id bigint, event_type string"}},
        "destination": {"table": name, "mode": "append", "location": f"{base}/table", "empty_result": "fail",
                        "corrupt_record": f"{name}_corrupt"},
    }), RUN, AS_OF)
    return spark.table(name).selectExpr("'good' as part", "cast(event_id as string) as value").unionByName(
        spark.table(f"{name}_corrupt").selectExpr("'corrupt' as part", "_corrupt_record as value"))


@query("""
    SELECT event_type, count(*) AS events, CAST(sum(user_id) AS BIGINT) AS users, min(event_id) AS first_event, max(value) AS largest,
           round(avg(event_id), 6) AS mean_event
    FROM events GROUP BY event_type
""")
def gold_incremental(spark, sf):
    """Three loads, each merged into the kept states by itself; the last run finds nothing to do."""
    name, base = fresh_table("gold"), folder(spark, "gold")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    metrics = [{"name": "events", "function": "count"}, {"name": "users", "function": "sum", "of": "user_id"},
               {"name": "first_event", "function": "min", "of": "event_id"}, {"name": "largest", "function": "max", "of": "value"},
               {"name": "mean_event", "function": "avg", "of": "event_id"}]
    for n in range(3):
        load = events.where(F.col("event_id") % 3 == n).withColumn("run_id", F.lit(f"run-{n}"))
        tables.append(load, f"{name}_raw", ["run_id"], f"{base}/raw")
        assert refreshed(spark, f"{name}_raw", "run_id", name, ["event_type"], metrics, f"{base}/gold") == [f"run-{n}"]
    assert refreshed(spark, f"{name}_raw", "run_id", name, ["event_type"], metrics, f"{base}/gold") == []
    return spark.table(name).withColumn("mean_event", F.round("mean_event", 6))


@query("""
    SELECT event_id, event_type, CAST(ts AS DATE)::VARCHAR AS day, 1 AS times FROM events
    UNION ALL SELECT -1, 'days', count(DISTINCT CAST(ts AS DATE))::VARCHAR, 1 FROM events
""")
def incremental_compacted(spark, sf):
    """Two runs over a growing folder, each followed by a compaction of its batches into days; the third finds nothing."""
    base = folder(spark, "days")
    events = table(spark, sf, "events")
    for condition in ("event_type <> 'view'", "event_type = 'view'"):
        events.where(condition).write.mode("append").parquet(f"{base}/in")
        drain(new_files(spark, f"{base}/in", "parquet", EVENT_SCHEMA), f"{base}/checkpoint", append_batches(f"{base}/out"))
        assert compacted(spark, f"{base}/out", "ts", f"{base}/days") >= 1
    assert compacted(spark, f"{base}/out", "ts", f"{base}/days") == 0
    days = spark.read.parquet(f"{base}/days").withColumn("day", F.col("ingest_day").cast("string"))
    rows = days.groupBy("event_id", "event_type", "day").agg(F.count("*").cast("int").alias("times"))
    return rows.unionByName(days.agg(F.countDistinct("day").cast("string").alias("day")).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit("days").alias("event_type"), "day", F.lit(1).alias("times")))
