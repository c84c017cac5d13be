"""Quality checks."""

from pyspark.sql import functions as F

from stratum.operators import quality
from stratum.queries import query, table
from stratum.queries.fixtures import RUN

EVENT_RULES = quality.parse_rules([
    {"check": {"function": "sql_expression", "arguments": {
        "name": "value_in_range", "expression": "value between 5 and 480", "msg": "value out of range"}},
     "criticality": "error"},
    {"check": {"function": "sql_expression", "criticality": "warn", "arguments": {
        "name": "type_has_no_r", "expression": 'event_type rlike "^[^r]+$"', "msg": "type holds an r"}}},
    {"check": {"function": "sql_expression", "arguments": {
        "name": "k_small", "expression": "nullif(cast(get_json_object(props, '$.k') as int), 50) < 90",
        "msg": "k is large"}}},
])

_FLAGS = """
    flags AS (SELECT *, coalesce(NOT (value BETWEEN 5 AND 480), FALSE) AS e1,
        NOT regexp_matches(event_type, '^[^r]+$') AS w1,
        coalesce(NOT (nullif(CAST(json_extract_string(props, '$.k') AS INTEGER), 50) < 90), FALSE) AS e2 FROM events)
"""


def _checked(spark, sf):
    return quality.annotated(table(spark, sf, "events"), EVENT_RULES)


def _names(column):
    return F.concat_ws(",", F.transform(column, lambda e: e["name"])).alias(column)


@query(f"""
    WITH {_FLAGS}
    SELECT event_id, concat_ws(',', CASE WHEN e1 THEN 'value_in_range' END, CASE WHEN e2 THEN 'k_small' END) AS dq_errors,
           CASE WHEN w1 THEN 'type_has_no_r' ELSE '' END AS dq_warnings, NOT (e1 OR e2) AS no_errors
    FROM flags
""")
def dq_annotate(spark, sf):
    return _checked(spark, sf).select(
        "event_id", _names("dq_errors"), _names("dq_warnings"), F.col("dq_errors").isNull().alias("no_errors"))


@query(f"WITH {_FLAGS} SELECT * EXCLUDE (e1, e2, w1) FROM flags WHERE NOT (e1 OR e2)")
def dq_passed(spark, sf):
    return quality.passed(_checked(spark, sf))


@query(f"WITH {_FLAGS} SELECT event_id, event_type, value FROM flags WHERE e1 OR e2 OR w1")
def dq_quarantined(spark, sf):
    return quality.quarantined(_checked(spark, sf)).select("event_id", "event_type", "value")


@query(f"""
    WITH {_FLAGS}
    SELECT 'corr-1' AS correlation_id, kind AS quality_check_type, name, message, count(*) AS "count",
           'events' AS source_table_path, 'job-1' AS job_id, 'run-1' AS run_id, 3 AS checks
    FROM (SELECT 'error' AS kind, 'value_in_range' AS name, 'value out of range' AS message FROM flags WHERE e1
          UNION ALL SELECT 'error', 'k_small', 'k is large' FROM flags WHERE e2
          UNION ALL SELECT 'warn', 'type_has_no_r', 'type holds an r' FROM flags WHERE w1)
    GROUP BY kind, name, message
""")
def dq_summary(spark, sf):
    failing = quality.quarantined(_checked(spark, sf))
    summary = quality.failure_summary(failing, "events", RUN, EVENT_RULES)
    return summary.withColumn("checks", F.expr("json_array_length(to_json(checks))")).drop("processed_time")


@query(f"""
    WITH {_FLAGS}
    SELECT 'events' AS source_table_path, 'corr-1' AS correlation_id, 'job-1' AS job_id, 'run-1' AS run_id,
           event_id, event_type, props, (e1 OR e2) AS has_error
    FROM flags WHERE e1 OR e2 OR w1
""")
def dq_exceptions_json(spark, sf):
    rows = quality.exception_rows(quality.quarantined(_checked(spark, sf)), "events", RUN)
    return rows.selectExpr(
        "source_table_path", "correlation_id", "job_id", "run_id",
        "variant_get(exception_record, '$.event_id', 'bigint') as event_id",
        "variant_get(exception_record, '$.event_type', 'string') as event_type",
        "variant_get(exception_record, '$.props', 'string') as props",
        "variant_get(exception_record, '$.dq_errors[0].name', 'string') is not null as has_error")


@query()
def dq_exceptions_variant(spark, sf):
    """VARIANT output has no SQL type to compare with."""
    return quality.exception_rows(quality.quarantined(_checked(spark, sf)), "events", RUN)


@query("""
    SELECT o_orderstatus, 'warn' AS quality_check_type, 'old' AS name, count(*) AS "count" FROM orders
    WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00' GROUP BY o_orderstatus
    UNION ALL SELECT o_orderstatus, 'error', 'cheap', count(*) FROM orders WHERE o_totalprice < 20000 GROUP BY o_orderstatus
""")
def dq_failure_counts_by_group(spark, sf):
    rules = [quality.Rule("old", "o_orderdate >= timestamp_ntz '1996-01-01 00:00:00'", "old order", "warn"),
             quality.Rule("cheap", "o_totalprice >= 20000", "cheap order")]
    failing = quality.quarantined(quality.annotated(table(spark, sf, "orders"), rules))
    return quality.failure_counts(failing, ["o_orderstatus"]).drop("message")
