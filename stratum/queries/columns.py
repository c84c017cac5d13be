"""Column operators."""

from pyspark.sql import functions as F

from stratum.operators.columns import (
    RunInfo,
    all_text,
    converted,
    filled,
    keep,
    moved_last,
    renamed,
    standardized,
    with_lineage,
    without,
)
from stratum.operators.names import with_clean_names, with_replaced_in_names
from stratum.queries import query, table
from stratum.queries.fixtures import RUN


@query("""
    SELECT p_partkey AS part_id, trim(lower('  ' || p_name || ' ')) AS title,
           upper(trim(lower(' ' || p_brand))) AS brand, trim(lower(p_type)) AS p_type, p_size
    FROM part
""")
def rename_then_standardize(spark, sf):
    padded = table(spark, sf, "part").selectExpr(
        "p_partkey", "'  ' || p_name || ' ' as p_name", "' ' || p_brand as p_brand", "p_type", "p_size")
    return standardized(padded, rename={"p_partkey": "part_id", "p_name": "name", "name": "title", "p_brand": "brand",
                                        "no_such": "x"},
                        case="lower", trim_all=True, upper=["brand"])


@query("""
    SELECT c_custkey, trim('  ' || c_name || '  ') AS c_name, lower(c_mktsegment) AS segment_low,
           upper(c_mktsegment || ' x') AS segment_up
    FROM customer
""")
def standardize_listed_columns(spark, sf):
    df = table(spark, sf, "customer").selectExpr(
        "c_custkey", "'  ' || c_name || '  ' as c_name", "c_mktsegment as segment_low", "c_mktsegment || ' x' as segment_up")
    return standardized(df, strip=["c_name", "missing"], lower=["segment_low"], upper=["segment_up"])


@query("""
    SELECT o_orderkey, upper(o_orderpriority) AS o_orderpriority, upper(o_orderstatus) AS o_orderstatus FROM orders
""")
def standardize_upper_all(spark, sf):
    return standardized(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), case="upper")


@query("SELECT c_custkey AS b, c_name AS d FROM customer")
def rename_in_sequence(spark, sf):
    return renamed(table(spark, sf, "customer").select("c_custkey", "c_name"),
                   {"c_custkey": "a", "a": "b", "c_name": "c", "c": "d", "unknown": "e"})


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(user_id AS VARCHAR) AS user_id
    FROM events
""")
def casts_strict(spark, sf):
    df = table(spark, sf, "events").selectExpr("event_id", "get_json_object(props, '$.k') as k", "user_id")
    return converted(df, [("k", "int"), ("user_id", "string"), ("missing", "int")])


@query("""
    SELECT event_id,
           CASE WHEN event_type IN ('click', 'view')
                THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
    FROM events
""")
def casts_null_on_error(spark, sf):
    df = table(spark, sf, "events").selectExpr(
        "event_id", "if(event_type in ('click', 'view'), '', 'x') || get_json_object(props, '$.k') as k")
    return converted(df, [("k", "int")], on_error="null")


@query("""
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
           l_returnflag, CAST(l_shipdate AS VARCHAR) AS l_shipdate
    FROM lineitem
""")
def all_to_string(spark, sf):
    return all_text(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"))


@query("SELECT c_name, c_acctbal, c_custkey FROM customer")
def drop_select_move(spark, sf):
    df = without(table(spark, sf, "customer"), ["c_nationkey", "unknown"])
    df = keep(df, ["c_custkey", "c_name", "unknown", "c_acctbal"])
    return moved_last(df, ["c_custkey", "unknown"])


@query("""
    SELECT o_orderkey AS order_key, o_custkey AS "cust", o_orderstatus AS _status, o_orderpriority AS "col",
           o_totalprice AS "Status", o_orderdate AS "status_1"
    FROM orders
""")
def sanitize_names(spark, sf):
    df = table(spark, sf, "orders")
    ugly = ["order key", "(cust)", "_status", "()", "Status", "status"]
    return with_clean_names(df.select(*[
        F.col(c).alias(n) for c, n in zip(
            ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate"], ugly)]))


@query("SELECT o_orderkey AS o_orderkey, o_custkey AS \"cust-key\" FROM orders")
def replace_name_chars(spark, sf):
    df = table(spark, sf, "orders").selectExpr("o_orderkey as `o.orderkey`", "o_custkey as `cust-key`")
    return with_replaced_in_names(df, ".", "_")


@query("""
    SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def fill_defaults(spark, sf):
    df = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return filled(df, {"quality": -1, "toxic": 0})


@query("""
    SELECT *, 'customer.parquet' AS file_name, 'corr-1' AS correlation_id, 'job-1' AS job_id, 'run-1' AS run_id,
           'loader' AS load_create_user_id, CAST(NULL AS VARCHAR) AS load_update_user_id,
           '2024-05-01 06:00:00' AS created, CAST(NULL AS VARCHAR) AS updated
    FROM customer
""")
def lineage_columns(spark, sf):
    df = with_lineage(table(spark, sf, "customer"), RUN)
    return df.selectExpr("* except (load_create_dtm, load_update_dtm)", "cast(load_create_dtm as string) as created",
                         "cast(load_update_dtm as string) as updated")


@query("""
    SELECT s_suppkey, 'given.csv' AS file_name, CAST(NULL AS VARCHAR) AS run_id FROM supplier
""")
def lineage_given_file_name(spark, sf):
    df = with_lineage(table(spark, sf, "supplier"), RunInfo(started=RUN.started), file_name="given.csv")
    return df.select("s_suppkey", "file_name", "run_id")
