"""Filters, derived columns and aggregation."""

from stratum.operators.aggregate import aggregated, rows_per_file
from stratum.operators.columns import with_expressions
from stratum.operators.percentiles import percentiles
from stratum.operators.rows import (
    deduplicated,
    union_all,
    where_all,
    where_in,
    where_not_null,
    where_null,
    where_run,
)
from stratum.plans.frames import gold_frame
from stratum.queries import query, table
from stratum.spec import PipelineSpec

PRICING = {
    "pipeline_metadata": {"name": "pricing_summary", "layer": "gold"},
    "source": {"type": "table", "properties": {"table": "lineitem"}},
    "transform": {
        "with_columns": [
            # Precisions that keep the product within 18 digits, which Spark computes in a machine word.
            {"name": "disc_price", "expr": "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(3,2)))"},
            {"name": "charge", "expr": "disc_price * (1 + cast(l_tax as decimal(3,2)))"},
        ],
        "filters": ["l_shipdate <= timestamp_ntz '1998-09-02 00:00:00'"],
        "aggregations": {
            "group_by": ["l_returnflag", "l_linestatus"],
            "metrics": [
                {"name": "sum_qty", "expr": "cast(sum(cast(l_quantity as decimal(18,2))) as double)"},
                {"name": "sum_disc_price", "expr": "cast(sum(disc_price) as double)"},
                {"name": "sum_charge", "expr": "round(cast(sum(charge) as double), 2)"},
                {"name": "avg_disc", "expr": "round(avg(l_discount), 6)"},
                {"name": "count_order", "expr": "count(*)"},
            ],
        },
    },
    "destination": {"table": "pricing_summary", "mode": "overwrite"},
}


@query("""
    SELECT l_returnflag, l_linestatus,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS sum_disc_price,
           round(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(6,2))) * (1 + CAST(l_tax AS DECIMAL(6,2)))) AS DOUBLE), 2) AS sum_charge,
           round(avg(l_discount), 6) AS avg_disc,
           count(*) AS count_order
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00'
    GROUP BY l_returnflag, l_linestatus
""")
def gold_pricing_summary(spark, sf):
    return gold_frame(table(spark, sf, "lineitem"), PipelineSpec.of(PRICING))


@query("""
    SELECT o_orderpriority, o_orderstatus, count(DISTINCT o_custkey) AS customers,
           max(o_totalprice) AS largest, min(o_orderdate) AS first_order,
           CAST(sum(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END) AS BIGINT) AS large_orders,
           count(DISTINCT date_trunc('month', o_orderdate)) AS months
    FROM orders GROUP BY o_orderpriority, o_orderstatus
""")
def agg_open_expressions(spark, sf):
    return aggregated(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], [
        {"name": "customers", "expr": "count(distinct o_custkey)"},
        {"name": "largest", "expr": "max(o_totalprice)"},
        {"name": "first_order", "expr": "min(o_orderdate)"},
        {"name": "large_orders", "expr": "sum(case when o_totalprice > 250000 then 1 else 0 end)"},
        {"name": "months", "expr": "count(distinct date_trunc('month', o_orderdate))"},
    ])


@query("""
    SELECT count(*) AS orders, count(DISTINCT o_custkey) AS customers, max(o_totalprice) AS largest FROM orders
""")
def agg_whole_table(spark, sf):
    return aggregated(table(spark, sf, "orders"), [], [
        {"name": "orders", "expr": "count(*)"},
        {"name": "customers", "expr": "count(distinct o_custkey)"},
        {"name": "largest", "expr": "max(o_totalprice)"},
    ], whole_table=True)


@query("SELECT * FROM customer")
def agg_without_groups_is_input(spark, sf):
    return aggregated(table(spark, sf, "customer"), [], [{"name": "n", "expr": "count(*)"}])


@query("""
    SELECT o_orderkey, upper(o_orderpriority) AS priority, upper(o_orderpriority) || '/' || o_orderstatus AS tag,
           CAST(length(upper(o_orderpriority) || '/' || o_orderstatus) AS INTEGER) AS tag_length
    FROM orders
""")
def with_columns_chain(spark, sf):
    df = with_expressions(table(spark, sf, "orders"), [
        ("priority", "upper(o_orderpriority)"),
        ("tag", "priority || '/' || o_orderstatus"),
        ("broken", "no_such_column + 1"),
        ("tag_length", "length(tag)"),
    ], on_error="skip")
    return df.select("o_orderkey", "priority", "tag", "tag_length")


@query("""
    SELECT o_orderkey, o_custkey,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth,
           count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                          ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent
    FROM orders
""")
def with_columns_window(spark, sf):
    window = "partition by o_custkey order by o_orderdate, o_orderkey"
    return with_expressions(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), [
        ("nth", f"cast(row_number() over ({window}) as bigint)"),
        ("recent", f"count(*) over ({window} rows between 2 preceding and current row)"),
    ]).drop("o_orderdate")


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           hour(ts) AS hour, list_contains(['click','view'], event_type) AS browsing,
           substr(event_type, 1, 2) || '_' || CAST(user_id AS VARCHAR) AS label,
           abs(round(value) - 250) AS distance
    FROM events
""")
def open_expression_surface(spark, sf):
    df = with_expressions(table(spark, sf, "events"), [
        ("k", "cast(get_json_object(props, '$.k') as int)"),
        ("hour", "cast(hour(ts) as bigint)"),
        ("browsing", "array_contains(array('click', 'view'), event_type)"),
        ("label", "substr(event_type, 1, 2) || '_' || user_id"),
        ("distance", "abs(round(value) - 250)"),
    ])
    return df.select("event_id", "k", "hour", "browsing", "label", "distance")


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE l_quantity < 24 AND l_discount BETWEEN 0.05 AND 0.07 AND l_shipdate >= TIMESTAMP '1994-01-01 00:00:00'
""")
def filters_conjunction(spark, sf):
    df = where_all(table(spark, sf, "lineitem"), [
        "l_quantity < 24",
        "l_discount between 0.05D and 0.07D",
        "l_shipdate >= timestamp_ntz '1994-01-01 00:00:00'",
    ])
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("""
    SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr')
""")
def filter_membership(spark, sf):
    return where_in(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ["de", "fr"])


@query("""
    SELECT CASE WHEN l.quality IS NULL THEN 'unlabelled' ELSE 'labelled' END AS kind, count(*) AS docs
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1
""")
def filter_null_and_not_null(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    both = union_all([
        where_null(joined, "quality").selectExpr("'unlabelled' as kind", "doc_id"),
        where_not_null(joined, "quality").selectExpr("'labelled' as kind", "doc_id"),
    ])
    return aggregated(both, ["kind"], [{"name": "docs", "expr": "count(*)"}])


@query("SELECT event_id, 'run-' || event_type AS run_id FROM events WHERE event_type = 'click'")
def filter_run(spark, sf):
    runs = table(spark, sf, "events").selectExpr("event_id", "'run-' || event_type as run_id")
    return where_run(runs, "run-click")


@query(r"""
    SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https?://[^/]*[0-9]')
""")
def filter_regex(spark, sf):
    return where_all(table(spark, sf, "pages").select("page_id", "url"), ["url rlike '^https?://[^/]*[0-9]'"])


@query("SELECT DISTINCT text, lang FROM documents")
def dedup_exact(spark, sf):
    return deduplicated(table(spark, sf, "documents").select("text", "lang"))


@query("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                     l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1
""")
def dedup_latest_by_key(spark, sf):
    return deduplicated(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate desc"])


@query("""
    SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
    UNION ALL SELECT 'part', p_partkey, p_name FROM part
""")
def union_by_name(spark, sf):
    return union_all([
        table(spark, sf, "customer").selectExpr("'customer' as kind", "c_custkey as id", "c_name as name"),
        table(spark, sf, "supplier").selectExpr("s_name as name", "'supplier' as kind", "s_suppkey as id"),
        table(spark, sf, "part").selectExpr("p_partkey as id", "p_name as name", "'part' as kind"),
    ])


@query("""
    SELECT 'orders.parquet' AS file_name, count(*) AS rows FROM orders
    UNION ALL SELECT 'lineitem.parquet', count(*) FROM lineitem
""")
def rows_by_source_file(spark, sf):
    from pyspark.sql import functions as F
    names = [table(spark, sf, t).select(F.col("_metadata.file_name").alias("file_name")) for t in ("orders", "lineitem")]
    return rows_per_file(union_all(names))


@query("""
    SELECT CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS flag,
           round(quantile_cont(l_extendedprice, 0.01), 6) AS p01, round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
           round(quantile_cont(l_extendedprice, 0.999), 6) AS p999, max(l_extendedprice) AS largest
    FROM lineitem GROUP BY 1
""")
def agg_exact_percentiles(spark, sf):
    """Half of all rows are one group; all groups go through sketched intervals."""
    lines = table(spark, sf, "lineitem").selectExpr("nullif(l_returnflag, 'N') as flag", "l_extendedprice")
    found = percentiles(lines, ["flag"], "l_extendedprice", {"p01": 0.01, "median": 0.5, "p999": 0.999, "largest": 1.0},
                        whole_group=1000, accuracy=1000)
    return found.selectExpr("flag", "round(p01, 6) as p01", "round(median, 6) as median", "round(p999, 6) as p999", "largest")
