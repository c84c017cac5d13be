"""Table sinks, read back."""

from pyspark.sql import functions as F

from stratum.operators.reconcile import loaded_per_file, log_level_counts, reconciled
from stratum.operators.aggregate import rows_per_file
from stratum.queries import query, table
from stratum.queries.fixtures import folder, fresh_table
from stratum.sinks import tables
from stratum.sinks.clustering import clustered


@query("""
    SELECT c_custkey, c_name, NULL AS c_mktsegment FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer WHERE c_acctbal >= 0
""")
def append_evolve(spark, sf):
    """The second append brings a new column and lacks an old one."""
    name = fresh_table("append")
    customer = table(spark, sf, "customer")
    tables.append(customer.where("c_acctbal < 0").select("c_custkey", "c_name"), name, location=folder(spark, name))
    tables.append(customer.where("c_acctbal >= 0").select("c_mktsegment", "c_custkey"), name)
    return spark.table(name)


@query("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def overwrite_swap(spark, sf):
    """The new rows are computed from the table they replace."""
    name = fresh_table("overwrite")
    tables.create(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), name,
                  location=folder(spark, name))
    new = spark.table(name).where("o_orderstatus = 'F'").selectExpr("o_orderkey", "o_totalprice * 2 as o_totalprice")
    tables.overwrite(new, name)
    return spark.table(name)


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey > 10")
def overwrite_partitioned(spark, sf):
    name = fresh_table("partitioned")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.create(orders, name, ["o_orderstatus"], folder(spark, name))
    tables.overwrite(spark.table(name).where("o_custkey > 10"), name)
    return spark.table(name)


@query("""
    SELECT CASE WHEN o_orderstatus = 'F' THEN 'F.csv' ELSE 'rest.csv' END AS source_name, count(*) AS records_total,
           CAST(sum(CASE WHEN o_orderstatus = 'F' OR o_orderpriority <> '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS records_succeeded,
           CASE WHEN o_orderstatus = 'F' THEN 'Success' ELSE 'Failed' END AS load_status
    FROM orders GROUP BY ALL
    UNION ALL SELECT 'lost.csv', count(*), 0, 'Failed' FROM customer
""")
def file_load_reconcile(spark, sf):
    name = fresh_table("load")
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey as id", "if(o_orderstatus = 'F', 'F.csv', 'rest.csv') as file_name", "o_orderpriority", "o_orderstatus")
    lost = table(spark, sf, "customer").selectExpr("c_custkey as id", "'lost.csv' as file_name")
    loaded = orders.where("o_orderstatus = 'F' or o_orderpriority <> '1-URGENT'").withColumn("run_id", F.lit("run-1"))
    tables.append(loaded.withColumn("run_id", F.lit("run-0")), name, location=folder(spark, name))
    tables.append(loaded, name)
    totals = rows_per_file(orders.select("id", "file_name").unionByName(lost), name="records_total")
    return reconciled(totals, loaded_per_file(spark.table(name), "run-1"))


@query("""
    SELECT 'run-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
           CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' ELSE 'INFO' END AS level, count(*) AS lines
    FROM events GROUP BY 1, 2
""")
def log_level_counts_by_run(spark, sf):
    lines = table(spark, sf, "events").selectExpr(
        "'run-' || to_date(ts) as run_id",
        """ts || ' - ' || case event_type when 'error' then 'ERROR' when 'view' then 'WARNING' else 'INFO' end
           || ' - shop.' || event_type || ':handle() - value - ' || value as code_message""")
    return log_level_counts(lines)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_shipdate::VARCHAR AS l_shipdate FROM lineitem
    WHERE l_partkey < (SELECT max(p_partkey) / 10 FROM part) OR l_shipdate < TIMESTAMP '1993-01-01'
""")
def clustered_write(spark, sf):
    """Lines ordered by part and day together, read back by either."""
    name = fresh_table("clustered")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate")
    tables.create(clustered(lines, ["l_partkey", "l_shipdate"]), name, location=folder(spark, name))
    limit = table(spark, sf, "part").agg((F.max("p_partkey") / 10).alias("part")).first().part
    found = spark.table(name).where((F.col("l_partkey") < limit) | (F.col("l_shipdate") < F.expr("timestamp_ntz '1993-01-01'")))
    return found.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
