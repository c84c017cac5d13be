"""Upsert, soft delete and snapshot difference."""

from pyspark.sql import functions as F

from stratum.operators.upsert import (
    ambiguous_matches,
    changes_composed,
    diff_applied,
    snapshot_applied,
    snapshot_diff,
    upserted,
)
from stratum.plans.runs import run
from stratum.queries import query, table
from stratum.queries.fixtures import RUN, folder, fresh_table
from stratum.sinks import tables
from stratum.spec import PipelineSpec

COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def _orders(spark, sf):
    return table(spark, sf, "orders").select(COLUMNS)


def _target(spark, sf):
    """All orders that are not pending."""
    return _orders(spark, sf).where("o_orderstatus <> 'P'")


def _source(spark, sf):
    """Changes: the finished orders at a new price, and the pending orders, new to the target."""
    return _orders(spark, sf).where("o_orderstatus IN ('F', 'P')").withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
""")
def upsert_default(spark, sf):
    return upserted(_target(spark, sf), _source(spark, sf), ["o_orderkey"])


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey,
           CASE WHEN o_orderstatus = 'P' THEN 'N' WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1
                WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN o_totalprice + o_totalprice + 1
                ELSE o_totalprice END AS o_totalprice
    FROM orders
""")
def upsert_conditional(spark, sf):
    """A SQL condition, chosen columns, and an update condition some matches fail."""
    return upserted(
        _target(spark, sf), _source(spark, sf), "tgt.o_orderkey = src.o_orderkey AND tgt.o_custkey >= 0",
        update={"o_totalprice": "tgt.o_totalprice + src.o_totalprice", "o_orderstatus": "'U'"},
        insert={"o_orderkey": "src.o_orderkey", "o_totalprice": "src.o_totalprice", "o_orderstatus": "'N'"},
        update_condition="tgt.o_totalprice > 100000")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN o_orderstatus = 'F' THEN 'late' ELSE l_returnflag END AS l_returnflag
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT o_orderkey, NULL, NULL, 'late' FROM orders
    WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def upsert_many_rows_per_key(spark, sf):
    """One source row updates every target row with its key."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    late = table(spark, sf, "orders").where("o_orderstatus = 'F'").selectExpr("o_orderkey as l_orderkey", "'late' as l_returnflag")
    return upserted(lines, late, ["l_orderkey"])


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
""")
def merge_into_table(spark, sf):
    name = fresh_table("merge")
    tables.create(_target(spark, sf), name, location=folder(spark, name))
    tables.merge(_source(spark, sf), name, ["o_orderkey"])
    tables.merge(_source(spark, sf), name, ["o_orderkey"])
    return spark.table(name)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
""")
def merge_touched_partitions(spark, sf):
    """The table is partitioned by a merge key: only the partitions F and P are rewritten."""
    name = fresh_table("merge_parts")
    tables.create(_target(spark, sf), name, ["o_orderstatus"], folder(spark, name))
    tables.merge(_source(spark, sf), name, ["o_orderkey", "o_orderstatus"])
    return spark.table(name)


@query("""
    SELECT o_orderkey, count(*) AS source_rows FROM (
        SELECT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY o_orderkey HAVING count(*) > 1
""")
def upsert_ambiguous_keys(spark, sf):
    source = table(spark, sf, "lineitem").selectExpr("l_orderkey as o_orderkey", "l_linenumber")
    return ambiguous_matches(_orders(spark, sf), source, ["o_orderkey"])


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, FALSE AS is_deleted, CAST(NULL AS VARCHAR) AS deleted_at
    FROM orders WHERE o_orderstatus IN ('F', 'P')
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, TRUE, '2024-05-01 06:00:00' FROM orders
    WHERE o_orderstatus NOT IN ('F', 'P')
""")
def soft_delete(spark, sf):
    """The source as a full snapshot: target rows it does not hold are flagged."""
    result = snapshot_applied(_target(spark, sf), _source(spark, sf), ["o_orderkey"], RUN.timestamp())
    return result.withColumn("deleted_at", F.col("deleted_at").cast("string"))


@query("""
    SELECT CASE o_orderstatus WHEN 'F' THEN 'update' WHEN 'P' THEN 'insert' ELSE 'delete' END AS change,
           o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE o_custkey <> 5 OR o_orderstatus <> 'F'
""")
def snapshot_difference(spark, sf):
    after = _source(spark, sf).withColumn(
        "o_totalprice", F.expr("if(o_custkey = 5 and o_orderstatus = 'F', o_totalprice - 1, o_totalprice)"))
    # The addition and subtraction of 1 must give the old price back for the unchanged rows.
    before = _target(spark, sf).withColumn(
        "o_totalprice", F.expr("if(o_custkey = 5 and o_orderstatus = 'F', o_totalprice + 1 - 1, o_totalprice)"))
    return snapshot_diff(before, after, ["o_orderkey"])


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P')
""")
def snapshot_difference_replayed(spark, sf):
    before, after = _target(spark, sf), _source(spark, sf)
    return diff_applied(before, snapshot_diff(before, after, ["o_orderkey"]), ["o_orderkey"])


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
""")
def merge_mixed_case(spark, sf):
    """The source spells its columns in another case."""
    name = fresh_table("merge_case")
    tables.create(_target(spark, sf), name, location=folder(spark, name))
    tables.merge(_source(spark, sf).toDF(*[c.upper() for c in COLUMNS]), name, ["o_orderkey"])
    return spark.table(name)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus IN ('F', 'P') THEN 'seen ' || o_orderstatus END AS note
    FROM orders
""")
def merge_new_column(spark, sf):
    """A column only the source has becomes one of the table; rows it does not touch have NULL there."""
    name = fresh_table("merge_column")
    tables.create(_target(spark, sf), name, location=folder(spark, name))
    tables.merge(_source(spark, sf).withColumn("note", F.concat(F.lit("seen "), "o_orderstatus")), name, ["o_orderkey"])
    return spark.table(name)


def _merged_by_spec(spark, frames, **destination):
    name = fresh_table("merge_spec")
    for number, frame in enumerate(frames):
        tables.create(frame, f"{name}_in{number}", location=folder(spark, f"{name}_in{number}"))
        run(spark, PipelineSpec.of({
            "pipeline_metadata": {"name": "orders_silver", "layer": "silver"},
            "source": {"type": "table", "properties": {"table": f"{name}_in{number}"}},
            "destination": {"table": name, "mode": "merge", "primary_keys": ["o_orderkey"], "location": folder(spark, name),
                            **destination}}), RUN)
    return spark.table(name)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           o_totalprice + 1 + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS o_totalprice
    FROM orders
""")
def merge_first_load(spark, sf):
    """The first load is inserted by the spec's expressions, as later rows are. A repeated load updates nothing."""
    insert = {c: f"src.{c}" for c in COLUMNS[:3]} | {"o_totalprice": "src.o_totalprice + 1"}
    return _merged_by_spec(spark, [_target(spark, sf), _source(spark, sf)], insert=insert, update={})


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           o_orderstatus NOT IN ('F', 'P') AS is_deleted,
           CASE WHEN o_orderstatus NOT IN ('F', 'P') THEN '2024-05-01 06:00:00' END AS deleted_at
    FROM orders
""")
def soft_delete_table(spark, sf):
    """Two snapshots by spec; the first one already has the columns of a soft delete."""
    result = _merged_by_spec(spark, [_target(spark, sf), _source(spark, sf)], enable_soft_deletes=True)
    return result.withColumn("deleted_at", F.col("deleted_at").cast("string"))


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice + 2 ELSE o_totalprice END AS o_totalprice, o_orderpriority
    FROM orders
""")
def merge_bucketed(spark, sf):
    """A target dealt by its key: two merges update and insert, the second over the first one's files."""
    name = fresh_table("bucketed")
    orders = table(spark, sf, "orders").select(*COLUMNS, "o_orderpriority")
    tables.create(orders.where("o_orderstatus <> 'P'"), name, location=folder(spark, name),
                  buckets=tables.Buckets(8, ("o_orderkey",)))
    changes = orders.where("o_orderstatus IN ('F', 'P')")
    for more in (1, 2):
        tables.merge(changes.withColumn("o_totalprice", F.col("o_totalprice") + more), name, ["o_orderkey"])
    return spark.table(name)


@query("""
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN o_orderkey < (SELECT max(o_orderkey) / 2 FROM orders) THEN 'closed' ELSE 'open' END AS state
    FROM orders
""")
def merge_hot_condition(spark, sf):
    """Three keys for all rows on both sides, and a comparison that one row of each key meets."""
    name = fresh_table("hot")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    tables.create(orders.withColumn("state", F.lit("open")), name, location=folder(spark, name))
    until = orders.agg((F.max("o_orderkey") / 2).alias("until")).first().until
    late = orders.select("o_orderstatus").distinct().withColumn("until", F.lit(until))
    early = orders.select("o_orderstatus", (-F.col("o_orderkey")).cast("double").alias("until"))
    source = early.unionByName(late).withColumn("state", F.lit("closed"))
    tables.merge(source, name, ["o_orderstatus"], update={"state": "src.state"}, insert={},
                 update_condition="tgt.o_orderkey < src.until")
    return spark.table(name)


@query("""
    WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0),
    c AS (SELECT o_orderkey, o_custkey, o_orderstatus,
                 CASE WHEN o_orderkey % 7 IN (1, 2) THEN o_totalprice + 2 ELSE o_totalprice END AS o_totalprice
          FROM orders WHERE o_orderkey % 3 <> 0)
    SELECT CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN c.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change,
           coalesce(c.o_orderkey, a.o_orderkey) AS o_orderkey,
           CASE WHEN c.o_orderkey IS NULL THEN a.o_totalprice ELSE c.o_totalprice END AS o_totalprice,
           a.o_totalprice AS old_price
    FROM a FULL JOIN c ON a.o_orderkey = c.o_orderkey
    WHERE a.o_orderkey IS NULL OR c.o_orderkey IS NULL OR a.o_totalprice <> c.o_totalprice
""")
def change_feed_composed(spark, sf):
    """Three snapshots, two differences, one net change per key: some rows come and go, some change twice or back."""
    orders = _orders(spark, sf)
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    first = orders.where(key % 5 != 0)
    middle = orders.where(key % 4 != 0).withColumn("o_totalprice", F.when(key % 7 < 4, price + 1).otherwise(price))
    last = orders.where(key % 3 != 0).withColumn("o_totalprice", F.when((key % 7).isin(1, 2), price + 2).otherwise(price))
    feeds = [snapshot_diff(a, b, ["o_orderkey"], keep_before=True).withColumn("version", F.lit(n))
             for n, (a, b) in enumerate(((first, middle), (middle, last)))]
    net = changes_composed(feeds[0].unionByName(feeds[1]), ["o_orderkey"], "version")
    return net.select("change", "o_orderkey", "o_totalprice", F.col("before.o_totalprice").alias("old_price"))
