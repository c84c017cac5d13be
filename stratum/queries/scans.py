"""File, table and fixed-width scans. The files are written from the driver's tables first."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stratum.operators.columns import converted
from stratum.queries import query, table
from stratum.queries.fixtures import AS_OF, folder, fresh_table, write_parts
from stratum.sinks import tables
from stratum.sources.csv_splits import is_split
from stratum.sources.files import corrupt_records, good_records, scan_folder, scan_with_corrupt
from stratum.sources.fixed_width import Field, as_bytes, scan_fixed_width
from stratum.sources.listing import files_frame, files_in, recent_day_folders
from stratum.sources.tables import scan_table

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
ORDER_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_totalprice", "double")]


def _orders(spark, sf):
    return table(spark, sf, "orders").select(ORDER_COLUMNS)


def _kind(df):
    """The delivery kind at the start of the file name; the number after it depends on the partitioning."""
    return converted(df, ORDER_TYPES).withColumn("file_name", F.regexp_extract("file_name", "^([a-z]+)", 1))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def parquet_scan_folder(spark, sf):
    df, _ = scan_folder(spark, sf, "parquet", extension="lineitem.parquet")
    return df.select("l_orderkey", "l_linenumber", "l_extendedprice")


def _format_round_trip(spark, sf, fmt):
    path = folder(spark, fmt)
    table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").write.format(fmt).save(path)
    schema_free, _ = scan_folder(spark, path, fmt)
    return schema_free.select(ORDER_COLUMNS)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def json_scan(spark, sf):
    return _format_round_trip(spark, sf, "json")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def orc_scan(spark, sf):
    return _format_round_trip(spark, sf, "orc")


@query("SELECT o_orderkey AS order_key, o_orderstatus AS status, o_custkey AS cust_no FROM orders")
def csv_single_file_clean_names(spark, sf):
    path = folder(spark, "csv")
    df = _orders(spark, sf).select(F.col("o_orderkey").alias("order key"), F.col("o_orderstatus").alias(" status "),
                                   F.col("o_custkey").alias("cust;no"))
    write_parts(df, path, "orders", ".csv", header=True)
    read, _ = scan_folder(spark, path, "csv", {"header": True}, ".csv", split_enabled=False)
    return converted(read.drop("file_name"), [("order_key", "bigint"), ("cust_no", "bigint")])


@query("""
    SELECT o_orderkey AS _c0, o_orderstatus AS _c1, CASE WHEN o_orderstatus = 'F' THEN 'fin' ELSE 'open' END AS file_name
    FROM orders
""")
def csv_no_header(spark, sf):
    path = folder(spark, "csv")
    df = _orders(spark, sf).select("o_orderkey", "o_orderstatus")
    write_parts(df.where("o_orderstatus = 'F'"), path, "fin", "_1.csv", header=False)
    write_parts(df.where("o_orderstatus <> 'F'"), path, "open", "_2.csv", header=False)
    read, files = scan_folder(spark, path, "csv", {"inferSchema": "true"}, ".csv", header_mode="no_header")
    assert is_split(files)
    return converted(read, [("_c0", "bigint")]).withColumn("file_name", F.regexp_extract("file_name", "^([a-z]+)", 1))


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CASE WHEN o_orderstatus = 'F' THEN 'fin' ELSE 'open' END AS file_name FROM orders
""")
def csv_all_header(spark, sf):
    path = folder(spark, "csv")
    orders = _orders(spark, sf)
    write_parts(orders.where("o_orderstatus = 'F'"), path, "fin", ".csv", header=True)
    write_parts(orders.where("o_orderstatus <> 'F'"), path, "open", ".csv", header=True)
    return _kind(scan_folder(spark, path, "csv", {}, ".csv", header_mode="all_header")[0])


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CASE WHEN o_orderstatus = 'F' THEN 'head' ELSE 'bare' END AS file_name FROM orders
""")
def csv_one_header(spark, sf):
    path = folder(spark, "csv")
    orders = _orders(spark, sf)
    write_parts(orders.where("o_orderstatus = 'F'"), path, "head", "_1.csv", header=True)
    write_parts(orders.where("o_orderstatus <> 'F'"), path, "bare", "_2.csv", header=False)
    return _kind(scan_folder(spark, path, "csv", {}, ".csv", header_mode="one_header")[0])


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CASE o_orderstatus WHEN 'F' THEN 'head' WHEN 'O' THEN 'bare' ELSE 'also' END AS file_name FROM orders
""")
def csv_auto(spark, sf):
    path = folder(spark, "csv")
    orders = _orders(spark, sf)
    write_parts(orders.where("o_orderstatus = 'F'"), path, "head", "_1.csv", header=True)
    write_parts(orders.where("o_orderstatus = 'O'"), path, "bare", "_2.csv", header=False)
    write_parts(orders.where("o_orderstatus NOT IN ('F', 'O')"), path, "also", "_3.csv", header=True)
    return _kind(scan_folder(spark, path, "csv", {}, ".csv")[0])


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def csv_auto_without_numbered_file(spark, sf):
    """No ``*_1`` file: first lines without illegal characters are headers, the others are data."""
    path = folder(spark, "csv")
    orders = table(spark, sf, "orders").selectExpr("o_orderkey", "'p ' || o_orderpriority as o_orderpriority", "o_orderstatus")
    write_parts(orders.where("o_orderstatus = 'F'").drop("o_orderstatus"), path, "head", ".csv", header=True)
    write_parts(orders.where("o_orderstatus <> 'F'").drop("o_orderstatus"), path, "bare", ".csv", header=False)
    df = scan_folder(spark, path, "csv", {}, ".csv")[0]
    return df.selectExpr("cast(o_orderkey as bigint) as o_orderkey", "substr(o_orderpriority, 3) as o_orderpriority")


@query("""
    SELECT CASE WHEN o_orderstatus = 'F' THEN 'head' ELSE 'bare' END AS file_name, TRUE AS found, count(*) AS rows,
           CAST(sum(o_custkey) AS BIGINT) AS customers
    FROM orders GROUP BY 1
""")
def file_discovery(spark, sf):
    """Discovered files joined with the rows read from them; files of another extension are not listed."""
    path = folder(spark, "files")
    orders = _orders(spark, sf)
    write_parts(orders.where("o_orderstatus = 'F'"), path, "head", ".csv", header=True)
    write_parts(orders.where("o_orderstatus <> 'F'"), path, "bare", ".csv", header=True)
    write_parts(orders, path, "other", ".txt", header=True)
    files = files_in(spark, path, ".csv")
    read, _ = scan_folder(spark, path, "csv", {}, ".csv", header_mode="all_header")
    found = files_frame(spark, files).join(read, "file_name", "left")
    names = F.regexp_extract("file_name", "^([a-z]+)", 1).alias("file_name")
    return found.groupBy(names).agg((F.countDistinct("path") > 0).alias("found"), F.count("o_orderkey").alias("rows"),
                                    F.sum(F.col("o_custkey").cast("bigint")).alias("customers"))


@query("""
    SELECT event_id, event_type, user_id FROM events
    WHERE dayofmonth(ts) >= 3
""")
def date_folders_last_n(spark, sf):
    """Events filed under 2024/05/<day> by their day of month; looking back 8 days from the 10th."""
    base = folder(spark, "days")
    events = table(spark, sf, "events").withColumn("day", F.dayofmonth("ts"))
    days = [r[0] for r in events.select("day").distinct().collect()]  # at most 31
    raw = folder(spark, "by-day")
    events.select("event_id", "event_type", "user_id", "day").write.partitionBy("day").parquet(raw)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(raw).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(path(f"{base}/2024/05"))
    fs.mkdirs(path(f"{base}/2024/notes/01"))
    for day in days:
        fs.rename(path(f"{raw}/day={day}"), path(f"{base}/2024/05/{day:02d}"))
    assert len(recent_day_folders(spark, base, AS_OF, 8)) <= 29
    df, _ = scan_folder(spark, base, "parquet", extension=".parquet", last_n_days=8, as_of=AS_OF)
    return df.select("event_id", "event_type", "user_id")


@query("""
    SELECT 'good' AS kind, o_orderkey, CAST(NULL AS VARCHAR) AS record FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT 'corrupt', NULL, CASE WHEN o_orderstatus = 'O' THEN 'x' || o_orderkey || ',' || o_custkey
        ELSE o_orderkey || ',' || o_custkey || ',surplus' END FROM orders WHERE o_orderstatus <> 'F'
""")
def corrupt_rows_split(spark, sf):
    """Unparsable numbers and surplus fields are kept as text beside the good rows."""
    path = folder(spark, "corrupt")
    line = F.expr("""case o_orderstatus when 'F' then concat_ws(',', o_orderkey, o_custkey)
        when 'O' then concat_ws(',', 'x' || o_orderkey, o_custkey) else concat_ws(',', o_orderkey, o_custkey, 'surplus') end""")
    _orders(spark, sf).select(line.alias("value")).write.text(path)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType())])
    df = scan_with_corrupt(spark, path, "csv", schema)
    good = good_records(df).selectExpr("'good' as kind", "o_orderkey", "cast(null as string) as record")
    bad = corrupt_records(df).selectExpr("'corrupt' as kind", "cast(null as bigint) as o_orderkey", "_corrupt_record as record")
    return good.unionByName(bad)


LAYOUT = [
    Field("c_name", 0, 25),
    Field("c_custkey", 25, 9, "zoned"),
    Field("c_acctbal", 34, 6, "packed", scale=2),
    Field("c_nationkey", 40, 4, "binary"),
]


def _records(spark, sf):
    """Customers as 44-byte mainframe records, built by column expressions."""
    minus = F.col("c_acctbal") < 0
    cents = F.lpad(F.abs(F.round(F.col("c_acctbal") * 100)).cast("bigint").cast("string"), 11, "0")
    packed = F.unhex(F.concat(cents, F.when(minus, "D").otherwise("C")))
    # Customers in debt get a negative number, so both signs of zoned fields occur.
    digits = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    zones = F.regexp_replace(F.substring(digits, 1, 8), "([0-9])", "F$1")
    zoned = F.unhex(F.concat(zones, F.when(minus, "D").otherwise("C"), F.substring(digits, 9, 1)))
    number = F.unhex(F.lpad(F.hex(F.col("c_nationkey").cast("bigint")), 8, "0"))
    record = F.concat(as_bytes(F.rpad("c_name", 25, " "), "cp037"), zoned, packed, number)
    return table(spark, sf, "customer").select(record.alias("value"))


@query("""
    SELECT c_name, CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END AS c_custkey, c_acctbal,
           CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer
""")
def fixed_width_cp037(spark, sf):
    path = folder(spark, "mainframe")
    # A binary cast to text keeps its bytes, and the text sink writes them as they are plus one separator.
    _records(spark, sf).select(F.col("value").cast("string").alias("value")).write.text(path)
    files = [f.path for f in files_in(spark, path, ".txt")]
    df = scan_fixed_width(spark, files, LAYOUT, record_length=45)
    return df.select("c_name", "c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_nationkey")


WIDE = [Field("share", 0, 9, "zoned", scale=9), Field("fine", 9, 20, "zoned", scale=18), Field("wide", 29, 16, "packed"),
        Field("small", 45, 4, "packed", scale=12), Field("number", 49, 4, "binary", scale=11)]


@query("""
    SELECT c_name, '0.' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS share,
           (CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END) || '12.' || lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS fine,
           CAST(CAST(c_custkey AS HUGEINT) * CAST('1000000000000000000001' AS HUGEINT) AS VARCHAR) AS wide,
           '0.00000' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS small,
           '0.0' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS number
    FROM customer
""")
def fixed_width_decimals(spark, sf):
    """Numbers with 0 to 18 decimals and of up to 31 digits keep every digit."""
    path = folder(spark, "decimals")
    key = F.col("c_custkey").cast("string")

    def zoned(digits, minus=F.lit(False)):
        zones = F.regexp_replace(F.expr("left(d, length(d) - 1)"), "([0-9])", "F$1")
        return F.unhex(F.concat(zones, F.when(minus, "D").otherwise("C"), F.expr("right(d, 1)"))), digits

    rows = table(spark, sf, "customer").select("c_name", "c_custkey", "c_acctbal")
    for name, digits, minus in (("share", F.lpad(key, 9, "0"), F.lit(False)),
                                ("fine", F.concat(F.lit("12"), F.lpad(key, 18, "0")), F.col("c_acctbal") < 0)):
        coded, text = zoned(digits, minus)
        rows = rows.withColumn("d", text).withColumn(name, coded)
    wide = F.unhex(F.concat(F.lpad(F.concat(key, F.lpad(key, 21, "0")), 31, "0"), F.lit("C")))
    small, number = F.unhex(F.concat(F.lpad(key, 7, "0"), F.lit("F"))), F.unhex(F.lpad(F.hex("c_custkey"), 8, "0"))
    rows.select(F.concat("share", "fine", wide, small, number, F.encode("c_name", "ISO-8859-1")).cast("string").alias(
        "value")).write.text(path)
    layout = [*WIDE, Field("c_name", 53, 18, "text")]
    df = scan_fixed_width(spark, [f.path for f in files_in(spark, path, ".txt")], layout, record_length=72, code_page="latin-1")
    return df.select("c_name", *(F.col(f.name).cast("string").alias(f.name) for f in WIDE))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def table_scan(spark, sf):
    name = fresh_table("supplier")
    tables.create(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), name, location=folder(spark, name))
    return scan_table(spark, name)


@query("""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus, o_totalprice,
           CASE WHEN o_orderstatus = 'F' THEN 'first' ELSE 'other' END AS file_name
    FROM orders
""")
def csv_split_options(spark, sf):
    """Reader options reach every part of a split delivery: F stands for NULL, fields are separated by bars."""
    path = folder(spark, "csv_options")
    orders = _orders(spark, sf).select([F.col(c).cast("string").alias(c) for c in ORDER_COLUMNS])
    for kind, part, number in (("first", "o_orderstatus = 'F'", 1), ("other", "o_orderstatus <> 'F'", 2)):
        rows = orders.where(part).select(F.concat_ws("|", *ORDER_COLUMNS).alias("|".join(ORDER_COLUMNS)))
        write_parts(rows.select(F.col(rows.columns[0]).alias("value")), path, kind, f"_{number}.csv", header=False, fmt="text")
    types = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    read, _ = scan_folder(spark, path, "csv", {"sep": "|", "nullValue": "F"}, ".csv", header_mode="no_header", schema=types)
    return read.withColumn("file_name", F.regexp_extract("file_name", "^([a-z]+)", 1))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_auto_many_files(spark, sf):
    """Forty files, the header in every second one: which equal the first row of part_1.csv is found by a scan of first lines."""
    path = folder(spark, "csv_many")
    orders = table(spark, sf, "orders").select(*ORDER_COLUMNS, "o_orderpriority")
    write_parts(orders.where("o_orderstatus = 'F'").repartition(20), path, "part_", ".csv", header=True)
    write_parts(orders.where("o_orderstatus <> 'F'").repartition(20), path, "rest", "_n.csv", header=False)
    return converted(scan_folder(spark, path, "csv", {}, ".csv")[0].drop("file_name"), ORDER_TYPES)


@query("""
    SELECT CASE WHEN o_orderstatus = 'O' THEN 'corrupt' ELSE 'good' END AS kind,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS o_orderkey,
           CASE WHEN o_orderstatus = 'O' THEN 'x' || o_orderkey || ',' || o_custkey END AS record,
           CASE WHEN o_orderstatus = 'F' THEN 'head' ELSE 'bare' END AS file_name
    FROM orders
""")
def csv_split_corrupt(spark, sf):
    """Malformed records of a split delivery, its headers told from data."""
    path = folder(spark, "csv_corrupt")
    line = F.expr("concat_ws(',', if(o_orderstatus = 'O', concat('x', o_orderkey), cast(o_orderkey as string)), o_custkey)")
    orders = _orders(spark, sf).select("o_orderstatus", line.alias("value"))
    heads = _orders(spark, sf).where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    write_parts(heads, path, "head", "_1.csv", header=True)
    write_parts(orders.where("o_orderstatus <> 'F'").select("value"), path, "bare", "_2.csv", header=False, fmt="text")
    df, _ = scan_folder(spark, path, "csv", {}, ".csv", schema="o_orderkey bigint, o_custkey bigint", keep_corrupt=True)
    kind = F.regexp_extract("file_name", "^([a-z]+)", 1).alias("file_name")
    good = good_records(df).select(F.lit("good").alias("kind"), "o_orderkey", F.lit(None).cast("string").alias("record"), kind)
    return good.unionByName(corrupt_records(df).select(
        F.lit("corrupt").alias("kind"), F.lit(None).cast("bigint").alias("o_orderkey"), F.col("_corrupt_record").alias("record"), kind))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate::VARCHAR AS o_orderdate FROM orders")
def xml_scan(spark, sf):
    """All columns of orders as XML elements, read by a schema with date and time."""
    path = folder(spark, "xml")
    orders = table(spark, sf, "orders")
    orders.write.format("xml").option("rowTag", "order").option("rootTag", "orders").save(path)
    read, _ = scan_folder(spark, path, "xml", {"rowTag": "order"}, schema=orders.schema)
    return read.drop("file_name").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate::VARCHAR AS o_orderdate FROM orders")
def text_scan(spark, sf):
    """All columns of orders as lines of text, taken apart by expressions."""
    path = folder(spark, "text")
    orders = table(spark, sf, "orders")
    orders.select(F.concat_ws("|", *[F.col(c).cast("string") for c in orders.columns]).alias("value")).write.text(path)
    read, _ = scan_folder(spark, path, "text")
    fields = F.split("value", "[|]")
    return read.select([fields[i].cast(f.dataType).alias(f.name) for i, f in enumerate(orders.schema.fields)]).withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT CAST(sum(length(s_name) + 1) AS BIGINT) AS bytes, count(*) AS line_ends, TRUE AS named FROM supplier")
def binary_scan(spark, sf):
    """Whole files as bytes, with their names."""
    path = folder(spark, "binary")
    table(spark, sf, "supplier").select(F.col("s_name").alias("value")).write.text(path)
    read, _ = scan_folder(spark, path, "binaryFile", extension=".txt")
    ends = F.length("content") - F.length(F.replace(F.decode("content", "UTF-8"), F.lit("\n"), F.lit("")))
    return read.agg(F.sum("length").alias("bytes"), F.sum(ends).cast("bigint").alias("line_ends"),
                    F.bool_and(F.col("file_name").startswith("part-")).alias("named"))
