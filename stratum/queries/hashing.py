"""Fingerprints, tokens, encryption and masks."""

from pyspark.sql import functions as F

from stratum.functions.formats import format_preserved, format_restored
from stratum.functions.hashing import detokenized, token, token_table, with_row_hash, with_token
from stratum.functions.privacy import decrypted, encrypted, masked, missing_masks, publish_masked_view
from stratum.plans.vault import vaulted
from stratum.queries import query, table
from stratum.queries.fixtures import folder, fresh_table
from stratum.scratch import staged
from stratum.sinks import tables

KEY = "0123456789abcdef0123456789abcdef"


@query("""
    SELECT event_id, sha256(concat_ws('||', CAST(event_id AS VARCHAR), CAST(ts AS VARCHAR), CAST(user_id AS VARCHAR),
        CASE WHEN event_type <> 'error' THEN event_type END, props)) AS row_hash
    FROM events
""")
def row_hash_compat(spark, sf):
    df = table(spark, sf, "events").selectExpr(
        "event_id", "ts", "user_id", "if(event_type <> 'error', event_type, null) as event_type", "props")
    return with_row_hash(df).select("event_id", "row_hash")


@query("""
    WITH e AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type, props FROM events)
    SELECT event_id, sha256(
        length(CAST(event_id AS VARCHAR)) || ':' || CAST(event_id AS VARCHAR)
        || coalesce(length(event_type) || ':' || event_type, '~')
        || coalesce(length(props) || ':' || props, '~')) AS row_hash
    FROM e
""")
def row_hash_strict(spark, sf):
    df = table(spark, sf, "events").selectExpr(
        "event_id", "if(event_type <> 'error', event_type, null) as event_type", "props")
    return with_row_hash(df, mode="strict").select("event_id", "row_hash")


@query("""
    SELECT doc_id, sha256(text || '||' || lang) AS text_hash FROM documents
""")
def row_hash_chosen_columns(spark, sf):
    df = with_row_hash(table(spark, sf, "documents"), ["text", "lang"], name="text_hash")
    return df.select("doc_id", "text_hash")


@query("""
    SELECT c_custkey, sha256(concat_ws('', CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END, 'pepper')) AS c_name_token
    FROM customer
""")
def token_hash(spark, sf):
    df = table(spark, sf, "customer").selectExpr(
        "c_custkey", "if(c_mktsegment <> 'BUILDING', c_name, null) as c_name")
    return with_token(df, "c_name", "pepper").select("c_custkey", "c_name_token")


@query("""
    SELECT DISTINCT text, sha256(text || 's1') AS text_token FROM documents
""")
def token_map(spark, sf):
    return token_table(table(spark, sf, "documents"), "text", "s1")


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def detokenize(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    tokens = token_table(orders, "o_orderpriority", "s2")
    hidden = with_token(orders, "o_orderpriority", "s2").drop("o_orderpriority")
    return detokenized(hidden, tokens, "o_orderpriority")


@query("""
    SELECT c_custkey, c_name, TRUE AS hidden FROM customer
""")
def encrypt_roundtrip(spark, sf):
    plain = table(spark, sf, "customer").selectExpr("c_custkey", "c_name", "c_name as secret")
    secret = encrypted(plain, "secret", KEY)
    back = decrypted(secret.withColumn("cipher", F.col("secret")), "secret", KEY)
    return back.select("c_custkey", F.col("secret").alias("c_name"), (F.col("cipher") != F.col("c_name")).alias("hidden"))


@query("""
    SELECT c_custkey,
           regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name,
           CAST(NULL AS VARCHAR) AS c_mktsegment
    FROM customer
""")
def mask_text_view(spark, sf):
    name = fresh_table("customer")
    tables.create(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), name,
                  location=folder(spark, name))
    return publish_masked_view(spark, name, f"{name}_masked", [
        {"column": "c_name", "policy": "mask_text"},
        {"column": "c_mktsegment", "policy": "mask_null"},
        {"column": "not_there", "policy": "mask_text"},
    ])


@query(r"""
    SELECT doc_id, regexp_replace(text, '[0-9]', '#', 'g') AS text, sha256(source) AS source FROM documents
""")
def mask_pattern(spark, sf):
    return masked(table(spark, sf, "documents").select("doc_id", "text", "source"), [
        {"column": "text", "policy": "mask_digits"},
        {"column": "source", "policy": "mask_hash"},
    ])


@query(r"""
    SELECT page_id, regexp_replace(html, '([A-Za-z0-9._%+-]+)@([A-Za-z0-9.-]+)', '***@\2', 'g') AS html FROM pages
""")
def mask_email(spark, sf):
    return masked(table(spark, sf, "pages").select("page_id", "html"), [{"column": "html", "policy": "mask_email"}])


@query("""
    WITH registered AS (
        SELECT 'customer_' || c_custkey AS table_name, 'name' AS "column",
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'mask_hash' ELSE 'mask_text' END AS policy FROM customer),
    applied AS (SELECT DISTINCT 'customer_' || o_custkey AS table_name FROM orders WHERE o_orderstatus <> 'F')
    SELECT table_name, "column", policy FROM registered
    WHERE NOT (policy = 'mask_text' AND table_name IN (SELECT table_name FROM applied))
""")
def mask_missing_policies(spark, sf):
    registered = table(spark, sf, "customer").selectExpr(
        "'customer_' || c_custkey as table_name", "'name' as column",
        "if(c_mktsegment = 'BUILDING', 'mask_hash', 'mask_text') as policy")
    applied = table(spark, sf, "orders").where("o_orderstatus <> 'F'").selectExpr(
        "'customer_' || o_custkey as table_name", "'name' as column", "'main.security.mask_text' as mask_name")
    return missing_masks(registered, applied, ["table_name", "column"])


@query("SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer")
def mask_typed(spark, sf):
    """A column that is masked as NULL keeps its type."""
    customers = table(spark, sf, "customer")
    result = masked(customers, [{"column": c, "policy": "mask_null"} for c in ("c_nationkey", "c_acctbal")])
    assert result.dtypes == customers.dtypes
    return result


@query("""
    SELECT c_custkey, c_name, regexp_replace(c_name, '[0-9]', '9', 'g') AS format, TRUE AS differs FROM customer
""")
def mask_format_preserving(spark, sf):
    """Names with other letters and digits in the same places, and back."""
    names = table(spark, sf, "customer").select("c_custkey", "c_name")
    # A row is a few bytes to read and much to compute, so rows are dealt to more tasks than their files are.
    names = names.repartition("c_custkey", "c_name")
    hidden = staged(names.withColumn("hidden", format_preserved(F.col("c_name"), "pepper")), "hidden-names")
    assert hidden.select("hidden").distinct().count() == names.select("c_name").distinct().count()
    same_letters = F.regexp_replace("c_name", "[0-9]", "9")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("hidden", "[0-9]", "9"), "[a-z]", "x"), "[A-Z]", "X")
    own = F.regexp_replace(F.regexp_replace(same_letters, "[a-z]", "x"), "[A-Z]", "X")
    return hidden.select("c_custkey", format_restored(F.col("hidden"), "pepper").alias("c_name"),
                         F.when(shape == own, same_letters).alias("format"), (F.col("hidden") != F.col("c_name")).alias("differs"))


@query("""
    SELECT c_custkey, c_mktsegment || c_nationkey AS who, sha256(c_mktsegment || c_nationkey || CASE WHEN c_mktsegment || c_nationkey IN (
        SELECT c_mktsegment || c_nationkey FROM customer WHERE c_custkey < (SELECT max(c_custkey) / 4 FROM customer))
        THEN 'old' ELSE 'new' END) AS who_token FROM customer
""")
def token_vault_second_run(spark, sf):
    """The second run has another salt: values of the first keep their tokens, new ones get new tokens."""
    name = fresh_table("vault")
    customers = table(spark, sf, "customer").selectExpr("c_custkey", "c_mktsegment || c_nationkey as who")
    quarter = customers.agg((F.max("c_custkey") / 4).alias("q")).first().q
    vaulted(customers.where(F.col("c_custkey") < quarter), "who", name, token("who", "old"), "run-1", folder(spark, name))
    return vaulted(customers, "who", name, token("who", "new"), "run-2")
