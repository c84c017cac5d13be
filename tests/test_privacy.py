import pytest
from pyspark.sql import functions as F

from stratum.functions.formats import format_preserved, format_restored
from stratum.functions.hashing import token
from stratum.functions.privacy import decrypted, encrypted, masked, missing_masks
from stratum.plans.vault import TokenCollision, vaulted

KEY = "k" * 32


def test_masks(spark):
    df = spark.sql("select 'Ab-12' a, 'me.x@site.org, you@b.c' b, 'tel 030-1' c, 'v' d, cast(null as string) e")
    row = masked(df, [
        {"column": "a", "policy": "mask_text"}, {"column": "b", "policy": "mask_email"},
        {"column": "c", "policy": "mask_digits"}, {"column": "d", "policy": "mask_null"},
        {"column": "e", "policy": "mask_text"}, {"column": "zz", "policy": "mask_text"}]).first()
    assert tuple(row) == ("Xx-nn", "***@site.org, ***@b.c", "tel ###-#", None, None)


def test_unknown_policy_is_an_error_and_own_policies_work(spark):
    df = spark.sql("select 'abc' as `a b`")
    with pytest.raises(ValueError):
        masked(df, [{"column": "a b", "policy": "nope"}])
    assert masked(df, [{"column": "a b", "policy": "left1"}], {"left1": "left({col}, 1)"}).first()[0] == "a"


def test_encryption(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "v string")
    cipher = encrypted(df, "v", KEY)
    values = [r.v for r in cipher.collect()]
    assert values[0] != values[1] and values[2] is None
    assert [r.v for r in decrypted(cipher, "v", KEY).collect()] == ["x", "x", None]
    with pytest.raises(ValueError):
        encrypted(df, "v", "short")


def test_missing_masks_compare_the_last_name_part(spark):
    registered = spark.createDataFrame([("a", "mask_text"), ("b", "mask_text"), ("c", "mask_hash")], "column string, policy string")
    applied = spark.createDataFrame([("a", "main.sec.mask_text"), ("b", "main.sec.mask_hash")], "column string, mask_name string")
    assert sorted(r["column"] for r in missing_masks(registered, applied).collect()) == ["b", "c"]


def test_format_preserving_tokens(spark):
    texts = ["", "7", "q", "Ab-12", "+49 30 1234567", "É é 1", "ZZZ zzz", "0" * 36, "a" * 26, "000", "001", "010", None, "x" * 13 + "9" * 19]
    texts += [f"{n:03}" for n in range(1000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", format_preserved(F.col("t"), "k1").alias("a"), format_preserved(F.col("t"), "k2").alias("b"))
    rows = rows.withColumn("back", format_restored(F.col("a"), F.lit("k1"))).collect()
    kinds = str.maketrans({**{c: "9" for c in "0123456789"}, **{c: "x" for c in "abcdefghijklmnopqrstuvwxyz"},
                           **{c: "X" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}})
    for r in rows:
        assert r.back == r.t and (r.t is None or r.a.translate(kinds) == r.t.translate(kinds))
    three = [r for r in rows[-1000:]]
    assert len({r.a for r in three}) == 1000 and sum(r.a == r.t for r in three) < 20 and sum(r.a == r.b for r in three) < 20
    with pytest.raises(Exception, match="no token of this format"):
        spark.createDataFrame([("1" * 37,)], "t string").select(format_preserved(F.col("t"), "k")).collect()


def test_vault_keeps_tokens_and_refuses_collisions(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "v string, n int")
    first = vaulted(df, "v", "vault_t", token("v", "s1"), "r1", f"{tmp_path}/vault")
    tokens = {r.n: r.v_token for r in first.collect()}
    assert tokens[1] == tokens[3] != tokens[2] and tokens[4] is None and first.columns == ["v", "n", "v_token"]
    more = spark.createDataFrame([("a", 1), ("c", 5)], "v string, n int")
    second = {r.n: r.v_token for r in vaulted(more, "v", "vault_t", token("v", "s2"), "r2").collect()}
    assert second[1] == tokens[1] and spark.table("vault_t").count() == 3
    with pytest.raises(TokenCollision):
        vaulted(spark.createDataFrame([("d",), ("e",)], "v string"), "v", "vault_t", F.lit("same"), "r3")
    with pytest.raises(TokenCollision):
        vaulted(spark.createDataFrame([("d",)], "v string"), "v", "vault_t", F.lit(tokens[1]), "r3")
    assert spark.table("vault_t").count() == 3
    vaulted(more, "v", "vault_t", token("v", "s9"), "r4")
    assert spark.table("vault_t").count() == 3


def test_tokens_compute_their_value_once(spark):
    """However often a step names the text, its digits are taken out once, so the plan stays small."""
    plan = spark.range(1).select(format_preserved(F.col("id").cast("string"), "k").alias("t"))
    text = plan._jdf.queryExecution().analyzed().toString()
    assert text.count("[^0-9]") == 1 and text.count("[^A-Za-z]") == 1
    seven = spark.createDataFrame([("Customer#000000007",), ("+49 30 1234567",), ("Q7",)], "t string")
    assert [r[0] for r in seven.select(format_restored(format_preserved(F.col("t"), "k"), "k")).collect()] == [
        "Customer#000000007", "+49 30 1234567", "Q7"]
