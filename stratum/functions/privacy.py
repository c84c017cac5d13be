"""Masking policies, column encryption and the report of missing masks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.quoting import quoted, ref

# A policy is a SQL expression in which {col} stands for the column, so that the same text serves a
# DataFrame projection and a catalog view.
POLICIES: dict[str, str] = {
    "mask_text": "mask({col})",
    "mask_digits": "regexp_replace({col}, '[0-9]', '#')",
    "mask_email": r"regexp_replace({col}, '([A-Za-z0-9._%+-]+)@([A-Za-z0-9.-]+)', '***@$2')",
    "mask_hash": "sha2(cast({col} as string), 256)",
    "mask_null": "if(false, {col}, null)",  # NULL of the column's own type
}
#: Policies that make text of text and are refused for other types.
TEXT_POLICIES = frozenset({"mask_text", "mask_digits", "mask_email"})


def masked_columns(columns: Sequence[str], masks: Iterable[Mapping[str, str]],
                   policies: Mapping[str, str] = POLICIES) -> list[str]:
    """Select-list SQL in which every registered, existing column is masked."""
    chosen = {m["column"]: m["policy"] for m in masks if m["column"] in columns}
    unknown = sorted(set(chosen.values()) - set(policies))
    if unknown:
        raise ValueError(f"unknown masking policies: {', '.join(unknown)}")
    return [
        f"{policies[chosen[c]].replace('{col}', quoted(c))} AS {quoted(c)}" if c in chosen else quoted(c)
        for c in columns
    ]


def masked(df: DataFrame, masks: Iterable[Mapping[str, str]],
           policies: Mapping[str, str] = POLICIES) -> DataFrame:
    masks = list(masks)
    _refuse_other_types(df, masks, policies)
    return df.selectExpr(*masked_columns(df.columns, masks, policies))


def _refuse_other_types(df: DataFrame, masks: Sequence[Mapping[str, str]], policies: Mapping[str, str]) -> None:
    types = dict(df.dtypes)
    for mask in masks:
        policy = mask["policy"]
        own = policy in TEXT_POLICIES and policies.get(policy) == POLICIES[policy]
        if own and not types.get(mask["column"], "string").startswith(("string", "varchar", "char")):
            raise ValueError(f"{policy} masks text, but {mask['column']} is {types[mask['column']]}")


def publish_masked_view(spark: SparkSession, table: str, view: str, masks: Iterable[Mapping[str, str]],
                        policies: Mapping[str, str] = POLICIES) -> DataFrame:
    """Create or replace the view through which readers see ``table``."""
    masks = list(masks)
    _refuse_other_types(spark.table(table), masks, policies)
    select = ", ".join(masked_columns(spark.table(table).columns, masks, policies))
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {select} FROM {table}")
    return spark.table(view)


def policy_of(mask_name: Column) -> Column:
    """The policy is the last part of a dotted mask name."""
    return F.regexp_extract(mask_name, r"([^.]+)$", 1)


def missing_masks(registered: DataFrame, applied: DataFrame,
                  scope: Sequence[str] = ("column",)) -> DataFrame:
    """Registered (scope..., policy) rows for which no mask of that policy is applied yet."""
    present = applied.select(*[ref(c) for c in scope], policy_of(ref("mask_name")).alias("policy")).distinct()
    return registered.join(present, [*scope, "policy"], "left_anti")


def _key(key: str | bytes | Column) -> Column:
    if isinstance(key, Column):
        return key
    raw = key.encode() if isinstance(key, str) else key
    if len(raw) != 32:
        raise ValueError("AES-256 needs a key of 32 bytes")
    return F.unhex(F.lit(raw.hex()))


def encrypted(df: DataFrame, column: str, key: str | bytes | Column) -> DataFrame:
    """AES-256-GCM with a random IV, as base64 text. NULL stays NULL.

    A literal key shows up in query plans; pass a Column (for example a secret function) to avoid that.
    """
    value = F.base64(F.aes_encrypt(ref(column).cast("string"), _key(key), F.lit("GCM")))
    return df.withColumn(column, value)


def decrypted(df: DataFrame, column: str, key: str | bytes | Column) -> DataFrame:
    value = F.aes_decrypt(F.unbase64(ref(column)), _key(key), F.lit("GCM"))
    return df.withColumn(column, value.cast("string"))
