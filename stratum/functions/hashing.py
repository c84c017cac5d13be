"""Row fingerprints and tokens (SHA-256)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.quoting import ref


def fingerprint(columns: Sequence[str], mode: str = "compat") -> Column:
    """SHA-256 over the text of several columns.

    ``compat`` joins the non-NULL values with ``||``: NULLs leave no trace, and a value holding the
    separator can collide. ``strict`` prefixes each value with its length and marks NULLs, so different
    rows get different input.
    """
    text = [ref(c).cast("string") for c in columns]
    if mode == "compat":
        return F.sha2(F.concat_ws("||", *text), 256)
    if mode == "strict":
        framed = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in text]
        return F.sha2(F.concat(*framed), 256)
    raise ValueError(f"mode must be compat or strict, not {mode!r}")


def with_row_hash(df: DataFrame, columns: Sequence[str] | None = None, mode: str = "compat",
                  name: str = "row_hash") -> DataFrame:
    return df.withColumn(name, fingerprint(df.columns if columns is None else columns, mode))


def token(column: str, salt: str = "") -> Column:
    """SHA-256 of the value followed by the salt. A NULL value yields the hash of the salt alone."""
    return F.sha2(F.concat_ws("", ref(column), F.lit(salt)), 256)


def with_token(df: DataFrame, column: str, salt: str = "") -> DataFrame:
    return df.withColumn(f"{column}_token", token(column, salt))


def token_table(df: DataFrame, column: str, salt: str = "") -> DataFrame:
    """One (value, token) row per distinct non-NULL value; the hash is computed once per value."""
    values = df.select(ref(column)).where(ref(column).isNotNull()).distinct()
    return with_token(values, column, salt)


def detokenized(df: DataFrame, tokens: DataFrame, column: str) -> DataFrame:
    """Replace ``<column>_token`` by the value it stands for; unknown tokens give NULL."""
    name = f"{column}_token"
    return df.join(tokens.select(name, column), name, "left").drop(name)
