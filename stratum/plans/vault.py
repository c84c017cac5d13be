"""A vault of tokens: a table (value, token, run) that only grows, so a value keeps its token for ever."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.quoting import ref
from stratum.scratch import staged
from stratum.sinks import tables


class TokenCollision(ValueError):
    """Two values would share a token."""


def vaulted(df: DataFrame, column: str, vault: str, token: Column, run_id: str, location: str | None = None) -> DataFrame:
    """``df`` with ``<column>_token`` beside the column; values the vault does not know are added to it first.

    ``token`` is an expression over the column. It applies to new values only: after a change of key or format old values
    keep their old tokens. A token that another value has, in the vault or among the new ones, fails the run before
    anything is written. NULL has no token.
    """
    spark = df.sparkSession
    name = f"{column}_token"
    values = df.select(ref(column).alias("value"), token.alias("token")).where("value is not null").distinct()
    known = spark.table(vault).select("value", "token") if spark.catalog.tableExists(vault) else None
    new = staged(values if known is None else values.join(known.select("value"), "value", "left_anti"), "new-tokens")
    if not new.isEmpty():
        every = new if known is None else new.unionByName(known.join(new.select("token"), "token", "left_semi").select("value", "token"))
        twice = every.groupBy("token").agg(F.countDistinct("value").alias("n")).where("n > 1")
        if not twice.isEmpty():
            raise TokenCollision(f"values of {column} would share a token in {vault}")
        tables.append(new.withColumn("run_id", F.lit(run_id)), vault, location=location)
    tokens = spark.table(vault).select(ref("value").alias("__value"), ref("token").alias(name))
    return df.join(tokens, ref(column) == F.col("__value"), "left").select(*[ref(c) for c in df.columns], name)
