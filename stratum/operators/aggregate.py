"""Grouped aggregation from SQL expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.quoting import ref, resolve


def aggregated(df: DataFrame, group_by: Sequence[str], metrics: Sequence[Mapping[str, str]],
               whole_table: bool = False) -> DataFrame:
    """One row per group with one column per metric ``{name, expr}``.

    Metrics without name or expression are ignored. Without groups or metrics the input comes back
    unchanged, unless ``whole_table`` asks for a single total row.
    """
    wanted = [F.expr(m["expr"]).alias(m["name"]) for m in metrics if m.get("name") and m.get("expr")]
    if not wanted or not (group_by or whole_table):
        return df
    return df.groupBy([resolve(df, c) for c in group_by]).agg(*wanted)


def rows_per_file(df: DataFrame, file_column: str = "file_name", name: str = "rows") -> DataFrame:
    return df.groupBy(ref(file_column).alias("file_name")).agg(F.count(F.lit(1)).alias(name))
