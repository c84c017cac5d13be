"""Catalog-table and JDBC scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    if not name:
        raise ValueError("a table scan needs a table name")
    return spark.table(name)


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """Disjoint conditions covering every row, NULLs included: below, between and above the bounds."""
    marks = [str(b) if isinstance(b, (int, float)) else "'" + str(b).replace("'", "''") + "'" for b in bounds]
    if not marks:
        return ["1 = 1"]
    middle = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(marks, marks[1:])]
    return [f"{column} < {marks[0]} OR {column} IS NULL", *middle, f"{column} >= {marks[-1]}"]


def scan_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              bounds: Sequence[object] = (), properties: Mapping[str, str] | None = None) -> DataFrame:
    """Read a database table, one partition per range of the partition column.

    Explicit bounds (for example quantiles) keep the partitions even when the values are not.
    """
    options = dict(properties or {})
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=options)
    return spark.read.jdbc(url, table, predicates=range_predicates(partition_column, bounds), properties=options)
