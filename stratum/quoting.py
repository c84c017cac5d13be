"""Column references that survive dots, spaces and backticks in names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    return F.col(quoted(name))


def refs(names) -> list[Column]:
    return [ref(n) for n in names]


def resolve(df: DataFrame, name: str) -> Column:
    """A top-level column if there is one of that exact name, else a nested path such as ``a.b``."""
    return ref(name) if name in df.columns else F.col(name)
