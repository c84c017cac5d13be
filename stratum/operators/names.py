"""Column-name cleaning."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

# Fixed value: the characters a column name may not hold in the target tables.
ILLEGAL = re.compile(r"[ ,;{}()\n\t=]")


def illegal_names(names: Iterable[str]) -> list[str]:
    return [n for n in names if ILLEGAL.search(n)]


def clean_names(names: Iterable[str], compat: bool = False) -> list[str]:
    """Legal, unique names.

    Illegal characters become one underscore, and the edges of a name changed that way are stripped, so
    ``_id`` stays ``_id``. Names that differ only in case count as equal, because Spark could not tell
    them apart. ``compat`` strips every name and compares case-sensitively.
    """
    taken: set[str] = set()
    result = []
    for name in names:
        cleaned = re.sub("_+", "_", ILLEGAL.sub("_", name))
        if compat or ILLEGAL.search(name):
            cleaned = cleaned.strip("_")
        cleaned = cleaned or "col"
        fold = (lambda s: s) if compat else str.lower
        unique, number = cleaned, 0
        while fold(unique) in taken:
            number += 1
            unique = f"{cleaned.rstrip('_')}_{number}"
        taken.add(fold(unique))
        result.append(unique)
    return result


def with_clean_names(df: DataFrame, compat: bool = False) -> DataFrame:
    names = clean_names(df.columns, compat)
    return df if names == df.columns else df.toDF(*names)


def with_replaced_in_names(df: DataFrame, text: str, replacement: str) -> DataFrame:
    return df.toDF(*[c.replace(text, replacement) for c in df.columns])
