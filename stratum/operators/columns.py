"""Column projections. Each operator adds one projection, whatever the number of columns."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stratum.quoting import ref, refs

log = logging.getLogger(__name__)


def with_expressions(df: DataFrame, columns: Iterable[tuple[str, str]], on_error: str = "fail") -> DataFrame:
    """Add SQL-expression columns in order; a later one may use an earlier one.

    ``on_error="skip"`` leaves out a column whose expression does not resolve.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error must be fail or skip, not {on_error!r}")
    for name, sql in columns:
        try:
            df = df.withColumn(name, F.expr(sql))
        except AnalysisException as problem:
            if on_error == "fail":
                raise
            log.warning("column %s left out: %s", name, problem)
    return df


@dataclass(frozen=True)
class LineageNames:
    """Names of the lineage columns; ``job`` and ``run`` are often prefixed with the platform's name."""

    file: str = "file_name"
    correlation: str = "correlation_id"
    job: str = "job_id"
    run: str = "run_id"
    created_by: str = "load_create_user_id"
    updated_by: str = "load_update_user_id"
    created_at: str = "load_create_dtm"
    updated_at: str = "load_update_dtm"
    #: column for the source file's full path; without one files of one name count together
    path: str = ""

    def all(self) -> tuple[str, ...]:
        return tuple(filter(None, (self.file, self.correlation, self.job, self.run, self.created_by, self.updated_by,
                                   self.created_at, self.updated_at, self.path)))


@dataclass(frozen=True)
class RunInfo:
    """Who and what is loading. ``started`` is an argument, so a rerun can reproduce its rows."""

    correlation_id: str | None = None
    job_id: str | None = None
    run_id: str | None = None
    user_id: str | None = None
    started: dt.datetime | None = None

    def timestamp(self) -> Column:
        return F.current_timestamp() if self.started is None else F.lit(self.started).cast("timestamp")


def with_lineage(df: DataFrame, run: RunInfo, file_name: str | None = None,
                 names: LineageNames = LineageNames()) -> DataFrame:
    """Add the eight lineage columns.

    The file name is the argument if given, else an existing column, else the scan's own metadata.
    """
    if file_name:
        source_file = F.lit(file_name)
    elif names.file in df.columns:
        source_file = ref(names.file)
    else:
        source_file = F.col("_metadata.file_name")
    text = {
        names.correlation: run.correlation_id,
        names.job: run.job_id,
        names.run: run.run_id,
        names.created_by: run.user_id,
        names.updated_by: None,
    }
    added = {names.file: source_file}
    added.update({name: F.lit(value).cast("string") for name, value in text.items()})
    added[names.created_at] = run.timestamp()
    added[names.updated_at] = F.lit(None).cast("timestamp")
    return df.withColumns(added)


def renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist, one entry after the other (``a -> b`` then ``b -> c`` chains)."""
    names = list(df.columns)
    for old, new in mapping.items():
        names = [new if n == old else n for n in names]
    return df if names == df.columns else df.toDF(*names)


def standardized(
    df: DataFrame,
    rename: Mapping[str, str] | None = None,
    case: str = "none",
    trim_all: bool = False,
    strip: Sequence[str] = (),
    lower: Sequence[str] = (),
    upper: Sequence[str] = (),
    protect: Sequence[str] = (),
) -> DataFrame:
    """Rename, then case and trim text, all in one projection.

    Order: case of all text columns, trim of all text columns, then the per-column lists
    (strip, lower, upper), so that a per-column choice wins. Columns in ``protect`` are exempt from
    the all-columns steps.
    """
    if case not in ("none", "lower", "upper"):
        raise ValueError(f"case must be none, lower or upper, not {case!r}")
    df = renamed(df, rename or {})
    everywhere = []
    if case != "none":
        everywhere.append(F.lower if case == "lower" else F.upper)
    if trim_all:
        everywhere.append(F.trim)
    chosen = ((F.trim, frozenset(strip)), (F.lower, frozenset(lower)), (F.upper, frozenset(upper)))

    changed = {}
    for field in df.schema.fields:
        steps = []
        if isinstance(field.dataType, StringType) and field.name not in protect:
            steps += everywhere
        steps += [step for step, names in chosen if field.name in names]
        value = ref(field.name)
        for step in steps:
            value = step(value)
        if steps:
            changed[field.name] = value
    return _replaced(df, changed)


def converted(df: DataFrame, casts: Iterable[tuple[str, str]], on_error: str = "fail") -> DataFrame:
    """Cast existing columns in place. ``on_error="null"`` turns a malformed value into NULL."""
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be fail or null, not {on_error!r}")
    changed: dict[str, Column] = {}
    for name, type_name in casts:
        if name in df.columns and type_name:
            value = changed.get(name, ref(name))
            changed[name] = value.cast(type_name) if on_error == "fail" else value.try_cast(type_name)
    return _replaced(df, changed)


def all_text(df: DataFrame) -> DataFrame:
    return df.select([ref(c).cast("string").alias(c) for c in df.columns])


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    unwanted = set(names)
    return df.select(refs(c for c in df.columns if c not in unwanted))


def keep(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns that exist, in the order asked for."""
    return df.select(refs(c for c in names if c in df.columns))


def moved_last(df: DataFrame, names: str | Sequence[str]) -> DataFrame:
    wanted = [names] if isinstance(names, str) else list(names)
    tail = [c for c in wanted if c in df.columns]
    return df.select(refs([c for c in df.columns if c not in tail] + tail))


def filled(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs by a default per column."""
    return df.fillna(dict(defaults)) if defaults else df


def _replaced(df: DataFrame, changed: Mapping[str, Column]) -> DataFrame:
    if not changed:
        return df
    return df.select([changed[c].alias(c) if c in changed else ref(c) for c in df.columns])
