"""The lazy part of each layer: spec and input frame in, output frame out. No action runs here."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from stratum.functions.hashing import with_row_hash
from stratum.operators.aggregate import aggregated
from stratum.operators.columns import (
    RunInfo,
    all_text,
    converted,
    filled,
    keep,
    moved_last,
    standardized,
    with_expressions,
    with_lineage,
    without,
)
from stratum.operators.names import with_replaced_in_names
from stratum.operators.rows import deduplicated, where_all
from stratum.quoting import quoted
from stratum.sources.files import scan_folder
from stratum.sources.listing import FileRef
from stratum.sources.tables import scan_jdbc, scan_table
from stratum.spec import AggregateSpec, PipelineSpec, TransformSpec

ROW_HASH = "row_hash"


def extracted(spark: SparkSession, spec: PipelineSpec,
              as_of: dt.date | None = None) -> tuple[DataFrame | None, list[FileRef]]:
    """The source frame, or None if there are no files, and the discovered files."""
    source = spec.source
    if source.kind == "table":
        return scan_table(spark, source.table), []
    if source.kind == "jdbc":
        return scan_jdbc(spark, source.url, source.table, source.partition_column, source.bounds,
                         source.options), []
    if source.kind == "file":
        return scan_folder(spark, source.path, source.format, source.options, source.extension,
                           source.last_n_days, as_of, source.split_enabled, source.header_mode, source.layout,
                           source.compat_names, source.schema, bool(spec.target.corrupt_record), spec.lineage.path)
    raise ValueError(f"source type {source.kind} is read by the streaming module")


def bronze_frame(df: DataFrame, spec: PipelineSpec, run: RunInfo) -> DataFrame:
    """Fingerprint of the raw row, derived columns, lineage, standardised text, fingerprint last.

    The fingerprint covers business columns only, unless the spec asks for all. Lineage columns and
    fingerprint are exempt from the all-columns text steps, so file names still match their files.
    """
    transform = spec.transform
    names = spec.lineage
    hashed = [c for c in df.columns if transform.hash_all_columns or c not in (names.file, names.path)]
    df = with_row_hash(df, hashed, transform.hash_mode, ROW_HASH)
    df = with_expressions(df, transform.with_columns, transform.on_column_error)
    df = with_lineage(df, run, names=names)
    df = standardized(df, protect=(*names.all(), ROW_HASH), **transform.standardize)
    return moved_last(_optional_steps(df, transform), ROW_HASH)


def silver_frame(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Derived columns, standardised text, casts."""
    transform = spec.transform
    df = with_expressions(df, transform.with_columns, transform.on_column_error)
    df = standardized(df, protect=(*spec.lineage.all(), ROW_HASH), **transform.standardize)
    df = converted(df, transform.casts, transform.on_cast_error)
    return _optional_steps(df, transform)


def gold_frame(df: DataFrame, spec: PipelineSpec, aggregations: AggregateSpec | None = None) -> DataFrame:
    """Derived columns and filters, then the aggregation of the target (or of the spec)."""
    transform = spec.transform
    df = with_expressions(df, transform.with_columns, transform.on_column_error)
    df = where_all(df, transform.filters)
    chosen = aggregations or transform.aggregations
    return aggregated(df, chosen.group_by, chosen.metrics, chosen.whole_table)


def gold_select(spark: SparkSession, spec: PipelineSpec, aggregations: AggregateSpec | None = None) -> str:
    """The same as SQL text over the source table, for targets published as views."""
    if spec.source.kind != "table":
        raise ValueError("a view needs a table as its source")
    chosen = aggregations or spec.transform.aggregations
    body = spec.source.table
    df = spark.table(body)
    for name, expression in spec.transform.with_columns:
        after = with_expressions(df, [(name, expression)], spec.transform.on_column_error)
        if after.columns == df.columns and name.lower() not in {c.lower() for c in df.columns}:
            continue  # it does not resolve and is to be skipped
        if after is not df:
            listed = ", ".join(f"({expression}) AS {quoted(c)}" if c.lower() == name.lower() else quoted(c)
                               for c in after.columns)
            body = f"(SELECT {listed} FROM {body})"
        df = after
    where = " AND ".join(f"({c})" for c in spec.transform.filters)
    groups = [quoted(c) for c in chosen.group_by]
    metrics = [f"{m['expr']} AS {quoted(m['name'])}" for m in chosen.metrics if m.get("name") and m.get("expr")]
    grouped = bool(metrics) and bool(groups or chosen.whole_table)
    select = ", ".join(groups + metrics) if grouped else "*"
    text = f"SELECT {select} FROM {body}"
    if where:
        text += f" WHERE {where}"
    if grouped and groups:
        text += f" GROUP BY {', '.join(groups)}"
    return text


def _optional_steps(df: DataFrame, transform: TransformSpec) -> DataFrame:
    df = where_all(df, transform.filters)
    df = filled(df, {c: v for c, v in transform.fill_nulls.items() if c in df.columns})
    if transform.deduplicate is not None:
        options = transform.deduplicate
        df = deduplicated(df, options.get("keys"), options.get("order_by") or ())
    if transform.drop:
        df = without(df, transform.drop)
    if transform.select:
        df = keep(df, transform.select)
    for text, replacement in transform.replace_in_names.items():
        df = with_replaced_in_names(df, text, replacement)
    return all_text(df) if transform.all_to_string else df
