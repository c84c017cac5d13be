"""File scans by format, and the routing between them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratum.operators.names import with_clean_names
from stratum.quoting import ref, refs
from stratum.sources.csv_splits import is_split, scan_splits
from stratum.sources.fixed_width import Field, scan_fixed_width
from stratum.sources.listing import FileRef, discovered, loaded, source_columns

# Fixed value: formats Spark reads by itself here. Table formats need their package on the class path.
FORMATS = ("csv", "parquet", "json", "orc", "text", "xml", "binaryFile", "delta", "fixed_width")
# Fixed value: another name for fixed-width files; the layout replaces the copybook.
ALIASES = {"cobol": "fixed_width"}


def scan_files(spark: SparkSession, files: Sequence[FileRef], file_format: str,
               options: Mapping[str, object] | None = None, schema: StructType | str | None = None,
               with_file_name: bool = True, path_column: str = "") -> DataFrame:
    """One scan over all files. The file name is attached here: later unions and groupings lose it."""
    reader = spark.read.format(file_format).options(**_reader_options(options))
    if schema is not None:
        reader = reader.schema(schema)
    df = loaded(reader, [f.path for f in files])
    if not with_file_name:
        return df
    name, *path = source_columns(path_column)
    return df.select("*", *([] if "file_name" in df.columns else [name]), *path)


def scan_csv(spark: SparkSession, files: Sequence[FileRef], options: Mapping[str, object] | None = None,
             split_enabled: bool = True, header_mode: str = "auto", extension: str = "",
             compat_names: bool = False, schema: StructType | str | None = None, keep_corrupt: bool = False,
             path_column: str = "") -> DataFrame:
    """CSV scan with legal column names; several files in a folder count as parts of one split file.

    With ``keep_corrupt``, which needs a schema, the text of malformed records is in ``_corrupt_record``.
    """
    if keep_corrupt:
        full, options = corrupt_schema(spark, schema), _corrupt_options("csv", options)
    else:
        full = schema
    if split_enabled and is_split(files):
        df = scan_splits(spark, files, options or {}, header_mode, extension, full, path_column)
    else:
        df = scan_files(spark, files, "csv", options, full, path_column=path_column)
    return with_clean_names(_with_corrupt_text(df) if keep_corrupt else df, compat_names)


def scan_folder(
    spark: SparkSession,
    path: str,
    file_format: str,
    options: Mapping[str, object] | None = None,
    extension: str = "",
    last_n_days: int | None = None,
    as_of: dt.date | None = None,
    split_enabled: bool = True,
    header_mode: str = "auto",
    layout: Sequence[Field] = (),
    compat_names: bool = False,
    schema: StructType | str | None = None,
    keep_corrupt: bool = False,
    path_column: str = "",
) -> tuple[DataFrame | None, list[FileRef]]:
    """Discover and scan. Returns the frame, or None if there is nothing to read, and the files."""
    file_format = ALIASES.get(file_format, file_format)
    if file_format not in FORMATS:
        raise ValueError(f"unsupported file format: {file_format}")
    files = discovered(spark, path, extension, last_n_days, as_of)
    if not files:
        return None, files
    if file_format == "csv":
        return scan_csv(spark, files, options, split_enabled, header_mode, extension, compat_names, schema,
                        keep_corrupt, path_column), files
    if keep_corrupt:
        full = spark.createDataFrame([], schema).schema
        return scan_with_corrupt(spark, [f.path for f in files], file_format, full, options, path_column), files
    if file_format == "fixed_width":
        return scan_fixed_width(spark, [f.path for f in files], layout, path_column=path_column,
                                **dict(options or {})), files
    return scan_files(spark, files, file_format, options, schema, path_column=path_column), files


CORRUPT = "_corrupt_record"


def scan_with_corrupt(spark: SparkSession, paths: str | Sequence[str], file_format: str,
                      schema: StructType, options: Mapping[str, object] | None = None, path_column: str = "") -> DataFrame:
    """Permissive CSV or JSON scan that keeps the text of malformed records in ``_corrupt_record``.

    Column pruning is off inside the CSV parser: with it, a record counts as malformed or not depending
    on the columns a query happens to use.
    """
    reader = spark.read.format(file_format).options(**_corrupt_options(file_format, options))
    df = loaded(reader.schema(corrupt_schema(spark, schema)), [paths] if isinstance(paths, str) else paths)
    return _with_corrupt_text(df.select("*", *source_columns(path_column)))


def corrupt_schema(spark: SparkSession, schema: StructType | str) -> StructType:
    """``schema`` with the column of malformed records."""
    known = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    return StructType(known.fields + [StructField(CORRUPT, StringType())])


def _corrupt_options(file_format: str, options: Mapping[str, object] | None) -> dict[str, object]:
    chosen = {**_reader_options(options), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if file_format == "csv":
        chosen["columnPruning"] = "false"
    return chosen


def _with_corrupt_text(df: DataFrame) -> DataFrame:
    """Spark refuses a scan pruned to the corrupt-record column alone, so the text is joined with nothing
    from a data column, which keeps that column in the scan whatever a query selects."""
    nothing = F.left(F.coalesce(ref(df.columns[0]).cast("string"), F.lit("")), F.lit(0))
    return df.withColumn(CORRUPT, F.concat(ref(CORRUPT), nothing))


def good_records(df: DataFrame) -> DataFrame:
    return df.where(ref(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_records(df: DataFrame) -> DataFrame:
    """File name and text of the malformed records."""
    return df.where(ref(CORRUPT).isNotNull()).select("file_name", CORRUPT)


def _reader_options(options: Mapping[str, object] | None) -> dict[str, object]:
    return dict(options or {})
