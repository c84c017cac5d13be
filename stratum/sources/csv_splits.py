"""CSV deliveries split into several files, with the header in all, some, one or none of them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.operators.names import ILLEGAL, illegal_names
from stratum.sources.listing import FileRef, loaded, plain_path, source_columns

# The header modes, and below the name pattern of the first file.
HEADER_MODES = ("auto", "no_header", "all_header", "one_header")


def is_split(files: Sequence[FileRef]) -> bool:
    """True if any folder holds more than one of the files."""
    return any(n > 1 for n in Counter(f.folder for f in files).values())


def header_mode(value: str | None) -> str:
    """The configured mode; anything unknown means ``auto``."""
    mode = (value or "auto").strip().lower()
    return mode if mode in HEADER_MODES else "auto"


def numbered_first(files: Sequence[FileRef], extension: str = "") -> list[FileRef]:
    """Files named ``*_1.<ext>``, which carry the header by convention."""
    suffix = re.escape(extension.lstrip(".")) if extension else "[^/]+"
    pattern = re.compile(rf"_1\.{suffix}$", re.IGNORECASE)
    return [f for f in files if pattern.search(f.name)]


def scan_splits(spark: SparkSession, files: Sequence[FileRef], options: Mapping[str, object],
                mode: str = "auto", extension: str = "", schema: StructType | str | None = None,
                path_column: str = "") -> DataFrame:
    """At most two scans: files with a header, and files without one read by position under its schema.

    A given ``schema`` is that of both, by position.

    ``no_header``, ``all_header`` and ``one_header`` look at no file before the scan. ``auto`` looks at
    the first line of each file.
    """
    mode = header_mode(mode)
    files = list(files)
    if mode == "all_header":
        with_header, bare = files, []
    elif mode == "no_header":
        with_header, bare = [], files
    elif mode == "one_header":
        with_header = numbered_first(files, extension)
        bare = _others(files, with_header)
        if not with_header:
            raise ValueError("header mode one_header needs a file named *_1.<ext>")
    else:
        with_header, bare = classified(spark, files, options, extension)

    if not with_header:
        return _read(spark, bare, options, header=False, schema=schema).select("*", *source_columns(path_column))
    headed = _read(spark, with_header, options, header=True, schema=schema)
    result = headed.select("*", *source_columns(path_column))
    if bare:
        rest = _read(spark, bare, options, header=False, schema=headed.schema)
        result = result.unionByName(rest.select("*", *source_columns(path_column)))
    return result


def classified(spark: SparkSession, files: Sequence[FileRef], options: Mapping[str, object],
               extension: str = "") -> tuple[list[FileRef], list[FileRef]]:
    """Split files into (with header, without) by their first rows.

    With a ``*_1`` file, its first row is the reference: if it is no legal header, no file has one;
    else the files whose first row equals it have one. Without a ``*_1`` file, a legal first row
    counts as a header. Rows are compared on the executors; only the paths of files with a header come back.
    """
    files = list(files)
    first = numbered_first(files, extension)
    if first:
        reference = first_rows(spark, first[:1], options)[0]
        if reference is None or illegal_names(reference):
            return [], files
        others = _others(files, first)
        same = F.col("row") == F.lit(reference)
        known = {*first, *_with(same, spark, others, options)}
    else:
        known = set(_with(~F.exists("row", lambda name: name.rlike(ILLEGAL.pattern)), spark, files, options))
    return [f for f in files if f in known], [f for f in files if f not in known]


def _with(condition: Column, spark: SparkSession, files: Sequence[FileRef], options: Mapping[str, object]) -> list[FileRef]:
    """The files for whose first row the condition holds."""
    if not files:
        return []
    found = {r.path for r in head_rows(spark, files, options).where(condition).select("path").collect()}
    return [f for f in files if f.path in found]


def _others(files: Sequence[FileRef], chosen: Sequence[FileRef]) -> list[FileRef]:
    taken = set(chosen)
    return [f for f in files if f not in taken]


def head_rows(spark: SparkSession, files: Sequence[FileRef], options: Mapping[str, object]) -> DataFrame:
    """(path, row): the values of each file's first row with text, by Spark's own text scan.

    Each file, or block of a large one, is a task of its own, and a task stops after the row and a few
    thousand lines, whatever the file's size. Files without text have no row. With the option ``multiLine`` a quoted value goes on
    over line ends.
    """
    chosen = {k.lower(): str(v) for k, v in options.items() if v is not None}
    delimiter = chosen.get("delimiter", chosen.get("sep", ","))
    encoding, quote = chosen.get("encoding", chosen.get("charset", "UTF-8")), chosen.get("quote", '"')
    many_lines = chosen.get("multiline", "false").lower() == "true"

    def first_of_file(batches):
        import csv
        import itertools

        import pyarrow

        rows = ((v, p, s) for batch in batches for v, p, s in zip(*(batch.column(i).to_pylist() for i in range(3))))
        head = next(rows, None)
        if head is None or head[2] > 0:  # a later block of the file
            return
        wide = 2 if "16" in encoding else 4 if "32" in encoding else 1
        texts = (v[:len(v) - len(v) % wide].decode(encoding, errors="replace") for v, _, _ in itertools.chain([head], rows))
        lines = itertools.dropwhile(lambda text: not text.strip("\ufeff\x00 \t\r\n"), texts)
        line = next(lines, None)
        if line is None:
            return
        line = line.lstrip("\ufeff").rstrip("\r")
        if len(delimiter) != 1:
            values = line.split(delimiter)
        else:
            quoting = {"quotechar": quote} if len(quote) == 1 else {"quoting": csv.QUOTE_NONE}
            more = lines if many_lines else ()
            values = next(csv.reader((text + "\n" * many_lines for text in itertools.chain([line], more)), delimiter=delimiter, **quoting))
        yield pyarrow.RecordBatch.from_arrays(
            [pyarrow.array([head[1]]), pyarrow.array([values], type=pyarrow.list_(pyarrow.string()))], names=["path", "row"])
        for _ in itertools.islice(batches, 8):  # a worker that leaves rows unread ends; small files are read to their end
            pass

    own = spark.newSession()  # settings of this scan only: one file a task, few rows a batch
    for name, value in (("spark.sql.files.openCostInBytes", "128m"), ("spark.sql.files.maxPartitionBytes", "128m"),
                        ("spark.sql.files.minPartitionNum", "1"), ("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")):
        own.conf.set(name, value)
    reader = own.read.format("text")
    if "linesep" in chosen:
        reader = reader.option("lineSep", chosen["linesep"])
    lines = loaded(reader, [f.path for f in files]).select(
        F.col("value").cast("binary"), plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("start"))
    return lines.mapInArrow(first_of_file, "path string, row array<string>")


def first_rows(spark: SparkSession, files: Sequence[FileRef],
               options: Mapping[str, object]) -> list[list[str] | None]:
    """Column values of each file's first row; None for a file without text. A file that cannot be read is an error."""
    if not files:
        return []
    found = {r.path: list(r.row) for r in head_rows(spark, files, options).collect()}
    return [found.get(f.path) for f in files]


def _read(spark: SparkSession, files: Sequence[FileRef], options: Mapping[str, object], header: bool,
          schema: StructType | str | None = None) -> DataFrame:
    """All reader options pass through; only the header is decided here, and the types of headerless parts."""
    chosen = {k: v for k, v in options.items() if k.lower() != "header"}
    if schema is not None:
        chosen = {k: v for k, v in chosen.items() if k.lower() != "inferschema"}
    reader = spark.read.options(**chosen).option("header", header)
    return loaded((reader if schema is None else reader.schema(schema)).format("csv"), [f.path for f in files])
