"""Load reconciliation per file and log summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.aggregate import rows_per_file
from stratum.operators.rows import where_run
from stratum.quoting import ref

# Fixed value: layout of a log line, "time - level - logger:function() - message".
LOG_LINE = r"^(.*?) - ([A-Z]+) - (.*?):(\w+)\(\) - (?s)(.*)$"


def loaded_per_file(target: DataFrame, run_id: str | None, run_column: str = "run_id",
                    file_column: str = "file_name") -> DataFrame:
    """Rows of one run in the target, by source file; reads two columns only."""
    return rows_per_file(where_run(target, run_id, run_column), file_column, "records_succeeded")


def reconciled(totals: DataFrame, succeeded: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Compare rows read with rows loaded per file.

    ``totals`` has (file_name, records_total), ``succeeded`` (file_name, records_succeeded) and ``files`` the
    discovered files as (file_name, path). ``file_name`` may hold names or, to tell files of one name apart, paths.
    A file with no loaded rows counts zero, and so does a discovered one that no row was read from; status is
    Success only if both counts agree.
    """
    joined = totals.join(succeeded, "file_name", "left")
    source_name = ref("file_name")
    if files is not None:
        paths = files.groupBy("file_name").agg(F.min("path").alias("path"))
        joined = joined.join(paths, "file_name", "full_outer")
        source_name = F.coalesce(ref("path"), source_name)
    total, loaded = (F.coalesce(ref(c), F.lit(0).cast("bigint")) for c in ("records_total", "records_succeeded"))
    return joined.select(
        source_name.alias("source_name"),
        total.alias("records_total"),
        loaded.alias("records_succeeded"),
        F.when(total == loaded, "Success").otherwise("Failed").alias("load_status"),
    )


def parsed_log(lines: DataFrame, message: str = "code_message") -> DataFrame:
    """Split formatted log lines into time, level, logger, function and text."""
    parts = {"logged_at": 1, "level": 2, "logger": 3, "function": 4, "text": 5}
    return lines.select("*", *[F.regexp_extract(ref(message), LOG_LINE, n).alias(name) for name, n in parts.items()])


def log_level_counts(lines: DataFrame, run_column: str = "run_id", message: str = "code_message") -> DataFrame:
    level = F.regexp_extract(ref(message), LOG_LINE, 2)
    return lines.groupBy(ref(run_column), level.alias("level")).agg(F.count(F.lit(1)).alias("lines"))
