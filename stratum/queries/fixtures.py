"""Run details and file layouts the registered queries share. All rows come from the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from stratum.operators.columns import RunInfo
from stratum.scratch import scratch_path

RUN = RunInfo("corr-1", "job-1", "run-1", "loader", dt.datetime(2024, 5, 1, 6, 0, tzinfo=dt.timezone.utc))
AS_OF = dt.date(2024, 5, 10)


def fresh_table(label: str) -> str:
    """A table name no other call uses."""
    import uuid

    return f"stratum_{label}_{uuid.uuid4().hex[:12]}"


def write_parts(df: DataFrame, folder: str, prefix: str, suffix: str, header: bool, fmt: str = "csv") -> int:
    """Write ``df`` with Spark and give the part files the delivery's names: <prefix><n><suffix>."""
    spark = df.sparkSession
    raw = scratch_path(spark, "parts")
    writer = df.write.option("header", header) if fmt == "csv" else df.write
    getattr(writer, fmt)(raw)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(raw).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(path(folder))
    parts = [s.getPath() for s in fs.listStatus(path(raw)) if s.getPath().getName().startswith("part-")]
    for number, part in enumerate(sorted(parts, key=lambda p: p.getName())):
        fs.rename(part, path(f"{folder}/{prefix}{number}{suffix}"))
    return len(parts)


def folder(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label)
