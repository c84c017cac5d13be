"""Where intermediate tables go.

A cluster names a shared folder in ``spark.checkpoint.dir``; executors on any machine can reach it, so
a staged table outlives the executor that wrote it. Where it is unset, the folder is below the warehouse.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared scratch folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/stratum/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the written table (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    known = _written.get()
    if known is not None:
        known.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def kept_only(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What is staged inside goes at the end, but for what is staged by the function it gives.

    No frame that reads what went may be used after that.
    """
    paths: list[str] = []
    outer = _written.get()

    def keep(df: DataFrame, label: str) -> DataFrame:
        token = _written.set(outer)
        try:
            return staged(df, label)
        finally:
            _written.reset(token)

    token = _written.set(paths)
    try:
        yield keep
    finally:
        _written.reset(token)
        for path in paths:
            remove(spark, path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes at the end. No frame that reads it may be used after that."""
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
