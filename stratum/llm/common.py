"""Helpers the operators of this package share."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stratum.scratch import staged

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_SQL = r"[^\x20\x09-\x0D]+"
PACKAGE_HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows a Python worker holds as Python objects at a time.
SLICE = 256


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hash64(data: bytes) -> int:
    """A signed 64-bit hash, equal on every machine."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def schema(ddl: str | T.StructType) -> T.StructType:
    return ddl if isinstance(ddl, T.StructType) else T.DataType.fromDDL(ddl)


def slices(batch: pa.RecordBatch, rows: int = SLICE) -> Iterator[list[list]]:
    """The batch's columns as lists, a bounded number of rows at a time."""
    for start in range(0, batch.num_rows, rows):
        yield [column.to_pylist() for column in batch.slice(start, rows).columns]


def arrow_mapped(df: DataFrame, work: Callable, result: T.StructType) -> DataFrame:
    """``mapInArrow`` by workers that look for this package where the driver found it."""
    places = df.sparkSession.sparkContext.environment
    if PACKAGE_HOME not in places.get("PYTHONPATH", "").split(os.pathsep):
        places["PYTHONPATH"] = os.pathsep.join(filter(None, [PACKAGE_HOME, places.get("PYTHONPATH")]))
    return df.mapInArrow(work, result)


def mapped_slices(df: DataFrame, ddl: str | T.StructType, function: Callable[[list[list]], Iterable[tuple]]) -> DataFrame:
    """``function`` gets the columns of a few hundred rows as lists and gives result rows."""
    spark_schema = schema(ddl)
    arrow_schema = to_arrow_schema(spark_schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in slices(batch):
                rows = list(function(columns))
                if rows:
                    arrays = [pa.array(values, type=field.type) for values, field in zip(zip(*rows), arrow_schema)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    return arrow_mapped(df, work, spark_schema)


def mapped_rows(df: DataFrame, ddl: str, function: Callable[..., Iterable[tuple]]) -> DataFrame:
    """``function`` gets the values of one row and gives result rows."""
    return mapped_slices(df, ddl, lambda columns: (out for row in zip(*columns) for out in function(*row)))


def numbered(df: DataFrame, label: str, row_id: str = "row_id") -> DataFrame:
    """``df`` written once, with a number for each row that later reads agree on."""
    return staged(df.withColumn(row_id, F.monotonically_increasing_id()), label)


#: Bits of the bitmap that tells rows apart which cannot be among given keys.
SIEVE_BITS = 1 << 25


def sieved(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key`` may be in ``keys`` (one column of longs), and the others, which need not be moved for a join.

    The keys are broadcast as a bitmap of bounded size; more keys let more of the other rows through as possible ones.
    """
    at = F.pmod(F.col(keys.columns[0]), F.lit(SIEVE_BITS))
    bitmap = F.broadcast(staged(keys.groupBy(F.shiftright(at, 15).alias("__chunk")).agg(
        F.bitmap_construct_agg(at.bitwiseAND(32_767)).alias("__bits")), "sieve"))
    place = F.pmod(key, F.lit(SIEVE_BITS))
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(place.bitwiseAND(32_767), 3).cast("int") + 1, F.lit(1))), 16, 10)
    set_ = F.coalesce(F.getbit(byte.cast("long"), place.bitwiseAND(7).cast("int")) == 1, F.lit(False))
    met = rows.join(bitmap, F.shiftright(place, 15) == F.col("__chunk"), "left").withColumn("__met", set_)
    return met.filter("__met").select(*rows.columns), met.filter("NOT __met").select(*rows.columns)
