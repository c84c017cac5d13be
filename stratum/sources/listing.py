"""File discovery through the Hadoop file system: metadata only, no file content."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

#: No path holds this character.
_BETWEEN = "\x01"


@dataclass(frozen=True)
class FileRef:
    path: str
    name: str
    size: int = 0

    @property
    def folder(self) -> str:
        return self.path.rsplit("/", 1)[0]


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


@dataclass(frozen=True)
class _Entry:
    path: str
    is_folder: bool
    size: int

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[1]


# Fixed value: how the file system's status objects print themselves.
_STATUS = re.compile(r"path=(.*?); isDirectory=(true|false)(?:; length=(\d+))?")


def _entries(spark: SparkSession, folder: str) -> list[_Entry]:
    """What a folder holds, fetched as one text: the calls to the JVM do not depend on the number of files."""
    fs, path = _file_system(spark, folder)
    text = spark.sparkContext._jvm.org.apache.commons.lang3.ArrayUtils.toString(fs.listStatus(path))
    return [_Entry(m[1], m[2] == "true", int(m[3] or 0)) for m in _STATUS.finditer(text)]


def loaded(reader: DataFrameReader, paths: Sequence[str]) -> DataFrame:
    """``reader.load`` of many paths, handed over as one text."""
    if len(paths) < 2:
        return reader.load(list(paths))
    spark = reader._spark
    array = spark.sparkContext._jvm.org.apache.commons.lang3.StringUtils.split(_BETWEEN.join(paths), _BETWEEN)
    return DataFrame(reader._jreader.load(array), spark)


def plain_path(path: Column) -> Column:
    """A path of a scan's metadata, in which some characters are escaped, as a listing has it."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def source_columns(path_column: str = "") -> list[Column]:
    """The scan's file name, and the file's full path if a column is named for it."""
    path = [plain_path(F.col("_metadata.file_path")).alias(path_column)] if path_column else []
    return [F.col("_metadata.file_name").alias("file_name"), *path]


def exists(spark: SparkSession, folder: str) -> bool:
    fs, path = _file_system(spark, folder)
    return fs.exists(path)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders directly in a folder."""
    return [e.name for e in _entries(spark, folder)]


def touched(spark: SparkSession, path: str) -> None:
    """Leave an empty file, if there is none."""
    fs, place = _file_system(spark, path)
    if not fs.exists(place):
        fs.mkdirs(place.getParent())
        fs.createNewFile(place)


def files_in(spark: SparkSession, folders: str | Sequence[str], extension: str = "") -> list[FileRef]:
    """Files directly in the folders whose path ends with ``extension`` (case-sensitive).

    Names starting with ``_`` or ``.`` are Spark's own bookkeeping and are left out, as Spark's readers
    do. A missing folder raises; an empty one gives an empty list.
    """
    found = []
    for folder in [folders] if isinstance(folders, str) else folders:
        for entry in _entries(spark, folder):
            if not entry.is_folder and entry.name[0] not in "_." and entry.name.endswith(extension or ""):
                found.append(FileRef(entry.path, entry.name, entry.size))
    return sorted(found, key=lambda f: f.path)


def recent_day_folders(spark: SparkSession, base: str, as_of: dt.date, last_n_days: int = 1) -> list[str]:
    """``base/YYYY/MM/DD`` folders not older than ``last_n_days`` days before ``as_of``, newest first.

    There is no upper bound: folders of future days are kept. Only years and months that can hold such
    a day are listed, and the paths are the listed ones, padded or not.
    """
    oldest = as_of - dt.timedelta(days=last_n_days - 1)
    bound = (oldest.year, oldest.month, oldest.day)
    level: list[tuple[tuple[int, ...], str]] = [((), base)]
    for depth in (1, 2, 3):
        level = [
            (parts + (number,), path)
            for parts, folder in level
            for number, path in _numbered_folders(spark, folder)
            if parts + (number,) >= bound[:depth]
        ]
    return [path for _, path in sorted(level, reverse=True)]


def _numbered_folders(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    return [(int(e.name), e.path) for e in _entries(spark, folder)
            if e.is_folder and e.name.isascii() and e.name.isdigit()]


def discovered(spark: SparkSession, base: str, extension: str = "", last_n_days: int | None = None,
               as_of: dt.date | None = None) -> list[FileRef]:
    """Files of a flat folder, or of the recent day folders if ``last_n_days`` is given.

    Without any matching day folder the base folder itself is searched.
    """
    if last_n_days is None:
        return files_in(spark, base, extension)
    if as_of is None:
        raise ValueError("date folders need an as_of date")
    return files_in(spark, recent_day_folders(spark, base, as_of, last_n_days) or base, extension)


def files_frame(spark: SparkSession, files: Sequence[FileRef]) -> DataFrame:
    """The discovered files as rows (file_name, path), one per listed file."""
    return spark.createDataFrame([(f.name, f.path) for f in files], "file_name string, path string")
