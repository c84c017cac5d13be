"""Quality rules by cross-document line frequency.

Lines are normalised and hashed; for each host the distinct documents holding a line are counted. Lines above
the host's limit are boilerplate, whatever their length, and are removed; a document that loses most of its words is rejected, and so
is one that fails the base rules (too few words, too much internal repetition).

Defined results: a NULL text counts as an empty one (no words, fails the base rules). A NULL host is a host of
its own. Rows with equal host and text are one document for the counts (copies do not make their own lines
frequent) and each gets its own result row; repeated ids stay repeated. An empty table gives an empty result.
Other columns of the input, whatever their names, are ignored by ``verdicts`` and kept by ``filtered``.
"""

from __future__ import annotations

import dataclasses
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import WORD, arrow_mapped, hash64, mapped_rows, numbered, sieved
from stratum.scratch import staged

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclasses.dataclass(frozen=True)
class Limits:
    """When a line is boilerplate and a document depleted."""

    min_words: int = 20
    max_repeat_percent: int = 30
    #: a line is removed if more of the host's distinct documents hold it than both of these say
    min_documents: int = 20
    host_percent: int = 5
    #: a document is depleted if more of its words were removed
    depleted_percent: int = 70


def normalised(line: str) -> str:
    return " ".join(WORD.findall(line.lower()))


def repeated_words(words: list[str], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` (a power of two) words that occur twice or more."""
    if len(words) <= size:
        return 0
    ids: dict[str, int] = {}
    grams = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    width = 1
    while width < size:
        pairs = grams[:-width] * (int(grams.max()) + 1) + grams[width:]
        distinct, grams = np.unique(pairs, return_inverse=True)
        width *= 2
        if len(distinct) == len(pairs):
            return 0
    found = np.bincount(grams)[grams] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(found)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def described(doc_id: int | None, host: str | None, text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines: dict[int, int] = {}
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        count = len(WORD.findall(line))
        if not count:
            continue
        repeats += line in seen
        seen.add(line)
        key = hash64(normalised(line).encode("utf-8", "surrogatepass"))
        lines[key] = lines.get(key, 0) + count
    digest = hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()
    return (doc_id, host, digest, len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), repeats,
            repeated_words(words), [{"line": k, "words": n} for k, n in lines.items()])


FEATURES = ("doc_id long, host string, digest binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, lines array<struct<line: long, words: long>>")


def features(docs: DataFrame, host: str) -> DataFrame:
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("host"), "text")
    return numbered(mapped_rows(narrow, FEATURES, lambda *row: (described(*row),)), "line-features")


def frequent_lines(described_docs: DataFrame, limits: Limits) -> DataFrame:
    """(host, line, documents) of the lines above their host's limit."""
    distinct = described_docs.groupBy("host", "digest").agg(F.first("lines").alias("lines"))
    hosts = described_docs.select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("host_documents"))
    counts = (
        distinct.select("host", F.inline("lines")).groupBy("host", "line").agg(F.count("*").alias("documents"))
        .filter(F.col("documents") > limits.min_documents)
    )
    hosts = hosts.withColumnRenamed("host", "of_host")
    return (
        counts.join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
        .filter(F.col("documents") * 100 > F.col("host_documents") * limits.host_percent)
        .select("host", "line", "documents")
    )


def judged(docs: DataFrame, host: str, limits: Limits) -> DataFrame:
    """A row for each document: its figures, its lines to remove, and whether it is kept."""
    found = features(docs, host)
    frequent = staged(frequent_lines(found, limits), "frequent-lines").select(
        F.col("host").alias("of_host"), F.col("line").alias("of_line"))
    removed = (
        found.select("row_id", "host", F.inline("lines"))
        .join(frequent, (F.col("line") == F.col("of_line")) & F.col("host").eqNullSafe(F.col("of_host")))
        .groupBy("row_id").agg(F.sum("words").alias("removed"), F.collect_list("line").alias("removed_lines"))
    )
    base = (F.col("n_words") < limits.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * limits.max_repeat_percent)
    depleted = F.col("n_removed_words") * 100 > F.col("n_words") * limits.depleted_percent
    return (
        found.drop("lines").join(removed, "row_id", "left")
        .withColumn("n_removed_words", F.coalesce("removed", F.lit(0)))
        .withColumn("base_failed", base)
        .withColumn("kept", ~base & ~depleted)
    )


def verdicts(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The figures and the verdict on each row of ``docs`` (doc_id, text and the host column are read)."""
    return judged(docs, host, limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words",
        "base_failed", "kept")


def filtered(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The kept documents without their frequent lines, in the columns of ``docs``."""
    # Equal host and text have equal verdicts, so the verdict is found by content and rows need no number.
    changes = (
        judged(docs, host, limits).filter(~F.col("kept") | F.col("removed_lines").isNotNull())
        .groupBy("host", "digest")
        .agg(F.first("kept").alias("__kept"), F.first("removed_lines").alias("__lines"))
    )
    changes = staged(changes, "line-changes").withColumnsRenamed({"host": "__host", "digest": "__digest"})
    columns = docs.columns
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    touched, others = sieved(docs, F.xxhash64(host, digest), changes.select(F.xxhash64("__host", "__digest")))
    joined = touched.join(changes, (digest == F.col("__digest")) & touched[host].eqNullSafe(F.col("__host")), "left")
    kept = joined.filter(F.coalesce("__kept", F.lit(True))).select(*columns, "__lines")

    def stripped(batches):
        at = columns.index("text")
        for batch in batches:
            texts, lists = batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist()
            texts = [t if not gone else without(t, set(gone)) for t, gone in zip(texts, lists)]
            arrays = list(batch.columns[:-1])
            arrays[at] = pa.array(texts, type=arrays[at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return with_length(arrow_mapped(kept, stripped, docs.schema).unionByName(others))


def without(text: str, gone: set[int]) -> str:
    lines = text.split("\n")
    return "\n".join(x for x in lines if not WORD.search(x)
                     or hash64(normalised(x).encode("utf-8", "surrogatepass")) not in gone)


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, brought up to date."""
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.length("text").cast(kind))
