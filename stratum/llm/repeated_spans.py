"""Removal of repeated byte spans, as by a suffix array over all texts.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts anywhere else. A suffix array over all texts
would order every suffix to find those strings; here content-chosen anchors bring together the places where equal
strings can be. Each window has one anchor, the gram with the smallest hash in it, so equal windows have equal anchors.
The windows of one anchor are a unit. Units with equal bytes settle each other by their hashes. Distinct units of one
anchor are the rest: their bytes are laid out in blocks, and the block's Burrows-Wheeler transform is expanded by
breadth-first backward extension, up to the least length, to find the windows that occur in more than one place.
An anchor with very many distinct units (a passage quoted in many places) would make a block too large; its windows
are counted by their digests instead, which needs no block.

Defined results: a NULL text counts as an empty one; texts shorter than a window lose nothing. Matches never cross
texts. Rows alike in id and text are copies of each other, so they lose all of their windows. An empty table gives no
rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from stratum.llm.bwt_intervals import repeated
from stratum.llm.common import arrow_mapped, mapped_rows, numbered, schema, slices
from stratum.llm.text_units import WINDOW, units
from stratum.scratch import staged

#: Distinct units of one anchor that still go into one block.
MOST_UNITS = 4096
BLOCK_BYTES = 1 << 20

TEXTS = ("doc_id long, digest binary, n_bytes long, sha string, "
         "units array<struct<anchor: long, unit: long, first: int, last: int>>")


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def described(doc_id: int | None, text: str | None) -> Iterable[tuple]:
    data = encoded(text)
    columns = (x.tolist() for x in units(np.frombuffer(data, dtype=np.uint8)))
    found = [dict(zip(("anchor", "unit", "first", "last"), row)) for row in zip(*columns)]
    yield doc_id, hashlib.md5(data).digest(), len(data), hashlib.sha256(data).hexdigest(), found


def compressed(docs: DataFrame) -> DataFrame:
    """(of_doc, of_digest, packed): the texts in little space, for a shuffle."""
    def packed(doc_id, text):
        data = encoded(text)
        yield doc_id, hashlib.md5(data).digest(), zlib.compress(data, 1)

    return mapped_rows(docs.selectExpr("cast(doc_id as long) doc_id", "text"),
                       "of_doc long, of_digest binary, packed binary", packed)


UNIT = "struct<anchor: long, unit: long, alone: boolean, hot: boolean, first: int, bytes: binary>"


def cut(text_no: int, packed: bytes, wanted: list | None) -> Iterable[tuple]:
    data = zlib.decompress(packed) if wanted else b""
    yield text_no, packed, [
        {"anchor": w["anchor"], "unit": w["unit"], "alone": w["alone"], "hot": w["hot"], "first": w["first"],
         "bytes": data[w["first"]:w["last"] + WINDOW]} for w in wanted or ()]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


SPANS = "text_no long, first int, end int"


def block_spans(fine: DataFrame) -> DataFrame:
    """Spans of the units that occur once, from blocks of whole groups of anchors."""
    result = schema(SPANS)
    arrow = to_arrow_schema(result)

    def solved(block: dict) -> Iterator[pa.RecordBatch]:
        rows = []
        for (text_no, alone, first, _), flags in zip(block.values(), repeated([b[3] for b in block.values()], WINDOW)):
            if alone:
                rows += [(text_no, first + a, first + b - 1 + WINDOW) for a, b in runs(flags)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, before = {}, 0, None
        for batch in batches:
            for columns in slices(batch, 1024):
                for text_no, anchor, unit, alone, first, data in zip(*columns):
                    if size > BLOCK_BYTES and anchor != before:
                        yield from solved(block)
                        block, size = {}, 0
                    before = anchor
                    if (anchor, unit) not in block:  # rows alike in id and text bring a unit twice
                        block[anchor, unit] = text_no, alone, first, data
                        size += len(data)
        if block:
            yield from solved(block)

    ordered = fine.select("text_no", "anchor", "unit", "alone", "first", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    return arrow_mapped(ordered, work, result)


def counted_spans(hot: DataFrame) -> DataFrame:
    """The same for anchors with very many units: every window is counted by its digest."""
    def windows(text_no, anchor, unit, alone, first, data):
        for i in range(len(data) - WINDOW + 1):
            yield text_no if alone else None, first + i, unit, hashlib.md5(data[i:i + WINDOW]).digest()

    every = mapped_rows(hot.select("text_no", "anchor", "unit", "alone", "first", "bytes").dropDuplicates(["anchor", "unit"]),
                        "text_no long, first int, unit long, window binary", windows)
    every = staged(every, "hot-windows")
    more = every.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
    return every.filter("text_no is not null").join(more, "window", "left_semi").select(
        "text_no", "first", (F.col("first") + WINDOW).alias("end"))


def cleaned(text_no: int, n_bytes: int, sha: str, packed: bytes | None, spans: list) -> Iterable[tuple]:
    """Figures of a text, and what is left of it (NULL if nothing was removed)."""
    merged: list[list[int]] = []
    for first, end in sorted((s["first"], s["end"]) for s in spans or ()):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([first, end])
    if not merged:
        yield text_no, 0, 0, sha, None
        return
    removed = sum(end - first for first, end in merged)
    if removed == n_bytes:
        left = b""
    else:
        data, left, at = zlib.decompress(packed), b"", 0
        pieces = []
        for first, end in merged:
            pieces.append(data[at:first])
            at = end
        left = b"".join([*pieces, data[at:]])
    yield text_no, removed, len(merged), hashlib.sha256(left).hexdigest(), left


CLEANED = "text_no long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left, NULL if all are) of each row."""
    narrow = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    texts = numbered(mapped_rows(narrow, TEXTS, described), "text-units", "text_no")
    every = texts.select("text_no", F.inline("units"))
    met = every.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    shared = staged(every.join(met, "anchor", "left_semi"), "shared-units")
    kinds = shared.groupBy("anchor", "unit").agg(
        F.count("*").alias("n"), F.min(F.struct("text_no", "first", "last")).alias("at"))
    kinds = staged(kinds, "distinct-units")
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    full = shared.join(kinds.filter("n > 1").select("anchor", "unit"), ["anchor", "unit"], "left_semi").select(
        "text_no", "first", (F.col("last") + WINDOW).cast("int").alias("end"))
    full = staged(full, "full-units")
    wanted = kinds.join(anchors, "anchor").select(
        F.col("at.text_no").alias("text_no"), F.struct(
            "anchor", "unit", (F.col("n") == 1).alias("alone"), (F.col("kinds") > MOST_UNITS).alias("hot"),
            F.col("at.first").alias("first"), F.col("at.last").alias("last")).alias("wanted"))
    wanted = wanted.groupBy("text_no").agg(F.collect_list("wanted").alias("wanted"))
    # Texts to be cut, or to lose a part: those with a unit that is settled by others, but not with all their bytes.
    needed = full.select("text_no").distinct().join(wanted, "text_no", "full_outer").join(
        texts.select("text_no", "doc_id", "digest"), "text_no")
    needed = staged(needed, "needed-texts")
    fetched = compressed(docs).join(needed, (F.col("digest") == F.col("of_digest")) & F.col("doc_id").eqNullSafe(F.col("of_doc")))
    fetched = staged(mapped_rows(fetched.select("text_no", "packed", "wanted"),
                                 f"text_no long, packed binary, cut array<{UNIT}>", cut), "cut-texts")
    fine = fetched.select("text_no", F.inline("cut"))
    spans = full.unionByName(block_spans(fine.filter("not hot"))).unionByName(counted_spans(fine.filter("hot")))
    spans = spans.groupBy("text_no").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    packed = fetched.select("text_no", "packed").dropDuplicates(["text_no"])
    lost = staged(mapped_rows(
        spans.join(texts.select("text_no", "n_bytes", "sha"), "text_no").join(packed, "text_no", "left")
        .select("text_no", "n_bytes", "sha", "packed", "spans"), CLEANED, cleaned), "cleaned")
    return texts.select("text_no", "doc_id", "digest", "n_bytes", "sha").join(lost, "text_no", "left").select(
        "doc_id", "digest", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept")


def report(docs: DataFrame) -> DataFrame:
    """The figures of each row."""
    return judged(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
