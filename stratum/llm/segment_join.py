"""Line dedup by an edit join on segments.

Lines within ``max_edits`` edits of each other are linked; of the lines that are linked directly or through others,
the first one stays (by document id, hash of the text and place) and the others go. A line is split into one segment
more than there may be edits, so two linked lines have a whole segment in common. Each line is entered in an index
under its length and each of its segments, and probes the indexes of its own and of the next smaller lengths with those
substrings that a segment can equal if the edits before and after it are to suffice. Candidates are verified by an
edit distance that keeps, for each number of edits, a bit for each diagonal of the band.

Shorter lines than ``min_chars`` are left alone. Equal lines are found by a 64-bit hash with their length, and are one
line from then on.

Defined results: a NULL text has no lines and stays NULL. Rows alike in id and text are treated alike and count as one.
A NULL id comes last. An empty table gives no rows. Only doc_id and text are read by ``report``; ``cleaned`` keeps all
columns.
"""

from __future__ import annotations

import dataclasses
import hashlib
import os
from collections.abc import Iterable
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.bucket_links import connected
from stratum.llm.common import WORD, arrow_mapped, hash64, mapped_rows, mapped_slices, numbered, sieved
from stratum.llm.line_frequency import with_length
from stratum.llm.text_units import Hashes
from stratum.scratch import kept_only, staged


@dataclasses.dataclass(frozen=True)
class Settings:
    max_edits: int = 2
    min_chars: int = 24
    #: Line ids that are broadcast to fetch their lines; more of them are joined by a shuffle.
    most_broadcast: int = 1_000_000


#: Letters counted in a line's profile, which keeps lines apart that share a segment by chance.
LETTERS = " etanis"
#: Characters from which on no further document is hashed together with those before it.
MOST_TOGETHER = 1 << 16


def encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def keys(line: str, edits: int) -> list[int]:
    """The index entries and probes of a line. A probe at the line's own place is its index entry."""
    return keys_of([line], edits)[0]


def keys_of(lines: list[str], edits: int) -> list[list[int]]:
    """``keys`` of each of the lines, which are hashed together."""
    sizes = np.array([len(line) for line in lines], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    data = np.frombuffer(encoded("".join(lines)), dtype=np.uint8)
    # Where characters start.
    places = np.arange(len(data) + 1) if len(data) == sizes.sum() else np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    hashes, hashed, fits = Hashes(data), [], []
    for shift in range(edits + 1):
        lengths = sizes - shift
        short, longer = np.divmod(np.maximum(lengths, 0), edits + 1)
        for i in range(edits + 1):
            width = short + (i >= edits + 1 - longer)
            start = i * short + np.maximum(i - (edits + 1 - longer), 0)
            salt = (lengths * 64 + i).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for move in range(max(-i, shift - (edits - i)), min(i, shift + (edits - i)) + 1):
                at = start + move
                fit = (lengths > edits) & (at >= 0) & (at + width <= sizes)
                begin = np.where(fit, first + at, 0)
                end = np.where(fit, begin + width, 0)
                hashed.append((hashes.of(places[begin], places[end]) ^ salt).view(np.int64))
                fits.append(fit)
    found = np.array(hashed).T.tolist()
    if (fit := np.array(fits)).all():
        return [list(set(row)) for row in found]
    return [list({key for key, fits_ in zip(row, each) if fits_}) for row, each in zip(found, fit.T.tolist())]


def within(a: str, b: str, edits: int) -> bool:
    """Whether ``a`` and ``b`` are at most ``edits`` edits apart."""
    if abs(len(a) - len(b)) > edits:
        return False
    head = len(os.path.commonprefix([a, b]))
    a, b = a[head:], b[head:]
    tail = len(os.path.commonprefix([a[::-1], b[::-1]]))
    if tail:
        a, b = a[:-tail], b[:-tail]
    # Bit d of reach[e]: a's first j + d - edits characters become b's first j ones by at most e edits.
    band = (1 << (2 * edits + 1)) - 1
    reach = []
    for e in range(edits + 1):
        reach.append(sum(1 << (edits + d) for d in range(e + 1)))
    for j, c in enumerate(b):
        match = 0
        for d in range(-edits, edits + 1):
            if 0 <= j + d < len(a) and a[j + d] == c:
                match |= 1 << (edits + d)
        after = [reach[0] & match]
        for e in range(1, edits + 1):
            after.append(((reach[e] & match) | reach[e - 1] | (reach[e - 1] >> 1) | (after[e - 1] << 1)) & band)
        if not after[edits]:
            return False
        reach = after
    goal = len(a) - len(b) + edits
    return bool(reach[edits] >> goal & 1)


def lines_of(text: str | None, least: int) -> Iterable[tuple[int, str]]:
    for i, line in enumerate(text.split("\n") if text else ()):
        if len(line) >= least:
            yield i, line


def profile(line: str) -> int:
    """The line's length and its counts of some letters, a byte each (of larger numbers the last byte)."""
    packed = len(line) & 255
    for i, letter in enumerate(LETTERS, 1):
        packed |= (line.count(letter) & 255) << (8 * i)
    return signed(packed)


def cells(line: str, width: int, count: int) -> list[int]:
    """A bit for each of ``count`` cells that hold an odd number of the line's runs of ``width`` characters, in longs."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    mixed = np.zeros(max(0, len(codes) - width + 1), dtype=np.uint32)
    for i in range(width):
        mixed = (mixed + codes[i:i + len(mixed)]) * np.uint32(0x9E3779B1)
    odd = np.bincount(mixed >> np.uint32(33 - count.bit_length()), minlength=count) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def neighbours(line: str) -> int:
    """64 cells of the line's pairs of neighbouring characters."""
    return cells(line, 2, 64)[0]


#: What ``alike`` compares of a line.
MEASURES = "struct<profile: long, letters: long, neighbours: long, triples: long, more_triples: long>"


def measured(line: str) -> dict[str, int]:
    triples, more = cells(line, 3, 128)
    return {"profile": profile(line), "letters": cells(line, 1, 64)[0], "neighbours": neighbours(line), "triples": triples,
            "more_triples": more}


def signed(packed: int) -> int:
    return packed - (1 << 64) if packed >> 63 else packed


def alike(edits: int):
    """Whether lines can be linked.

    An edit changes each number of the profile by one, two of its letters' numbers, two cells of letters, four of
    neighbours and six of triples, at most.
    """
    def condition(n: Column, m: Column) -> Column:
        byte = [[F.shiftright(x["profile"], 8 * i).bitwiseAND(255) for i in range(8)] for x in (n, m)]
        apart = [(a - b + edits).bitwiseAND(255) for a, b in zip(*byte)]
        together = reduce(add, (F.abs(x - edits) for x in apart[1:]))
        odd = [F.bit_count(n[c].bitwiseXOR(m[c])) for c in ("letters", "neighbours", "triples", "more_triples")]
        return (odd[0] <= 2 * edits) & (odd[1] <= 4 * edits) & (odd[2] + odd[3] <= 6 * edits) & reduce(
            and_, (x <= 2 * edits for x in apart)) & (together <= 2 * edits)
    return condition


def described(columns: list[list], settings: Settings) -> Iterable[tuple]:
    """A row of ``LINES`` for each of the documents, some of which are hashed together."""
    at, size = 0, 0
    for i, text in enumerate(texts := columns[1], 1):
        size += len(text or "")
        if size >= MOST_TOGETHER or i == len(texts):
            yield from described_together(columns[0][at:i], texts[at:i], settings)
            at, size = i, 0


def described_together(doc_ids: list, texts: list, settings: Settings) -> Iterable[tuple]:
    lines = [list(lines_of(text, settings.min_chars)) for text in texts]
    entries = iter(keys_of([line for found in lines for _, line in found], settings.max_edits) if any(lines) else ())
    for doc_id, text, found in zip(doc_ids, texts, lines):
        data = encoded(text or "")
        yield doc_id, hashlib.md5(data).hexdigest(), hash64(data), [
            {"at": i, "line": hash64(encoded(line)), "n": len(line), "keys": next(entries)} for i, line in found]


LINES = ("doc_id long, digest string, tie long, "
         "lines array<struct<at: int, line: long, n: int, keys: array<long>>>")


def line_texts(docs: DataFrame, members: DataFrame, settings: Settings) -> DataFrame:
    """(member, text, n) of the given lines, n being what ``alike`` compares."""
    wanted = staged(members.select(F.col("member").alias("wanted")).distinct(), "wanted-lines")
    if wanted.count() <= settings.most_broadcast:
        wanted = F.broadcast(wanted)
    least = settings.min_chars

    def lines(text: str | None) -> Iterable[tuple]:
        for _, line in lines_of(text, least):
            yield hash64(encoded(line)), line

    every = mapped_rows(docs.select("text"), "member long, text string", lines)
    found = every.join(wanted, F.col("member") == F.col("wanted"), "left_semi").dropDuplicates(["member"])
    return staged(mapped_rows(found, f"member long, text string, n {MEASURES}",
                              lambda member, text: ((member, text, measured(text)),)), "line-texts")


def confirmer(edits: int):
    def confirmed(a: int, b: int, text_a: str, text_b: str) -> Iterable[tuple]:
        if within(text_a, text_b, edits):
            yield a, b
    return confirmed


def judged(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Rows (row_id, doc_id, digest, n_lines), and of those that lose lines row_id, removed, n_near, n_chars."""
    rows = numbered(mapped_slices(docs.selectExpr("cast(doc_id as long) doc_id", "text"), LINES,
                                  lambda columns: described(columns, settings)), "lines")
    every = rows.select("row_id", "doc_id", "tie", F.inline("lines"))
    keyed = every.select(F.col("line").alias("member"), F.explode("keys").alias("bucket"))
    # Most buckets hold one line, and only their numbers are shuffled; those of copies of one line are told in what is left.
    twice = keyed.groupBy("bucket").agg(F.count("*").alias("met")).filter("met > 1")
    met = staged(keyed.join(twice.select("bucket"), "bucket", "left_semi").distinct(), "line-buckets")
    shared = met.groupBy("bucket").agg(F.count("*").alias("met")).filter("met > 1")
    met = staged(met.join(shared.select("bucket"), "bucket", "left_semi"), "shared-buckets")
    texts = line_texts(docs, met, settings)
    buckets = staged(met.join(texts.select(F.col("member").alias("of"), "n"), F.col("member") == F.col("of")).select(
        "bucket", "member", "n"), "measured-buckets")
    edits = settings.max_edits
    labels = connected(buckets, texts.select("member", "text"), alike(edits), confirmer(edits))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tie", "at")
    distinct = every.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    classed = staged(distinct.join(labels.withColumnRenamed("member", "line"), "line", "left").select(
        "line", "copies", F.coalesce("label", "line").alias("label"), F.col("first").alias("own")), "classes")
    first = classed.groupBy("label").agg(F.min("own").alias("first"), F.sum("copies").alias("all")).filter("all > 1")
    first = staged(classed.join(first, "label").select(F.col("line").alias("of_line"), "own", "first"), "first-lines")
    gone = (
        every.drop("keys").join(first, F.col("line") == F.col("of_line")).filter(place != F.col("first"))
        .groupBy("row_id").agg(F.sort_array(F.collect_list("at")).alias("removed"), F.sum("n").alias("n_chars"),
                               F.count_if(place == F.col("own")).alias("n_near"))
    )
    return rows.select("row_id", "doc_id", "digest", F.size("lines").alias("n_lines")), staged(gone, "removed-lines")


def report(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Of each row: lines judged, lines removed, those with no equal line before them, their characters and places."""
    rows, gone = judged(docs, settings)
    zero = F.lit(0)
    return rows.join(gone, "row_id", "left").select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), zero).cast("long").alias("n_removed"),
        F.coalesce("n_near", zero).cast("long").alias("n_near"), F.coalesce("n_chars", zero).cast("long").alias("n_removed_chars"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed_lines"))


def cleaned(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the removed lines; documents that are left without a word, having lost lines, go."""
    with kept_only(docs.sparkSession) as keep:
        rows, gone = judged(docs, settings)
        lost = rows.join(gone, "row_id").groupBy(F.col("doc_id").alias("__doc"), F.col("digest").alias("__digest")).agg(
            F.first("removed").alias("__removed"))
        lost = keep(lost, "lost-lines")
    digest = F.md5(F.coalesce("text", F.lit("")))
    touched, others = sieved(docs, F.xxhash64(F.col("doc_id").cast("long"), digest), lost.select(F.xxhash64("__doc", "__digest")))
    joined = touched.join(lost, touched["doc_id"].cast("long").eqNullSafe(F.col("__doc")) & (digest == F.col("__digest")),
                          "left").select(*docs.columns, "__removed")
    columns, at = docs.columns, docs.columns.index("text")

    def work(batches):
        for batch in batches:
            texts, lists = batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist()
            texts = [without(t, set(gone_)) if gone_ else t for t, gone_ in zip(texts, lists)]
            keep = [not gone_ or bool(WORD.search(t)) for t, gone_ in zip(texts, lists)]
            arrays = list(batch.columns[:-1])
            arrays[at] = pa.array(texts, type=arrays[at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(keep))

    return with_length(arrow_mapped(joined, work, docs.schema).unionByName(others))


def without(text: str, places: set[int]) -> str:
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in places)
