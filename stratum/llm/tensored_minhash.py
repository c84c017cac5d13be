"""Near-duplicates by MinHash with tensored banding.

A document is the set of its distinct shingles, of three words if ``Settings`` say nothing else. Collections of ``ROWS``
minhashes are computed, in blocks of ``BLOCK`` collections; every pair of a block's collections is a table, and its key
combines the two collections' values. Documents that agree in two collections of a block meet in a table, so 40
minhashes serve 30 tables of four rows each. There are so many blocks that two sets at the threshold meet in a table but
for a chance of 7e-6: five at 0.85, six at 0.8. Larger blocks would need fewer minhashes, but documents that are alike
would meet in many more tables. A table is split into bands of set sizes, as sets of very different size cannot be alike
enough; only a set near a border is in two of them.

Documents with equal sets are one class from then on. Tables in which the same classes meet are one bucket. A bucket's
candidates are confirmed on the full sets, as bucket_links tells: no link between components is lost, and pairs inside
one are not formed.

Defined results: without words or text, the set is empty, the document stands alone and is kept. Rows with equal ids
have equal marks if their sets are equal. A NULL id never names a component unless all of its ids are NULL. An empty
table gives no rows. Only doc_id and text are read by ``report``; ``deduplicated`` keeps all columns.
"""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import math
import re
from collections import OrderedDict
from collections.abc import Iterable
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.bucket_links import connected
from stratum.llm.common import WORD, hash64, mapped_rows, numbered, sieved
from stratum.scratch import kept_only, staged

SHINGLE = 3
THRESHOLD_PERCENT = 85
ROWS = 2
BLOCK = 4
#: Sizes of a band's sets lie in so many steps, of which the threshold allows one.
STEPS = 4
#: Chance that two sets at the threshold meet in no table.
MISSED = 7e-6
UPPER = re.compile("[A-Z]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_words: dict[str, int] = {}


@dataclasses.dataclass(frozen=True)
class Settings:
    """Words of a shingle, and from which similarity two sets are linked."""

    shingle: int = SHINGLE
    threshold_percent: int = THRESHOLD_PERCENT

    @functools.cached_property
    def collections(self) -> int:
        agree = (self.threshold_percent / 100) ** ROWS
        missed = (1 - agree) ** BLOCK + BLOCK * agree * (1 - agree) ** (BLOCK - 1)
        return BLOCK * max(1, math.ceil(math.log(MISSED) / math.log(missed)))


@functools.cache
def salts_and_factors(collections: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = np.random.RandomState(20).randint(1, 2**63 - 1, size=(2, collections * ROWS, 1), dtype=np.int64).astype(np.uint64)
    return seeds[0], seeds[1] | np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def word_hash(word: str) -> int:
    found = _words.get(word)
    if found is None:
        if len(_words) > 500_000:
            _words.clear()
        found = _words[word] = hash64(word.encode("utf-8", "surrogatepass")) & 0xFFFFFFFFFFFFFFFF
    return found


def lowered(text: str) -> str:
    """``text`` with A-Z in lower case, and nothing else changed."""
    return text.lower() if text.isascii() else UPPER.sub(lambda m: m[0].lower(), text)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = WORD.findall(lowered(text)) if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(word_hash, words), dtype=np.uint64, count=len(words))
    count = max(1, len(words) - size + 1)
    total = np.full(count, min(len(words), size), dtype=np.uint64)
    for i in range(min(len(words), size)):
        total = mixed(total + hashes[i:i + count])
    return np.unique(total)


def collections_of(values: np.ndarray, collections: int) -> list[int]:
    salts, factors = salts_and_factors(collections)
    least = np.full(collections * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(values), 4096):  # long texts a piece at a time
        part = (values[None, start:start + 4096] ^ salts) * factors
        part ^= part >> np.uint64(31)
        least = np.minimum(least, (part * factors).min(axis=1))
    rows = least.reshape(collections, ROWS)
    value = np.arange(1, collections + 1, dtype=np.uint64)
    for i in range(ROWS):
        value = mixed(value + rows[:, i])
    return value.astype(np.int64).tolist()


def described(doc_id: int | None, text: str | None, settings: Settings) -> tuple:
    values = shingles(text, settings.shingle)
    key = hashlib.md5((text or "").encode("utf-8", "surrogatepass")).hexdigest()
    if not len(values):
        return doc_id, key, 0, None, [], None
    digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
    cells = dict(zip(CELLS, parities(values)))
    return doc_id, key, len(values), digest, collections_of(values, settings.collections), cells


#: Names of the longs that hold the parities.
CELLS = "abcdefgh"
SIGNATURE = ("doc_id long, text_key string, n_shingles long, set_key binary, collections array<long>, "
             f"parities struct<{', '.join(f'{c}: long' for c in CELLS)}>")


def parities(values: np.ndarray) -> tuple[int, ...]:
    """A bit for each of 512 cells that hold an odd number of the hashes.

    Two sets have at least as many hashes that only one of them holds as there are bits that differ.
    """
    odd = np.bincount((values >> np.uint64(40)).astype(np.int64) & 511, minlength=512) & 1
    return tuple(np.packbits(odd.astype(np.uint8)).view(np.int64).tolist())


def classes(signatures: DataFrame) -> DataFrame:
    """(set_key, class_id, class_doc): the distinct sets."""
    return staged(signatures.filter("n_shingles > 0").groupBy("set_key").agg(
        F.min("row_id").alias("class_id"), F.min("doc_id").alias("class_doc")), "classes")


def buckets(representatives: DataFrame, settings: Settings) -> DataFrame:
    """(bucket, class_id, n): classes that meet in a table; tables with equal classes are one bucket."""
    values = staged(representatives.select("class_id", "n", F.posexplode("collections").alias("i", "value")), "values")
    shared = values.groupBy("value").agg(F.count("*").alias("met")).filter("met > 1").select("value")
    # A value nobody shares can be part of no shared key.
    usable = values.join(shared, "value", "left_semi").groupBy("class_id", "n").agg(
        F.sort_array(F.collect_list(F.struct("i", "value"))).alias("v")).filter(F.size("v") > 1)
    pairs = F.expr(f"filter(flatten(transform(v, x -> transform(v, y -> if(x.i < y.i and x.i div {BLOCK} = y.i div {BLOCK}, "
                   "xxhash64(x.i, y.i, x.value, y.value), null)))), k -> k is not null)")
    # Sizes of sets to be linked differ by one step at most; a set within a step of its band's start is in the band before, too.
    step = F.log(F.col("n").cast("double")) / (1.001 * math.log(100 / settings.threshold_percent))
    bands = F.array_distinct(F.array(F.floor(step / STEPS), F.floor((step - 1) / STEPS)))
    keys = usable.select("class_id", "n", F.explode(pairs).alias("key"))
    keys = staged(keys.withColumn("band", F.explode(bands)).select(
        "class_id", "n", F.xxhash64("key", "band").alias("bucket")), "table-keys")
    met = keys.groupBy("bucket").agg(F.count("*").alias("met"), F.sum(F.xxhash64("class_id").cast("decimal(20,0)")).alias("s"),
                                     F.bit_xor(F.xxhash64(F.lit(1), "class_id")).alias("x"))
    chosen = met.filter("met > 1").groupBy("met", "s", "x").agg(F.min("bucket").alias("bucket"))
    return staged(keys.join(chosen.select("bucket"), "bucket", "left_semi"), "buckets")


_sets: OrderedDict[tuple[int, str], np.ndarray] = OrderedDict()
#: Hashes that a worker keeps of the sets it met last.
MOST_KEPT = 2_000_000
_kept = 0


def cached_shingles(text: str, size: int) -> np.ndarray:
    global _kept
    key = size, text
    found = _sets.get(key)
    if found is not None:
        _sets.move_to_end(key)
        return found
    found = shingles(text, size)
    if len(found) < MOST_KEPT // 8:
        _sets[key] = found
        _kept += len(found)
        while _kept > MOST_KEPT:
            _kept -= len(_sets.popitem(last=False)[1])
    return found


def confirmer(settings: Settings):
    def confirmed(a: int, b: int, text_a: str, text_b: str) -> Iterable[tuple]:
        x, y = cached_shingles(text_a, settings.shingle), cached_shingles(text_b, settings.shingle)
        same = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * same >= settings.threshold_percent * (len(x) + len(y) - same):
            yield a, b
    return confirmed


def candidate_texts(docs: DataFrame, representatives: DataFrame, met: DataFrame) -> DataFrame:
    """(class_id, text) of the classes in ``met``."""
    wanted = staged(representatives.join(met.select("class_id").distinct(), "class_id", "left_semi").select(
        "class_id", F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_key")), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("full_text"),
                        F.md5(F.coalesce("text", F.lit(""))).alias("text_key"))
    texts, _ = sieved(texts, F.xxhash64("doc_id", "text_key"), wanted.select(F.xxhash64("of_doc", "of_key")))
    found = texts.join(wanted, (F.col("text_key") == F.col("of_key")) & F.col("doc_id").eqNullSafe(F.col("of_doc")))
    return staged(found.select("class_id", F.col("full_text").alias("text")).dropDuplicates(["class_id"]), "class-texts")


def near(threshold_percent: int):
    """What sizes and parities allow: the smaller set is the largest intersection possible, the larger one the smallest
    union; and of both sizes together, no more than (100 - t) / (100 + t) may be hashes that only one set holds."""
    def condition(n: Column, m: Column) -> Column:
        apart = reduce(add, (F.bit_count(n["parities"][c].bitwiseXOR(m["parities"][c])) for c in CELLS))
        n, m = n["size"], m["size"]
        return (threshold_percent * F.greatest(n, m) <= 100 * F.least(n, m)) & (
            (100 + threshold_percent) * apart <= (100 - threshold_percent) * (n + m))
    return condition


def marked(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The signatures of all rows with component_id."""
    signatures = numbered(mapped_rows(docs.selectExpr("cast(doc_id as long) doc_id", "text"), SIGNATURE,
                                      lambda *row: (described(*row, settings),)), "signatures")
    distinct = classes(signatures)
    representatives = signatures.withColumnsRenamed({"row_id": "class_id", "n_shingles": "n"}).join(
        distinct.select("class_id"), "class_id", "left_semi")
    met = buckets(representatives, settings)
    measured = representatives.select("class_id", F.struct(F.col("n").alias("size"), "parities").alias("measures"))
    met = staged(met.join(measured, "class_id").select("bucket", F.col("class_id").alias("member"), F.col("measures").alias("n")),
                 "measured-buckets")
    texts = candidate_texts(docs, representatives, met.select(F.col("member").alias("class_id")))
    labels = connected(met, texts.withColumnRenamed("class_id", "member"), near(settings.threshold_percent),
                       confirmer(settings)).withColumnRenamed("member", "class_id")
    named = distinct.join(labels, "class_id")
    smallest = named.groupBy("label").agg(F.min("class_doc").alias("component"))
    named = named.select("class_id", "label").join(smallest, "label").select("class_id", "component")
    own = staged(distinct.join(named, "class_id", "left").select(
        F.col("set_key").alias("of_set"), F.coalesce("component", "class_doc").alias("component")), "components")
    return signatures.join(own, F.col("set_key") == F.col("of_set"), "left").select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row."""
    return marked(docs).select("doc_id", "n_shingles", "component_id",
                               F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stand for their component, in its columns."""
    with kept_only(docs.sparkSession) as keep:
        gone = marked(docs, settings).filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
            F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key")).distinct()
        gone = keep(gone, "duplicates")
    key = F.md5(F.coalesce("text", F.lit("")))
    touched, others = sieved(docs, F.xxhash64(F.col("doc_id").cast("long"), key), gone.select(F.xxhash64("__doc", "__key")))
    alike = touched["doc_id"].cast("long").eqNullSafe(F.col("__doc")) & (key == F.col("__key"))
    return touched.join(gone, alike, "left_anti").unionByName(others)
