"""Benchmark decontamination with a distributed positional inverted index.

The index holds the postings (document, position) of every word that the benchmark uses. A window of a benchmark
item is looked up from its rarest word: its postings, shifted by the word's offset, give possible starts; those of
the second rarest word, shifted likewise, are intersected with them; what is left is confirmed word by word.
Everything is DataFrame operations. A side is broadcast only where Spark finds its written size below its limit.

Defined results: a NULL text (document or item) has no words; such a document has no hits, such an item no windows.
A NULL item id counts in n_items and is left out of the list of ids. Repeated documents each get a row, repeated
items each count. An item shorter than a window is one window. Empty tables give no rows, or rows without hits.
Only doc_id, text, item_id are read, so other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratum.scratch import staged

#: Fixed pattern: a word is a run of anything but ASCII characters that are no digits or letters (text in lower case).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20


def words_of(text: str) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def digest_of(text: str) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def test_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window_id, item, item_id, length, words) of each ``size`` consecutive words of an item."""
    items = benchmark.select("item_id", words_of("text").alias("all_words")).filter(F.size("all_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all_words") - (size - 1), F.lit(1)))
    windows = (
        items.withColumn("item", F.monotonically_increasing_id())
        .withColumn("start", F.explode(starts))
        .select("item", "item_id", F.slice("all_words", F.col("start"), F.lit(size)).alias("words"))
        .withColumn("length", F.size("words")).withColumn("window_id", F.monotonically_increasing_id())
    )
    return staged(windows, "test-windows")


def index(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Postings (row_id, pos, word) of the windows' words, and a row for each document's first position.

    The latter holds doc_id, n_words and the digest of the text (NULL in other rows).
    """
    vocabulary = staged(windows.select(F.explode("words").alias("term")).distinct(), "test-terms")
    texts = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
        digest_of("text").alias("digest"), words_of("text").alias("words"))
    postings = texts.select("row_id", "doc_id", "digest", F.size("words").alias("n_words"),
                            F.posexplode_outer("words").alias("pos", "word"))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    found = (
        postings.join(vocabulary, F.col("word") == F.col("term"), "left")
        .filter(F.col("term").isNotNull() | first)
        .select("row_id", F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("digest")).alias("digest"),
                F.greatest("n_words", F.lit(0)).cast("long").alias("n_words"), first.alias("first"), "pos",
                F.col("term").alias("word"))
    )
    return staged(found, "postings")


def ranked_terms(windows: DataFrame, postings: DataFrame) -> DataFrame:
    """(window_id, length, offset, term, rank): each window's terms, the rarest of the training data first.

    Windows with a word that the training data never uses are left out.
    """
    frequency = (postings.filter(F.col("word").isNotNull()).groupBy("word").agg(F.count("*").alias("postings"))
                 .withColumnRenamed("word", "known"))
    terms = windows.select("window_id", "length", F.posexplode("words").alias("offset", "term"))
    by_window = W.partitionBy("window_id")
    ranked = (
        terms.join(frequency, F.col("term") == F.col("known"))
        .withColumn("rank", F.row_number().over(by_window.orderBy("postings", "offset")))
        .withColumn("known_terms", F.count("*").over(by_window))
        .filter(F.col("known_terms") == F.col("length"))
    )
    return staged(ranked.select("window_id", "length", "offset", "term", "rank"), "ranked-terms")


def possible_starts(postings: DataFrame, ranked: DataFrame, rank: int) -> DataFrame:
    terms = ranked.filter(F.col("rank") == rank).select("window_id", "length", "offset", "term")
    start = F.col("pos") - F.col("offset")
    return (
        postings.select("row_id", "n_words", "pos", "word").join(terms, F.col("word") == F.col("term"))
        .filter((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .select("row_id", "window_id", "length", start.alias("start"))
    )


def phrase_matches(postings: DataFrame, windows: DataFrame, ranked: DataFrame) -> DataFrame:
    """(row_id, window_id, start, length) of each exact occurrence of a window."""
    rarest, second = possible_starts(postings, ranked, 1), possible_starts(postings, ranked, 2)
    keys = ["row_id", "window_id", "start"]
    both = rarest.filter(F.col("length") > 1).join(second.select(keys), keys, "left_semi")
    open_starts = staged(both.unionByName(rarest.filter(F.col("length") == 1)).select(*keys, "length"), "starts")
    wanted = open_starts.join(windows.select("window_id", "words"), "window_id").select(
        *keys, "length", F.posexplode("words").alias("offset", "term"))
    rows = staged(open_starts.select("row_id").distinct(), "start-rows")
    there = postings.filter(F.col("word").isNotNull()).select("row_id", "pos", "word").join(rows, "row_id", "left_semi")
    there = there.withColumnsRenamed({"row_id": "of_row"})
    met = wanted.join(there, (F.col("row_id") == F.col("of_row")) & (F.col("pos") == F.col("start") + F.col("offset"))
                      & (F.col("word") == F.col("term")))
    return met.groupBy(*keys, "length").agg(F.count("*").alias("met")).filter(F.col("met") == F.col("length")).drop("met")


def proximity_matches(postings: DataFrame, windows: DataFrame, ranked: DataFrame, terms: int = 3,
                      slop: int = 50) -> DataFrame:
    """(row_id, window_id, pos): the window's rarest term with its next rarest ones at most ``slop`` words away."""
    wanted = ranked.filter(F.col("rank") <= terms).select("window_id", "term", "rank")
    found = postings.join(wanted, F.col("word") == F.col("term")).select("row_id", "window_id", "rank", "pos")
    part = F.floor(F.col("pos") / slop)
    centres = found.filter("rank = 1").select(
        "row_id", "window_id", F.col("pos").alias("centre"), F.explode(F.array(part - 1, part, part + 1)).alias("part"))
    others = found.filter("rank > 1").withColumn("part", part)
    near = centres.join(others, ["row_id", "window_id", "part"]).filter(F.abs(F.col("pos") - F.col("centre")) <= slop)
    needed = ranked.groupBy("window_id").agg((F.least(F.max("rank"), F.lit(terms)) - 1).alias("needed"))
    return (
        near.groupBy("row_id", "window_id", "centre").agg(F.count_distinct("rank").alias("near"))
        .join(needed, "window_id").filter("near = needed").select("row_id", "window_id", F.col("centre").alias("pos"))
    )


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """A row for each document: its words, hit words, items met, and whether it is contaminated."""
    windows = test_windows(benchmark, size)
    postings = index(docs, windows)
    matches = staged(phrase_matches(postings, windows, ranked_terms(windows, postings)), "matches")
    spans = matches.groupBy("row_id", "start").agg(F.max("length").alias("length"))
    end = F.col("start") + F.col("length")
    before = F.max(end).over(W.partitionBy("row_id").orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    hits = (
        spans.withColumn("before", F.coalesce(before, F.lit(0)))
        .groupBy("row_id").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "before"))).alias("hit"))
    )
    items = (
        matches.select("row_id", "window_id").distinct().join(windows.select("window_id", "item", "item_id"), "window_id")
        .select("row_id", "item", "item_id").distinct()
        .groupBy("row_id").agg(F.count("*").alias("items"),
                               F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    n_hit = F.coalesce("hit", F.lit(0))
    return (
        postings.filter("first").select("row_id", "doc_id", "digest", "n_words")
        .join(hits, "row_id", "left").join(items, "row_id", "left")
        .select(
            "doc_id", "digest", "n_words", n_hit.cast("long").alias("n_hit"),
            F.coalesce("items", F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.concat_ws(",", "item_ids"), F.lit("")), 256).alias("items_sha256"),
            ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"))
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, in its columns."""
    found = report(docs, benchmark).filter("contaminated").select(F.col("digest").alias("__digest")).distinct()
    found = staged(found, "contaminated")
    return docs.join(found, digest_of("text") == F.col("__digest"), "left_anti")
