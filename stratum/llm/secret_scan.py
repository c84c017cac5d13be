"""Secret scans: base patterns, and strings that pass a battery of randomness tests.

Candidates for the battery are maximal runs of token characters. Each gets the encoding with the smallest alphabet
that holds it, and is tested in that alphabet for uniform use of its symbols (chi-squared), for the number of runs
below and above the alphabet's middle, and for serial correlation. The three p-values are combined by Fisher's method.
A low one says: not random. Which ones are low is decided within strata of encoding and length, as short strings have
less evidence, by the step-up rule for the rate of false discoveries; p-values are counted in narrow intervals for
that, so nothing is ordered as a whole. What is left, and is long enough for its alphabet to be judged, is reported.

Everything is DataFrame operations.

Defined results: a NULL text counts as an empty one and has no spans. Spans count code points, the end is exclusive.
Repeated rows each get a row; an empty table gives none. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratum.scratch import staged

# Fixed patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # 16 or more characters
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8
#: Runs that the battery judges.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Alphabets in the order of their symbols, and the least length to judge a string in each.
ENCODINGS = {
    "hex": ("0123456789abcdef", r"^[0-9a-f]+$", 24),
    "upper_hex": ("0123456789ABCDEF", r"^[0-9A-F]+$", 24),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", r"^[A-Z2-7]+$", 24),
    "alphanumeric": ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", r"^[0-9A-Za-z]+$", 20),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_", r"", 20),
}
KINDS = ("assign", "access", "hex", "random")
FALSE_DISCOVERIES = 0.05
#: Intervals of -ln(p) per unit, and the largest value told apart.
FINE, DEEPEST = 8, 40.0


def located(text: Column, kind: str, pattern: str) -> Column:
    """A struct of the kind, the lengths between matches, and the matches; NULL without a match."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    return F.when(text.rlike(pattern), F.struct(
        F.lit(kind).alias("kind"), F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(
            text, F.lit(pattern), F.lit(0)).alias("match")).alias("parts")))


def scanned(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, found) of every row, written once: the texts are read in one pass."""
    text = F.coalesce("text", F.lit(""))
    found = F.array(*(located(text, kind, pattern) for kind, pattern in
                      zip(KINDS, (ASSIGN, ACCESS, HEX, CANDIDATE))))
    return staged(docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
        F.filter(found, lambda x: x.isNotNull()).alias("found")), "secret-matches")


def spans(found: DataFrame) -> DataFrame:
    """(row_id, kind, start, end, match): matches with their places."""
    parts = found.select("row_id", F.inline("found")).select("row_id", "kind", F.posexplode("parts").alias("at", "part"))
    match = F.coalesce("part.match", F.lit(""))
    end = F.sum(F.col("part.gap") + F.length(match)).over(W.partitionBy("row_id", "kind").orderBy("at"))
    placed = parts.select("row_id", "kind", match.alias("match"), end.cast("long").alias("end")).filter("match != ''")
    value = F.regexp_extract("match", ASSIGN, 1)
    return (
        placed.filter((F.col("kind") != "assign") | (F.length(value) >= LEAST_VALUE))
        .select("row_id", "kind", (F.col("end") - F.length("match")).alias("start"), "end", "match")
    )


def upper_tail(z: Column) -> Column:
    """Chance that a standard normal value is above ``z``."""
    x = F.abs(z) / 2 ** 0.5
    t = 1 / (1 + 0.3275911 * x)
    # The coefficients of formula 7.1.26 in Abramowitz and Stegun's handbook.
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = F.greatest(series * F.exp(-x * x) / 2, F.lit(1e-18))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda sum_, x: sum_ + x)


def battery(candidates: DataFrame) -> DataFrame:
    """``candidates`` (match) with encoding, n, long_enough and p: the combined p-value of randomness."""
    encoding = F.lit("base64")
    for name, (_, pattern, _) in reversed(ENCODINGS.items()):
        if pattern:
            encoding = F.when(F.col("body").rlike(pattern), name).otherwise(encoding)
    symbols = F.create_map(*(F.lit(x) for name, (alphabet, _, _) in ENCODINGS.items() for x in (name, alphabet)))
    least = F.create_map(*(F.lit(x) for name, (_, _, length) in ENCODINGS.items() for x in (name, length)))
    described = (
        candidates.withColumn("body", F.rtrim(F.col("match"), F.lit("="))).filter(F.length("body") > 1)
        .withColumn("encoding", encoding).withColumn("alphabet", symbols[F.col("encoding")])
        .withColumn("n", F.length("body").cast("double")).withColumn("k", F.length("alphabet").cast("double"))
        .withColumn("long_enough", F.col("n") >= least[F.col("encoding")])
        .withColumn("values", F.transform(F.split("body", ""), lambda c: F.call_function(
            "locate", c, F.col("alphabet")).cast("double") - 0.5))
    )
    n, k = F.col("n"), F.col("k")
    squares = total(F.transform(F.array_distinct("values"), lambda v: F.pow(
        F.size(F.filter("values", lambda w: w == v)).cast("double"), F.lit(2.0))))
    freedom = k - 1
    uneven = (squares * k / n - n) / freedom
    # The cube root of a chi-squared value over its freedom is nearly normal (Wilson and Hilferty).
    spread = 2 / (9 * freedom)
    uniform = upper_tail((F.cbrt(F.greatest(uneven, F.lit(0.0))) - (1 - spread)) / F.sqrt(spread))
    pairs = F.arrays_zip(F.slice(F.col("values"), F.lit(1), F.size("values") - 1).alias("a"),
                         F.slice(F.col("values"), F.lit(2), F.size("values") - 1).alias("b"))
    high = total(F.transform("values", lambda v: F.when(v > k / 2, 1.0).otherwise(0.0)))
    runs = 1 + total(F.transform(pairs, lambda p: F.when((p["a"] > k / 2) != (p["b"] > k / 2), 1.0).otherwise(0.0)))
    expected = 2 * F.col("high") * (n - F.col("high")) / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    run_z = F.when(variance > 0, (F.col("runs") - expected) / F.sqrt(F.greatest(variance, F.lit(1e-9)))).otherwise(
        F.lit(8.0))
    mean = F.col("mean")
    around = total(F.transform("values", lambda v: (v - mean) * (v - mean)))
    along = total(F.transform(pairs, lambda p: (p["a"] - mean) * (p["b"] - mean)))
    serial_z = F.when(F.col("around") > 0, F.col("along") / F.greatest(F.col("around"), F.lit(1e-9)) * F.sqrt(n)).otherwise(
        F.lit(8.0))
    half = -F.log(F.col("p_uniform")) - F.log(F.col("p_runs")) - F.log(F.col("p_serial"))
    return (
        described.withColumns({"mean": total(F.col("values")) / n, "p_uniform": uniform, "high": high, "runs": runs})
        .withColumns({"around": around, "along": along})
        .withColumns({"p_runs": 2 * upper_tail(F.abs(run_z)), "p_serial": 2 * upper_tail(F.abs(serial_z))})
        .withColumn("half", half)
        .withColumn("p", F.exp(-F.col("half")) * (1 + F.col("half") + F.col("half") * F.col("half") / 2))
        .select(*candidates.columns, "encoding", "n", "long_enough", "p")
    )


def random_spans(judged: DataFrame) -> DataFrame:
    """Those whose randomness is not rejected at the false-discovery rate within their stratum."""
    depth = F.least(-F.log(F.greatest("p", F.lit(1e-300))), F.lit(DEEPEST))
    judged = judged.withColumns({"length_class": F.floor(F.log2("n") * 2), "interval": F.floor(depth * FINE)})
    stratum = ["encoding", "length_class"]
    counts = staged(judged.groupBy(*stratum, "interval").agg(F.count("*").alias("strings")), "p-values")
    deeper = F.sum("strings").over(W.partitionBy(*stratum).orderBy(F.desc("interval")))
    tested = F.sum("strings").over(W.partitionBy(*stratum))
    # An interval counts at its largest p-value, so the rate is kept.
    rejected = F.exp(-F.col("interval") / FINE) <= FALSE_DISCOVERIES * F.col("deeper") / F.col("tested")
    limits = (
        counts.withColumns({"deeper": deeper, "tested": tested}).filter(rejected)
        .groupBy(*stratum).agg(F.min("interval").alias("limit"))
    )
    return judged.join(limits, stratum, "left").filter(
        F.col("long_enough") & (F.col("limit").isNull() | (F.col("interval") < F.col("limit"))))


def joined(list_: Column) -> Column:
    return F.array_join(F.transform(list_, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """A row for each document: base counts, digest of the base spans, and all spans."""
    found = scanned(docs)
    placed = staged(spans(found), "secret-spans")
    base = placed.filter("kind != 'random'")
    judged = staged(battery(placed.filter("kind = 'random'")), "randomness")
    columns = ["row_id", "kind", "start", "end"]
    every = base.select(*columns).unionByName(random_spans(judged).select(*columns))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    lists = (
        every.withColumn("rank", rank).groupBy("row_id")
        .agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("list"),
             *(F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in KINDS))
    )
    base_list = F.filter("list", lambda s: s["kind"] != "random")
    return found.select("row_id", "doc_id").join(lists, "row_id", "left").select(
        "doc_id", *(F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.coalesce(joined(base_list), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined(F.col("list")), F.lit("")).alias("spans"))
