"""Personal data: base patterns, and spans that a linear-chain conditional random field tags.

The tagger (``shape_crf``) is trained on the driver from a small labelled table, at most ``Settings.labelled`` lines of
it, and goes to the executors, a few hundred kilobytes. Each text is scanned and decoded in one pass without a shuffle;
a text costs time in proportion to its length, and is looked at in parts of about a million characters.

Kinds in their order: email, ip, card and phone of the base, then name, address, birth, account and contact of the tagger.
A tagged span that overlaps one of the base is left out, all others stand. No tagged span crosses a line.

Defined results: a NULL text counts as an empty one and has no spans. Spans count code points, the end is exclusive.
Repeated rows each get a row; an empty table gives none. Without a labelled line nothing but the base is found. Only doc_id
and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import mapped_slices
from stratum.llm.pii_examples import LABELS
from stratum.llm.shape_crf import Decoder, Settings, Tagger, trained

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + LABELS[1:]

# Fixed patterns. An address is looked for at each @; possessive parts and the test for a digit before an ip only save time.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NOT_DIGITS = re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def emails(text: str) -> Iterable[Span]:
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its test, by kind, then start."""
    found = list(emails(text))
    found += (("ip", *m.span()) for m in IP.finditer(text) if all(map(at_most_255, m[0].split("."))))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGITS.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += (("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGITS.sub("", m[0])) <= 15)
    return found


def apart(tagged: list[Span], base: list[Span]) -> list[Span]:
    """Tagged spans that overlap none of ``base``, by kind, then start."""
    taken = sorted((a, b) for _, a, b in base)
    free, k, reach = [], 0, 0
    for span in sorted(tagged, key=lambda s: s[1]):
        while k < len(taken) and taken[k][0] < span[2]:
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= span[1]:
            free.append(span)
    return sorted(free, key=lambda s: (KINDS.index(s[0]), s[1]))


def fitted(examples: DataFrame, settings: Settings = Settings()) -> Tagger:
    """A tagger from (line_id, words, tags); beyond the bound those lines count whose ids' hashes are smallest."""
    usable = examples.filter("words is not null and tags is not null").select(
        "words", "tags", F.xxhash64("line_id").alias("rank"))
    total = usable.count()
    if total > settings.labelled:  # so that few more lines than the bound are ordered
        cut = -2 ** 63 + min(2 ** 64 - 1, 2 ** 64 * 2 * settings.labelled // total)
        usable = usable.filter(F.col("rank") <= cut)
    lines = usable.orderBy("rank", "words", "tags").limit(settings.labelled).collect()  # at most Settings.labelled
    return trained([([w or "" for w in r.words], [t or "O" for t in r.tags]) for r in lines], LABELS, settings)


def found(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """(doc_id, base, tagged): spans of each row as arrays of structs."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # bounded by the labelled lines
    decoders: list[Decoder] = []

    def scanned(columns: list[list]) -> Iterable[tuple]:
        if not decoders:
            decoders.append(Decoder(shared.value))
        ids, texts = columns[0], [text or "" for text in columns[1]]
        for doc_id, text, tagged in zip(ids, texts, decoders[0].spans(texts)):
            base = base_spans(text)
            yield doc_id, as_structs(base), as_structs(apart(tagged, base))

    one = "array<struct<kind: string, start: long, end: long>>"
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return mapped_slices(narrow, f"doc_id long, base {one}, tagged {one}", scanned)


def as_structs(spans: list[Span]) -> list[dict]:
    return [{"kind": kind, "start": start, "end": end} for kind, start, end in spans]


def report(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """A row for each document: base counts, the digest of the base spans, and all spans."""
    def text(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found(docs, tagger).select(
        "doc_id", *map(number, BASE_KINDS),
        F.sha2(text("base"), 256).alias("base_sha256"),
        F.concat_ws(",", *(F.when(F.size(c) > 0, text(c)) for c in ("base", "tagged"))).alias("spans"),
        F.size("tagged").cast("long").alias("n_tagged"))


def redacted(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; columns and rows stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    decoders: list[Decoder] = []
    place = docs.columns.index("text")

    def cleaned(columns: list[list]) -> Iterable[tuple]:
        if not decoders:
            decoders.append(Decoder(shared.value))
        for row, tagged in zip(zip(*columns), decoders[0].spans([text or "" for text in columns[place]])):
            text = row[place]
            base = base_spans(text or "")
            parts, free = [], 0
            for kind, start, end in sorted(base + apart(tagged, base), key=lambda s: (s[1], -s[2])):
                if start >= free:
                    parts += [text[free:start], f"[{kind}]"]
                free = max(free, end)
            yield tuple("".join(parts) + value[free:] if k == place and parts else value for k, value in enumerate(row))

    return mapped_slices(docs, docs.schema, cleaned)
