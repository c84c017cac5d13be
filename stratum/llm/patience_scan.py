"""License scans by patience alignment.

A template is aligned with a stretch of a text: words that occur once in both are anchors, the longest run of anchors
in the same order is kept, and the gaps between them, in which more words occur once, are aligned the same way. The
share of the template's words that find a partner is the coverage. Stretches are taken around each place of the
template's keys, its rarest words and so many of them that no copy of the least coverage is without one. They end at
matches found before. Among adjacent copies a wide stretch has every word several times; stretches of about the
template's length at the key's place in the template are aligned as well then, and the best coverage counts.

Defined results: a NULL text counts as an empty one and has no matches. Any length of text is scanned whole. Repeated
rows each get a row; an empty table gives none. Only doc_id and text are read.
"""

from __future__ import annotations

import bisect
import dataclasses
import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame

from stratum.llm.common import mapped_rows
from stratum.llm.license_templates import TEMPLATES

TOKEN = re.compile(r"[^\W_]+")
LEAST_COVERAGE = 0.8
#: Words a stretch has around its key, per word of the template.
REACH = 1.5
#: Keys of a template at least: its rarest words among all templates.
KEYS = 3
#: Words a narrow stretch has at both ends beside the template's length, as parts of the template and a constant.
SLACKS = ((4, 2), (16, 1), (None, 0))


@dataclasses.dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    #: the places of each key in the template
    keys: dict[str, tuple[int, ...]]


def templates(texts: dict[str, str], least: float = LEAST_COVERAGE) -> list[Template]:
    words = {name: tuple(TOKEN.findall(text.lower())) for name, text in texts.items()}
    common = Counter(w for own in words.values() for w in set(own))
    found = []
    for name, own in words.items():
        if not own:
            continue
        keys: dict[str, tuple[int, ...]] = {}
        # A copy can lack (1 - least) of the words; the keys are more than that.
        needed = int(len(own) * (1 - least) + 1e-9) + 1
        for word in sorted(set(own), key=lambda w: (common[w], -len(w), w)):
            if len(keys) >= KEYS and sum(map(len, keys.values())) >= needed:
                break
            keys[word] = tuple(i for i, w in enumerate(own) if w == word)
        found.append(Template(name, own, keys))
    return found


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by piles of cards."""
    tops: list[int] = []
    places: list[int] = []
    back: list[int] = []
    for i, value in enumerate(values):
        pile = bisect.bisect_left(tops, value)
        back.append(places[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            places.append(i)
        else:
            tops[pile], places[pile] = value, i
    found, at = [], places[-1] if places else -1
    while at >= 0:
        found.append(at)
        at = back[at]
    return found[::-1]


def aligned(a: list[str] | tuple[str, ...], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, in order."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = [(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place]
        if not anchors:
            # Words that repeat inside a gap: equal ends still belong together.
            while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
                pairs.append((a0, b0))
                a0, b0 = a0 + 1, b0 + 1
            while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
                a1, b1 = a1 - 1, b1 - 1
                pairs.append((a1, b1))
            continue
        kept = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
        pairs += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(pairs)


def matches(text: str, known: list[Template], least: float = LEAST_COVERAGE) -> list[tuple[str, int, int, float]]:
    """(license, start, end, coverage) of each match, in code points; of overlapping ones the longest template's."""
    found = list(TOKEN.finditer(text.lower())) if text else []
    words = [m[0] for m in found]
    at: dict[str, list[int]] = {}
    keys = frozenset().union(*(t.keys for t in known)) if known else frozenset()
    for i, word in enumerate(words):
        if word in keys:
            at.setdefault(word, []).append(i)
    taken: list[tuple[str, int, int, float]] = []
    covered = bytearray(len(words))
    for template in sorted(known, key=lambda t: -len(t.words)):
        size = len(template.words)
        for place in sorted(i for key in template.keys for i in at.get(key, ())):
            # A match beside the place is taken too; the place is then tried again without it.
            while not covered[place]:
                pairs = best_pairs(template, words, place, covered, least)
                if len(pairs) / size < least:
                    break
                first, last = pairs[0][1], pairs[-1][1]
                taken.append((template.name, found[first].start(), found[last].end(), round(len(pairs) / size, 4)))
                covered[first:last + 1] = b"\x01" * (last + 1 - first)
    return sorted(taken, key=lambda m: (m[1], m[0]))


def best_pairs(template: Template, words: list[str], place: int, covered: bytearray, least: float) -> list[tuple[int, int]]:
    """The pairs of most coverage among the stretches around ``place``; none if no stretch has enough words."""
    size, wanted = len(template.words), Counter(template.words)
    reach = int(size * REACH) + 2
    low = covered.rfind(b"\x01", max(0, place - reach), place) + 1 or max(0, place - reach)
    high = covered.find(b"\x01", place, place + reach)
    high = min(len(words), place + reach) if high < 0 else high
    stretches = [(low, high)]
    for offset in template.keys[words[place]]:
        for part, more in SLACKS:
            slack = (size // part if part else 0) + more
            stretches.append((max(low, place - offset - slack), min(high, place - offset + size + slack)))
    best: list[tuple[int, int]] = []
    for start, end in stretches:
        if (Counter(words[start:end]) & wanted).total() < least * size:
            if (start, end) == (low, high):
                return best  # the others are parts of this one
            continue
        pairs = nearest(aligned(template.words, words[start:end]), size)
        if len(pairs) >= least * size and (not best or worth(pairs, size) > worth(best, size)):
            best = [(i, start + j) for i, j in pairs]
        if len(best) == size:
            break
    return best


def worth(pairs: list[tuple[int, int]], size: int) -> tuple[int, int]:
    """Pairs, less the words by which they reach beyond the template's length into what may be the next copy."""
    span = pairs[-1][1] - pairs[0][1] + 1
    return len(pairs) - max(0, span - size), -span


def nearest(pairs: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Without stray pairs: the largest run whose neighbours are at most a quarter of the template apart."""
    gap = max(3, size // 4)
    run: list[tuple[int, int]] = []
    best: list[tuple[int, int]] = []
    for pair in pairs:
        if run and pair[1] - run[-1][1] > gap:
            best, run = max(best, run, key=len), []
        run.append(pair)
    return max(best, run, key=len)


def report(docs: DataFrame, texts: dict[str, str] | None = None, least: float = LEAST_COVERAGE) -> DataFrame:
    """Of each row: matches, the best one with its coverage, and all with their places."""
    known = templates(TEMPLATES if texts is None else texts, least)

    def scanned(doc_id: int | None, text: str | None) -> Iterable[tuple]:
        found = matches(text or "", known, least)
        best = max(found, key=lambda m: (m[3], m[2] - m[1]), default=(None, 0, 0, 0.0))
        yield doc_id, len(found), best[0], best[3], ",".join(f"{name}:{a}:{b}" for name, a, b, _ in found)

    return mapped_rows(docs.selectExpr("cast(doc_id as long) doc_id", "text"),
                       "doc_id long, n_licenses long, license string, coverage double, spans string", scanned)
