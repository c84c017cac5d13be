"""A linear-chain conditional random field over word shapes, and its decoding in numpy batches.

The score of a labelling is the sum of a weight for each word's own features, those of the two words before and the one
after it in its line, and each pair of adjacent labels. Training maximises the likelihood of labelled lines (forward-backward sums over all of them at once).

Decoding is Viterbi's, with one exact saving. If a word's score for O beats that of every other label by more than any two
transitions could return, every best labelling has O there (``certain``). What lies between such words is decoded by itself,
all stretches of one length together.
"""

from __future__ import annotations

import dataclasses
import re
from collections import Counter
from collections.abc import Sequence

import numpy as np

#: Stands before and after each line; it always has the label O.
BORDER = "\n"
TOKEN = re.compile(r"\n|[^\x20\x09-\x0D]+")
TRAILING = ",.;:!?"
RUNS = re.compile(r"x{2,}|X{2,}|d{5,}")
LONGEST_SHAPE = 12
DIGITS = frozenset("0123456789")
#: What a word shows: its shape, itself in lower case, its last sign of punctuation, its digits, and whether it has only those.
Signs = tuple[str, str | None, str, int, bool]


def shape(bare: str) -> str:
    """Capitals, digits and other letters by a sign each, runs shortened: "Oak-12" is "Xxx-dd"."""
    if bare.isalpha():
        if bare.islower():
            return "xx" if len(bare) > 1 else "x"
        if bare[1:].islower() and bare[0].isupper():
            return "Xxx" if len(bare) > 2 else "Xx"
    signs = "".join(["d" if c in DIGITS else "X" if c.isupper() else "x" if c.isalpha() else c for c in bare])
    return RUNS.sub(lambda m: m[0][0] * 2 if m[0][0] != "d" else "d+", signs)[:LONGEST_SHAPE]


def signs(word: str) -> Signs:
    word = word[:64]
    bare = word.rstrip(TRAILING)
    end = word[-1] if len(bare) < len(word) else ""
    digits = 0 if bare.isalpha() else sum([c in DIGITS for c in bare])
    return shape(bare), bare.lower(), end, min(digits, 10), digits == len(bare)


def features(found: Signs) -> list[str]:
    of_shape, bare, end, digits, only = found
    if bare == BORDER:
        return ["border"]
    return ["any", f"shape {of_shape}", f"word {bare}", f"end {end}", f"digits {digits} {only}"]


@dataclasses.dataclass(frozen=True)
class Settings:
    #: lines of the labelled table that training sees at most, in the order of a hash of their ids
    labelled: int = 4000
    #: a feature counts if it occurs so often in the labelled lines
    least: int = 3
    epochs: int = 45
    rate: float = 0.2
    #: penalties on the weights of features and of transitions; small transitions leave more words certain
    ridge: float = 0.00003
    ridge_between: float = 0.002
    #: added to the score of O when texts are decoded: what is reported must be likelier than nothing by this much
    caution: float = 2.0


@dataclasses.dataclass
class Tagger:
    labels: tuple[str, ...]  # O is the first
    known: dict[str, int]
    #: weights of a word's own features, and of the features of the word before, of the one before that, and of the next
    own: np.ndarray
    before: np.ndarray
    earlier: np.ndarray
    after: np.ndarray
    between: np.ndarray

    caution: float = 0.0

    def rows(self, found: Signs) -> list[np.ndarray]:
        at = [self.known[f] for f in features(found) if f in self.known]
        rows = [weights[at].sum(axis=0) for weights in (self.own, self.before, self.earlier, self.after)]
        rows[0][0] += self.caution
        return rows

    def slack(self) -> np.ndarray:
        """For each label, what the transitions around a word can add to it over O at the most."""
        t = self.between
        return (t - t[:, :1]).max(axis=0) + (t - t[:1, :]).max(axis=1)


def gradient(scores: np.ndarray, between: np.ndarray, tags: np.ndarray, inside: np.ndarray,
             ) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of ``tags`` (lines x places), and its slopes by ``scores`` (lines x places x labels) and ``between``.

    The first place of a line is a border, which has label 0; places outside (``inside`` is False) are at the end. Chances
    are scaled to sum 1 at each place; the scales' logarithms add up to the sum over all labellings.
    """
    lines, places, n = scores.shape
    top = scores.max(axis=2)
    local, step = np.exp(scores - top[:, :, None]), np.exp(between)
    forward, backward, scale = np.zeros_like(scores), np.ones_like(scores), np.ones((lines, places))
    forward[:, 0, 0] = 1
    for t in range(1, places):
        reached = (forward[:, t - 1] @ step) * local[:, t]
        scale[:, t] = np.where(inside[:, t], reached.sum(axis=1), 1)
        forward[:, t] = np.where(inside[:, t, None], reached / scale[:, t, None], forward[:, t - 1])
    for t in range(places - 2, -1, -1):
        left = ((local[:, t + 1] * backward[:, t + 1]) @ step.T) / scale[:, t + 1, None]
        backward[:, t] = np.where(inside[:, t + 1, None], left, 1)
    total = scores[:, 0, 0].sum() + (np.log(scale) + np.where(inside, top, 0))[:, 1:].sum()
    hot = np.eye(n)[tags] * inside[:, :, None]
    pairs = inside[:, 1:]
    before = (forward[:, :-1] / scale[:, 1:, None])[pairs]
    expected = (before.T @ (local * backward)[:, 1:][pairs]) * step
    seen = np.zeros((n, n))
    np.add.at(seen, (tags[:, :-1][pairs], tags[:, 1:][pairs]), 1)
    likelihood = (scores * hot).sum() + (seen * between).sum() - total
    return float(likelihood), hot - forward * backward * inside[:, :, None], seen - expected


def trained(lines: Sequence[tuple[Sequence[str], Sequence[str]]], labels: tuple[str, ...], settings: Settings = Settings()) -> Tagger:
    """Fit to (words, tags) of lines; words without a known tag count as O."""
    lines = [([BORDER, *words, BORDER], [labels[0], *tags, labels[0]]) for words, tags in lines if len(words) == len(tags)]
    counts = Counter(f for words, _ in lines for word in words for f in features(signs(word)))
    known = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= settings.least))}
    size, n, places = len(known), len(labels), max((len(w) for w, _ in lines), default=0)
    tagger = Tagger(labels, known, *(np.zeros((size, n)) for _ in range(4)), np.zeros((n, n)), settings.caution)
    if not lines:
        return tagger
    number = {label: i for i, label in enumerate(labels)}
    tags, inside = np.zeros((len(lines), places), dtype=np.int64), np.zeros((len(lines), places), dtype=bool)
    where: list[list[tuple[int, int]]] = [[], [], [], []]  # (word's place, feature) in the order of the weights
    for i, (words, names) in enumerate(lines):
        inside[i, :len(words)] = True
        tags[i, :len(words)] = [number.get(name, 0) for name in names]
        for t, word in enumerate(words):
            for f in features(signs(word)):
                if f in known:
                    for kind, to in enumerate((t, t + 1, t + 2, t - 1)):
                        if 0 <= to < len(words):
                            where[kind].append((i * places + to, known[f]))
    order = []
    for pairs in where:
        at = np.array(sorted(pairs, key=lambda p: p[1]), dtype=np.int64).reshape(-1, 2)
        order.append((at[:, 0], at[:, 1], np.searchsorted(at[:, 1], np.arange(size))))

    weights = [tagger.own, tagger.before, tagger.earlier, tagger.after, tagger.between]
    speed, energy = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for epoch in range(1, settings.epochs + 1):
        scores = np.zeros((len(lines) * places, n))
        for w, (place, feature, _) in zip(weights, order):
            for label in range(n):
                scores[:, label] += np.bincount(place, weights=w[feature, label], minlength=len(scores))
        _, by_score, by_pair = gradient(scores.reshape(len(lines), places, n), tagger.between, tags, inside)
        flat = by_score.reshape(-1, n)
        slopes = [np.stack([np.bincount(feature, weights=flat[place, label], minlength=size) for label in range(n)], axis=1)
                  for place, feature, _ in order] + [by_pair]
        penalties = [settings.ridge] * 4 + [settings.ridge_between]
        for w, slope, v, e, penalty in zip(weights, slopes, speed, energy, penalties):  # Adam's steps
            slope = slope / len(lines) - penalty * w
            v += 0.1 * (slope - v)
            e += 0.01 * (slope * slope - e)
            w += settings.rate * (v / (1 - 0.9 ** epoch)) / (np.sqrt(e / (1 - 0.99 ** epoch)) + 1e-8)
    return tagger


def best_paths(scores: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Viterbi for stretches of one length (stretches x places x labels), with an O before and behind each."""
    many, places, _ = scores.shape
    value = scores[:, 0] + between[0]
    back = np.zeros(scores.shape, dtype=np.int8)
    for t in range(1, places):
        step = value[:, :, None] + between
        back[:, t] = step.argmax(axis=1)
        value = step.max(axis=1) + scores[:, t]
    path = np.zeros((many, places), dtype=np.int64)
    path[:, -1] = (value + between[:, 0]).argmax(axis=1)
    for t in range(places - 1, 0, -1):
        path[:, t - 1] = back[np.arange(many), t, path[:, t]]
    return path


class Decoder:
    """Tags words; keeps the scores of words it has met, up to a number."""

    MOST_WORDS = 200_000
    #: characters of a text that are looked at together
    CHUNK = 1 << 20

    def __init__(self, tagger: Tagger):
        self.tagger, self.slack = tagger, tagger.slack()[1:]
        self.kinds: dict[Signs, int] = {}
        self.forget()

    def forget(self) -> None:
        """Words met go; so do the scores of their kinds, if there are many."""
        self.met: dict[str, int] = {}
        if len(self.kinds) > self.MOST_WORDS or not self.kinds:
            self.kinds = {}
            self.tables = [np.empty((1024, len(self.tagger.labels))) for _ in range(4)]
        self.number(BORDER)

    def number(self, word: str) -> int:
        """Words that differ in nothing the tagger knows have one number."""
        found = signs(word)
        if word != BORDER and f"word {found[1]}" not in self.tagger.known:
            found = (found[0], None, *found[2:])
        at = self.kinds.get(found)
        if at is None:
            at = self.kinds[found] = len(self.kinds)
            if at == len(self.tables[0]):
                self.tables = [np.concatenate([table, np.empty_like(table)]) for table in self.tables]
            for table, row in zip(self.tables, self.tagger.rows(found)):
                table[at] = row
        self.met[word] = at
        return at

    def scored(self, words: list[str], starts: bool, ends: bool) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the words, and where O is certain; the context beyond a line's start or end is a border."""
        ids = list(map(self.met.get, words))
        if None in ids:
            ids = [self.number(word) if at is None else at for word, at in zip(words, ids)]
        ids = np.array(ids)
        own, before, earlier, after = self.tables
        scores = own[ids]
        scores[1:] += before[ids[:-1]]
        scores[2:] += earlier[ids[:-2]] * (ids[1:-1] != 0)[:, None]
        scores[:-1] += after[ids[1:]]
        if starts:
            scores[0] += before[0]
            scores[1:2] += earlier[0] * (ids[:1] != 0)
        if ends:
            scores[-1] += after[0]
        certain = (scores[:, :1] - scores[:, 1:] > self.slack).all(axis=1) | (ids == 0)
        return scores, certain

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(label, start, end) in code points for each text."""
        if len(self.met) > self.MOST_WORDS:
            self.forget()
        found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        waiting: dict[int, list] = {}  # by length: (text, offset, chunk, place, scores)
        for i, text in enumerate(texts):
            at, width = 0, self.CHUNK
            while at < len(text):
                end = len(text)
                if end - at > width:
                    gap = re.compile(r"[\x20\x09-\x0D]").search(text, at + width)
                    end = gap.start() if gap else end
                chunk = text if end - at == len(text) else text[at:end]
                words = TOKEN.findall(chunk)
                if not words:
                    break
                scores, certain = self.scored(words, at == 0, end == len(text))
                if at:
                    certain[:2] = True  # where the part before ended
                stop, following = len(words), len(text)
                if end < len(text):  # the last word's neighbour is not here yet: go on from the last two certain words
                    sure = np.flatnonzero(certain[:-2] & certain[1:-1])
                    if not len(sure) or not sure[-1]:
                        width *= 2
                        continue
                    stop = int(sure[-1])
                    following = at + next(m.start() for k, m in enumerate(TOKEN.finditer(chunk)) if k == stop)
                open_ = np.flatnonzero(~certain[:stop])
                if len(open_):
                    edges = np.flatnonzero(np.diff(open_) > 1)
                    firsts, lasts = open_[np.r_[0, edges + 1]], open_[np.r_[edges, len(open_) - 1]]
                    for a, b in zip(firsts.tolist(), lasts.tolist()):
                        waiting.setdefault(b - a + 1, []).append((i, at, chunk, a, scores[a:b + 1]))
                at, width = following, self.CHUNK
        tagged: dict[tuple[int, int], list] = {}
        for stretches in waiting.values():
            paths = best_paths(np.stack([s[4] for s in stretches]), self.tagger.between)
            for k in np.flatnonzero(paths.any(axis=1)).tolist():
                i, offset, chunk, a, _ = stretches[k]
                tagged.setdefault((i, offset), [chunk]).append((a, paths[k].tolist()))
        for (i, offset), (chunk, *parts) in tagged.items():
            places = [m.span() for m in TOKEN.finditer(chunk)]
            for first, path in parts:
                k = 0
                while k < len(path):
                    label, a = path[k], k
                    while k < len(path) and path[k] == label:
                        k += 1
                    if label:
                        start, end = places[first + a][0], places[first + k - 1][1]
                        while end > start + 1 and chunk[end - 1] in TRAILING:
                            end -= 1
                        found[i].append((self.tagger.labels[label], offset + start, offset + end))
        return [sorted(spans, key=lambda s: s[1]) for spans in found]
