"""A quality classifier by co-training.

Two logistic models look at a document: one at figures of its text, one at its metadata (source, language, length).
They start from the same labelled documents. In each round, each model labels those documents of a pool that it is
most sure of, and hands them to the other one for training. Held-out labelled documents calibrate both scores and
weigh them; the combined score is given to every document.

The models are fitted on the driver: on at most ``Settings.labelled`` labelled documents and a pool of at most
``Settings.pool`` others, both taken in the order of a hash of the id. Everything else, the figures and the scores,
covers all documents and runs on the executors.

Defined results: a NULL text counts as an empty one; NULL metadata are a value of their own. Labels that are NULL are
left out. Without labels of both kinds every document gets the score 0.5 and is kept. Repeated rows each get a row; an
empty table gives none.
"""

from __future__ import annotations

import dataclasses
import math
from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import WORD, hash64, mapped_rows, mapped_slices
from stratum.scratch import staged

SOURCES, LANGUAGES = 48, 12


@dataclasses.dataclass(frozen=True)
class Settings:
    labelled: int = 20_000
    pool: int = 20_000
    rounds: int = 4
    #: documents handed over per class, model and round, and the certainty they need
    handed: int = 400
    certainty: float = 0.97
    #: one labelled document in so many is held out for calibration
    held_out: int = 5
    kept_from: float = 0.5


def text_figures(text: str) -> list[float]:
    words = WORD.findall(text)
    n, chars = max(1, len(words)), max(1, len(text))
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    lines = [x for x in text.split("\n") if x.strip()]
    adjacent = sum(a == b for a, b in zip(words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    ends = sum(x.rstrip()[-1:] in ".!?" for x in lines)
    return [
        math.log1p(len(words)), float(lengths.mean()), float(lengths.std()), len(counts) / n,
        max(counts.values(), default=0) / n, adjacent / n, pairs / n, sum(map(str.isupper, words)) / n,
        sum(map(str.isupper, text)) / chars, sum(map(str.isdigit, text)) / chars,
        sum(map(text.count, "#*$%&<>")) / n, text.count("|") / n, text.count("!") / n, text.count(".") / n,
        text.count(",") / n, float((lengths <= 3).mean()), float((lengths >= 12).mean()), math.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)), ends / max(1, len(lines)), len(words) / max(1, len(lines)) / 100,
    ]


def metadata_figures(source: str | None, lang: str | None, chars: int | None) -> list[float]:
    found = [0.0] * (SOURCES + LANGUAGES + 2)
    found[hash64(f"s{source}".encode("utf-8", "surrogatepass")) % SOURCES] = 1.0
    found[SOURCES + hash64(f"l{lang}".encode("utf-8", "surrogatepass")) % LANGUAGES] = 1.0
    found[-2], found[-1] = math.log1p(max(0, chars or 0)), float(chars is None)
    return found


class Logistic:
    """Ridge logistic regression on scaled columns, by Newton's steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._scaled(x)
        self.weights = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            slope = z.T @ (y - p) - penalty * self.weights
            bend = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(bend, slope)
            self.weights += step
            if np.abs(step).max() < 1e-6:
                break

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._scaled(x) @ self.weights, -30, 30)


def chance(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-score))


@dataclasses.dataclass
class Model:
    """The models of the two views, their calibrations, and how the calibrated scores are combined."""

    views: list[Logistic]
    calibrations: list[Logistic]
    combination: Logistic

    def chances(self, text: np.ndarray, metadata: np.ndarray) -> list[np.ndarray]:
        scores = [c.score(v.score(x)[:, None]) for v, c, x in zip(self.views, self.calibrations, (text, metadata))]
        return [*map(chance, scores), chance(self.combination.score(np.stack(scores, axis=1)))]


def trained(views: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray], settings: Settings) -> Model | None:
    """``views``: the labelled documents' figures for both models; ``pool``: the same of documents without labels."""
    held = np.arange(len(y)) % settings.held_out == 0
    if not all(len(np.unique(y[part])) == 2 for part in (held, ~held)):
        return None
    train = [[x[~held]] for x in views]
    labels = [[y[~held]], [y[~held]]]
    free = np.ones(len(pool[0]), dtype=bool)

    def fitted() -> list[Logistic]:
        return [Logistic(np.concatenate(x), np.concatenate(t)) for x, t in zip(train, labels)]

    for _ in range(settings.rounds):
        models = fitted()
        handed = False
        for own, other in ((0, 1), (1, 0)):
            p = chance(models[own].score(pool[own])) if len(free) else np.empty(0)
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                best = np.argsort(-np.where(free, sure, -1), kind="stable")[:settings.handed]
                best = best[free[best] & (sure[best] >= settings.certainty)]
                if len(best):
                    train[other].append(pool[other][best])
                    labels[other].append(np.full(len(best), label))
                    free[best] = False
                    handed = True
        if not handed:
            break
    models = fitted()
    scores = [m.score(x[held]) for m, x in zip(models, views)]
    calibrations = [Logistic(s[:, None], y[held]) for s in scores]
    calibrated = np.stack([c.score(s[:, None]) for c, s in zip(calibrations, scores)], axis=1)
    return Model(models, calibrations, Logistic(calibrated, y[held]))


FIGURES = "doc_id long, text_view array<float>, metadata_view array<float>"


def figures(docs: DataFrame) -> DataFrame:
    def described(doc_id, text, source, lang) -> Iterable[tuple]:
        text = text or ""
        yield doc_id, text_figures(text), metadata_figures(source, lang, len(text))

    narrow = docs.selectExpr("cast(doc_id as long) doc_id", "text", "source", "lang")
    return staged(mapped_rows(narrow, FIGURES, described), "figures")


def lowest(rows: DataFrame, n: int, *more: str) -> list[tuple]:
    """Views and quality of the ``n`` rows whose ids have the smallest hashes, ordered by these, then ``more``.

    Rows are counted first, and only those below a cut among the hashes are ordered, about two for each that is wanted:
    what the driver gets from all partitions together depends on ``n`` alone.
    """
    ranked = rows.select(F.xxhash64("doc_id").alias("rank"), "text_view", "metadata_view", "quality")
    total, wanted = ranked.count(), 2 * n
    while wanted < total:
        cut = wanted * 2 ** 64 // total - 2 ** 63
        found = ranked.filter(F.col("rank") < cut).orderBy("rank", *more).limit(n).collect()
        if len(found) == n:  # else ids repeat and few hashes are small
            return [r[1:] for r in found]
        wanted *= 4
    return [r[1:] for r in ranked.orderBy("rank", *more).limit(n).collect()]


def scored(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The chance of good quality of each row, by both views and combined, and whether it is kept."""
    every = figures(docs)
    known = labels.select(F.col("doc_id").cast("long").alias("of_doc"), F.col("quality").cast("double").alias("quality"))
    known = known.filter(F.col("of_doc").isNotNull() & F.col("quality").isNotNull())
    sample = lowest(every.join(known, F.col("doc_id") == F.col("of_doc")), settings.labelled, "quality")
    pool = lowest(every.join(known, F.col("doc_id") == F.col("of_doc"), "left_anti").withColumn("quality", F.lit(None)),
                  settings.pool)
    model = None
    if sample:
        views = [np.array([row[i] for row in sample], dtype=np.float64) for i in range(2)]
        others = [np.array([row[i] for row in pool], dtype=np.float64).reshape(len(pool), views[i].shape[1])
                  for i in range(2)]
        model = trained(views, np.array([float(row[2] > 0.5) for row in sample]), others, settings)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def judged(columns: list[list]) -> Iterable[tuple]:
        ids, text, metadata = columns
        if shared.value is None:
            return [(i, 0.5, 0.5, 0.5, True) for i in ids]
        chances = shared.value.chances(np.array(text, dtype=np.float64), np.array(metadata, dtype=np.float64))
        return [(i, a, b, c, c >= settings.kept_from) for i, a, b, c in zip(ids, *(x.tolist() for x in chances))]

    return mapped_slices(every, "doc_id long, p_text double, p_metadata double, score double, kept boolean", judged)
