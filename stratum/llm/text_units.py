"""Units of a text: runs of windows that one content-chosen anchor stands for."""

from __future__ import annotations

import numpy as np

WINDOW = 200
#: Length of an anchor in bytes; a window holds WINDOW - ANCHOR + 1 possible ones.
ANCHOR = 40
SPAN = WINDOW - ANCHOR + 1
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.RandomState(6).randint(1, 2**63 - 1, size=256, dtype=np.int64).astype(np.uint64)
_POWERS = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _powers(kind: str, size: int) -> np.ndarray:
    known = _POWERS[kind]
    while len(known) < size:
        step = np.uint64(pow(_BASE if kind == "up" else _INVERSE, len(known), 1 << 64))
        known = np.concatenate([known, known * step])
    if len(known) <= 1 << 22:  # longer tables are not kept
        _POWERS[kind] = known
    return known[:size]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


class Hashes:
    """Hashes of any byte ranges of a text, from sums over its prefixes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data] * _powers("up", len(data)), out=self.sums[1:])
        self.down = _powers("down", len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        return _mixed((self.sums[size:] - self.sums[:-size]) * self.down[:-size] + np.uint64(size))


def least_positions(values: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` values the place of its smallest value (the first one of equals)."""
    count = len(values) - span + 1
    best, at, width = values, np.arange(len(values)), 1
    while width < span:
        step = min(width, span - width)
        left, right = best[:-step], best[step:]
        later = right < left
        at = np.where(later, at[step:], at[:-step])
        best = np.where(later, right, left)
        width += step
    return at[:count]


def units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each unit: hash of its anchor, hash of its bytes, first window start, last window start."""
    if len(data) < WINDOW:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    hashes = Hashes(data)
    grams = hashes.grams(ANCHOR)
    anchors = least_positions(grams, SPAN)
    first = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
    last = np.append(first[1:], len(anchors)) - 1
    # The anchor's place in the unit is part of what windows have in common, so it joins the unit's hash.
    whole = hashes.of(first, last + WINDOW)
    return grams[anchors[first]].view(np.int64), whole.view(np.int64), first, last
