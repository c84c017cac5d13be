"""Repeated substrings of a block by interval expansion on its Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by at least their first ``depth`` symbols (0..511), by doubling.

    Suffixes that already differ from all others keep their place and are not sorted again.
    """
    size = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(6, dtype=np.int64)])
    keys = np.zeros(size, dtype=np.int64)
    for i in range(6):
        keys = (keys << 9) | padded[i:i + size]
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.append(True, ordered[1:] != ordered[:-1])
    rank = np.empty(size + 1, dtype=np.int64)  # place of the first suffix that is not told apart
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(size), 0))
    rank[size] = -1
    known = 6
    while known < depth:
        alone = first & np.append(first[1:], True)
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        open_ = order[places]
        own = rank[open_]
        keys = own * (size + 2) + rank[np.minimum(open_ + known, size)] + 1
        sorting = np.argsort(keys)
        order[places] = open_ = open_[sorting]
        keys = keys[sorting]
        starts = np.append(True, keys[1:] != keys[:-1])
        first[places] = starts
        rank[open_] = places[np.maximum.accumulate(np.where(starts, np.arange(len(places)), 0))]
        known *= 2
    return order


def repeated(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, at which starts a substring of ``length`` bytes begins that begins elsewhere too.

    Backward extension goes breadth first: at level L the boundaries between suffixes that have L symbols in common
    are known. Rows of the transform that hold the same symbol, with no other such row between them, are neighbours
    after extension by it; they have L + 1 symbols in common if L is the least of the boundaries between the rows. A
    boundary still unknown at the last level separates suffixes with ``length`` or more symbols in common. A mark
    between strings (symbol 0) is never extended by, so nothing reaches across it.
    """
    parts = []
    for string in strings:
        parts.append(np.frombuffer(string, dtype=np.uint8).astype(np.uint16) + 1)
        parts.append(np.zeros(1, dtype=np.uint16))
    symbols = np.concatenate(parts)
    size = len(symbols)
    order = suffix_order(symbols, length)
    transform = symbols[order - 1]
    rows = np.argsort(transform, kind="stable")  # row j after extension comes from row rows[j]
    upper, lower = rows[:-1], rows[1:]
    grown = (transform[upper] == transform[lower]) & (transform[lower] != 0)
    unknown = np.flatnonzero(grown) + 1
    upper, lower = upper[grown], lower[grown]
    known = np.ones(size, dtype=bool)
    known[unknown] = False
    frontier = np.flatnonzero(known)
    # Between neighbouring rows there is one boundary, which alone decides: it leads straight to the one it extends to.
    near = lower == upper + 1
    leads = np.zeros(size, dtype=np.int64)
    leads[lower[near]] = unknown[near]
    far, upper, lower = unknown[~near], upper[~near], lower[~near]
    flags = np.zeros(size, dtype=np.int32)
    for _ in range(length - 1):
        if not len(frontier):
            break
        after = leads[frontier]
        if len(far):
            flags[frontier] = 1
            passed = np.cumsum(flags, dtype=np.int32)
            flags[frontier] = 0
            met = passed[lower] > passed[upper]
            after = np.concatenate([after, far[met]])
            far, upper, lower = far[~met], upper[~met], lower[~met]
        frontier = after[~known[after]]
        known[frontier] = True
    unknown = np.flatnonzero(~known)
    found = np.zeros(size, dtype=bool)
    found[order[unknown]] = True
    found[order[unknown - 1]] = True
    results, at = [], 0
    for string in strings:
        results.append(found[at:at + max(0, len(string) - length + 1)])
        at += len(string) + 1
    return results
