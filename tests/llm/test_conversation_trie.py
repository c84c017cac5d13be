"""The conversation trie against a dictionary of prefixes, for shards of any size."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from stratum.llm import conversation_trie
from stratum.llm.conversation_trie import Settings
from stratum.llm.paren_trie import Parentheses

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, shard int, path string"


def brute(rows):
    turns = collections.defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(listed)] for c, listed in turns.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, listed in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - c % 20, [])[:h]) + tuple(listed[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    saved, leaves = collections.Counter(), collections.Counter()
    for path, listed in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(listed) - 1) * (len(WORD.findall(path[-1][1])) if path else 0)
            leaves[path[:d]] += children[path] == 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def trie(df, **settings):
    rows = conversation_trie.trie(df, Settings(**settings)).collect()
    assert len({r.conv_id for r in rows if r.parent_conv_id is None}) <= 1
    return sorted(tuple(-1 if x is None else x for x in r) for r in rows)


@pytest.fixture(scope="module")
def rows():
    """Repeated first turns, whole copies, turnless conversations, absent heads, NULLs, empty and long texts."""
    rng = random.Random(6)
    found = []
    for c in [*range(300), *range(1003, 1030), 10 ** 12 + 7]:
        for t in range(rng.randint(1, 6)):
            found.append((c, t if t else None, rng.choice(["user", "bot", None]), rng.choice(["hi", "hi there", None, " "]), t, "x"))
    found += [(c, t, "user", f"the same turn {t}", 0, None) for c in range(400, 700) for t in range(1, 5)]
    found += [(c, 1, "user", "word " * 20_000, 0, "") for c in range(700, 704)]
    found += [(None, 1, "user", "nobody's", 1, "y")] * 3
    return found


@pytest.mark.parametrize("settings", [{}, {"shard_turns": 1}, {"shard_turns": 7, "run": 3}, {"shard_turns": 200, "run": 1}], ids=str)
def test_trie(spark, rows, settings):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert trie(df, **settings) == brute(rows)


def test_empty_and_turnless(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []
    rows = [(c, 1, "u", "t", 0, "") for c in range(1000) if c % 20 and zlib.crc32(str(c).encode()) % 4]
    got = trie(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and len(got) == 1 and got[0][3] == len(rows)  # only the root, with all as members


def test_deep_conversation(spark):
    rows = [(c, t, "u", f"turn {t}", 0, "") for c in (1, 2, 3) for t in range(400)]
    assert trie(spark.createDataFrame(rows, SCHEMA), shard_turns=50) == brute(rows)


def test_parentheses():
    rng = random.Random(1)
    for _ in range(60):
        opening, depth = [True], 1
        while depth:
            up = rng.random() < (0.55 if len(opening) < rng.choice((5, 300, 9000)) else 0)
            opening.append(up)
            depth += 1 if up else -1
        code = Parentheses(np.array(opening))
        stack, close = [], {}
        for i, up in enumerate(opening):
            if up:
                stack.append(i)
            else:
                close[stack.pop()] = i
        assert dict(zip(code.nodes.tolist(), code.findclose().tolist())) == close
        assert code.leaf_ranks().tolist() == [sum(a and not b for a, b in zip(opening[:i], opening[1:])) for i in
                                              range(len(opening) + 1)] if len(opening) < 500 else True
