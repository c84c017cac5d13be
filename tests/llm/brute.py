"""Brute-force versions of the operators, over lists of (doc_id, text, ...)."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_figures(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


def shingle_set(text, size=3):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


class Groups:
    def __init__(self, items):
        self.parent = {x: x for x in items}

    def of(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def tie(self, a, b):
        a, b = self.of(a), self.of(b)
        self.parent[max(a, b)] = min(a, b)


def near_duplicates(docs, size=3, percent=85):
    """{doc_id: (set size, smallest id of the component)} for unique ids."""
    sets, holders, groups = {}, defaultdict(list), Groups([i for i, _ in docs])
    for i, text in docs:
        sets[i] = shingle_set(text, size)
        shared = Counter(j for gram in sets[i] for j in holders[gram])
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                groups.tie(i, j)
        for gram in sets[i]:
            holders[gram].append(i)
    return {i: (len(sets[i]), groups.of(i)) for i, _ in docs}


def repeated_bytes(docs, window=200):
    datas = [(i, (text or "").encode()) for i, text in docs]
    counts = Counter(data[a:a + window] for _, data in datas for a in range(len(data) - window + 1))
    found = {}
    for i, data in datas:
        gone = [False] * len(data)
        for a in range(len(data) - window + 1):
            if counts[data[a:a + window]] > 1:
                gone[a:a + window] = [True] * window
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        left = bytes(b for b, g in zip(data, gone) if not g)
        found[i] = len(data), sum(gone), spans, hashlib.sha256(left).hexdigest()
    return found


def contamination(docs, items, size=13):
    pattern = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = {text: pattern.findall((text or "").translate(LOWER)) for _, text in [*docs, *items]}
    windows = defaultdict(set)
    for item, text in items:
        own = words[text]
        for a in range(max(1, len(own) - size + 1) if own else 0):
            windows[tuple(own[a:a + size])].add(item)
    found = {}
    for i, text in docs:
        own, hit, met = words[text], set(), set()
        for length in {len(w) for w in windows}:
            for a in range(len(own) - length + 1):
                key = tuple(own[a:a + length])
                if key in windows:
                    hit |= set(range(a, a + length))
                    met |= windows[key]
        digest = hashlib.sha256(",".join(sorted(map(str, met))).encode()).hexdigest()
        found[i] = len(own), len(hit), len(met), digest, len(hit) > 0 and 20 * len(hit) >= len(own)
    return found


ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
                    r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        after = [i]
        for j, y in enumerate(b, 1):
            after.append(min(row[j] + 1, after[-1] + 1, row[j - 1] + (x != y)))
        row = after
    return row[-1]


def removed_lines(docs, edits=2, least=24):
    """{doc_id: places of the removed lines} for unique ids."""
    places = []
    for i, text in docs:
        digest = hashlib.md5((text or "").encode()).hexdigest()
        places += [((i, digest, at), line) for at, line in enumerate((text or "").split("\n")) if len(line) >= least]
    lines = sorted({line for _, line in places})
    groups, bags = Groups(lines), {line: Counter(line) for line in lines}
    for n, a in enumerate(lines):
        for b in lines[n + 1:]:
            # An edit changes the letters' counts by two at most.
            if abs(len(a) - len(b)) > edits or (bags[a] - bags[b]).total() + (bags[b] - bags[a]).total() > 2 * edits:
                continue
            if edit_distance(a, b) <= edits:
                groups.tie(a, b)
    first = {}
    for place, line in places:
        key = groups.of(line)
        first[key] = min(first.get(key, place), place)
    found = {i: [] for i, _ in docs}
    for place, line in places:
        if place != first[groups.of(line)]:
            found[place[0]].append(place[2])
    return found


def mix_targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target} for {source: size}; None comes last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        scale = sum(weight[s] for s in free)
        target = {s: most * sizes[s] if s in full else left * weight[s] / scale for s in order}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above
