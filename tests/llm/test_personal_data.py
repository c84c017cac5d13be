"""Personal data: base patterns and the tagger against brute force, held-out lines, awkward rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from stratum.llm import pii_examples, pii_spans, shape_crf

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a.b+c@d.example.org, x@y and @z.com a@@b.c a@b.c_d@e.f", "1.2.3.4 256.1.1.1 1.2.3.4.5 007.1.1.255 1.2.3", None, "", " \n",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111 1111 1111", "+1 (017) 555-7713 +1234567 +1 2 3 4 5 6 7 8 9 (0)",
    "é😀 +49 30 1234567 ß a@b.cd 9807915762804490", "my name is Anna Weber , born on 12/04/1980 and", "SSN 123-45-6789",
    "x" * 5000 + "@" + "1" * 5000 + ".2.3.4", "1" * 30000, "+" + "9 " * 20000, ("Ha. " * 50 + "\n") * 200, "a@b.c" * 300,
]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    text = text or ""
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                yield kind, *m.span()


@pytest.fixture(scope="module")
def tagger(spark):
    return pii_spans.fitted(pii_examples.examples(spark))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", None, 1, i) for i, t in enumerate(TEXTS)] + [(3, TEXTS[0], "y", "z", 2, 3)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, kind string, base int, `n email` long")


def test_base_spans_of_random_texts():
    rng = random.Random(1)
    pieces = ["@", ".", "-", " ", "+", "(", ")", "a", "b.c", "1", "23", "255", "4111111111111111", "_", "\n", "é", "x@y.z", "+1 "]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))
        assert pii_spans.base_spans(text) == list(plain(text)), text


def test_report(docs, tagger):
    rows = pii_spans.report(docs, tagger).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = TEXTS[0] if r.doc_id == 3 and r.n_email else TEXTS[r.doc_id]
        base = list(plain(text))
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in pii_spans.BASE_KINDS)
        assert r.spans.startswith(listed) and len(list(filter(None, r.spans.split(",")))) == len(base) + r.n_tagged
    by_id = {r.doc_id: r.spans for r in rows}
    assert "name:11:21" in by_id[8] and "birth:32:42" in by_id[8] and by_id[9] == "account:4:15"
    assert pii_spans.report(docs.limit(0), tagger).count() == 0


def test_redacted_keeps_rows_and_columns(docs, tagger):
    left = pii_spans.redacted(docs, tagger)
    assert left.schema == docs.schema
    texts = {(r.doc_id, r.spans): r.text for r in left.collect()}
    assert texts[8, "x"] == "my name is [name] , born on [birth] and" and texts[2, "x"] is None and texts[3, "x"] == ""
    assert texts[7, "x"].startswith("é😀 [phone] ß [email] ")


def test_without_labelled_lines_only_the_base_is_found(spark, docs):
    nothing = pii_spans.fitted(pii_examples.examples(spark).limit(0))
    assert all(r.n_tagged == 0 for r in pii_spans.report(docs, nothing).collect())


def test_labelled_lines_are_bounded(spark):
    settings = shape_crf.Settings(labelled=20, epochs=3)
    a, b = (pii_spans.fitted(pii_examples.examples(spark, 200).repartition(n), settings) for n in (3, 7))
    assert a.known == b.known and np.array_equal(a.own, b.own)


def tagged_spans(words, tags):
    places, at = [], 0
    for word in words:
        places.append((at, at + len(word)))
        at += len(word) + 1
    for tag, group in itertools.groupby(range(len(words)), key=lambda i: tags[i]):
        group = list(group)
        if tag != "O":
            start, end = places[group[0]][0], places[group[-1]][1]
            yield tag, start, start + len(" ".join(words)[start:end].rstrip(shape_crf.TRAILING))


def test_held_out_lines(tagger):
    decoder, hits, made, wanted = shape_crf.Decoder(tagger), 0, 0, 0
    for _, words, tags in pii_examples.made(600, seed=5):
        want, got = set(tagged_spans(words, tags)), set(decoder.spans([" ".join(words)])[0])
        hits, made, wanted = hits + len(want & got), made + len(got), wanted + len(want)
    assert hits >= 0.7 * wanted and hits >= 0.8 * made


def test_gradient():
    rng = np.random.default_rng(0)
    scores, between = rng.normal(size=(3, 5, 3)), rng.normal(size=(3, 3))
    inside = np.arange(5) < np.array([5, 3, 4])[:, None]
    tags = np.where(inside, rng.integers(0, 3, size=(3, 5)), 0)
    tags[:, 0] = 0
    value, by_score, by_pair = shape_crf.gradient(scores, between, tags, inside)
    for array, slopes in ((scores, by_score), (between, by_pair)):
        for at in np.ndindex(array.shape):
            if array is scores and (not inside[at[:2]] or at[1] == 0):
                continue
            array[at] += 1e-6
            assert abs((shape_crf.gradient(scores, between, tags, inside)[0] - value) / 1e-6 - slopes[at]) < 1e-4
            array[at] -= 1e-6


def test_best_paths():
    rng = np.random.default_rng(1)
    for places in (1, 2, 4):
        scores, between = rng.normal(size=(20, places, 3)), rng.normal(size=(3, 3))
        for got, own in zip(shape_crf.best_paths(scores, between).tolist(), scores):
            def value(path):
                ends = [0, *path, 0]
                return sum(own[i, y] for i, y in enumerate(path)) + sum(between[a, b] for a, b in zip(ends, ends[1:]))
            assert value(got) == pytest.approx(max(map(value, itertools.product(range(3), repeat=places))))


def test_certain_words_and_parts_change_nothing(tagger, monkeypatch):
    rng = random.Random(3)
    texts = ["\n".join(" ".join(pii_examples.line(rng)[0]) for _ in range(rng.randint(1, 12))) for _ in range(30)]
    wanted = shape_crf.Decoder(tagger).spans(texts)
    assert sum(map(len, wanted)) > 20
    whole = shape_crf.Decoder(tagger)
    whole.slack = whole.slack + 1e9  # only borders are certain
    assert whole.spans(texts) == wanted
    monkeypatch.setattr(shape_crf.Decoder, "CHUNK", 40)
    monkeypatch.setattr(shape_crf.Decoder, "MOST_WORDS", 5)
    assert [shape_crf.Decoder(tagger).spans([t])[0] for t in texts] == wanted
