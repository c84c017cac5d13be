"""The tokenizer, the licence scan and the classifier."""

import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece

import brute
from stratum.llm import cotraining, patience_scan, token_transducer
from stratum.llm.license_templates import TEMPLATES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(1)
    letters = list("abcdeflnorstui  \n.,▁é你好ж😀0123456789#<s>_=\t\x00ABCTheing")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return texts + ["a" * 5000, "   " * 2000, "abcabcabd" * 700, " ", "\n", "<s></s>", "▁▁", "thethething" * 900, "="]


def test_counts_are_the_librarys(library, awkward):
    wanted = [len(x) for x in library.encode(awkward)]
    vocabulary = token_transducer.Vocabulary.load(MODEL)
    assert token_transducer.Transducer(vocabulary).count(awkward) == wanted


def test_small_tables_chunks_and_blocks_change_nothing(library, awkward, monkeypatch):
    monkeypatch.setattr(token_transducer, "BLOCK", 97)
    small = token_transducer.Transducer(token_transducer.Vocabulary.load(MODEL), most_states=40, chunk=8)
    assert small.count(awkward) == [len(x) for x in library.encode(awkward)]


def test_states_are_not_made_again_and_again(monkeypatch):
    """The states that a few megabytes of text need are kept."""
    vocabulary = token_transducer.Vocabulary.load(MODEL)
    rng, made = random.Random(4), []
    texts = ["".join(rng.choice("aaaeeeiioonnrrssttlldcmup") for _ in range(2000)) for _ in range(150)]
    transducer = token_transducer.Transducer(vocabulary)
    counts = transducer.count(texts)
    plain = transducer._transition
    monkeypatch.setattr(transducer, "_transition", lambda *where: (made.append(where), plain(*where)))
    assert transducer.count(texts) == counts
    assert not made


def test_token_counts_of_documents(spark, library):
    table = pq.read_table(f"{FOLDER}/documents.parquet").select(["doc_id", "text"]).to_pylist()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    more = spark.createDataFrame([(-1, None), (-2, ""), (0, "again")], "doc_id long, text string")
    got = token_transducer.token_counts(docs.select("doc_id", "text").unionByName(more), MODEL, limit=500).collect()
    wanted = [(r["doc_id"], len(r["text"].encode()), n, n > 500)
              for r, n in zip(table, (len(x) for x in library.encode([r["text"] for r in table])))]
    wanted += [(-1, 0, 0, False), (-2, 0, 0, False), (0, 5, len(library.encode("again")), False)]
    assert sorted(map(tuple, got)) == sorted(wanted)
    assert token_transducer.token_counts(docs.limit(0), MODEL).count() == 0


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_a_common_subsequence():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 25))]
        b = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 25))]
        pairs = patience_scan.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        assert len(pairs) <= longest_common(a, b)
        unique = list(dict.fromkeys(a))
        assert len(patience_scan.aligned(unique, unique)) == len(unique)


def test_increasing_runs_are_longest():
    rng = random.Random(6)
    for _ in range(300):
        values = rng.sample(range(50), rng.randint(0, 12))
        found = [values[i] for i in patience_scan.longest_increasing(values)]
        assert found == sorted(found) and len(found) == longest_common(values, sorted(values))


def test_licenses_are_found(spark):
    rng = random.Random(7)
    prose = " ".join(rng.choice("the of this and license under work general any".split()) for _ in range(400))
    rows, wanted = [], {}
    for n, (name, text) in enumerate(TEMPLATES.items()):
        words = text.split()
        if len(words) > 30:  # a few changed words
            for at in (5, 17, 29):
                words[at] = "other"
        rows.append((n, f"{prose}\n\n{' '.join(words)}\n{prose}\n{' '.join(words)}"))
        wanted[n] = name
    rows += [(100, prose), (101, None), (102, ""), (100, prose)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.license, r.n_licenses, r.spans) for r in patience_scan.report(docs).collect()]
    for n, name in wanted.items():
        row = next(g for g in got if g[0] == n)
        assert row[1] == name and row[2] == 2, (name, row)
        first = row[3].split(",")[0].split(":")
        text = rows[n][1][int(first[1]):int(first[2])]
        assert text.split()[0] in TEMPLATES[name] and len(text) >= 0.7 * len(TEMPLATES[name])
    assert sorted((g[0], g[2]) for g in got if g[0] >= 100) == [(100, 0), (100, 0), (101, 0), (102, 0)]
    assert patience_scan.report(docs.limit(0)).count() == 0


def test_adjacent_licenses_are_all_found():
    rng = random.Random(8)
    prose = " ".join(rng.choice("the of this and license under work general any".split()) for _ in range(400))
    known = patience_scan.templates(TEMPLATES)
    for name, text in TEMPLATES.items():
        for copies in (2, 3, 7, 40):
            for before, between in (("", "\n"), (f"{prose}\n", "\n"), ("", "\n\nthird party\n"), (f"{prose}\n", " foo bar baz\n")):
                whole = f"{before}{between.join([text] * copies)}\n{before}"
                got = patience_scan.matches(whole, known)
                assert [m[0] for m in got] == [name] * copies, (name, copies, before[:9], between)
                starts = [len(before) + n * (len(text) + len(between)) for n in range(copies)]
                assert [m[1] for m in got] == starts and all(m[3] == 1 for m in got)


def test_changed_adjacent_licenses_are_found():
    rng = random.Random(9)
    known = patience_scan.templates(TEMPLATES)
    for name in ("MIT", "BSD-2-Clause", "Apache-2.0", "GPL-3.0"):
        for _ in range(20):
            copies = []
            for _ in range(5):
                words = TEMPLATES[name].split()
                for at in rng.sample(range(1, len(words) - 1), len(words) // 10):
                    words[at] = "other"
                copies.append(" ".join(words))
            assert [m[0] for m in patience_scan.matches("\n".join(copies), known)] == [name] * 5


def test_every_copy_of_enough_coverage_has_a_key():
    for template in patience_scan.templates(TEMPLATES):
        kept = sum(w not in template.keys for w in template.words)
        assert kept / len(template.words) < patience_scan.LEAST_COVERAGE
    # None of the three rarest words is left in this copy.
    mit = next(t for t in patience_scan.templates(TEMPLATES) if t.name == "MIT")
    rarest = list(mit.keys)[:3]
    copy = " ".join("other" if w in rarest else w for w in mit.words)
    assert [m[0] for m in patience_scan.matches(copy, [mit])] == ["MIT"]


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen, held_out = labels.filter("doc_id % 3 > 0"), labels.filter("doc_id % 3 = 0")
    rows = cotraining.scored(docs, seen).join(held_out, "doc_id").select("kept", "quality", "score").collect()
    right = [r.kept == (r.quality == 1) for r in rows]
    assert sum(right) / len(right) > 0.98
    clean = [r.kept for r in rows if r.quality == 1]
    assert sum(clean) / len(clean) > 0.99


def test_views_teach_each_other():
    import numpy as np

    rng = np.random.RandomState(0)
    y = rng.randint(0, 2, 4000).astype(float)
    views = [np.stack([y * 3 + rng.randn(4000), rng.randn(4000)], axis=1) for _ in range(2)]
    settings = cotraining.Settings(rounds=3)
    model = cotraining.trained([v[:60] for v in views], y[:60], [v[60:3000] for v in views], settings)
    combined = model.chances(*(v[3000:] for v in views))
    right = [((p > 0.5) == (y[3000:] == 1)).mean() for p in combined]
    assert right[2] >= max(right[:2]) - 0.005 and right[2] > 0.95


def test_classifier_without_labels_and_with_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None), (None, "x", "s", "en"), (1, "", "s", "en")],
                                 "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    got = cotraining.scored(docs, labels).collect()
    assert len(got) == 3 and all(r.kept and r.score == 0.5 for r in got)
    assert cotraining.scored(docs.limit(0), labels).count() == 0


def test_figures_are_finite():
    for text in ("", "\n\n", "a", "😀" * 10, "A B C " * 300):
        assert all(x == x and abs(x) < 1e6 for x in cotraining.text_figures(text))
    assert brute.WORD.findall("a b") == ["a", "b"]


def test_the_rows_of_smallest_hashes(spark):
    from pyspark.sql import functions as F
    ids = [*range(500), *[7] * 300, *[8] * 300]
    rows = spark.createDataFrame([(i, [float(i)], [float(n)], n % 2) for n, i in enumerate(ids)],
                                 "doc_id long, text_view array<float>, metadata_view array<float>, quality int").repartition(9)
    plain = rows.orderBy(F.xxhash64("doc_id"), "quality", "metadata_view").collect()
    for n in (1, 20, 450, 5000):
        found = cotraining.lowest(rows, n, "quality", "metadata_view")
        assert [tuple(r) for r in found] == [(r.text_view, r.metadata_view, r.quality) for r in plain[:n]]
    assert cotraining.lowest(rows.limit(0), 5) == []
