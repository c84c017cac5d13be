"""The pipeline's stages on a small table, each judged on its own input."""

import random

import corpus_pipeline
import brute
from stratum.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = docs.columns
    found = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, FOLDER).write.parquet(path := f"{tmp_path}/{n}")
        docs = spark.read.parquet(path)
        found[name] = before, {r.doc_id: r for r in docs.collect()}
        assert set(columns) <= set(docs.columns) and (docs.columns == columns or name == "mixing")
    before, after = found["quality rules"]
    assert all(i not in after for i, r in before.items() if brute.base_figures(r.text)[5])
    assert len(after) >= 0.9 * sum(not brute.base_figures(r.text)[5] for r in before.values())
    before, after = found["line dedup"]
    gone = brute.removed_lines([(i, r.text) for i, r in before.items()])
    for i, r in before.items():
        left = "\n".join(x for at, x in enumerate(r.text.split("\n")) if at not in gone[i])
        assert after[i].text == left if brute.WORD.search(left) or not gone[i] else i not in after
    before, after = found["near-duplicates"]
    marks = brute.near_duplicates([(i, r.text) for i, r in before.items()], 5, 80)
    assert set(after) == {i for i, (_, c) in marks.items() if i == c}
    before, after = found["benchmark decontamination"]
    hits = brute.contamination([(i, r.text) for i, r in before.items()], items)
    assert set(after) == {i for i in before if not hits[i][4]}
    before, after = found["mixing"]
    assert all(0 < r.taken <= 3 * r.size for r in after.values())
    taken, target = {}, {}
    for r in after.values():
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_near_copies_with_an_added_block_go(spark):
    words = [f"w{i}" for i in range(244)]
    rows = [(1, " ".join(words[:200])), (2, " ".join(words)), (3, " ".join(f"{w}x" for w in words)),
            (4, " ".join([*(f"{w}x" for w in words[:120]), *words[120:180], *(f"{w}x" for w in words[180:])]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()) == [1, 3, 4]


def test_near_duplicates_at_the_stage_s_threshold(spark):
    """Copies on both sides of 80% of five-word shingles: every link is found, and none that is not there."""
    rng = random.Random(12)
    texts = []
    for _ in range(40):
        words = ["".join(rng.choice("abcdeginorst") for _ in range(6)) for _ in range(rng.randint(60, 200))]
        texts.append(words)
        for _ in range(5):
            copy = list(words)
            at, n = rng.randrange(len(words) // 2), rng.randint(1, len(words) // 5)
            copy[at:at + rng.choice([0, n])] = ["".join(rng.choice("uvwxyz") for _ in range(6)) for _ in range(n)]
            texts.append(copy)
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    marks, others = brute.near_duplicates(rows, 5, 80), brute.near_duplicates(rows)
    wanted = {i for i, (_, c) in marks.items() if i == c}
    assert wanted != {i for i, (_, c) in others.items() if i == c} and 45 < len(wanted) < 200
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()}
    assert kept == wanted


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
