"""Each operator against a brute-force version on small tables with every awkward case."""

import hashlib
import random

import pytest

import brute
from stratum.llm import (
    bwt_intervals,
    line_frequency,
    pareto_mix,
    positional_index,
    repeated_spans,
    secret_scan,
    segment_join,
    tensored_minhash,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id long, units string, size long, line string"


def sentence(rng, words=12):
    return " ".join("".join(rng.choice("abcdeghinorst") for _ in range(rng.randint(2, 8))) for _ in range(words))


@pytest.fixture(scope="module")
def texts():
    """Texts with exact and near copies, shared passages, repeats, NULLs, empties, ties and other alphabets."""
    rng = random.Random(11)
    found = ["\n".join(sentence(rng) for _ in range(rng.randint(1, 6))) for _ in range(30)]
    passage = sentence(rng, 60)
    for n in range(8):
        found.append(f"{sentence(rng, 5)} {passage} {sentence(rng, 5 + n)}")
    base = sentence(rng, 150).split()
    for n in range(10):
        words = list(base)
        for _ in range(n):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        found.append(" ".join(words))
    line = sentence(rng)
    found += [line + "\n" + sentence(rng), line[:9] + "x" + line[10:] + "\n" + sentence(rng), sentence(rng) + "\n" + line[:-1]]
    found += [found[3], found[3], found[40], None, "", " \n\t ", "a", "a b", "A B", "é 你好 😀 ß " * 30, "In. " * 120, "x" * 700, "x" * 450]
    return list(enumerate(found))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, None if t is None else len(t), 1, "u", 2, "l") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def as_map(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_quality_base_figures(docs, texts):
    got = as_map(line_frequency.verdicts(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == {i: brute.base_figures(t) for i, t in texts}


def test_frequent_lines_go_and_depleted_documents_are_rejected(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        own = sentence(rng, 30) if i % 20 else "few words of my own here"
        rows.append((i, f"Home | About  us | Terms of use and privacy and many other words here\n{own}" if i < 40 else sentence(rng, 30), "h"))
    rows += [(100 + i, rows[41][1] + "\nA line that only copies hold", "h") for i in range(50)]  # copies count once
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = as_map(line_frequency.verdicts(docs), "n_removed_words", "kept")
    assert got[1] == (15, True) and got[0] == (15, False) and got[50] == (0, True) and got[100] == (0, True)
    left = as_map(line_frequency.filtered(docs), "text")
    assert 0 not in left and left[1] == (rows[1][1].split("\n")[1],) and left[100] == (rows[60][1],)


def test_frequent_lines_of_any_length_go(spark):
    rng = random.Random(5)
    for length in (40, 41, 400):
        notice = sentence(rng, length)
        rows = [(i, f"{notice}\n{sentence(rng, 3 * length)}" if i < 30 else sentence(rng, 30), "h") for i in range(60)]
        rows.append((100, notice, "h"))
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = as_map(line_frequency.verdicts(docs), "n_removed_words", "kept")
        assert got[0] == (length, True) and got[50] == (0, True) and got[100] == (length, False)
        left = as_map(line_frequency.filtered(docs), "text")
        assert 100 not in left and left[0] == (rows[0][1].split("\n")[1],)


def test_near_duplicates(docs, texts):
    got = as_map(tensored_minhash.report(docs), "n_shingles", "component_id", "kept")
    assert got == {i: (n, c, i == c) for i, (n, c) in brute.near_duplicates(texts).items()}
    kept = tensored_minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, _, k) in got.items() if k)


def test_repeated_spans(docs, texts, monkeypatch):
    wanted = brute.repeated_bytes(texts)
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert as_map(repeated_spans.report(docs), *columns) == wanted
    monkeypatch.setattr(repeated_spans, "MOST_UNITS", 1)  # every group by the way for large ones
    assert as_map(repeated_spans.report(docs), *columns) == wanted


def test_intervals_find_all_repeats():
    rng = random.Random(2)
    for _ in range(60):
        strings = list({bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(6)})
        length = rng.randint(2, 9)
        grams = [s[i:i + length] for s in strings for i in range(len(s) - length + 1)]
        wanted = [[grams.count(s[i:i + length]) > 1 for i in range(len(s) - length + 1)] for s in strings]
        assert [x.tolist() for x in bwt_intervals.repeated(strings, length)] == wanted


def test_contamination(spark, docs, texts):
    rng = random.Random(8)
    items = [(5, "Alpha " + texts[31][1].split(" ", 6)[6][:200].upper()), (12, " ".join(texts[0][1].split()[:9])),
             (3, texts[2][1][10:160]), (7, sentence(rng, 40)), (8, ""), (9, None), (20, "in in, in. IN")]
    benchmark = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, row_id string")
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = as_map(positional_index.report(docs, benchmark), *columns)
    assert got == brute.contamination(texts, items)
    assert any(v[4] for v in got.values())
    left = positional_index.decontaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, v in got.items() if not v[4])
    nothing = as_map(positional_index.report(docs, benchmark.limit(0)), *columns)
    assert all(v[1] == 0 and not v[4] for v in nothing.values()) and len(nothing) == len(texts)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "zebra one two three four quark"), (2, "zebra " + "x " * 80 + "quark")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "quark zebra")], "item_id long, text string")
    windows = positional_index.test_windows(benchmark)
    postings = positional_index.index(docs, windows)
    ranked = positional_index.ranked_terms(windows, postings)
    near = positional_index.proximity_matches(postings, windows, ranked, terms=2, slop=10).collect()
    first = {r.row_id for r in postings.filter("doc_id = 1").collect()}
    assert {r.row_id for r in near} == first


SECRETS = [
    'password = "hunter2hunter2"', "TOKEN:short", "token=secret:abcdefghij", "my api_key => x", "apikey='A_b.c+d/e=f-'",
    "AKIA" + "A1" * 8, "AKIAXX", "AKIA" * 5, "deadbeef" * 4, "é😀 passwd: 0123456789 " + "0f" * 20, None, "",
    "Secret: " + hashlib.sha256(b"1").hexdigest(), "ſecret = abcdefghijkl", "token=token=abcdefgh",
]


def test_base_secrets(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(SECRETS)], "doc_id long, text string, kind int")
    got = as_map(secret_scan.report(docs), "base_sha256", "n_assign", "n_access", "n_hex", "spans")
    for i, text in enumerate(SECRETS):
        base = brute.base_secrets(text)
        assert got[i][0] == hashlib.sha256(base.encode()).hexdigest(), text
        assert got[i][1:4] == tuple(base.count(k + ":") for k in ("assign", "access", "hex"))
        assert set(filter(None, base.split(","))) <= set(got[i][4].split(","))


def test_random_strings_are_told_from_words(spark):
    rng = random.Random(9)
    symbols = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(i, "see " + "".join(rng.choice(symbols) for _ in range(40)) + " end") for i in range(40)]
    rows += [(100 + i, "see " + sentence(rng, 8).replace(" ", "_") + " and " + "ab" * 20) for i in range(200)]
    got = as_map(secret_scan.report(spark.createDataFrame(rows, "doc_id long, text string")), "n_random")
    assert sum(got[i][0] for i in range(40)) >= 36
    assert sum(got[100 + i][0] for i in range(200)) <= 10


def test_line_dedup(docs, texts):
    got = as_map(segment_join.report(docs), "removed_lines", "n_removed")
    wanted = brute.removed_lines(texts)
    assert got == {i: (",".join(map(str, at)), len(at)) for i, at in wanted.items()}
    assert sum(map(len, wanted.values())) > 10
    left = segment_join.cleaned(docs)
    assert left.columns == docs.columns
    kept = as_map(left, "text")
    for i, text in texts:
        lines = None if text is None else [x for at, x in enumerate(text.split("\n")) if at not in wanted[i]]
        if wanted[i] and not any(brute.WORD.search(x) for x in lines):
            assert i not in kept
        else:
            assert kept[i][0] == (None if lines is None else "\n".join(lines))


def test_edit_join_keys_and_verification():
    rng = random.Random(3)
    for _ in range(3000):
        edits = rng.randint(1, 3)
        a = "".join(rng.choice("abc") for _ in range(rng.randint(8, 20)))
        b = list(a)
        for _ in range(edits):
            at = rng.randrange(len(b))
            b[at:at + 1] = rng.choice(([], [rng.choice("abc")], [b[at], rng.choice("abc")]))
        b = "".join(b)
        assert set(segment_join.keys(a, edits)) & set(segment_join.keys(b, edits))
        c = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        assert segment_join.within(a[:8], c, edits) == (brute.edit_distance(a[:8], c) <= edits)
        assert segment_join.within(a, b, edits)


def test_mix(docs, texts):
    rows = pareto_mix.report(docs).collect()
    sizes, taken = {}, {}
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    for i, text in texts:
        n = len(brute.WORD.findall(text or ""))
        sizes[source[i]] = sizes.get(source[i], 0) + n
    target = brute.mix_targets(sizes)
    for r in rows:
        assert r.size == len(brute.WORD.findall(dict(texts)[r.doc_id] or ""))
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert len(rows) == len(texts)
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert sorted(map(tuple, pareto_mix.report(docs.repartition(3)).collect())) == sorted(map(tuple, rows))


def test_mix_keeps_columns(docs):
    clashing = docs.withColumnsRenamed({"row_id": "target", "units": "rank", "line": "factor"})
    found = pareto_mix.mixed(clashing)
    assert set(found.columns) == set(clashing.columns) | {"source_size", "taken"}
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, pareto_mix.report(docs).collect()))


def test_mix_limits_copies_and_weighs_documents(spark):
    rows = [(i, "w " * 10, "big", 1.0) for i in range(300)] + [(1000 + i, "w " * 10, "small", 1.0 + i % 2) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double")
    plan = pareto_mix.Plan(weights=(1, 100))
    got = as_map(pareto_mix.report(docs, plan=plan), "target", "taken")
    assert all(got[1000 + i] == (300.0, 30) for i in range(10))
    plan = pareto_mix.Plan(weights=(30, 1), share=1.0)
    heavy = as_map(pareto_mix.report(docs, weight="weight", plan=plan), "target", "taken")
    assert sum(heavy[1000 + i][1] for i in range(1, 10, 2)) > sum(heavy[1000 + i][1] for i in range(0, 10, 2))


@pytest.mark.parametrize("report", [
    line_frequency.verdicts, tensored_minhash.report, repeated_spans.report, segment_join.report, secret_scan.report,
    pareto_mix.report, line_frequency.filtered, segment_join.cleaned, tensored_minhash.deduplicated,
], ids=lambda f: f"{f.__module__.split('.')[-1]}.{f.__name__}")
def test_empty_tables_and_repeated_rows(spark, docs, report):
    assert report(docs.limit(0)).count() == 0
    if report.__name__ in ("report", "verdicts"):
        some = docs.filter("doc_id in (3, 31, 40) or text is null").drop("doc_id").withColumn("doc_id", docs.n_chars * 0)
        assert report(some.unionByName(some)).count() == 2 * some.count()


def test_profiles_of_lines_with_many_letters_do_not_overflow(spark):
    """The top byte of a profile counts the letter s; lines at both ends of it are compared."""
    from stratum.llm import segment_join
    same = "".join(f"{i:03}" for i in range(200))
    texts = ["s" * 130 + same, "s" * 131 + same, same + "x" * 130, same + "s" * 127 + "xxx", "x" * 130 + same]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = segment_join.report(docs).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(0, 0), (1, 1), (2, 0), (3, 0), (4, 0)]


def test_neighbours_of_linked_lines_differ_by_four_bits_an_edit():
    import random
    from stratum.llm.segment_join import neighbours
    rng = random.Random(5)
    for _ in range(2000):
        line = "".join(rng.choice("abc dé") for _ in range(rng.randrange(24, 90)))
        near = line
        for _ in range(2):
            i, kind = rng.randrange(len(near)), rng.randrange(3)
            near = near[:i] + rng.choice(["x", "", near[i] + "y"]) + near[i + 1:] if kind else near
        assert ((neighbours(line) ^ neighbours(near)) & (2 ** 64 - 1)).bit_count() <= 8


def test_parities_bound_what_only_one_set_holds():
    import numpy as np
    from stratum.llm.tensored_minhash import parities
    rng = np.random.RandomState(3)
    for _ in range(300):
        x, y = (np.unique(rng.randint(0, 2 ** 63, rng.randint(1, 400), dtype=np.int64).astype(np.uint64)) for _ in range(2))
        y = np.unique(np.concatenate([y[:rng.randint(0, 40)], x[rng.randint(0, 40):]]))
        bits = sum(((a ^ b) & (2 ** 64 - 1)).bit_count() for a, b in zip(parities(x), parities(y)))
        assert bits <= len(np.setxor1d(x, y))


@pytest.mark.parametrize("what", ["sets", "lines"])
def test_near_copies_below_the_threshold_form_few_pairs(spark, what, monkeypatch):
    """Copies of one text or line share buckets, but are too far from each other to be linked."""
    import random
    from stratum.llm import bucket_links, segment_join, tensored_minhash
    rng, made, plain = random.Random(9), [], bucket_links.staged

    def counted(df, label):
        df = plain(df, label)
        if label == "pairs":
            made.append(df.count())
        return df

    monkeypatch.setattr(bucket_links, "staged", counted)
    words = [f"w{i:03}" for i in range(150)]
    if what == "sets":
        texts = [" ".join(f"e{rng.randrange(10 ** 9)}" if i in places else w for i, w in enumerate(words))
                 for places in (set(rng.sample(range(150), 6)) for _ in range(120))]
        rows = tensored_minhash.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
        assert sum(r.kept for r in rows) > 100
    else:
        texts = [" ".join(words[:20]) + " " + "".join(rng.choice("bcdfghjklmpqruvwxyz") for _ in range(8)) for _ in range(120)]
        rows = segment_join.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
        assert sum(r.n_removed for r in rows) < 5
    assert sum(made) < 1500  # of 7,140


def test_copies_meet_in_few_tables(spark, monkeypatch):
    """Copies that are all alike share most of their minhashes, but need not meet in every pair of them."""
    from stratum.llm import tensored_minhash
    rng, made, plain = random.Random(6), [], tensored_minhash.staged

    def counted(df, label):
        df = plain(df, label)
        if label == "table-keys":
            made.append(df.count())
        return df

    monkeypatch.setattr(tensored_minhash, "staged", counted)
    words = [f"w{i:03}" for i in range(400)]
    texts = [" ".join(f"e{n}" if i == at else w for i, w in enumerate(words)) for n, at in enumerate(rng.sample(range(400), 40))]
    rows = tensored_minhash.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.doc_id for r in rows if r.kept] == [0]
    assert sum(made) <= 40 * 60  # 132 for each copy, if every two collections make a table with two bands


def test_lines_with_a_word_changed_here_and_there_form_few_pairs(spark, monkeypatch):
    """Lines of one length that differ in parts of two words have nearly the same letters, but not the same triples."""
    from stratum.llm import bucket_links
    rng, made, plain = random.Random(7), [], bucket_links.staged

    def counted(df, label):
        df = plain(df, label)
        if label == "pairs":
            made.append(df.count())
        return df

    monkeypatch.setattr(bucket_links, "staged", counted)
    words = sentence(rng, 80).split()
    texts = [" ".join(w + "".join(rng.choice("bcdfghjklm") for _ in range(4)) if i == at else w for i, w in enumerate(words))
             for at in (rng.randrange(80) for _ in range(200))]
    rows = segment_join.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    first = list(range(len(texts)))
    for j in range(len(texts)):
        for i in range(j):
            if first[i] != first[j] and segment_join.within(texts[i], texts[j], 2):
                first = [min(first[i], first[j]) if x in (first[i], first[j]) else x for x in first]
    assert {r.doc_id for r in rows if r.n_removed} == {i for i, x in enumerate(first) if i != x}
    assert sum(made) < 4500  # of 19,900


def test_sketches_of_linked_lines_differ_by_a_few_bits_an_edit():
    rng = random.Random(5)
    for _ in range(2000):
        line = "".join(rng.choice("abc dé😀") for _ in range(rng.randrange(24, 90)))
        near = line
        for _ in range(2):
            i, kind = rng.randrange(len(near)), rng.randrange(3)
            near = near[:i] + rng.choice(["x", "", near[i] + "y"]) + near[i + 1:] if kind else near
        for width, count in ((1, 64), (2, 64), (3, 128)):
            x, y = segment_join.cells(line, width, count), segment_join.cells(near, width, count)
            assert sum(((a ^ b) & (2 ** 64 - 1)).bit_count() for a, b in zip(x, y)) <= 4 * width


def test_few_links_are_joined_without_a_shuffle(spark, monkeypatch):
    """A step over few links looks them up in what is broadcast, whatever Spark broadcasts by itself."""
    from stratum.llm import bucket_links, components
    plain, plans = components.staged, []

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, label)

    monkeypatch.setattr(bucket_links, "staged", seen)
    monkeypatch.setattr(components, "staged", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        labels = spark.range(60).selectExpr("id member", "id label")
        links = spark.createDataFrame([(i, i + 3) for i in range(0, 45)] + [(7, 1), (7, 1), (59, 50)], "a long, b long")
        for most in (components.FEW, 0):
            monkeypatch.setattr(components, "FEW", most)
            del plans[:]
            got = bucket_links.joined(labels, links, links.count()).collect()
            smallest = {i: i % 3 for i in range(48)} | {59: 50}
            assert sorted(map(tuple, got)) == [(i, smallest.get(i, i)) for i in range(60)]
            assert any("SortMergeJoin" in plan for plan in plans) == (not most)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_no_key_touches_are_told_apart(spark):
    from pyspark.sql import functions as F
    from stratum.llm.common import sieved
    rows = spark.range(5000).withColumn("text", F.md5(F.col("id").cast("string"))).withColumn("__own", F.lit(1))
    key = F.xxhash64("id", "text")
    for wanted in ("id % 50 = 7", "id < 0"):
        touched, others = sieved(rows, key, rows.filter(wanted).select(key))
        assert touched.columns == others.columns == rows.columns
        keys = {r.id for r in rows.filter(wanted).collect()}
        met, left = {r.id for r in touched.collect()}, {r.id for r in others.collect()}
        assert met >= keys and len(met) <= len(keys) + 5 and not met & left and met | left == set(range(5000))
