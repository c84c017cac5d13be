"""Integer clusters against numpy, with every awkward row."""

import hashlib
import math

import numpy as np
import pytest

from stratum.llm import centroid_clusters
from stratum.llm.centroid_clusters import Settings

SCHEMA = "vec_id long, embedding array<double>, cluster string, x int, start string"


def brute(rows, settings):
    rows = [(i, [math.floor(settings.scale * v) for v in e]) for i, e in rows
            if e is not None and len(e) == settings.size and all(v is not None and math.isfinite(v) for v in e)]
    if not rows:
        return []
    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{settings.salt}{r[0]}".encode()).hexdigest(), r[1]))
    centroids, x = [r[1] for r in order[:settings.clusters]], np.array([r[1] for r in rows], dtype=np.int64)

    def nearest():
        apart = ((x[:, None, :] - np.array(centroids)[None]) ** 2).sum(axis=2)
        return apart.argmin(axis=1), apart.min(axis=1)

    for _ in range(settings.rounds):
        of, _d = nearest()
        centroids = [(x[of == k].sum(axis=0) // (of == k).sum()).tolist() if (of == k).any() else c for k, c in enumerate(centroids)]
    of, d = nearest()
    return [(i, int(k), int(v), int(d[of == k].sum()), int(d.sum()),
             hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for (i, _), k, v in zip(rows, of, d)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("settings", [Settings(size=4, clusters=6), Settings(size=4, clusters=200, rounds=2),
                                      Settings(size=4, clusters=1), Settings(size=4, clusters=5, margin=1)], ids=str)
def test_clusters(spark, settings):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=4) * (1 + i % 3)).tolist()) for i in range(150)]
    rows += [(200 + i, [0.25, -0.5, 1.0, 0.0]) for i in range(80)]  # one vector, often
    rows += [(7, rows[9][1]), (7, rows[8][1]), (None, rows[3][1]), (None, rows[4][1])]
    rows += [(300, None), (301, []), (302, [1.0] * 3), (303, [1.0] * 5), (304, [1.0, None, 1.0, 1.0]), (305, [float("nan")] * 4),
             (306, [float("inf"), 0.0, 0.0, 0.0]), (307, [524287.5, -524288.0, 0.0, -1e-9])]
    df = spark.createDataFrame([(i, e, "c", 1, "s") for i, e in rows], SCHEMA).repartition(4)
    got = centroid_clusters.report(df, settings)
    assert in_order(map(tuple, got.collect())) == in_order(brute(rows, settings))


def test_nothing_usable(spark):
    df = spark.createDataFrame([(1, [1.0], "", 1, "")], SCHEMA)
    for part in (df, df.limit(0)):
        got = centroid_clusters.report(part)
        assert got.collect() == [] and dict(got.dtypes)["inertia"] == "bigint" and dict(got.dtypes)["cluster"] == "int"


def test_too_large_components_fail(spark):
    df = spark.createDataFrame([(1, [600000.0] * 4, "", 1, "")], SCHEMA)
    with pytest.raises(Exception, match="a component above"):
        centroid_clusters.report(df, Settings(size=4)).collect()


def test_rounds_shuffle_sums_only(spark):
    rows = centroid_clusters.integers(spark.createDataFrame([(1, [1.0] * 4, "", 1, "")], SCHEMA), Settings(size=4))
    sums = centroid_clusters.assigned(rows, [[0] * 4, [1] * 4]).groupBy("cluster").count()
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan and "partial_count" in plan
