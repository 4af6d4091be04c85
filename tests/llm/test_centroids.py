"""Centroid clustering against brute force."""

import hashlib
import math

import numpy as np

SCHEMA = "vec_id long, embedding array<double>, id string, x int, cluster int, distance double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, 2, 0.5) for i, v in rows], SCHEMA)


def brute(rows, k, rounds, dims, scale=256):
    ok = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
          if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) and abs(c) * scale <= 1 << 27 for c in v)]
    order = sorted(ok, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cent = [list(v) for _, v in order[:k]]

    def assign():
        out = []
        for _, v in ok:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cent]
            j = d.index(min(d))
            out.append((j, d[j]))
        return out
    for _ in range(rounds):
        at = assign()
        for j in range(len(cent)):
            mine = [v for (_, v), (c, _) in zip(ok, at) if c == j]
            if mine:
                cent[j] = [sum(col) // len(mine) for col in zip(*mine)]
    at = assign()
    own = [0] * len(cent)
    for j, d in at:
        own[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted(((i, j, d, own[j], sum(own), sha[j]) for (i, _), (j, d) in zip(ok, at)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_clusters_match_brute_force_and_bounds_save_work(spark):
    from tidewatch.llm.centroids import cluster
    rng = np.random.default_rng(5)
    heart = rng.normal(size=(12, 6))
    rows = [(i, (heart[i % 12] + 0.2 * rng.normal(size=6)).tolist()) for i in range(900)]
    report = {}
    out = cluster(table(spark, rows).repartition(5), k=12, rounds=6, dims=6, report=report)
    assert out.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert got(out) == brute(rows, 12, 6, 6)
    assert report["vectors"] == [900] * 7
    assert report["evaluated"][0] == 900 * 12 and report["evaluated"][-1] < 900 * 12 // 4


def test_displacements_use_the_total_not_the_sum():
    from tidewatch.llm.centroids import displacements
    there_and_back = [np.array([[0, 0]]), np.array([[30, 40]]), np.array([[3, 4]])]
    assert np.allclose(displacements(there_and_back), [[5.0], [45.0], [0.0]])


def test_ties_nulls_repeats_large_and_short(spark):
    from tidewatch.llm.centroids import cluster
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, 1.0]), (4, [0.0, 1.0]), (None, [0.5, 0.5]),
            (None, [0.5, 0.5]), (5, None), (6, []), (7, [1.0]), (8, [nan, 1.0]), (9, [inf, 0.0]), (10, [None, 1.0]),
            (11, [1e9, 0.0]), (12, [-0.0, 400000.0]), (13, [300000.0, -500000.0]), (14, [-1e-9, 1 / 256])]
    for k, rounds in ((3, 4), (40, 2), (1, 0)):
        assert got(cluster(table(spark, rows), k=k, rounds=rounds, dims=2)) == brute(rows, k, rounds, 2)
    assert cluster(table(spark, []), dims=2).count() == 0
    assert cluster(table(spark, [(1, None)]), dims=2).collect() == []
    hot = [(i, [0.25, 0.5]) for i in range(300)] + [(1000 + i, [float(i), 0.0]) for i in range(30)]
    assert got(cluster(table(spark, hot), k=5, rounds=3, dims=2)) == brute(hot, 5, 3, 2)
