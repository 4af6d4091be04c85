"""Embedding near-duplicates: a loose hot group over several shards."""

from itertools import pairwise

import numpy as np


def near_pairs(x):
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.95
    np.fill_diagonal(near, False)
    return near


def loose(rng, n, hot):
    """Vectors of which ``hot`` lie around one centre with cosines around the
    bound, so that each links with some of the others only."""
    x = rng.normal(size=(n, 64))
    x[:hot] = x[0] + rng.normal(size=(hot, 64)) * rng.uniform(0.1, 0.3, size=(hot, 1))
    m = (n - hot) // 3
    x[hot + m:hot + 2 * m] = x[hot:hot + m] + rng.normal(size=(m, 64)) * 0.2
    return x.astype(np.float32)


def test_loose_hot_group_in_four_shards(spark):
    from tidewatch.llm.embedding_dedup import near_vectors
    x = loose(np.random.default_rng(11), 9000, 3000)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    report = {}
    got = {r.id: (r.n_links, r.component_id) for r in near_vectors(df, shard_rows=2250, report=report).collect()}
    near = near_pairs(x)
    want = near.sum(axis=1)
    mine = np.array([got[i][0] for i in range(len(x))])
    recall = np.minimum(mine, want).sum() / want.sum()
    print("links", int(want.sum()), "recall", recall, report)
    assert (mine <= want).all() and recall >= 0.995 and report["shards"] == 4
    single = np.flatnonzero(want == 1)
    assert len(single) > 1000 and (mine[single] == 1).mean() >= 0.995


def test_beams_widen_before_a_scan(monkeypatch):
    """With scans made dear, saturated beams widen and still find all links."""
    from tidewatch.llm import embedding_dedup as e
    from tidewatch.llm.hnsw import Graph
    x = loose(np.random.default_rng(12), 1500, 300)
    rows = e.Doubles(x)
    g = Graph(rows.unit(), np.arange(len(x), dtype=np.uint64))
    nodes = e.Doubles(x[g.keys.astype(int)])
    widths = []
    search = g.search
    monkeypatch.setattr(g, "search", lambda q, ef: (widths.append(ef), search(q, ef))[1])
    monkeypatch.setattr(e, "SCAN_SPEED", 1)
    own = np.argsort(g.keys)
    got = [np.stack([a, g.keys[b].astype(int)]) for a, b, _ in e.shard_links(g, nodes, rows, 0.95, 0.995, own)]
    near = near_pairs(x)
    found = np.zeros_like(near)
    found[tuple(np.concatenate(got, axis=1))] = True
    assert set(widths) >= {32, 64, 128, 256}
    assert not (found & ~near).any() and (found & near).sum() >= 0.995 * near.sum()


def test_forest_unites_links_given_in_parts():
    from tidewatch.llm.embedding_dedup import Forest
    f = Forest(np.arange(100, 120))
    chain = list(pairwise([3, 9, 1, 15, 7]))
    for a, b in [*chain, (10, 11), (12, 11)]:
        f.join(np.array([a]), np.array([b]))
    f.join(np.array([17, 17, 18]), np.array([16, 19, 2]))
    ends, roots = f.edges()
    assert dict(zip(ends.tolist(), roots.tolist())) == {
        **dict.fromkeys([101, 103, 107, 109, 115], 101), **dict.fromkeys([110, 111, 112], 110),
        **dict.fromkeys([116, 117, 119], 116), 102: 102, 118: 102}
