"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

DOCS = "doc_id long, text string, item_id string, score int, n int, t string"
ITEMS = "item_id long, text string, uid string, doc_id int, terms int"


def slow_terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k):
    d = [(i, slow_terms(t)) for i, t in docs]
    d = [(i, len(w), Counter(w)) for i, w in d if w]
    n_docs, total = len(d), sum(n for _, n, _ in d)
    df = Counter(w for _, _, c in d for w in c)
    out = []
    for item, text in items:
        q, got = Counter(slow_terms(text)), []
        for i, n, c in d:
            m = 100 - 75 + 75 * n * n_docs // total
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1000000000 * c[w] // (1000 * c[w] + 8 * m))
                    for w, r in q.items() if w in c)
            if s > 0:
                got.append((-s, i is None, i, s))
        got.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, j + 1, i, s) for j, (_, _, i, s) in enumerate(got[:k])]
    return sorted(out, key=repr)


def run(spark, docs, items, **more):
    from tidewatch.llm.lexical_search import search
    a = spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in docs], DOCS).repartition(4)
    b = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in items], ITEMS)
    out = search(a, b, **more)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_search_matches_brute_force_in_one_block_and_in_many(spark):
    rng = random.Random(4)
    word = lambda: f"{rng.choice(['the', 'of', 'Sea', 'été', 'x9', 'ÀB'])}{rng.choice(['', '', rng.randrange(60)])}"
    docs = [(i, rng.choice([" ", "-", "\t", "_"]).join(word() for _ in range(rng.randrange(0, 60)))) for i in range(700)]
    docs += [(1000 + i, "the of the sea") for i in range(900)]         # a hot group of equal scores
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 25)))) for i in range(25)]
    want = brute(docs, items, 10)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, block_terms=30, block_items=9) == want


def test_search_edge_cases(spark):
    docs = [(3, "Alpha beta"), (1, "alpha beta"), (None, "alpha beta"), (2, None), (4, ""), (5, "!? \x7f"),
            (6, "gamma"), (6, "gamma"), (7, "beta " * 40000), ((1 << 63) - 1, "gamma"), (None, "gamma")]
    items = [(1, "ALPHA alpha"), (1, "beta"), (None, "gamma"), (2, None), (3, " - "), (4, "unseen"), (5, "Gamma! gamma")]
    for k in (2, 4, 10):
        assert run(spark, docs, items, k=k) == brute(docs, items, k)
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == []
    assert run(spark, [(1, None)], items) == []


def test_heaps_stay_bounded():
    import numpy as np
    from tidewatch.llm.lexical_search import Heaps
    h = Heaps(1, 3)
    for i in range(50):
        h.offer(np.full((4, 1), 7), np.arange(4 * i, 4 * i + 4), np.ones(4, bool))
    assert sorted(h.rows()) == [(0, 0, 7), (0, 1, 7), (0, 2, 7)]
