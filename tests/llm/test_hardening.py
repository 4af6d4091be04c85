"""Clashing column names, concurrent commits, long payloads, far queries."""

import gzip
import io
import random
import time

import numpy as np
from pyspark.sql import functions as F


def test_mix_with_columns_named_like_its_own(spark):
    from tidewatch.llm.mixing import mix, word_count
    rows = [(i, "a b c"[: 1 + 2 * (i % 3)], "en" if i % 4 else "de", f"s{i % 5}", 7.0, "x", i, 1.5, "y", "z") for i in range(80)]
    plain = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix_p double, _mix_source string, "
                                      "_mix_0 long, mix_weight double, _doc_0 string, _drawn string")
    dims = lambda: {"source": F.col("source"), "lang": F.col("lang")}
    a, b = (mix(d, dims(), word_count("text"), power=0.5) for d in (plain, odd))
    show = lambda d: sorted((r.doc_id, round(r.mix_weight, 9), round(r.mix_p, 9), r.mix_kept) for r in d.collect())
    assert show(a) == show(b)
    kept = b.select("doc_id", "_mix_source", "_mix_0", "_doc_0", "_drawn").collect()
    assert {(r.doc_id, r._mix_source, r._mix_0, r._doc_0, r._drawn) for r in kept} == {(r[0], "x", r[6], "y", "z") for r in rows}


def test_raking_has_no_single_partition_exchange_of_cells(spark):
    from tidewatch.llm._util import Scratch
    from tidewatch.llm.mixing import rake, tempered_targets
    cells = spark.createDataFrame([(f"s{i % 7}", "en" if i % 3 else "de", 10 + i) for i in range(21)], "source string, lang string, tokens long")
    cells = cells.groupBy("source", "lang").agg(F.sum("tokens").alias("tokens"))
    got = rake(cells, ["source", "lang"], {d: tempered_targets(cells, d, 0.5) for d in ("source", "lang")}, Scratch(spark, "rake"))
    total = sum(r.tokens for r in cells.collect())
    for d in ("source", "lang"):
        want = {r.value: r.share for r in tempered_targets(cells, d, 0.5).collect()}
        have = {r[0]: r.w / total for r in got.groupBy(d).agg(F.sum("w").alias("w")).collect()}
        assert all(abs(have[k] / want[k] - 1) < 1e-9 for k in want)
    plan = tempered_targets(cells, "lang", 0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_encode_with_columns_named_like_its_own(spark):
    from tidewatch.llm.bpe import encode
    texts = ["short one", "long text " * 400, None, ""]
    plain = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    odd = spark.createDataFrame([(i, t, "k", "l", 5, 1) for i, t in enumerate(texts)],
                                "doc_id long, text string, key string, _key string, long_ids int, _LONG_IDS int")
    a = {r.doc_id: r.ids for r in encode(plain, long_chars=500).collect()}
    b = {r.doc_id: (r.ids, r.key, r["_key"], r.long_ids, r["_LONG_IDS"]) for r in encode(odd, long_chars=500).collect()}
    assert b == {i: (ids, "k", "l", 5, 1) for i, ids in a.items()} and len(a[1]) > 400


def test_rollup_commits_during_compaction_and_totals_read_after_it(spark, tmp_path, monkeypatch):
    from tidewatch.llm.token_rollup import TokenRollup, change
    r = TokenRollup(spark, str(tmp_path / "rollup"))
    d = spark.createDataFrame([("s", "en", 3)], "source string, lang string, n long")
    add = lambda b: r.commit(b, change(d, "insert", "v", F.col("n")))
    show = lambda t: [(x.docs, x.tokens) for x in t.collect()]
    assert add("a")
    before = r.totals()
    listed = r._done

    def listing(kind):
        out = listed(kind)
        if kind == "batch" and not r.committed("b"):
            add("b")            # a batch committed right after the listing
        return out
    monkeypatch.setattr(r, "_done", listing)
    r.compact()
    monkeypatch.undo()
    assert show(r.totals()) == [(2, 6)] and show(before) == [(1, 3)]
    assert not add("a") and not add("b") and r.batches() == {"a", "b"}
    r.compact()
    r.compact()
    assert show(r.totals()) == [(2, 6)] and show(before) == [(1, 3)]
    time.sleep(1.1)
    r.expire(0)
    assert show(r.totals()) == [(2, 6)] and not r._done("batch") and len(r._done("base")) == 1
    assert not add("a") and add("c") and show(r.totals()) == [(3, 9)]
    r.compact(0)
    assert not add("c") and show(r.totals()) == [(3, 9)] and r.batches() == {"a", "b", "c"}


def test_long_incompressible_payload_is_read_in_linear_time():
    from tidewatch.llm.warc import parse
    body = np.random.default_rng(0).bytes(48 << 20)
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    data = gzip.compress(head + body + b"\r\n\r\n", 1)
    start = time.perf_counter()
    rows = list(parse(io.BytesIO(data), True, lambda row: True, True))
    assert len(rows) == 1 and rows[0]["payload"] == body and time.perf_counter() - start < 10


def test_far_queries_over_wide_segments(spark, monkeypatch):
    """Two segments of 32 bits, patterns dealt to several blocks, and a query
    that is far from everything."""
    from tidewatch.llm import hamming_search as h
    rng = random.Random(3)
    monkeypatch.setattr(h, "_segments", lambda n: [(0, 32), (32, 32)])
    monkeypatch.setattr(h, "BLOCK_FLIPS", 1000)
    monkeypatch.setattr(h, "BLOCK_QUERIES", 2)
    signed = lambda c: c - (1 << 64) if c >> 63 else c
    base = rng.getrandbits(64)
    codes = [(i, base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 6)))) for i in range(60)]
    asks = [(1000, base), (1001, base ^ 0x0000000700000007), (1002, base ^ (1 << 63)), (1003, codes[5][1])]
    df = lambda rows: spark.createDataFrame([(i, signed(c), "x") for i, c in rows], "id long, code long, n string")
    got = sorted((r.query_id, r.rank, r.id, r.distance) for r in h.nearest_codes(df(codes), df(asks), k=5).collect())
    want = []
    for q, c in asks:
        near = sorted((bin(c ^ x).count("1"), i) for i, x in codes)[:5]
        want += [(q, j + 1, i, d) for j, (d, i) in enumerate(near)]
    assert got == sorted(want)
    assert h._patterns(h._patterns(h._patterns(None, 5, spark, s := h.Scratch(spark, "p"), 0), 5, spark, s, 1), 5, spark, s, 2).count() == 10
