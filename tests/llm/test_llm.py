"""Operators of ``tidewatch.llm`` against brute force on small rows, with
nulls, empty and long texts, ties, repeated rows, clashing names and empty
tables."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, rk int, w double, ids string"


def docs(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]) with clashing extra columns."""
    full = [(r[0], r[1], (r + (None, None))[2], (r + (None, None))[3], None if r[1] is None else len(r[1]),
             "x", 1, 0.5, "y") for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(rng, n, kinds=400):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


# --- components ------------------------------------------------------------

def test_components_match_union_find(spark):
    from tidewatch.llm.components import UnionFind, connected_components
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001 + i) for i in range(400)]
    edges += [(rng.randrange(2000, 4000), rng.randrange(2000, 4000)) for _ in range(900)] + [(5, 5), (None, 3)]
    uf = UnionFind()
    for a, b in edges:
        if a is not None and a != b:
            uf.join(a, b)
    got = {r.node: r.label for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: uf.root(x) for x in uf.up}
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 ---------------------------------------------------------------------

def slow_fingerprint(text):
    import re
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_simhash(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[root(i)].append(d)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return Counter((d, f"{fps[i]:016x}", least[root(i)]) for i, (d, _) in enumerate(rows))


def test_simhash_matches_brute_force(spark):
    from tidewatch.llm.simhash import near_duplicates
    rng = random.Random(1)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "a b"), (None, "a b"), (7, "É É É x"),
            (8, "x " * 70000), (9, "x " * 70000), (9, "x " * 70000), (None, "zz yy xx ww"), (10, "a b c\x1cd e")]
    for g in range(12):
        base = words(rng, 120)
        for k in range(6):
            t = list(base)
            for _ in range(k):
                t[rng.randrange(len(t))] = "new"
            rows.append((100 + 10 * g + k, " ".join(t)))
    got = near_duplicates(docs(spark, rows)).collect()
    assert Counter((r.id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in got) == brute_simhash(rows)
    assert near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_ball_edges_connect_all_pairs(spark, bits):
    from tidewatch.llm.components import UnionFind
    from tidewatch.llm.simhash import ball_edges
    rng = random.Random(bits)
    base = [rng.getrandbits(64) for _ in range(3)]
    fps = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(25)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in ball_edges(spark.createDataFrame(signed, "fp long"), bits).collect()]
    assert all(bin(a ^ b).count("1") <= bits for a, b in edges)
    mine, true = UnionFind(), UnionFind()
    for a, b in edges:
        mine.join(a, b)
    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= bits:
                true.join(a, b)
    assert all(mine.root(f) == true.root(f) for f in fps)


def test_one_bit_links_between_buckets_with_smaller_members(spark):
    from tidewatch.llm.simhash import ball_edges
    # 12 and 13 meet only on themselves, where 4 and 9 are the smallest members
    got = {frozenset(r) for r in ball_edges(spark.createDataFrame([(12,), (13,), (4,), (9,)], "fp long"), 1).collect()}
    assert got == {frozenset(p) for p in [(12, 13), (12, 4), (13, 9)]}


# --- 2 ---------------------------------------------------------------------

def test_warc_round_trip(spark, tmp_path):
    from tidewatch.llm.warc import base32_sha1, page_records, read_archive, write_archive
    pages = [(1, "http://a/\r\nX: y", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://d", ""),
             (5, "é", "ü" * 200000), (6, "u", "one"), (None, "n", "same"), (8, "h", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n"),
             (9, "t", "tie"), (9, "t", "tie")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string")
    for options in ({}, {"compression": "none"}, {"max_file_bytes": "2000"}):
        path = str(tmp_path / f"a{len(str(options))}")
        write_archive(page_records(df), path, **options)
        rows = read_archive(spark, path, partition_bytes="1000").collect()
        assert len(rows) == len(pages)
        full = {r.record_id: r.payload for r in rows if r.record_type == "response"}
        kinds = Counter()
        for r in rows:
            body = bytes(full[r.refers_to] if r.record_type == "revisit" else r.payload)
            assert (r.payload_length, r.payload_digest) == (len(body), base32_sha1(body))
            kinds[r.record_id[9:], r.record_type, r.refers_to and r.refers_to[9:], body.decode()] += 1
        want = Counter()
        for i, _, h in pages:
            top = max((p for p, _, x in pages if (x or "") == (h or "") and p is not None), default=None)
            again = i != top
            want["null" if i is None else str(i), "revisit" if again else "response", str(top) if again else None, h or ""] += 1
        assert kinds == want
        heads = read_archive(spark, path, payload=False)
        assert heads.filter("payload IS NOT NULL").count() == 0 and heads.count() == len(pages)
        some = read_archive(spark, path).filter("record_type = 'revisit' AND record_id IN ('urn:page:1', 'urn:page:2')")
        assert "Filter" not in some._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
        assert [r.record_id for r in some.collect()] == ["urn:page:1"]
    empty = str(tmp_path / "empty")
    write_archive(page_records(df.limit(0)), empty)
    assert read_archive(spark, empty).count() == 0


def test_warc_reads_foreign_archives(tmp_path):
    import gzip
    import io

    from tidewatch.llm.warc import parse
    rec = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <u:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    bodies = [b"a" * 100000, b"", b"WARC/1.0\r\n\r\n", b"z"]
    recs = [rec % (b"resource" if i % 2 else b"metadata", i, len(b), b) for i, b in enumerate(bodies)]
    for data, gz in ((b"".join(recs), False), (b"".join(map(gzip.compress, recs)), True), (gzip.compress(b"".join(recs)), True)):
        got = list(parse(io.BytesIO(data), gz, lambda r: r["record_type"] == "resource", True))
        assert [(r["record_id"], r["payload"]) for r in got] == [("u:1", bodies[1]), ("u:3", bodies[3])]


# --- 3 ---------------------------------------------------------------------

def test_hamming_search_matches_full_scan(spark):
    from tidewatch.llm.hamming_search import nearest_codes, sign_codes
    rng = random.Random(5)
    base = [(i, rng.getrandbits(63)) for i in range(150)] + [(200 + i, 77) for i in range(60)]
    base += [(300 + i, 77 ^ 1 << rng.randrange(60)) for i in range(20)] + [(5, base[5][1]), (None, 3), (999, None)]
    q = [b for b in base if b[0] is None or b[0] % 7 == 0] + [(1001, None)]
    mk = lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "id long, code long, d string")
    got = sorted((r.query_id, r.rank, r.id, r.distance) for r in nearest_codes(mk(base), mk(q), 5).filter("query_id IS NOT NULL").collect())
    clean = {b for b in base if None not in b}
    want = []
    for i, c in sorted({x for x in q if None not in x}):
        near = sorted((bin(c ^ d).count("1"), j) for j, d in clean if j != i)[:5]
        want += [(i, r + 1, j, d) for r, (d, j) in enumerate(near)]
    assert got == want
    assert nearest_codes(mk([]), mk(q)).count() == 0 and nearest_codes(mk(base), mk([])).count() == 0
    few = nearest_codes(mk(base[:3]), mk(base[:1]), 5).collect()
    assert sorted(r.id for r in few) == [1, 2]
    v = spark.createDataFrame([(1, [1.0, -1.0, 0.0, float("nan"), 2.0]), (2, None), (3, []), (4, [1.0] * 64)],
                              "vec_id long, embedding array<float>")
    assert {r.id: r.code for r in sign_codes(v).collect()} == {1: 17, 2: None, 3: 0, 4: -1}


# --- 4 ---------------------------------------------------------------------

def brute_repeats(rows, k=13):
    import re
    ws = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    order = lambda d: float("inf") if d is None else d
    for (d, _), w in zip(rows, ws):
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            least[g] = min(least.get(g, float("inf")), order(d))
    out = Counter()
    for (d, _), w in zip(rows, ws):
        gone = set()
        for i in range(len(w) - k + 1):
            if least[tuple(w[i:i + k])] < order(d):
                gone |= set(range(i, i + k))
        out[d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return out


@pytest.mark.parametrize("window,first", [(13, 4), (5, 4), (4, 4), (3, 4), (26, 4), (13, 1)])
def test_substrings_match_brute_force(spark, window, first):
    from tidewatch.llm.substrings import remove_repeats
    rng = random.Random(window)
    passages = [words(rng, n) for n in (13, 14, 12, 40, 90)]
    rows = [(900, None), (901, ""), (902, "one two"), (None, " ".join(passages[3])), (None, " ".join(passages[3] + ["q"])),
            (50, " ".join(["a"] * 60)), (51, " ".join(["a"] * 40)), (903, "x y " * 30000), (3, " ".join(passages[4])),
            (4, " ".join(passages[4])), (4, " ".join(passages[4])), (4, "\n".join(passages[4] + ["z"])),
            (904, "p q\x1cr " * 13), (30, "p q\x1cr " * 13)]
    for i in range(60):
        t = words(rng, rng.randrange(80))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(t) + 1)
            t[at:at] = rng.choice(passages)
        rows.append((100 + i, " ".join(t)))
    got = remove_repeats(docs(spark, rows), window=window, first=first)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()) == brute_repeats(rows, window)


def test_substrings_empty(spark):
    from tidewatch.llm.substrings import remove_repeats
    assert remove_repeats(docs(spark, []), carry=("lang", "fp")).count() == 0


# --- 5 ---------------------------------------------------------------------

def test_mixing_meets_targets(spark):
    from tidewatch.llm.mixing import mix, word_count
    rng = random.Random(2)
    rows = [(i, " ".join(words(rng, rng.randrange(1, 60))), rng.choice(["en", "en", "en", "de", None]),
             rng.choice(["a", "a", "b"])) for i in range(400)] + [(500, None, "zz", "a"), (501, "", None, None), (None, "x", "en", "a"), (7, "x y", "en", "a")]
    d = docs(spark, rows)
    dims = {"lang": F.col("lang"), "source": F.col("source")}
    got = mix(d, dims, word_count(), power=0.5).select("doc_id", "text", "lang", "source", "mix_weight", "mix_p", "mix_kept", "w").collect()
    assert len(got) == len(rows) and all(r.w == 0.5 and 0 <= r.mix_p <= 1 for r in got)
    for c in ("lang", "source"):
        nat, mixed = Counter(), Counter()
        for r in got:
            n = len((r.text or "").split())
            nat[r[c]] += n
            mixed[r[c]] += n * r.mix_p
        t = {k: v ** 0.5 for k, v in nat.items()}
        for k in nat:
            assert mixed[k] / sum(mixed.values()) == pytest.approx(t[k] / sum(t.values()), abs=1e-9)
    assert [r.mix_p for r in got if r.doc_id == 500] == [0.0]
    for r in got:
        u = int(hashlib.md5(f"mix:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert r.mix_kept == (u < r.mix_p)
    assert mix(docs(spark, []), dims, word_count()).count() == 0
    total = sum(len((r[1] or "").split()) for r in rows)
    half = mix(d, dims, word_count(), power=1.0, budget=total / 2).agg(F.min("mix_p"), F.max("mix_p")).first()
    assert half[1] == pytest.approx(0.5)


# --- 6 ---------------------------------------------------------------------

def test_bpe_matches_the_library(spark):
    from tokenizers import Tokenizer

    from tidewatch.llm.bpe import decode, encode, tokenizer_path
    tok = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(4)
    texts = [None, "", " \n", "Hello, world! it's 42", "<|endoftext|>x<|ENDOFTEXT|>", "é É 하", "a" * 9000,
             "".join(rng.choice("abcdeé'1!") for _ in range(30000)), "word " * 4000, "x\x1cy z　w", "'" * 700 + "s"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(8, texts[8]), (None, "nul")]
    got = encode(docs(spark, rows), decoded="decoded", long_chars=5000)
    assert got.columns[:4] == ["doc_id", "text", "lang", "source"]
    out = got.select("doc_id", "text", "ids", "decoded").collect()
    assert len(out) == len(rows)
    for r in out:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == ids, repr(r.text)[:60]
        assert r.decoded == tok.decode(ids, skip_special_tokens=False)
    again = decode(got.select("doc_id", "ids")).collect()
    assert Counter(r.decoded for r in again) == Counter(r.decoded for r in out)
    assert encode(docs(spark, [])).count() == 0


def test_bpe_tree_concatenation():
    from tidewatch.llm.bpe import Bpe, tokenizer_path
    m = Bpe(tokenizer_path())
    rng = random.Random(6)
    kinds = ["a", "b", "the", "é", "é", "'s", "'", "1", "!", "?!", "<|endoftext|>", "ß", "İ", "Σ", "中", "한", "ll", " ", "\n"]
    for _ in range(400):
        pool = rng.sample(kinds, rng.randint(1, len(kinds)))
        t = "".join(rng.choice(pool) for _ in range(rng.choice([1, 5, 40, 300])))
        assert np.array_equal(m.tree(t, rng.choice([1, 7, 33])), m.plain(t)), repr(t)
        assert np.array_equal(m.encode(t), m.plain(t)), repr(t)


# --- 7 ---------------------------------------------------------------------

def test_packing_is_lossless(spark):
    from tidewatch.llm.packing import byte_bpe, pack, ranks_path
    m = byte_bpe(ranks_path())
    rng = random.Random(8)
    rows = [(i, " ".join(words(rng, rng.randrange(200)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "long  text\n\n " * 3000), (None, "no id"), (5, "again"), (5, "again")]
    want = Counter()
    for d, t in rows:
        if t:
            want[d, tuple(m.encoding.encode_ordinary(t)) + (m.eos,)] += 1
    for shard in (1000, 1 << 21):
        got = pack(docs(spark, rows), row_length=256, shard_tokens=shard).collect()
        parts = []
        for r in got:
            ids = np.frombuffer(r.ids, m.dtype)
            assert len(ids) == 256 and r.cu_seqlens[-1] == r.n_tokens <= 256 and r.position_resets == r.cu_seqlens[:-1]
            assert (ids[r.n_tokens:] == m.eos).all()
            parts += [(d, o, tuple(ids[a:b].tolist())) for d, o, a, b in
                      zip(r.doc_ids, r.doc_offsets, r.cu_seqlens, r.cu_seqlens[1:])]
        assert sum(len(p[2]) for p in parts) == sum(len(k[1]) * n for k, n in want.items())
        whole = Counter((d, p) for d, o, p in parts if (d, p) in want)
        assert all(whole[k] == n for k, n in want.items() if len(k[1]) <= 256)
        big = sorted((o, p) for d, o, p in parts if d == 102)
        assert sum((p for _, p in big), ()) in {k[1] for k in want if k[0] == 102}
    assert pack(docs(spark, [])).count() == 0


def test_best_fit_decreasing():
    from tidewatch.llm.packing import best_fit_decreasing
    rng = random.Random(9)
    for _ in range(60):
        most = rng.choice([5, 16, 33])
        lengths = [rng.randint(1, most) for _ in range(rng.randrange(60))]
        rooms, want = [], []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [r for r in rooms if r >= lengths[i]]
            want.append(min(fits) if fits else most)
            if fits:
                rooms.remove(min(fits))
            rooms.append(want[-1] - lengths[i])
        got = best_fit_decreasing(lengths, most)
        assert sorted(i for r in got for i in r) == list(range(len(lengths)))
        assert sorted(most - sum(lengths[i] for i in r) for r in got) == sorted(rooms)


# --- 8 ---------------------------------------------------------------------

def test_language_id(spark):
    from tidewatch.llm.lang_id import fit, predict
    from tidewatch.llm.queries import held_out
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit(d.filter(~held_out()))
    got = predict(d, model).filter(held_out()).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert got[0] >= 0.98 and got[1] > 100
    rows = [(1, None), (2, ""), (3, "123 !? _ ²"), (4, "中文"), (5, "the of and"), (5, "the of and"), (None, "zu und der"), (6, "x" * 3000000)]
    out = predict(docs(spark, rows), model).select("doc_id", "lang_pred", "score", "fp").collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3))
    assert by[4].lang_pred in model.langs and by[5].lang_pred == "en" and by[None].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in out)
    none = fit(docs(spark, [(1, "a b", None), (2, None, "en")]))
    assert none.langs == [] and predict(docs(spark, rows), none).filter("lang_pred != 'und'").count() == 0
    assert predict(docs(spark, []), model).count() == 0


# --- 9 ---------------------------------------------------------------------

def test_token_rollup(spark, tmp_path):
    from tidewatch.llm.token_rollup import TokenRollup, change
    rows = spark.createDataFrame([(1, "a", "en", 5, 7), (2, "a", None, 3, 3), (2, "a", None, 3, 3), (3, None, "en", None, 2)],
                                 "doc_id long, source string, lang string, n long, n2 long")
    r = TokenRollup(spark, str(tmp_path / "r"))
    show = lambda: {(x.source, x.lang, x.tokenizer): (x.docs, x.tokens) for x in r.totals().collect()}
    assert show() == {}
    ins = change(rows, "insert", "v1", F.col("n"))
    assert r.commit("1", ins) and not r.commit("1", ins)
    assert show() == {("a", "en", "v1"): (1, 5), ("a", None, "v1"): (2, 6), (None, "en", "v1"): (1, 0)}
    r.compact()
    assert not r.commit("1", ins)
    (tmp_path / "r" / "batch" / "2").mkdir(parents=True)        # an attempt that died before its commit
    assert r.commit("2", change(rows, "revise", "v1", F.col("n2"), F.col("n")))
    want = {("a", "en", "v1"): (1, 7), ("a", None, "v1"): (2, 6), (None, "en", "v1"): (1, 2)}
    assert show() == want
    r.compact()
    assert show() == want and r.batches() == {"1", "2"}
    assert r.commit("3", change(rows, "delete", "v1", F.col("n2")).unionAll(change(rows, "other", "v9", F.col("n"))))
    assert show() == {}
    assert r.commit("4", change(rows.limit(0), "insert", "v1", F.col("n"))) and show() == {}


# --- 10 --------------------------------------------------------------------

def test_near_vectors_match_brute_force(spark):
    from tidewatch.llm.embedding_dedup import near_vectors
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 16))
    x[300:700] = x[300] + rng.normal(size=(400, 16)) * 0.15
    x[700:760] = x[7]
    x[760:780] = x[8] * 3
    rows = [(i, [float(a) for a in v.astype(np.float32)]) for i, v in enumerate(x)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] + [1.0] * 15), (2004, [None] + [1.0] * 15),
             (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (None, rows[7][1]), (5, rows[5][1]), (2007, [float("inf")] * 16)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int")
    got = near_vectors(df, shard_rows=256).collect()
    ok = [i for i, (_, v) in enumerate(rows) if v and len(v) == 16 and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    y = np.array([rows[i][1] for i in ok])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.95
    np.fill_diagonal(near, False)
    links = {i: int(n) for i, n in zip(ok, near.sum(axis=1))}
    links |= {len(rows) - 5: 1, len(rows) - 4: 1}               # 2005 and 2006
    true = Counter((rows[i][0], links.get(i, 0)) for i in range(len(rows)))
    mine = Counter((r.id, r.n_links) for r in got)
    assert sum((true - mine).values()) <= 0.01 * len(rows)
    lab = np.arange(len(ok))
    while True:
        new = np.array([min(lab[i], lab[near[i]].min(initial=lab[i])) for i in range(len(ok))])
        if (new == lab).all():
            break
        lab = new
    groups = defaultdict(list)
    for i, la in zip(ok, lab):
        groups[la].append(rows[i][0])
    least = Counter((d, min(x for x in g if x is not None)) for g in groups.values() for d in g)
    alone = Counter({(2000, 2000): 1, (2001, 2001): 1, (2002, 2002): 1, (2003, 2003): 1, (2004, 2004): 1, (2007, 2007): 1,
                     (2005, 2005): 1, (2006, 2005): 1})
    assert Counter((r.id, r.component_id) for r in got) == least + alone
    assert all(r.kept == (r.id is not None and r.id == r.component_id) for r in got)
    assert near_vectors(df.limit(0)).count() == 0


def test_near_vectors_recall_of_several_graphs(spark):
    """A hot group of near copies must not hide missed links of other pairs,
    and a link that one end finds counts for both."""
    from tidewatch.llm.embedding_dedup import near_vectors
    rng = np.random.default_rng(3)
    n, hot = 8000, 1500
    x = rng.normal(size=(n, 64))
    x[:hot] = x[0] + rng.normal(size=(hot, 64)) * 0.14
    m = (n - hot) // 3
    x[hot + m:hot + 2 * m] = x[hot:hot + m] + rng.normal(size=(m, 64)) * 0.2
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    report = {}
    got = {r.id: r.n_links for r in near_vectors(df, shard_rows=3000, report=report).collect()}
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.95
    np.fill_diagonal(near, False)
    assert np.array_equal([got[i] for i in range(n)], near.sum(axis=1))
    assert report["shards"] == 3 and report["audit_true"] > 0 and report["audit_recall"] >= 0.995


def test_near_vectors_decide_ties_in_doubles(spark):
    """Pairs within some 1e-9 of the bound are decided as doubles decide."""
    from tidewatch.llm.embedding_dedup import near_vectors
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(64, 64)))
    rows, want = [], {}
    for i in range(30):
        u, w = q[2 * i], q[2 * i + 1]
        c = 0.95 + (1 if i % 2 else -1) * (1 + i) * 2e-10
        rows += [(2 * i, [float(a) for a in u * 3]), (2 * i + 1, [float(a) for a in c * u + np.sqrt(1 - c * c) * w])]
        want |= {2 * i: (i % 2, 2 * i), 2 * i + 1: (i % 2, 2 * i + 1 - i % 2)}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.id: (r.n_links, r.component_id) for r in near_vectors(df).collect()} == want


# --- 5, targets that cannot be met ------------------------------------------

def test_mix_tells_of_unmet_targets(spark):
    from tidewatch.llm.mixing import mix
    rows = [("s1", "en", 100), ("s2", "de", 300)]           # every source holds one language
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, s string, l string, n long")
    share = lambda *r: spark.createDataFrame(r, "value string, share double")
    dims, report = {"source": F.col("s"), "lang": F.col("l")}, {}
    with pytest.warns(UserWarning, match="not met"):
        mix(d, dims, F.col("n"), targets={"source": share(("s1", 0.5), ("s2", 0.5)),
                                          "lang": share(("en", 0.2), ("de", 0.8))}, report=report)
    assert not report["met"] and report["deviation"] > 0.3
    mix(d, dims, F.col("n"), targets={"source": share(("s1", 0.5), ("s2", 0.5)),
                                      "lang": share(("en", 0.5), ("de", 0.5))}, report=report)
    assert report["met"]


# --- pipeline --------------------------------------------------------------

def test_pipeline_near_copies_without_ids(spark):
    import corpus_pipeline as P
    rng = random.Random(11)
    a, b, c, d = (" ".join(words(rng, 300)) for _ in range(4))
    rows = [(1, a), (2, a), (None, a), (3, b), (3, b), (None, c), (None, c), (None, d), (4, None), (5, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    whole = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)
    got = P.simhash_near_dedup(spark, whole.withColumn("fp", F.lit("clash")), "")
    assert got.columns == P.COLUMNS
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(1, a), (3, b), (None, c), (None, d), (4, None)])
    assert P.simhash_near_dedup(spark, whole.limit(0), "").count() == 0


def test_pipeline_near_copies_with_shared_ids(spark):
    import corpus_pipeline as P
    rng = random.Random(12)
    a, b, c = (" ".join(words(rng, 300)) for _ in range(3))
    rows = [(1, a), (1, b), (2, b), (3, a), (0, c), (3, c), (4, c)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
    got = P.simhash_near_dedup(spark, docs, "")
    assert got.columns == P.COLUMNS
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(1, a), (1, b), (0, c)])


def test_pipeline_matches_brute_force(spark, tmp_path):
    import corpus_pipeline as P
    from tokenizers import Tokenizer

    from tidewatch.llm.bpe import tokenizer_path
    from tidewatch.llm.lang_id import fit, predict
    from tidewatch.llm.queries import held_out
    src = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "src0", 0), (9002, "123 456", "en", "src0", 7), (9003, "", None, None, 0)],
                                  src.schema)
    src.unionAll(extra).write.parquet(str(tmp_path / "documents.parquet"))
    whole = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in P.run(spark, str(tmp_path)).collect()}
    # stage by stage, by hand
    pred = {r.doc_id: r for r in predict(whole, fit(whole.filter(~held_out()))).collect()}
    rows = [(r.doc_id, r.text) for r in pred.values() if r.lang_pred != "und" and r.score >= P.MIN_LANGUAGE_SCORE]
    assert {9001, 9002, 9003}.isdisjoint(d for d, _ in rows) and len(rows) >= src.count() - 2
    keep = {d for d, _, c in brute_simhash(rows) if d == c}
    rows = [r for r in rows if r[0] in keep]
    cut = {d: (n, k) for d, w, n, k in brute_repeats(rows) if n == 0 or n < w}
    texts = {d: (t if cut[d][0] == 0 else cut[d][1]) for d, t in rows if d in cut}
    stage4 = P.mixing(spark, whole.select("doc_id", "lang", "source", "n_chars").join(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id"), str(tmp_path))
    assert stage4.columns == P.COLUMNS
    kept = {r.doc_id for r in stage4.collect()}
    assert set(got) == kept and 0 < len(kept) <= len(texts)
    tok = Tokenizer.from_file(tokenizer_path())
    for d in kept:
        ids = tok.encode(texts[d], add_special_tokens=False).ids
        assert list(got[d].ids) == ids and got[d].n_tokens == len(ids)
        assert got[d].decoded == tok.decode(ids, skip_special_tokens=False)
