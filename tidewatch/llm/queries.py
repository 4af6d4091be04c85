"""Registered queries of this subpackage, one per operator, each over its
whole table, with the DuckDB twin where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm._util import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- 1: SimHash near-dedup -------------------------------------------------

@register("op1_simhash_near_dedup")
def op1(spark, sf_dir):
    from tidewatch.llm.simhash import near_duplicates
    d = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return d.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id")


# --- 4: substring dedup ----------------------------------------------------

_OP4_SQL = r"""WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
own AS (SELECT s, min(doc_id) AS lo FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM win JOIN own USING (s) WHERE doc_id > lo),
gone AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM hit GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.p) AS k
  FROM words a ANTI JOIN hit USING (doc_id, p) GROUP BY a.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.k, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@register("op4_substring_dedup", _OP4_SQL)
def op4(spark, sf_dir):
    from tidewatch.llm.substrings import remove_repeats
    d = remove_repeats(table(spark, sf_dir, "documents"), window=13)
    return d.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


# --- 3: exact top-k search -------------------------------------------------

@register("op3_exact_topk_search", """WITH c AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS id,
         CAST(list_sum(list_transform(range(1, 65), lambda i: abs(q.b[i] - c.b[i]))) AS INTEGER) AS distance
  FROM c q JOIN c ON q.vec_id != c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM p) WHERE rank <= 10""")
def op3(spark, sf_dir):
    from tidewatch.llm.hamming_search import nearest_codes, sign_codes
    from tidewatch.llm._util import Scratch
    codes = Scratch(spark, "codes").save(sign_codes(table(spark, sf_dir, "embeddings")), "codes")
    return nearest_codes(codes, codes.filter("id % 50 = 0"), k=10)


# --- 5: mixing sources to target weights -----------------------------------

TOPIC = "CASE WHEN contains(text, 'License') THEN 'legal' WHEN contains(text, '@') THEN 'contact' ELSE 'prose' END"
MIX_POWER = 0.9


def _op5_sql(sweeps: int = 24) -> str:
    dims = ("source", "lang", "topic")
    ctes = [rf"""d AS (SELECT doc_id, source, lang, {TOPIC} AS topic,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents)""",
            "cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS t FROM d GROUP BY ALL)"]
    goals = []
    for x in dims:
        ctes.append(f"""goal_{x} AS (SELECT {x} AS v, pow(sum(t), {MIX_POWER}) / sum(pow(sum(t), {MIX_POWER})) OVER () AS g
  FROM cells GROUP BY {x} HAVING sum(t) > 0)""")
        goals.append(f"LEFT JOIN goal_{x} ON cells.{x} IS NOT DISTINCT FROM goal_{x}.v")
    ctes.append(f"""r0 AS MATERIALIZED (SELECT source, lang, topic, t, t AS w, sum(t) OVER () AS total,
  {', '.join(f'coalesce(goal_{x}.g, 0) AS g_{x}' for x in dims)} FROM cells {' '.join(goals)})""")
    n = 0
    for _ in range(sweeps):
        for x in dims:
            ctes.append(f"""r{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (w),
  CASE WHEN sum(w) OVER (PARTITION BY {x}) > 0 THEN w * (g_{x} * total / sum(w) OVER (PARTITION BY {x})) ELSE 0 END AS w
  FROM r{n})""")
            n += 1
    ctes.append(f"rate AS (SELECT *, CASE WHEN t > 0 THEN w / t ELSE 0 END AS f FROM r{n})")
    ctes.append("p AS (SELECT *, least(1.0, f / max(f) OVER ()) AS p FROM rate)")
    return "WITH " + ",\n".join(ctes) + """
SELECT d.doc_id, d.topic, round(p.f, 6) AS weight, round(p.p, 6) AS p,
       CAST(CAST('0x' || substr(md5('mix:' || d.doc_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 < p.p AS kept
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic = p.topic"""


def mixed(docs: DataFrame) -> DataFrame:
    """Documents with their mixing weight, probability and draw."""
    from tidewatch.llm.mixing import mix, word_count
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": F.expr(TOPIC)}
    return mix(docs, dims, word_count("text"), power=MIX_POWER)


@register("op5_mixing", _op5_sql())
def op5(spark, sf_dir):
    d = mixed(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.expr(TOPIC).alias("topic"), F.round("mix_weight", 6).alias("weight"),
                    F.round("mix_p", 6).alias("p"), F.col("mix_kept").alias("kept"))


# --- 9: token counts -------------------------------------------------------

#: Tokenizer versions of the count query: words, then words with punctuation split off.
SPLIT_WORD = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


@register("op9_token_counts", rf"""WITH d AS (
  SELECT doc_id, source, lang,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n1,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{SPLIT_WORD}')) AS BIGINT) AS n2
  FROM documents),
k AS (SELECT * FROM d WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))
SELECT source, lang, 'words-1' AS tokenizer, CAST(count(*) AS BIGINT) AS docs, CAST(sum(n1) AS BIGINT) AS tokens
FROM k GROUP BY ALL
UNION ALL
SELECT source, lang, 'words-2', CAST(count(*) AS BIGINT), CAST(sum(n2) AS BIGINT) FROM k GROUP BY ALL""")
def op9(spark, sf_dir):
    """Inserts of all documents under two tokenizer versions (the second
    first with the counts of the first), a revision of all counts of the
    second, deletes of the documents labelled toxic, and replays."""
    from tidewatch.llm._util import Scratch
    from tidewatch.llm.mixing import word_count
    from tidewatch.llm.token_rollup import TokenRollup, change
    scratch = Scratch(spark, "tokens")
    n2 = F.coalesce(F.regexp_count(F.col("text"), F.lit(SPLIT_WORD)), F.lit(0)).cast("long")
    d = table(spark, sf_dir, "documents")
    d = scratch.save(d.select("doc_id", "source", "lang", word_count("text").alias("n1"), n2.alias("n2")), "counts")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    gone = d.join(toxic, "doc_id", "left_semi")
    rollup = TokenRollup(spark, scratch.path("rollup"))
    insert = change(d, "insert", "words-1", F.col("n1")).unionAll(change(d, "insert", "words-2", F.col("n1")))
    revise = change(d, "revise", "words-2", F.col("n2"), F.col("n1"))
    delete = change(gone, "delete", "words-1", F.col("n1")).unionAll(change(gone, "delete", "words-2", F.col("n2")))
    rollup.commit("0001-insert", insert)
    rollup.commit("0002-revise", revise)
    rollup.compact()
    rollup.commit("0003-delete", delete)
    rollup.commit("0002-revise", revise)        # replayed batches add nothing
    rollup.commit("0003-delete", delete)
    return rollup.totals()


# --- 2: WARC ---------------------------------------------------------------

@register("op2_warc", """WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
g AS (SELECT h, max(page_id) AS first FROM p GROUP BY h)
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + (((CAST('0x' || substr(p.x, (i // 4) * 5 + 1, 5) AS BIGINT)) >> (15 - 5 * (i % 4))::INT) & 31) AS INT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN p.page_id = g.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id = g.first THEN NULL ELSE g.first END AS refers_to
FROM p JOIN g USING (h)""")
def op2(spark, sf_dir):
    from tidewatch.llm._util import Scratch
    from tidewatch.llm.warc import page_records, read_archive, write_archive
    path = Scratch(spark, "archive").path("pages")
    write_archive(page_records(table(spark, sf_dir, "pages"), min_bytes=0), path)
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    # responses are read with their payload, revisits by their headers only
    full = read_archive(spark, path).filter("record_type = 'response'")
    again = read_archive(spark, path, payload=False).filter("record_type = 'revisit'")
    both = full.drop("payload").unionByName(again.drop("payload"))
    return both.select(page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
                       "payload_digest", "record_type", page("refers_to").alias("refers_to"))


# --- 6: BPE encoding and decoding ------------------------------------------

@register("op6_bpe_round_trip")
def op6(spark, sf_dir):
    from tidewatch.llm.bpe import encode
    d = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                    F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


# --- 7: token-id / binary output -------------------------------------------

@register("op7_token_packing")
def op7(spark, sf_dir):
    from tidewatch.llm._util import Scratch
    from tidewatch.llm.packing import pack
    rows = Scratch(spark, "packing").save(pack(table(spark, sf_dir, "documents")), "rows")
    return rows.select("pack_id", "n_tokens", F.size("doc_ids").alias("n_segments"), "cu_seqlens", "position_resets",
                       "doc_ids", "doc_offsets", F.sha2(F.col("ids"), 256).alias("ids_sha256"))


# --- 8: language ID --------------------------------------------------------

def held_out():
    """Documents that the language model must not learn from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


@register("op8_language_id")
def op8(spark, sf_dir):
    from tidewatch.llm.lang_id import fit, predict
    d = table(spark, sf_dir, "documents")
    model = fit(d.filter(~held_out()))
    return predict(d.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


# --- 10: embedding near-dedup ----------------------------------------------

@register("op10_embedding_near_dedup", """WITH RECURSIVE e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id != b.vec_id
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.95),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
SELECT e.vec_id, CAST((SELECT count(*) FROM l WHERE l.a = e.vec_id) AS BIGINT) AS n_links,
       least(e.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS component_id,
       e.vec_id <= coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id) AS kept
FROM e""")
def op10(spark, sf_dir):
    from tidewatch.llm.embedding_dedup import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


# --- 11: centroid clustering -----------------------------------------------

def _op11_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    def nearest(c: str) -> str:
        return f"""(SELECT vec_id, arg_min(j, (d, j)) AS j, min(d) AS d FROM (
  SELECT v.vec_id, c.j, list_sum(list_transform(range(1, {dims + 1}),
    lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS d FROM v, {c} c) GROUP BY vec_id)"""
    ctes = [f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {dims})""",
            f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS INTEGER) AS j, x
  FROM v QUALIFY j < {k})"""]
    for t in range(rounds):
        ctes.append(f"a{t} AS MATERIALIZED {nearest(f'c{t}')}")
        ctes.append(f"""s{t} AS (SELECT j, i, sum(v.x[i]) AS s, count(*) AS n
  FROM a{t} JOIN v USING (vec_id), range(1, {dims + 1}) AS r(i) GROUP BY j, i)""")
        ctes.append(f"""c{t + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN (
  SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{t} GROUP BY j) m USING (j))""")
    ctes.append(f"f AS MATERIALIZED {nearest(f'c{rounds}')}")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT f.vec_id, f.j AS cluster, f.d AS distance, CAST(sum(f.d) OVER (PARTITION BY f.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(f.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM f JOIN c{rounds} c ON f.j = c.j"""


@register("op11_centroid_clustering", _op11_sql())
def op11(spark, sf_dir):
    from tidewatch.llm.centroids import cluster
    return cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5).withColumnRenamed("id", "vec_id")


# --- 12: ranked lexical search ---------------------------------------------

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@register("op12_ranked_lexical_search", f"""WITH d AS MATERIALIZED (SELECT doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
q AS (SELECT u, item_id, t, count(*) AS q FROM (
  SELECT u, item_id, unnest({_TERMS}) AS t FROM (SELECT row_number() OVER () AS u, * FROM benchmark)) GROUP BY ALL),
f AS (SELECT doc_id, n, t, count(*) AS f FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM f GROUP BY t), s),
p AS (SELECT doc_id, t, w * ((1000000000 * f) // (1000 * f + 8 * (100 - 75 + (75 * n * n_docs) // total))) AS p
  FROM f JOIN w USING (t), s),
r AS (SELECT u, item_id, doc_id, CAST(sum(q * p) AS BIGINT) AS score FROM q JOIN p USING (t) GROUP BY ALL HAVING sum(q * p) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY u ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r QUALIFY rank <= 10""")
def op12(spark, sf_dir):
    from tidewatch.llm.lexical_search import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


# --- 13: personal data -----------------------------------------------------

@register("op13_personal_data")
def op13(spark, sf_dir):
    from tidewatch.llm.pii import KINDS, personal_data
    found = personal_data(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    of = lambda k: F.filter(base, lambda s: s["kind"] == k)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
