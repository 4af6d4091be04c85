"""Embedding near-duplicates by sharded small-world graphs.

Equal vectors are folded into one class first, so a vector that a third of
all rows share costs one node.  Classes are dealt to shards of bounded size
by a hash, every shard gets a navigable small-world graph, and the classes of
every shard query every shard, in blocks.  A beam is widened

* for each query whose beam is filled with links, until it is not, and
* for a whole block, when an audit of some of its queries against all vectors
  of the shard finds less than ``recall`` of the links of any one of them
  (hits on the query itself are no links),

as long as a wider beam costs less than a scan of the shard; then the shard
is scanned, once, so the audit always passes in the end.

A shard holds ``SHARD_BYTES`` of vectors (16,384 of 64 components) unless
``shard_rows`` says otherwise.  Graphs search in float32; a similarity further
from the bound than float32 can err is decided by it, any other is verified
as a cosine of the vectors themselves, in double precision and with the same
result from both ends.  A group returns link counts and a spanning forest of
its links, never the pairs, and the forests' components are united over all
groups.

A link that only one of its ends finds counts for both: every group also
returns an exclusive-or of its links' hashes, per query and per node found.
Where the two differ for a vector and a shard, the links found from it are
not those found towards it, and that vector scans that shard.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._util import Scratch, mix64
from tidewatch.llm.components import connected_components
from tidewatch.llm.hnsw import Graph

COSINE = 0.95
#: Bytes of a shard's vectors, audited queries of a block.
SHARD_BYTES = 4 << 20
AUDIT = 32
RECALL = 0.995
EF = 32
#: Vectors that a scan compares in the time that a beam spends on one of its places.
SCAN_SPEED = 1024
_BLOCK = 256
_PAIRS = 1 << 16


class Doubles:
    """Vectors in double precision, by component, with their lengths."""

    def __init__(self, rows):
        self.t = np.ascontiguousarray(np.stack([np.asarray(v, np.float64) for v in rows]).T)
        every = np.arange(self.t.shape[1])
        self.norm = np.sqrt(self.dots(every, self, every))

    def dots(self, a: np.ndarray, other: Doubles, b: np.ndarray) -> np.ndarray:
        """Products of pairs, summed component by component, so that a pair
        gives the same double from both ends."""
        out = np.zeros(len(a))
        for x, y in zip(self.t, other.t):
            out += x[a] * y[b]
        return out

    def cosines(self, a: np.ndarray, other: Doubles, b: np.ndarray) -> np.ndarray:
        return self.dots(a, other, b) / (self.norm[a] * other.norm[b])

    def unit(self) -> np.ndarray:
        return np.ascontiguousarray((self.t / self.norm).T, np.float32)

    def packed(self, order: np.ndarray) -> np.ndarray:
        """Rows in ``order``, as float32 where that loses nothing."""
        rows = self.t.T[order]
        with np.errstate(over="ignore"):
            short = rows.astype(np.float32)
        return short if np.array_equal(short, rows) else rows


def _scan_beats(graph: Graph, ef: int) -> bool:
    return SCAN_SPEED * ef >= len(graph.x)


def _links_of_block(graph: Graph, q: np.ndarray, bound: float, ef: int | None):
    """(query, node, similarity) candidates of one block of queries by beams
    of width ``ef`` (None: by a scan).  Queries whose beam is full of them
    widen it, or scan where that costs less."""
    at, to, sims, open_ = [], [], [], np.arange(len(q))
    while len(open_) and ef is not None:
        sim, ids = graph.search(q[open_], ef)
        good = sim >= bound
        full = good.all(axis=1) & (sim.shape[1] >= ef)
        r, c = np.nonzero(good & ~full[:, None])
        at.append(open_[r]), to.append(ids[r, c]), sims.append(sim[r, c])
        open_ = open_[full]
        ef = None if _scan_beats(graph, 2 * ef) else 2 * ef
    if len(open_):
        sim = q[open_] @ graph.x.T
        r, c = np.nonzero(sim >= bound)
        at.append(open_[r]), to.append(c), sims.append(sim[r, c])
    return np.concatenate(at), np.concatenate(to), np.concatenate(sims)


def _audit(graph: Graph, q: np.ndarray, me: np.ndarray, bound: float, real, asker: np.ndarray):
    """(found, true) links of the audited queries of a block: some of those
    with a link to another vector (``asker``: the block's links) and a
    spread over all."""
    found = np.bincount(asker, minlength=len(q))
    seen = np.flatnonzero(found)
    linked = seen[:: max(1, len(seen) // (AUDIT // 2))][:AUDIT // 2]
    spread = np.arange(0, len(q), max(1, len(q) // (AUDIT // 2)))[:AUDIT // 2]
    sample = np.union1d(linked, spread)
    sim = q[sample] @ graph.x.T
    r, c = np.nonzero(sim >= bound)
    s, r = sim[r, c], sample[r]
    ok = (c != me[r]) & real(r, c, s)
    return found[sample], np.bincount(r[ok], minlength=len(q))[sample]


def shard_links(graph: Graph, nodes: Doubles, asked: Doubles, cosine: float, recall: float,
                own: np.ndarray | None = None, ef: int | None = EF) -> Iterator[tuple]:
    """Links (query index, node) between ``asked`` and other vectors of a
    shard (``nodes``, in the graph's order), a block of queries at a time, and
    the (found, true) links of the block's last audit.  ``own`` is the node of
    each query itself (-1: not in the shard); hits on it are no links.  An
    ``ef`` of None scans the shard."""
    q32, slack = asked.unit(), max(1e-5, (len(asked.t) + 4) * 2.0 ** -23)
    own = np.full(len(q32), -1) if own is None else own
    bound = cosine - slack
    for i in range(0, len(q32), _BLOCK):
        q, me, width = q32[i:i + _BLOCK], own[i:i + _BLOCK], ef

        def real(r, c, sim):
            ok = sim >= cosine + slack
            for j in np.array_split(np.flatnonzero(~ok), max(1, int((~ok).sum()) // _PAIRS)):
                ok[j] = asked.cosines(i + r[j], nodes, c[j]) >= cosine
            return ok

        while True:
            a, b, sim = _links_of_block(graph, q, bound, width)
            ok = (b != me[a]) & real(a, b, sim)
            a, b = a[ok], b[ok]
            told = (0, 0)
            if width is None:
                break
            found, true = _audit(graph, q, me, bound, real, a)
            if (found >= recall * true).all():
                told = int(found.sum()), int(true.sum())
                break
            width = None if _scan_beats(graph, 2 * width) else 2 * width
        yield i + a, b, told


def _link_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash per link, the same from both ends."""
    return mix64(np.minimum(a, b).astype(np.uint64), np.maximum(a, b).astype(np.uint64)).view(np.int64)


class Forest:
    """Components of links given a few queries at a time, over positions of
    the sorted ``ids``; every root is its component's smallest position."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.up = np.arange(len(ids))
        self.used = np.zeros(len(ids), bool)

    def _roots(self, at: np.ndarray) -> np.ndarray:
        r = self.up[at]
        while (n := self.up[r]).tobytes() != r.tobytes():
            r = n
        return r

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links between positions, those of one ``a`` side by side."""
        cut = np.flatnonzero(np.diff(a, prepend=-1, append=-1))
        for i, j in zip(cut[:-1], cut[1:]):
            at = np.append(b[i:j], a[i])
            roots = self._roots(at)
            least = roots.min()
            self.up[roots] = least
            self.up[at] = least
            self.used[at] = True

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.used)
        return self.ids[at], self.ids[self._roots(at)] if len(at) else self.ids[at]


def near_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
                 shard_rows: int | None = None, recall: float = RECALL, report: dict | None = None) -> DataFrame:
    """One row (id, n_links, component_id, kept) per row of ``vectors``.

    ``n_links`` counts the other rows linked directly (cosine at least
    ``cosine``), ``component_id`` is the smallest id reachable over links
    (the row's own included), ``kept`` says whether that is the row's own.
    Vectors that are null, empty, zero or hold a null or non-finite
    component link with nothing, and vectors of different lengths do not
    link.  Rows with a null id count and link like others but are never the
    smallest id nor kept.  Repeated rows link with each other.  Other
    columns are ignored; an empty table gives an empty result.

    ``report``, when given, receives ``audit_found`` and ``audit_true``
    (links of the audited queries of blocks that a beam answered),
    ``audit_recall`` (None without such links), ``shards`` and ``repaired``
    (pairs of a vector and a shard scanned because a link was found from one
    end only); the same goes to the log.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("ok", F.coalesce((F.size("v") > 0) & fine, F.lit(False)))
    good = rows.filter("ok").select("id", F.transform("v", lambda c: c + F.lit(0.0)).alias("v"))
    classes = good.groupBy("v").agg(F.min("id").alias("lo"), F.count("*").alias("n"))
    classes = classes.select(F.monotonically_increasing_id().alias("cls"), "lo", "n", "v", F.size("v").alias("dims"))
    classes = scratch.save(classes, "classes")
    most = F.greatest(F.floor(F.lit(SHARD_BYTES) / (4 * F.col("dims"))), F.lit(1)) if shard_rows is None else F.lit(shard_rows)
    counts = classes.groupBy("dims").agg(F.count("*").alias("c")).select(
        "dims", F.ceil(F.col("c") / most).cast("int").alias("shards"))
    counts = scratch.save(counts, "counts")
    dealt = classes.join(counts, "dims").select(
        "cls", "n", "v", "dims", "shards", F.pmod(F.xxhash64("cls"), F.col("shards")).cast("int").alias("shard"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = Doubles(pdf["v"])
        g = Graph(rows.unit(), pdf["cls"].to_numpy().astype(np.uint64))
        order = pd.Index(pdf["cls"]).get_indexer(g.keys.astype(np.int64))
        size = pdf["n"].to_numpy()[order]
        return pd.DataFrame({"dims": pdf["dims"].iloc[:1], "shard": pdf["shard"].iloc[:1], "shards": pdf["shards"].iloc[:1],
                             "graph": [g.dump(rows.packed(order))], "sizes": [size.astype(np.int64).tobytes()]})

    cores = max(1, spark.sparkContext.defaultParallelism)
    graphs = (dealt.select("cls", "n", "v", "dims", "shard", "shards").repartition(4 * cores, "dims", "shard")
              .groupBy("dims", "shard").applyInPandas(build, "dims int, shard int, shards int, graph binary, sizes binary"))
    graphs = scratch.save(graphs, "graphs")
    # the queries of a group are those of one shard, ``home``; they ask one shard
    asked = dealt.select("cls", "n", "v", "dims", F.col("shard").alias("home"),
                         F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    held = graphs.withColumn("home", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")

    def query(scan: bool):
        def run(q: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
            if not len(q) or not len(g):
                return pd.DataFrame({"kind": [], "a": [], "b": [], "shard": [], "h": []})
            graph, size = Graph.load(g["graph"].iloc[0]), np.frombuffer(g["sizes"].iloc[0], np.int64)
            nodes = Doubles(graph.x)
            graph.x = nodes.unit()
            cls, keys = q["cls"].to_numpy(np.int64), graph.keys.astype(np.int64)
            home, shard = int(g["home"].iloc[0]), int(g["shard"].iloc[0])
            own = pd.Index(keys).get_indexer(cls)
            ids = np.unique(np.concatenate([cls, keys]))
            forest, cls_at, key_at = Forest(ids), np.searchsorted(ids, cls), np.searchsorted(ids, keys)
            n, found, true = np.zeros(len(cls), np.int64), 0, 0
            there, back, hit = np.zeros(len(cls), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
            for a, b, told in shard_links(graph, nodes, Doubles(q["v"]), cosine, recall, own, None if scan else EF):
                order = np.argsort(a, kind="stable")
                a, b = a[order], b[order]
                np.add.at(n, a, size[b])
                forest.join(cls_at[a], key_at[b])
                h = _link_hash(cls[a], keys[b])
                np.bitwise_xor.at(there, a, h)
                np.bitwise_xor.at(back, b, h)
                hit[b] = True
                found, true = found + told[0], true + told[1]
            ends, roots = forest.edges()
            out = [pd.DataFrame({"kind": "edge", "a": ends, "b": roots, "shard": shard, "h": 0})]
            if scan:
                out.append(pd.DataFrame({"kind": "count", "a": cls, "b": n, "shard": shard, "h": 0}))
            else:
                out += [pd.DataFrame({"kind": "count", "a": cls[n > 0], "b": n[n > 0], "shard": shard, "h": there[n > 0]}),
                        pd.DataFrame({"kind": "back", "a": keys[hit], "b": 0, "shard": home, "h": back[hit]}),
                        pd.DataFrame({"kind": "audit", "a": [found], "b": [true], "shard": shard, "h": 0})]
            return pd.concat(out)
        return run

    keys, links = ["dims", "home", "shard"], "kind string, a long, b long, shard int, h long"
    got = (asked.repartition(4 * cores, *keys).groupBy(*keys)
           .cogroup(held.repartition(4 * cores, *keys).groupBy(*keys)).applyInPandas(query(False), links))
    got = scratch.save(got, "found")
    # a shard that a vector found other links in than it was found from is scanned by it
    uneven = (got.filter("kind IN ('count', 'back')").groupBy(F.col("a").alias("cls"), "shard")
              .agg(F.bit_xor("h").alias("h")).filter("h != 0").select("cls", "shard"))
    uneven = scratch.save(uneven, "uneven")
    repaired = uneven.count()
    if repaired:
        again = asked.join(uneven, ["cls", "shard"])
        needed = held.join(again.select(*keys).distinct(), keys, "left_semi")
        more = (again.select(*asked.columns).repartition(4 * cores, *keys).groupBy(*keys)
                .cogroup(needed.repartition(4 * cores, *keys).groupBy(*keys)).applyInPandas(query(True), links))
        more = scratch.save(more, "scanned")
        kept = got.join(uneven.select(F.col("cls").alias("a"), "shard", F.lit("count").alias("kind")),
                        ["a", "shard", "kind"], "left_anti").select(*got.columns)
        got = kept.unionAll(more.select(*got.columns))
    told = got.filter("kind = 'audit'").agg(F.sum("a"), F.sum("b")).first()
    found, true = told[0] or 0, told[1] or 0
    figures = {"audit_found": found, "audit_true": true, "audit_recall": found / true if true else None,
               "shards": counts.agg(F.sum("shards")).first()[0] or 0, "repaired": repaired}
    logging.getLogger(__name__).info("audit of near vectors: %s", figures)
    if report is not None:
        report.update(figures)
    cc = connected_components(spark, got.filter("kind = 'edge'").select("a", "b"), scratch)
    cc = scratch.save(cc.withColumnRenamed("node", "cls"), "cc")
    links = got.filter("kind = 'count'").groupBy(F.col("a").alias("cls")).agg(F.sum("b").alias("far"))
    named = classes.select("cls", "lo", "n", "v").join(cc, "cls", "left").join(links, "cls", "left")
    named = scratch.save(named.select("v", "lo", F.coalesce("label", "cls").alias("label"),
                                      (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("n_links")), "named")
    least = named.groupBy("label").agg(F.min("lo").alias("component_id"))
    label = scratch.save(named.join(least, "label").select("v", "n_links", "component_id"), "labels")
    out = good.join(label, "v").select("id", "n_links", "component_id")
    alone = rows.filter("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.unionAll(alone)
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
