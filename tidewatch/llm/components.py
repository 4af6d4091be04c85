"""Connected components of an edge table, by alternating star contraction.

Nodes are integers; the label of a node is the smallest node it can reach.
Each partition first replaces its edges by a spanning star forest (a
union-find over that partition's edges only), then large-star and small-star
rounds run as joins and minimum aggregates until the edges stop changing.
The number of rounds grows with the logarithm of the longest chain.  The
minimum table of a round is written before it is joined, so that both sides
of the join are plain shuffles: a node with a third of all edges is split by
the adaptive skew join, or the small side is broadcast by its true size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm._util import Scratch


class UnionFind:
    """Smallest-member union-find over hashable nodes."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up = self.up
        r = x
        while (n := up.get(r, r)) != r:
            r = n
        while (n := up.get(x, x)) != r:
            up[x] = r
            x = n
        return r

    def join(self, a, b) -> None:
        a, b = self.root(a), self.root(b)
        if a < b:
            self.up[b] = a
            self.up.setdefault(a, a)
        elif b < a:
            self.up[a] = b
            self.up.setdefault(b, b)


def _forest(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    uf = UnionFind()
    for pdf in rows:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
            uf.join(a, b)
    nodes = list(uf.up)
    for i in range(0, len(nodes), 65536):
        part = nodes[i:i + 65536]
        yield pd.DataFrame({"a": part, "b": [uf.root(x) for x in part]}).query("a != b")


def _stars(e: DataFrame, scratch: Scratch, both: bool, tag: str) -> DataFrame:
    """One star step: every node's larger (``both``) or all smaller
    neighbours are linked to its smallest neighbour (itself included)."""
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    if both:
        arcs = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select("b", "a"))
    else:
        arcs = e.select(hi.alias("u"), lo.alias("v"))
    least = scratch.save(arcs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"min{tag}")
    j = arcs.join(least, "u")
    if both:
        out = j.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = j.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select("u", "m"))
    return out.filter("a != b").distinct()


def connected_components(spark: SparkSession, edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, label) for every node of ``edges(a, b)`` that has an edge to
    another node; ``label`` is the smallest node reachable.  Self loops,
    repeated edges and rows with a null end are allowed and add nothing;
    an empty table gives an empty result."""
    scratch = scratch or Scratch(spark, "components")
    e = (edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
         .filter("a IS NOT NULL AND b IS NOT NULL AND a != b"))
    e = scratch.save(e.mapInPandas(_forest, "a long, b long").distinct(), "edges0")
    seen, old, r = None, ["edges0"], 0
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
                e.select("b", "b").distinct())
        seen, r = state, r + 1
        large = scratch.save(_stars(e, scratch, True, f"L{r}"), f"large{r}")
        e = scratch.save(_stars(large, scratch, False, f"S{r}"), f"edges{r}")
        for name in (*old, f"minL{r}", f"large{r}", f"minS{r}"):
            scratch.drop(name)
        old = [f"edges{r}"]
