"""Centroid clustering (Lloyd's rounds) with ns-bounds.

Vectors become integers, so that every distance, sum and centroid is exact.
Beside a vector's cluster the state holds, per centroid, the distance at its
last evaluation and the round of that evaluation.  The history of centroids
gives the norm of a centroid's *total* displacement since then, which by the
triangle inequality loosens the old distance into a bound: one displacement
from there to here, never longer than the sum of the rounds' drifts.

* A vector whose own centroid is bounded below every other centroid stays;
  nothing is evaluated.
* Otherwise the distance to its own centroid is evaluated, then those to the
  centroids whose lower bound does not exceed it.  A skipped centroid is
  strictly farther, so ties are decided exactly.

A round is one pass without a shuffle over the state table, which is written
to the shared folder.  Vectors that changed cluster are subtracted from the
old sums and added to the new ones; a task sends one row per cluster that it
touched.  The driver holds the centroids of all rounds (``k`` x ``dims`` x
``rounds`` numbers), nothing that grows with the vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm._util import Scratch, batches_of

#: Components beyond this have squared distances that may not fit 64 bits.
LARGEST = 1 << 27
_BATCH = 4096
_PAIRS = 1 << 16
#: Relative slack of stored (32-bit) distances and of displacements.
_F32, _F64 = 3e-7, 1e-9


def _square(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``c``."""
    most = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    if x.shape[1] * 4 * int(most) ** 2 < 1 << 53:       # every partial sum is an exact double
        a, b = x.astype(float), c.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


def _square_pairs(x: np.ndarray, r: np.ndarray, c: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows ``r`` of ``x`` to the rows ``j`` of ``c``."""
    out = np.empty(len(r), np.int64)
    for i in range(0, len(r), _PAIRS):
        gap = x[r[i:i + _PAIRS]] - c[j[i:i + _PAIRS]]
        out[i:i + _PAIRS] = np.einsum("nd,nd->n", gap, gap)
    return out


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """Norm of every centroid's displacement from each round to the last one."""
    gaps = np.stack(history).astype(float) - history[-1].astype(float)
    return np.sqrt((gaps * gaps).sum(axis=2)) * (1 + _F64)


def reassign(x: np.ndarray, own: np.ndarray, near: np.ndarray, seen: np.ndarray,
             history: list[np.ndarray], moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New clusters of ``x`` and the number of distances evaluated per row.
    ``near`` and ``seen`` (distance at, and round of, the last evaluation per
    centroid) are brought up to date in place."""
    c, now = history[-1], len(history) - 1
    every = np.arange(len(c))
    gap = moved[seen, every]
    at = np.arange(len(x))
    upper = near[at, own] * (1 + _F32) + gap[at, own]
    lower = near * (1 - _F32) - gap
    lower[at, own] = np.inf
    fail = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
    asked = np.zeros(len(x), np.int32)
    if not len(fail):
        return own, asked
    mine = own[fail]
    d = np.full((len(fail), len(c)), np.iinfo(np.int64).max)
    d[np.arange(len(fail)), mine] = _square_pairs(x, fail, c, mine)
    here = np.sqrt(d[np.arange(len(fail)), mine])
    r, j = np.nonzero(lower[fail] <= (here * (1 + _F64))[:, None])
    d[r, j] = _square_pairs(x, fail[r], c, j)
    r, j = np.concatenate([r, np.arange(len(fail))]), np.concatenate([j, mine])
    near[fail[r], j], seen[fail[r], j] = np.sqrt(d[r, j]), now
    asked[fail] = np.bincount(r, minlength=len(fail))
    new = own.copy()
    new[fail] = d.argmin(axis=1)        # the first of equal distances
    return new, asked


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def _fixed(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _round(history: list[np.ndarray], dims: int, last: bool):
    """The pass of one round over the state's record batches."""
    k, now, moved = len(history[-1]), len(history) - 1, displacements(history)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, _BATCH):
            if not b.num_rows:
                continue
            x = _matrix(b.column("x"), dims)
            if now == 0:
                d = _square(x, history[0])
                was, new = np.full(len(x), -1, np.int32), d.argmin(axis=1).astype(np.int32)
                near, seen = np.sqrt(d).astype(np.float32), np.zeros((len(x), k), np.uint16)
                asked = np.full(len(x), k, np.int32)
            else:
                was = b.column("cluster").to_numpy().astype(np.int32)
                near, seen = (_fixed(b.column(n), t, k).copy() for n, t in (("near", np.float32), ("seen", np.uint16)))
                new, asked = reassign(x, was, near, seen, history, moved)
                new = new.astype(np.int32)
            out = [b.column("id"), b.column("x"), pa.array(new), pa.array(was), pa.array(asked)]
            if last:
                out.append(pa.array(_square_pairs(x, np.arange(len(x)), history[-1], new)))
                names = ["id", "x", "cluster", "was", "asked", "distance"]
            else:
                out += [_binary(near), _binary(seen)]
                names = ["id", "x", "cluster", "was", "asked", "near", "seen"]
            yield pa.RecordBatch.from_arrays(out, names)
    return run


def _changes(k: int, dims: int):
    """Signed sums and counts of the vectors that changed cluster, one row
    per cluster and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for b in batches_of(batches, _BATCH):
            x = _matrix(b.column("x"), dims)
            for name, sign in (("cluster", 1), ("was", -1)):
                to = b.column(name).to_numpy()
                some = to >= 0
                np.add.at(total, to[some], sign * x[some])
                np.add.at(count, to[some], sign)
        some = np.flatnonzero(count.astype(bool) | total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([[int(count[i]), *total[i].tolist()] for i in some], pa.list_(pa.int64()))],
            ["cluster", "s"])
    return run


def integers(vectors: DataFrame, id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, x) of the vectors that can be clustered, x = floor(scale * component)."""
    d = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale <= LARGEST))
    d = d.filter(F.coalesce((F.size("v") == dims) & fine, F.lit(False)))
    return d.select("id", F.transform("v", lambda c: F.floor(c * scale).cast("int")).alias("x"))


def cluster(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5,
            dims: int = 64, scale: int = 256, seed: str = "2", report: dict | None = None) -> DataFrame:
    """One row (id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256) per row of ``vectors`` that can be clustered.

    Vectors that are null, have another length than ``dims``, or hold a null,
    non-finite or too large component (beyond 2^27 once scaled: squared
    distances might not fit 64 bits) have no row.  Centroids start as the
    ``k`` vectors with the smallest lower-case hex SHA-256 of ``seed:id`` (all
    vectors where there are fewer; rows with a null id come after all others;
    equal hashes go by vector).  Each round assigns every vector to the
    nearest centroid (ties: the smaller number) and replaces centroids by the
    floor of their vectors' means; a centroid without vectors stays.  After
    the last round vectors are assigned once more.  Repeated rows count each.
    Sums of distances beyond 64 bits are null.  Other columns are ignored; an
    empty table gives an empty result.

    ``report``, when given, receives ``evaluated`` and ``vectors``: distances
    evaluated and vectors seen, per assignment.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "centroids")
    state = scratch.save(integers(vectors, id, vector, dims, scale), "vectors")
    kind = state.schema["id"].dataType.simpleString()
    first = state.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    first = first.orderBy(F.col("h").asc_nulls_last(), "x").limit(k).select("x").collect()
    history = [np.array([r.x for r in first], np.int64).reshape(-1, dims)]
    k = len(first)
    sums = [[0] * (dims + 1) for _ in range(k)]
    bounds = f"id {kind}, x array<int>, cluster int, was int, asked int, near binary, seen binary"
    final = f"id {kind}, x array<int>, cluster int, was int, asked int, distance long"
    told, old = [], "vectors"
    for t in range(rounds + 1 if k else 0):
        name, last = f"round{t}", t == rounds
        state = scratch.save(state.mapInArrow(_round(history, dims, last), final if last else bounds), name)
        scratch.drop(old)
        old = name
        if report is not None:
            told.append(state.agg(F.sum("asked"), F.count("*")).first())
        if last:
            break
        moved = state.filter("cluster != was").select("x", "cluster", "was")
        part = moved.mapInArrow(_changes(k, dims), "cluster int, s array<long>").select("cluster", F.posexplode("s"))
        for r in part.groupBy("cluster", "pos").agg(F.sum(F.col("col").cast("decimal(20,0)")).alias("s")).collect():
            sums[r.cluster][r.pos] += int(r.s)
        history.append(np.array([[s // n for s in rest] if n else old_c.tolist()
                                 for (n, *rest), old_c in zip(sums, history[-1])], np.int64).reshape(-1, dims))
    if report is not None:
        report.update(evaluated=[r[0] or 0 for r in told], vectors=[r[1] for r in told])
    if not k:
        state = state.withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")})
    by = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    total, fits = sum(int(r.s) for r in by), lambda n: n if n < 1 << 63 else None
    rows = [(r.cluster, fits(int(r.s)), fits(total),
             hashlib.sha256(",".join(map(str, history[-1][r.cluster].tolist())).encode()).hexdigest()) for r in by]
    kinds = T.StructType.fromDDL("cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    figures = spark.createDataFrame(rows, kinds)     # at most k rows
    return (state.select("id", "cluster", "distance").join(F.broadcast(figures), "cluster")
            .select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
