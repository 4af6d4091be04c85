"""Navigable small-world graphs over one shard of vectors, in numpy.

Vectors are unit length.  Nodes are added in batches that at most double the
graph; every batch searches the graph built so far and its own members, and
takes neighbours by the usual diversity rule (a candidate is taken when it
is nearer to the node than to any neighbour already taken, the nearest of
the others fill up).  Searches run for many queries at once: each step
expands the best open candidates of every query together.
"""

from __future__ import annotations

import io

import numpy as np

M_UPPER, M_BASE = 12, 24
EF_BUILD = 48
_EXPAND = 6
_BATCH = 256


def _mix(x: np.ndarray) -> np.ndarray:
    from tidewatch.llm._util import mix64
    return mix64(x.astype(np.uint64), np.full(len(x), 7, np.uint64))


def _top(sim: np.ndarray, ids: np.ndarray, extra: np.ndarray, k: int):
    """The k best columns of each row, best first."""
    if sim.shape[1] > k:
        at = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        sim, ids, extra = (np.take_along_axis(x, at, 1) for x in (sim, ids, extra))
    at = np.argsort(-sim, axis=1, kind="stable")
    return tuple(np.take_along_axis(x, at, 1) for x in (sim, ids, extra))


def _diverse(x: np.ndarray, sim: np.ndarray, ids: np.ndarray, m: int) -> np.ndarray:
    """Neighbours (rows, m), -1 where there are fewer, out of candidates
    sorted by falling similarity (``ids`` -1 and ``sim`` -inf: none)."""
    b, c = ids.shape
    if c <= m:
        return np.pad(ids, ((0, 0), (0, m - c)), constant_values=-1)
    v = x[np.maximum(ids, 0)]
    between = np.matmul(v, v.transpose(0, 2, 1))
    taken = np.zeros((b, c), bool)
    count = np.zeros(b, np.int32)
    for j in range(c):
        near = np.where(taken, between[:, j], -np.inf).max(axis=1)
        ok = (ids[:, j] >= 0) & (count < m) & (sim[:, j] > near)
        taken[:, j] = ok
        count += ok
    rank = np.where(ids < 0, 2 * c, np.arange(c) + np.where(taken, 0, c))
    at = np.argsort(rank, axis=1, kind="stable")[:, :m]
    return np.take_along_axis(ids, at, 1)


class Graph:
    def __init__(self, x: np.ndarray, keys: np.ndarray):
        """``x``: unit vectors (n, d) float32; ``keys`` decide levels and
        the order of insertion, so a rebuilt shard is the same graph."""
        n = len(x)
        order = np.argsort(_mix(keys), kind="stable")
        self.x, self.keys = np.ascontiguousarray(x[order]), keys[order]
        u = (_mix(self.keys + 1) >> np.uint64(11)).astype(float) / float(1 << 53)
        self.level = np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(M_UPPER)).astype(np.int32), 8)
        if n:
            self.level[0] = max(self.level.max(), 0)        # the entry point reaches the top
        top = int(self.level[0]) if n else 0
        self.links = [np.full((n, M_BASE if lv == 0 else M_UPPER), -1, np.int32) for lv in range(top + 1)]
        done = min(n, 1)
        while done < n:
            size = min(max(done, 32), _BATCH, n - done)
            self._insert(np.arange(done, done + size))
            done += size

    def _insert(self, new: np.ndarray) -> None:
        q = self.x[new]
        entry = np.zeros((len(new), 1), np.int64)
        mates = q @ q.T
        np.fill_diagonal(mates, -np.inf)
        for lv in range(len(self.links) - 1, -1, -1):
            here = np.flatnonzero(self.level[new] >= lv)
            sim, ids = self._beam(q, entry, EF_BUILD if len(here) else 1, lv)
            entry = ids[:, :4] if ids.shape[1] >= 4 else ids
            entry = np.where(entry < 0, 0, entry)
            if not len(here):
                continue
            m = self.links[lv].shape[1]
            own = mates[np.ix_(here, here)]
            k = min(len(here) - 1, EF_BUILD // 2)
            s, i = sim[here], ids[here]
            if k > 0:
                at = np.argpartition(-own, k - 1, axis=1)[:, :k]
                s = np.concatenate([s, np.take_along_axis(own, at, 1)], axis=1)
                i = np.concatenate([i, new[here][at]], axis=1)
            s, i, _ = _top(np.where(i < 0, -np.inf, s), i, i, EF_BUILD)
            picked = _diverse(self.x, s, np.where(np.isneginf(s), -1, i), m)
            self.links[lv][new[here]] = picked
            self._link_back(lv, np.repeat(new[here], m), picked.ravel())

    def _link_back(self, lv: int, src: np.ndarray, dst: np.ndarray) -> None:
        ok = dst >= 0
        src, dst = src[ok], dst[ok]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        to, first, count = np.unique(dst, return_index=True, return_counts=True)
        links, m = self.links[lv], self.links[lv].shape[1]
        wide = np.full((len(to), m + int(count.max(initial=0))), -1, np.int64)
        wide[:, :m] = links[to]
        row = np.repeat(np.arange(len(to)), count)
        wide[row, m + np.arange(len(dst)) - np.repeat(first, count)] = src
        wide.sort(axis=1)
        wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
        full = (wide >= 0).sum(axis=1) > m
        some = np.flatnonzero(~full)
        links[to[some]] = -np.sort(-wide[some], axis=1)[:, :m]
        for part in np.array_split(np.flatnonzero(full), max(1, int(full.sum()) // 512)):
            if len(part):
                ids = wide[part]
                sim = np.einsum("bd,bcd->bc", self.x[to[part]], self.x[np.maximum(ids, 0)])
                s, i, _ = _top(np.where(ids < 0, -np.inf, sim), ids, ids, min(ids.shape[1], 2 * m))
                links[to[part]] = _diverse(self.x, s, np.where(np.isneginf(s), -1, i), m)

    def _beam(self, q: np.ndarray, entry: np.ndarray, ef: int, lv: int):
        """(similarities, nodes) of the best ``ef`` nodes of a layer, best
        first, -inf and -1 where fewer were reached."""
        b, n = len(q), len(self.x)
        rows = np.arange(b)[:, None]
        seen = np.zeros((b, n), bool)
        ids = np.sort(entry, axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        sim = np.where(ids < 0, -np.inf, np.einsum("bd,bcd->bc", q, self.x[np.maximum(ids, 0)]))
        seen[np.broadcast_to(rows, ids.shape)[ids >= 0], ids[ids >= 0]] = True
        opened = ids < 0
        live = np.arange(b)
        links = self.links[lv]
        while len(live):
            s, o = sim[live], opened[live]
            key = np.where(o, -np.inf, s)
            k = min(_EXPAND, key.shape[1])
            at = np.argpartition(-key, k - 1, axis=1)[:, :k] if key.shape[1] > k else np.argsort(-key, axis=1)
            good = ~np.isneginf(np.take_along_axis(key, at, 1))
            more = good.any(axis=1)
            live, at, good = live[more], at[more], good[more]
            if not len(live):
                break
            picked = np.where(good, np.take_along_axis(ids[live], at, 1), -1)
            flags = opened[live]
            np.put_along_axis(flags, at, np.take_along_axis(flags, at, 1) | good, 1)
            opened[live] = flags
            near = np.where(picked[:, :, None] >= 0, links[np.maximum(picked, 0)], -1).reshape(len(live), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
            width = int(fresh.sum(axis=1).max())
            if width == 0:
                continue
            at = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
            near, fresh = np.take_along_axis(near, at, 1), np.take_along_axis(fresh, at, 1)
            seen[np.broadcast_to(live[:, None], near.shape)[fresh], near[fresh]] = True
            got = np.matmul(self.x[np.maximum(near, 0)], q[live][:, :, None])[:, :, 0]
            got = np.where(fresh, got, -np.inf)
            near = np.where(fresh, near, -1)
            s, i, o = _top(np.concatenate([sim[live], got], axis=1), np.concatenate([ids[live], near], axis=1),
                           np.concatenate([opened[live], near < 0], axis=1), ef)
            if s.shape[1] > sim.shape[1]:
                grow = ((0, 0), (0, s.shape[1] - sim.shape[1]))
                sim = np.pad(sim, grow, constant_values=-np.inf)
                ids = np.pad(ids, grow, constant_values=-1)
                opened = np.pad(opened, grow, constant_values=True)
            sim[live], ids[live], opened[live] = s, i, o
        at = np.argsort(-sim, axis=1, kind="stable")
        return np.take_along_axis(sim, at, 1), np.take_along_axis(ids, at, 1)

    def search(self, q: np.ndarray, ef: int):
        """Best ``ef`` nodes for unit vectors ``q`` through all layers."""
        entry = np.zeros((len(q), 1), np.int64)
        for lv in range(len(self.links) - 1, 0, -1):
            _, ids = self._beam(q, entry, 4, lv)
            entry = np.where(ids < 0, 0, ids)
        return self._beam(q, entry, ef, 0)

    def dump(self, rows: np.ndarray | None = None) -> bytes:
        """The graph as bytes, with ``rows`` (the vectors that ``x`` was made
        from, in its order) in place of ``x``."""
        out = io.BytesIO()
        np.savez(out, x=self.x if rows is None else rows, keys=self.keys, level=self.level, **{f"l{i}": a for i, a in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Graph:
        z = np.load(io.BytesIO(data))
        g = cls.__new__(cls)
        g.x, g.keys, g.level = z["x"], z["keys"], z["level"]
        g.links = [z[f"l{i}"] for i in range(sum(k[0] == "l" and k[1:].isdigit() for k in z.files))]
        return g
