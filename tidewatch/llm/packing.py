"""Packing of token ids into rows of one length, as binary matrices.

Every text is encoded, ended by ``eos`` and cut into pieces of at most the
row length; pieces are placed by best-fit decreasing: the longest first,
each into the row with the least room that still holds it.  A segment tree
over the room left finds that row in ``log(row length)`` steps.

Packing runs inside the partitions of the input, shard by shard: a shard is
closed when it holds ``shard_tokens`` tokens, so memory is bounded, nothing
is shuffled, and no key of the data can make a task larger than its
partition.

A packed row carries its ids (little-endian ``uint16`` or ``uint32``, padded
to the row length), the cumulative segment lengths, and for every segment
its position reset (where the position counter starts again at 0), its
document and its offset there; concatenating a document's segments by
offset gives back its tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._util import batches_of

ROW_LENGTH = 2048
SHARD_TOKENS = 1 << 21
CACHE_WORDS = 400_000


def ranks_path() -> str:
    """The vocabulary the queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class ByteBpe:
    """A rank file with cached chunks.  Texts are cut before single spaces,
    where the vocabulary's split pattern always cuts too."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.size = len(ranks)
        self.eos = self.size
        self.dtype = np.dtype("<u2" if self.size < 1 << 16 else "<u4")
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})
        self.cache: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        first, *rest = text.split(" ")
        chunks = [first, *[" " + w for w in rest]]
        cache = self.cache
        new = {w for w in chunks if w not in cache}
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = set(chunks)
        for w in new:
            cache[w] = np.array(self.encoding.encode_ordinary(w), self.dtype).tobytes()
        out = np.frombuffer(b"".join([cache[w] for w in chunks]), self.dtype)
        for w in new:                   # long chunks are not kept
            if len(w) > 64:
                del cache[w]
        return out


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


class RoomTree:
    """Rows by the room they have left, with a search for the least room
    that holds a length (a segment tree over 0..row length)."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = self.leaves + room
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (room, row) with the least room >= length."""
        count, i = self.count, self.leaves + length
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], most: int) -> list[list[int]]:
    """Items of each row; items longer than ``most`` are not allowed."""
    tree, rows = RoomTree(most), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        got = tree.take(lengths[i])
        if got is None:
            rows.append([i])
            got = most, len(rows) - 1
        else:
            rows[got[1]].append(i)
        if got[0] > lengths[i]:
            tree.add(got[0] - lengths[i], got[1])
    return rows


def _shard(docs: list, most: int, dtype: np.dtype, pad: int) -> list[dict]:
    """Packed rows of (id, tokens) pairs."""
    items = [(d, o, t[o:o + most]) for d, t in docs for o in range(0, len(t), most)]
    out = []
    for row in best_fit_decreasing([len(x[2]) for x in items], most):
        ids = np.full(most, pad, dtype)
        ends = np.cumsum([0, *(len(items[i][2]) for i in row)])
        for i, a, b in zip(row, ends, ends[1:]):
            ids[a:b] = items[i][2]
        out.append({"n_tokens": int(ends[-1]), "ids": ids.tobytes(), "cu_seqlens": ends.tolist(),
                    "position_resets": ends[:-1].tolist(), "doc_ids": [items[i][0] for i in row],
                    "doc_offsets": [items[i][1] for i in row]})
    return out


def pack(docs: DataFrame, text: str = "text", id: str = "doc_id", path: str | None = None,
         row_length: int = ROW_LENGTH, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Packed rows (pack_id, n_tokens, ids, cu_seqlens, position_resets,
    doc_ids, doc_offsets) of all texts.

    Null and empty texts have no tokens and appear in no row.  A text longer
    than a row is split into several segments without loss.  Repeated rows
    are packed as often as they stand there; a null id stays null in
    ``doc_ids``; other columns are ignored; an empty table gives no rows.
    ``pack_id`` is unique and depends on the partitioning of the input.
    """
    path = path or ranks_path()
    kind = docs.schema[id].dataType.simpleString()
    fields = f"n_tokens long, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<{kind}>, " \
             "doc_offsets array<long>"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(path)
        eos = np.array([model.eos], model.dtype)
        held, n, schema = [], 0, None

        def flush():
            out = _shard(held, row_length, model.dtype, model.eos)
            for i in range(0, len(out), 512):
                yield pa.RecordBatch.from_pylist(out[i:i + 512], schema=schema)

        for b in batches_of(rows, 256):
            schema = pa.schema([("n_tokens", pa.int64()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())),
                                ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(b.schema.types[0])),
                                ("doc_offsets", pa.list_(pa.int64()))])
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not t:
                    continue
                ids = np.concatenate([model.encode(t), eos])
                held.append((d, ids))
                n += len(ids)
                if n >= shard_tokens:
                    yield from flush()
                    held, n = [], 0
        if held:
            yield from flush()

    out = docs.select(F.col(id).alias("id"), F.col(text).alias("t")).mapInArrow(run, fields)
    return out.select(F.monotonically_increasing_id().alias("pack_id"), "*")
