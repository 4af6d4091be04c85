"""BPE encoding and decoding of whole texts, with tree concatenation.

Encoding gives exactly the ids the ``tokenizers`` library gives for the
whole text.  White space is a hard border for the tokenizers meant here
(pre-tokens never cross it, and it leaves no token), so ordinary texts are
encoded word by word through a bounded cache of words.

Texts longer than ``long_chars`` and words longer than ``LONG_WORD`` go
through a tree: the text is cut in halves down to pieces of bounded size,
the pieces are encoded in parallel, and the halves are put together again
level by level.  A cut can fall inside a word, so the tokens around it may
be wrong: a window of text around the join is encoded again and grows until
its tokens agree with both sides for a run of tokens, and it replaces what
lies between.  Where a run of tokens agrees, everything beyond it is
unaffected by the cut: every pair of neighbouring tokens of the result then
stands next to each other in a valid encoding.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._util import Scratch, batches_of, fresh

#: Characters with the Unicode property White_Space (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_WORDS = re.compile(f"[^{SPACE}]+")
#: A word of Latin-1 letters, maybe with plain punctuation after it: for the
#: vocabulary's own steps (compose, lower-case, split by kind) it is one run
#: of letters and one of punctuation.
_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
LONG_TEXT = 1 << 16
LONG_WORD = 1 << 13
_WINDOW, _AGREE = 64, 6
#: Words kept by a Python worker; the cache starts anew when it is full.
CACHE_WORDS = 400_000


def tokenizer_path() -> str:
    """The vocabulary the queries use."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def safe_cut(text: str, i: int) -> int:
    """Largest position ``<= i`` where the text may be cut without changing
    its Unicode composition (not before a mark or a joining jamo)."""
    while 0 < i < len(text) and (unicodedata.category(text[i])[0] == "M" or "ᅠ" <= text[i] <= "ᇿ"):
        i -= 1
    return i


def _byte_letters() -> dict[int, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable
    bytes for themselves, the others by code points from 256 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in kept]
    return {b: 256 + i for i, b in enumerate(rest)}


_BYTES = _byte_letters()


class Bpe:
    """A tokenizer file with cached words (one per Python worker)."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.cache: dict[str, bytes] = {}
        self.model = self.tok.model
        self.simple = True
        self.simple = all(np.array_equal(self._simple(w), self.plain(w)) for w in ("Größe,", "ÀB", "z!?", "tion"))
        n = self.tok.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tok.id_to_token(i) for i in range(n)]
        added = self.tok.get_added_tokens_decoder()
        self.size = np.array([0 if t is None else len(t.encode()) if i in added else len(t.removesuffix("</w>"))
                              for i, t in enumerate(self.tokens)], np.int64)

    def plain(self, text: str) -> np.ndarray:
        """The library's own encoding."""
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.int32)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        words = _WORDS.findall(text)
        cache = self.cache
        new = list({w for w in words if w not in cache})
        if new:
            if len(cache) + len(new) > CACHE_WORDS:
                cache.clear()
                new = list(set(words))
            short = []
            for w in new:
                if (got := self._simple(w)) is not None:
                    cache[w] = got.tobytes()
                elif len(w) <= LONG_WORD:
                    short.append(w)
            for w, e in zip(short, self.tok.encode_batch_fast(short, add_special_tokens=False)):
                cache[w] = np.array(e.ids, np.int32).tobytes()
            for w in new:
                if w not in cache:
                    cache[w] = self.tree(w, LONG_WORD).tobytes()
        out = np.frombuffer(b"".join([cache[w] for w in words]), np.int32)
        for w in new:                   # long words are not kept
            if len(w) > 64:
                del cache[w]
        return out

    def _simple(self, word: str) -> np.ndarray | None:
        """Ids of a short word of letters and punctuation straight from the
        merge model; None for any other word or vocabulary."""
        m = _SIMPLE.fullmatch(word) if len(word) <= 64 else None
        if m is None or not self.simple:
            return None
        parts = [m[1].lower().encode().decode("latin-1").translate(_BYTES), m[2]]
        return np.array([t.id for p in parts if p for t in self.model.tokenize(p)], np.int32)

    def tree(self, text: str, most: int) -> np.ndarray:
        """Ids by halves of at most ``most`` characters and joins."""
        parts = [(p, self.plain(p)) for p in halves(text, most)]
        while len(parts) > 1:
            parts = [(a[0] + b[0], self.join(*a, *b)) for a, b in zip(parts[::2], parts[1::2])]
        return parts[0][1]

    def join(self, left: str, lids: np.ndarray, right: str, rids: np.ndarray) -> np.ndarray:
        """Ids of ``left + right`` from those of both."""
        if not left or not right:
            return rids if not left else lids
        w = _WINDOW
        while True:
            start = safe_cut(left, max(len(left) - w, 0))
            stop = len(right) if w >= len(right) else safe_cut(right, w)
            ids = self.plain(left[start:] + right[:stop])
            at = np.concatenate([[0], np.cumsum(self.size[ids])])
            cut = int(self.size[self.plain(left[start:])].sum())
            lo = (0, 0) if start == 0 else self._agree_left(lids, ids, at[:-1] - cut)
            hi = (len(rids), len(ids)) if stop == len(right) else self._agree_right(rids, ids, at[:-1] - cut)
            if lo and hi and lo[1] <= hi[1]:
                return np.concatenate([lids[:lo[0]], ids[lo[1]:hi[1]], rids[hi[0]:]]).astype(np.int32)
            if start == 0 and stop == len(right):
                return ids
            w *= 2

    def _agree_left(self, lids, ids, at):
        """First run of tokens that ``ids`` shares with the end of ``lids``:
        (index after it in ``lids``, index after it in ``ids``)."""
        tail = lids[-(len(ids) + 1):]
        place = -np.cumsum(self.size[tail][::-1])[::-1]
        return self._run(tail, place, ids, at, len(lids) - len(tail), at + self.size[ids] <= 0, last=False)

    def _agree_right(self, rids, ids, at):
        """Last run that ``ids`` shares with the start of ``rids``: (index
        of its start in ``rids``, in ``ids``)."""
        head = rids[:len(ids) + 1]
        place = np.cumsum(self.size[head]) - self.size[head]
        return self._run(head, place, ids, at, 0, at >= 0, last=True)

    @staticmethod
    def _run(own, place, ids, at, offset, allowed, last):
        where = {p: i for i, p in enumerate(place.tolist())}
        n, runs = 0, []
        for j, (p, t, ok) in enumerate(zip(at.tolist(), ids.tolist(), allowed.tolist())):
            i = where.get(p)
            n = n + 1 if ok and i is not None and own[i] == t else 0
            if n >= _AGREE:
                runs.append((i, j))
        if not runs:
            return None
        if last:
            i, j = runs[-1]
            return offset + i - _AGREE + 1, j - _AGREE + 1
        i, j = runs[0]
        return offset + i + 1, j + 1

    def decode(self, ids) -> str:
        """The library's decoding of these files (they name no decoder):
        the tokens joined by one space, special tokens kept."""
        tokens = self.tokens
        return " ".join([t for t in map(tokens.__getitem__, ids) if t is not None])


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def depth_of(length: int, most: int) -> int:
    d = 0
    while length > most << d:
        d += 1
    return d


def halves(text: str, most: int) -> list[str]:
    """``2 ** depth`` pieces by repeated halving (some may be empty)."""
    parts = [text]
    for _ in range(depth_of(len(text), most)):
        cut = [safe_cut(p, len(p) // 2) for p in parts]
        parts = [x for p, c in zip(parts, cut) for x in (p[:c], p[c:])]
    return parts


# --- operators -------------------------------------------------------------

def _encode_long(texts: DataFrame, path: str, most: int, scratch: Scratch) -> DataFrame:
    """(key, ids) of distinct long texts (key, t): pieces are dealt to tasks
    of their own and joined pairwise, one level of the tree a pass."""
    def cut(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for key, t in zip(pdf["key"], pdf["t"]):
                parts = halves(t, most)
                yield pd.DataFrame({"key": key, "depth": len(parts).bit_length() - 1, "idx": range(len(parts)),
                                    "t": parts})

    def encode(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            pdf["ids"] = [bpe(path).tree(t, LONG_WORD).tobytes() for t in pdf["t"]]
            yield pdf

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        a, b = pdf["t"]
        x, y = (np.frombuffer(i, np.int32) for i in pdf["ids"])
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "depth": pdf["depth"].iloc[:1] - 1,
                             "idx": pdf["idx"].iloc[:1] // 2, "t": [a + b], "ids": [bpe(path).join(a, x, b, y).tobytes()]})

    kinds = "key string, depth int, idx int, t string"
    n = max(1, texts.sparkSession.sparkContext.defaultParallelism) * 4
    parts = texts.mapInPandas(cut, kinds).repartition(n, "key", "idx").mapInPandas(encode, f"{kinds}, ids binary")
    parts = scratch.save(parts, "pieces0")
    level = 0
    while True:
        deepest = parts.agg(F.max("depth")).first()[0]
        if not deepest:
            return parts.select("key", F.col("ids").alias("long_ids"))
        level += 1
        joined = (parts.filter("depth > 0").groupBy("key", F.shiftright("idx", 1))
                  .applyInPandas(merge, f"{kinds}, ids binary"))
        parts = scratch.save(parts.filter("depth = 0").unionByName(joined), f"pieces{level}")
        scratch.drop(f"pieces{level - 1}")


def encode(docs: DataFrame, text: str = "text", path: str | None = None, ids: str = "ids", decoded: str | None = None,
           long_chars: int = LONG_TEXT) -> DataFrame:
    """``docs`` with the column ``ids`` (array<int>), the token ids of every
    whole text, and, where ``decoded`` names a column, the text decoded from
    them.  Null and blank texts have no ids.  Other columns pass unchanged
    (one named like an output column is replaced); repeated rows are encoded
    alike; an empty table gives an empty result.  Texts over ``long_chars``
    characters are encoded once per distinct text.
    """
    path = path or tokenizer_path()
    docs = docs.drop(*[c for c in (ids, decoded) if c])
    scratch = Scratch(docs.sparkSession, "bpe")
    is_long = F.length(text) > long_chars
    long_texts = docs.filter(is_long).select(F.sha2(F.col(text).cast("binary"), 256).alias("key"), F.col(text).alias("t"))
    whole = scratch.save(_encode_long(long_texts.dropDuplicates(["key"]), path, long_chars, scratch), "long")
    key, other, found = fresh(docs.columns, "_key", "_other", "_long_ids")
    keyed = docs.filter(is_long).withColumn(key, F.sha2(F.col(text).cast("binary"), 256))
    big = keyed.join(whole.select(F.col("key").alias(other), F.col("long_ids").alias(found)), F.col(key) == F.col(other))
    rest = docs.filter(~F.coalesce(is_long, F.lit(False))).withColumn(found, F.lit(None).cast("binary"))
    names = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = f"{kinds}, `{ids}` array<int>" + (f", `{decoded}` string" if decoded else "")
    at = names.index(text)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path)
        for b in batches_of(rows, 256):
            got = [np.frombuffer(x, np.int32) if x is not None else model.encode(t or "")
                   for t, x in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist())]
            ends = np.cumsum([0, *map(len, got)]).astype(np.int32)
            flat = np.concatenate(got) if got else np.empty(0, np.int32)
            cols = [*b.columns[:len(names)], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))]
            if decoded:
                cols.append(pa.array([model.decode(x.tolist()) for x in got], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=[*names, ids, *([decoded] if decoded else [])])

    both = rest.select(*[F.col(f"`{c}`") for c in names], found).unionAll(
        big.select(*[F.col(f"`{c}`") for c in names], found))
    return both.mapInArrow(run, out)


def decode(docs: DataFrame, ids: str = "ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """``docs`` with the text decoded from the array column ``ids`` (special
    tokens kept, ids outside the vocabulary skipped, null gives null)."""
    path = path or tokenizer_path()
    docs = docs.drop(decoded)
    names, at = docs.columns, docs.columns.index(ids)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path)
        n = len(model.tokens)
        for b in batches_of(rows, 256):
            texts = [None if x is None else model.decode([i for i in x if i is not None and 0 <= i < n])
                     for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*names, decoded])

    return docs.mapInArrow(run, f"{kinds}, `{decoded}` string")
