"""Language identification, word first with character backoff.

A model holds, per language, the log frequency of its words and of the
character n-grams of its words (lengths ``N_MAX`` down to 1, word borders
marked).  A known word scores its log frequencies; an unseen
word scores the mean log frequency of its n-grams of the longest length of
which any is known, falling back to shorter and shorter ones.  The scores of
all words of a text are summed over the whole text, with the log share of
the language among the labelled documents as the prior.

The tables are fitted on a bounded sample of labelled documents
(``docs_per_lang`` per language in expectation, of at most ``most_langs``
languages) and keep every word and n-gram of it, so the model that is
broadcast is bounded by the sample, not by the data.  Prediction reads
nothing but the text.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._util import Scratch, batches_of

UNKNOWN = "und"
N_MAX = 4
#: Bounds of the fit's sample: documents per language, languages.
DOCS_PER_LANG = 2000
MOST_LANGS = 256
#: Words kept by a Python worker; the cache starts anew when it is full.
CACHE_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")
_LONG = 1 << 20


def grams(word: str, n: int) -> list[str]:
    w = f"^{word}$" if n > 1 else word
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-cased words of a text, in lists of bounded length."""
    if len(text) <= _LONG:
        yield _WORD.findall(text.lower())
        return
    found = (m[0].lower() for m in _WORD.finditer(text))
    while part := list(islice(found, 1 << 16)):
        yield part


@dataclass
class Model:
    """``tables[n]`` is (grams, log frequencies by row and language); ``n =
    0``: whole words.  Look-ups are built where words are scored, in the
    tasks; the driver holds columns only."""

    langs: list
    prior: np.ndarray
    tables: list = field(repr=False)

    @cached_property
    def _rows(self) -> list[dict]:
        return [{g: i for i, g in enumerate(grams.to_pylist())} for grams, _ in self.tables]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_rows"}

    def score_word(self, word: str) -> np.ndarray:
        known = self._rows[0].get(word)
        if known is not None:
            return self.tables[0][1][known]
        for n in range(N_MAX, 0, -1):
            index = self._rows[n]
            rows = [index[g] for g in grams(word, n) if g in index]
            if rows:
                return self.tables[n][1][rows].mean(axis=0)
        return np.zeros(len(self.langs))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id",
        docs_per_lang: int = DOCS_PER_LANG, most_langs: int = MOST_LANGS) -> Model:
    """Fit on rows with a text and a language.  At most about
    ``docs_per_lang`` documents of a language are read, chosen by a hash of
    their id; fewer labelled documents are all read.  Where labels name more
    than ``most_langs`` languages, the sample is of those with the most
    labelled documents (ties: by name).  Every word and n-gram of the sample
    is kept.  Without any labelled row the model knows no language."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "langid")
    d = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("lang"),
                    F.xxhash64(F.col(id).cast("string"), F.lit("langid")).alias("h")).filter("t IS NOT NULL AND lang IS NOT NULL")
    share = d.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_langs)
    share = scratch.save(share, "share")
    part = 1 << 20
    chosen = d.join(F.broadcast(share), "lang").filter(         # at most most_langs rows
        F.pmod("h", F.lit(part)) < F.lit(part) * F.least(F.lit(1.0), F.lit(float(docs_per_lang)) / F.col("n")))

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(rows, 128):
            words: dict[str, Counter] = {}
            for la, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for part in words_of(t):
                    words.setdefault(la, Counter()).update(part)
            out: list[list] = [[], [], [], []]
            for la, c in words.items():
                tables = [c, *(Counter() for _ in range(N_MAX))]
                for w, k in c.items():
                    for n in range(1, N_MAX + 1):
                        for g in grams(w, n):
                            tables[n][g] += k
                for n, t in enumerate(tables):
                    out[0] += [la] * len(t)
                    out[1] += [n] * len(t)
                    out[2] += t.keys()
                    out[3] += t.values()
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()),
                                              pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())],
                                             names=["lang", "n", "gram", "k"])

    counts = chosen.select("lang", "t").mapInArrow(count, "lang string, n int, gram string, k long")
    counts = scratch.save(counts.groupBy("lang", "n", "gram").agg(F.sum("k").alias("k")), "counts")
    rows = counts.toArrow()             # bounded by the sample
    langs = sorted(set(rows.column("lang").unique().to_pylist()))
    at = {la: i for i, la in enumerate(langs)}
    prior = np.zeros(len(langs))
    for r in share.filter(F.col("lang").isin(langs)).collect() if langs else []:
        prior[at[r.lang]] = r.n
    tables: list[tuple] = []
    for n in range(N_MAX + 1):
        part_n = rows.filter(pc.equal(rows.column("n"), n)).combine_chunks()
        code = [pc.dictionary_encode(part_n.column(c)).combine_chunks() for c in ("gram", "lang")]
        gram, la = ((x.chunk(0) if isinstance(x, pa.ChunkedArray) else x) for x in code)
        names = gram.dictionary
        m = np.full((len(names), len(langs)), 0.5)
        m[gram.indices.to_numpy(), np.array([at[x] for x in la.dictionary.to_pylist()], np.int64)[la.indices.to_numpy()]] += part_n.column("k").to_numpy()
        tables.append((names, np.log(m / m.sum(axis=0)) if len(names) else m))
    return Model(langs, np.log(prior / prior.sum()) if len(langs) else prior, tables)


class _Scorer:
    """Sums word scores through a bounded cache."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.rows = np.empty((CACHE_WORDS, len(self.model.langs)))
        self.index: dict[str, int] = {}

    def total(self, words: list[str]) -> np.ndarray:
        index = self.index
        new = {w for w in words if w not in index}
        if len(index) + len(new) > CACHE_WORDS:
            if len(new) > CACHE_WORDS:
                return np.sum([self.model.score_word(w) for w in words], axis=0)
            index.clear()
            new = set(words)
        for w in new:
            self.rows[len(index)] = self.model.score_word(w)
            index[w] = len(index)
        return self.rows[np.fromiter(map(index.__getitem__, words), np.int64, len(words))].sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        langs = self.model.langs
        total, letters = self.model.prior.copy(), False
        for words in words_of(text or ""):
            if words and langs:
                total += self.total(words)
            letters = letters or any(c.isalpha() for w in words for c in w)
        if not letters or not langs:
            return UNKNOWN, 0.0
        best = int(np.argmax(total))        # ties: the first language by name
        return langs[best], float(1.0 / np.exp(total - total[best]).sum())


#: The scorer of a Python worker, kept from one task to the next.
_SCORERS: dict = {}


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the probability of that
    language, 0 to 1).

    A null text, a text without a letter, or a model without languages gives
    ``und`` with score 0; a text whose letters carry no evidence gets the
    commonest language.  Columns named like an output are replaced; other
    columns pass unchanged; an empty table gives an empty result.
    """
    docs = docs.drop("lang_pred", "score")
    names, at = docs.columns, docs.columns.index(text)
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = _Scorer(shared.value)
        scorer = _SCORERS[key]
        for b in batches_of(rows, 512):
            got = [scorer.predict(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(run, f"{kinds}, lang_pred string, score double")
