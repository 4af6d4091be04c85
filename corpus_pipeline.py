"""Corpus pipeline: language, near copies, repeated passages, mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the
stage before it kept; its result is written as Parquet and read again as the
next stage's ``docs``.  All stages but the last return the columns of
``documents`` (doc_id, text, lang, source, n_chars).

No SQL twin: SimHash, the language model and the tokenizer have no SQL
form.  ``tests/llm`` holds the run against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents whose best language is less likely than this are rejected.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language; rejected are null texts, texts
    without a letter, and texts no language explains better than all others
    together.  The label is not changed."""
    from tidewatch.llm.lang_id import UNKNOWN, fit, predict
    from tidewatch.llm.queries import held_out
    model = fit(docs.filter(~held_out()))
    got = predict(docs.select(*COLUMNS), model)
    return got.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: the one with the
    smallest id (of the group's rows with that id, the one whose text sorts
    first; rows with that id in other groups are judged there).  Of a group
    without any id one document stays, from those with the group's smallest
    fingerprint the one whose text sorts first."""
    from tidewatch.llm.simhash import fingerprints, near_duplicates
    groups = near_duplicates(docs, shingle=3, max_bits=2)
    rest = F.min(F.struct(*COLUMNS[1:])).alias("rest")
    least = F.col("id") == F.col("component_id")
    ids = groups.groupBy(F.col("id").alias("doc_id")).agg(F.max(least).alias("keep"),
                                                          (F.min("fp") == F.max("fp")).alias("one"))
    ids = ids.filter("keep")
    named = docs.join(ids.filter("one").select("doc_id"), "doc_id").groupBy("doc_id").agg(rest).select("doc_id", "rest.*")
    # ids whose rows differ in fingerprint: a survivor for each group
    several = docs.join(ids.filter("NOT one").select("doc_id"), "doc_id", "left_semi").withColumn("row", F.struct(*COLUMNS))
    labels = groups.filter(least).select(F.col("id").alias("doc_id"), "fp", "label").distinct()
    several = fingerprints(several, id="row").select("fp", "id.*").join(labels, ["doc_id", "fp"])
    several = several.groupBy("doc_id", "label").agg(rest).select("doc_id", "rest.*")
    no_id = docs.filter("doc_id IS NULL").withColumn("row", F.struct(*COLUMNS))
    first = groups.filter("component_id IS NULL AND fp = label").select("fp").distinct()
    alone = fingerprints(no_id, id="row").join(first, "fp").select("fp", "id.*")
    alone = alone.groupBy("fp", "doc_id").agg(rest).select("doc_id", "rest.*")
    return named.unionByName(several).unionByName(alone).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 13 words or more that also start in a document with a
    smaller id.  Texts without such a passage stay as they are; of the
    others the words kept are joined by one space, and a document that loses
    all its words goes."""
    from tidewatch.llm.substrings import remove_repeats
    got = remove_repeats(docs, window=13, keep_layout=True, carry=("lang", "source"))
    got = got.filter("n_removed = 0 OR n_removed < n_words").withColumnRenamed("kept", "text")
    return got.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents to tempered shares of source, language and topic."""
    from tidewatch.llm.queries import mixed
    return mixed(docs).filter("mix_kept").select(*COLUMNS)


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text and the text decoded from them."""
    from tidewatch.llm.bpe import encode
    got = encode(docs.select(*COLUMNS), decoded="decoded")
    return got.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("language_id", language_id), ("simhash_near_dedup", simhash_near_dedup),
          ("substring_dedup", substring_dedup), ("mixing", mixing), ("bpe_round_trip", bpe_round_trip)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the whole table ``documents``."""
    from tidewatch.llm._util import Scratch, table
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        scratch.settle()
    return STAGES[-1][1](spark, docs, sf_dir)
