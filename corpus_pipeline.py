"""Corpus pipeline: language ID, line dedup, near-dedup, mixing, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` applies them in order and writes each result to the shared checkpoint folder.

Nulls, empty and repeated rows, and empty tables have the results that the operators define; columns besides those
of ``documents`` are dropped by the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelforge.llm import bpe, langid, line_dedup, minhash, mixing
from panelforge.llm.common import cut_lineage, documents, text_of

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A prediction below this share is no language that the model knows.
MIN_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents without a letter, or of no language the model knows, go; a null lang is filled in."""
    docs = docs.select(*COLUMNS)
    model = langid.fit(docs.filter(~langid.held_out()))
    out = langid.predict(docs, model)
    known = F.col("lang_pred") != langid.UNKNOWN if model is not None else langid.has_letter(F.col("text"))
    if model is not None:
        known = known & (F.col("score") >= MIN_SCORE)
    filled = F.coalesce("lang", "lang_pred") if model is not None else F.col("lang")
    return out.filter(known).withColumn("lang", filled).select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: common blocks go from later documents; a document that loses all its words goes."""
    out = line_dedup.remove_common_lines(docs.select(*COLUMNS), long_lines=True)
    out = out.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\s]"))
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7 on five-word shingles and similarity 0.8: of each group the smallest doc_id stays (null is the
    largest), and of rows alike in doc_id and text one.

    A row is known by its doc_id and a digest of its text, as ids may be null or repeated.
    """
    row_id = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                      F.md5(text_of("text")).alias("sig"))
    docs = docs.select(*COLUMNS).withColumn("row_id", row_id)
    kept = minhash.near_duplicates(docs, id_col="row_id", width=5, percent=80).filter("kept")
    docs = docs.join(kept.select("row_id").distinct(), "row_id", "left_semi")
    copy = F.row_number().over(W.partitionBy("row_id").orderBy(F.md5(F.concat_ws("\x1f", "lang", "source", "n_chars"))))
    return docs.withColumn("copy", copy).filter("copy = 1").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: each document as often as the mix takes it."""
    out = mixing.mix_sources(docs.select(*COLUMNS)).filter("repeats > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: token ids of every text, decoded again and compared with it."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = docs.select(*COLUMNS).withColumn("text_sha256", F.sha2(text_of("text"), 256))
    out = bpe.round_trip(rows, vocabulary, public_tokenizers.PATTERN)
    return out.select("doc_id", "lang", "source", "n_chars", F.size("token_ids").cast("long").alias("n_tokens"),
                      "token_ids", "text_sha256", (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", near_dedup),
    ("mix_sources", mix),
    ("bpe", tokens),
]

#: The language, alignment, minhash and BPE stages are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
