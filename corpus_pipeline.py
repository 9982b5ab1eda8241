"""Corpus pipeline: five stages over ``documents``, each one of the llm operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet and rereads it for the next stage. All but the last
return the columns of ``documents``, with other columns beside them unchanged.

Defined results: an empty table gives an empty one; a null or empty text, and one
without a letter, has no recognised language and goes in the first stage; equal rows
are copies of one document, of which the second stage keeps one; a null ``lang`` is
filled, a null ``source`` is a source of its own. Extra columns of any name, also
those that the operators use, pass through to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.llm import bpe, jaccard, language, mixing, secret_scan
from tripforge.llm.common import crc_mod, stored, table

#: Documents whose best language has less than this probability are rejected.
LEAST_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; a missing ``lang`` is filled with it."""
    model = language.fit(docs.filter(crc_mod("doc_id", 3) != 1))
    # the row is one struct beside its text, so that no column name clashes with the prediction's
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    kept = language.predict(rows, model).filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*[F.coalesce("row.lang", "lang_pred").alias("lang") if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80% of its five-word shingles."""
    return jaccard.keep_one(docs, words=5, percent=80)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced in the texts."""
    out = secret_scan.redact(docs, secret_scan.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and whether they decode to the text."""
    coded = bpe.encode_checked(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", "ids", "n_tokens", "round_trip")


STAGES = [("language_id", language_id), ("ngram_jaccard", ngram_jaccard), ("secret_scan", secret_redaction),
          ("source_mixing", source_mixing), ("byte_bpe", byte_bpe)]

#: Trained models and seeded draws are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
