"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

A stage is a function of (spark, docs, sf_dir) and works on every row its predecessor kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoobs.llm import bpe, lang_id, minhash, mixing, secret_scan
from geoobs.llm.common import fresh, stored

# A document in a known language loses less than this share of the places of its n-grams.
LEAST_SCORE = 0.2
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letter, or n-grams unlike every profile.

    Profiles are learned from the labelled documents. A null ``lang`` gets the predicted language.
    """
    pred, score = fresh(docs, "lang_pred", "lang_score")
    learned = lang_id.profiles(docs, "text", "lang")
    guessed = lang_id.with_language(docs, learned, "text", pred, score)
    kept = guessed.filter((F.col(pred) != lang_id.UNKNOWN) & (F.col(score) >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", pred)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near-duplicates, the one with the smallest id.

    Five-word shingles, similarity 0.8. Documents without words stay, as do rows without an id; of
    rows that repeat an id the smallest by all columns stays. An empty table stays empty.
    """
    return minhash.without_near_duplicates(docs, words=5, similar=0.8)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; ``n_chars`` follows where the text changed.

    Null and empty texts hold none and stay as they are, repeated rows are treated alike, an empty
    table stays empty.
    """
    (spans,) = fresh(docs, "secrets")
    found = secret_scan.scan(docs, "text", spans, key="doc_id")
    hit = F.size(spans) > 0
    clean = F.when(hit, secret_scan.redact(F.col("text"), F.col(spans))).otherwise(F.col("text"))
    (text,) = fresh(found, "clean")
    cleaned = found.withColumn(text, clean).withColumn(
        "n_chars",
        F.when(hit, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType),
    )
    return cleaned.withColumn("text", F.col(text)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents so that sources meet their weights; one taken twice is two rows.

    Size is counted in words. Documents without any (null and empty texts) are taken at the rate of
    their source, and not at all if the source has no words. Rows without a source are a source of
    their own, repeated rows share the copies of their document. An empty table stays empty.
    """
    return mixing.apply_mix(docs, weights=(5, 2, 1), share=1.5, most=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and whether their bytes give the text again.

    A null text counts as empty and has no ids. Repeated rows are encoded one by one, an empty table
    stays empty.
    """
    done = bpe.encode_verified(
        docs, "text", "token_ids", "round_trip", ranks_path=RANKS,
        keep=["doc_id", "lang", "source"],
    )
    return done.select(
        "doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids", "round_trip",
    )


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets),
    ("mix", mix), ("encode", encode),
]

# Signatures, sampling and byte-pair merges are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
