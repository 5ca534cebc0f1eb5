"""Queries of the text operators over the whole ``documents`` table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, lang_id, minhash, mixing, token_counts, token_store
from .common import table
from .registry import query

OVER = 512


@query("op1_byte_bpe")
def op1_byte_bpe(spark, sf_dir):
    """Ids and decoded bytes of every text, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, "text", "token_ids", ranks_path=ranks)
    both = bpe.decode(ids, "token_ids", "decoded", ranks_path=ranks)
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256)
        .alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(
        docs, "text", vocabulary=public_tokenizers.path("byte_bpe_50k.json"), limit=OVER
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op10_token_store")
def op10_token_store(spark, sf_dir):
    """Writes all ids as addressable codes and reports each document from the files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = token_store.write(
        docs, "doc_id", "text", vocabulary=public_tokenizers.path("byte_bpe_50k.json"), end_id=0
    )
    read = token_store.read_documents(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op9_source_mix")
def op9_source_mix(spark, sf_dir):
    """Words that a mix of 150 % of all words takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, "doc_id", "text", "source", weights=(5, 2, 1), share=1.5, most=2.0)
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


@query("op8_lang_id")
def op8_lang_id(spark, sf_dir):
    """Languages learned from two thirds of the documents, predicted for all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", lang_id.held_out(F.col("doc_id")))
    learned = lang_id.profiles(docs.filter("NOT held_out"), "text", "lang")
    guessed = lang_id.with_language(docs.drop("lang"), learned, "text", "lang_pred", "score")
    return guessed.select("doc_id", "held_out", "lang_pred", "score")


@query("op6_minhash_dedup")
def op6_minhash_dedup(spark, sf_dir):
    """Components of near-duplicate documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, "doc_id", "text", words=4, similar=0.8)
