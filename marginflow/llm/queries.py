"""Registered queries of the training-data operators: production parameters,
whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm import (decontaminate, hardneg, langid, lattice, lines, minhash, mixing, packing, quality, tokens,
                            toxicity, trie, whitening)
from marginflow.llm.common import documents, is_held_out, table
from marginflow.llm.oracle import ORACLE_SQL  # noqa: F401  (part of this module's interface)


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from text and lang of the rows that
    are not held out."""
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.filter(~is_held_out(F.col("doc_id"))))
    return langid.identify(docs, model, [F.col("doc_id").cast("long").alias("doc_id"),
                                         is_held_out(F.col("doc_id")).alias("held_out")],
                           "doc_id long, held_out boolean")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_repeated_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label quality of every document; labels.quality is not an input."""
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs), [F.col("doc_id").cast("long").alias("doc_id")], "doc_id long")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), percent=85)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.exact_duplicates(documents(spark, sf_dir), keep="max")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from the labels of the rows that
    are not held out."""
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").filter(~is_held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model, [F.col("doc_id").cast("long").alias("doc_id"),
                                        is_held_out(F.col("doc_id")).alias("held_out")],
                          "doc_id long, held_out boolean")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), F.col("doc_id").cast("long"))
    return mixed.select(F.col("payload").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings"), is_anchor=F.col("vec_id") % 50 == 0, label=moved)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_langid, op2_token_counts, op3_line_dedup, op4_quality, op5_minhash, op6_exact_dedup,
                            op7_packing, op8_toxicity, op9_mixing, op10_lattice, op11_whitening,
                            op12_decontaminate, op13_hard_negatives)}
