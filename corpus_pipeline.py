"""Corpus pipeline: documents to packed training sequences.

Every stage takes (spark, docs, sf_dir), works on all rows that its
predecessor kept and calls one operator of ``marginflow.llm``; all but the
last return the columns of documents.  ``run`` writes each stage as Parquet
under the shared checkpoint folder and reads it back for the next one.

The operators define their results for nulls, empty and long texts, ties,
repeated rows and empty tables; the stages add:

* language: learned from the non-null ``lang`` of its input; rows whose
  language is undetermined or whose margin is narrow go.
* exact and near duplicates: of each group the row with the smallest doc_id
  stays; rows without an id stay; rows that repeat the staying id all stay.
  An exact copy goes by its id and text: another text under its id stays.
* mixing: a row is repeated as often as the mix takes it, or goes.
* packing: one row per piece.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm import langid, minhash, mixing, packing, trie
from marginflow.llm.common import documents, is_held_out, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents_schema(docs: DataFrame) -> str:
    return ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = langid.fit(docs.filter(~is_held_out(F.col("doc_id"))))
    out = langid.identify(docs, model, [F.col(c) for c in COLUMNS], _documents_schema(docs))
    return out.filter(~F.col("rejected")).select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    gone = trie.exact_duplicates(docs, keep="min").filter(~F.col("kept")).select("doc_id", "text_sha256").distinct()
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    key = F.translate(F.coalesce("text", F.lit("")), upper, upper.lower())  # as trie.normalise
    return (docs.withColumn("text_sha256", F.sha2(key.cast("binary"), 256))
            .join(gone, ["doc_id", "text_sha256"], "left_anti").select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    gone = minhash.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, F.struct(*COLUMNS), narrow=False)
    return mixed.filter("repeats > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "repeats"))).select("payload.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Compression, sketches and tokenizers are beyond SQL: tests/llm holds the
# pipeline against brute force.
ORACLE_SQL = None
