"""Corpus pipeline: raw documents to packed training sequences.

Five stages, each a function of ``(spark, docs, sf_dir)``; what one returns is
written as Parquet and read again as the next one's documents.  All but the
last return the columns of ``documents``.

1. language: documents without a recognised language go.
2. quality: documents that the quality rules reject go.
3. near_duplicates: one document of each near-duplicate class stays.
4. secrets: found secrets are blacked out in the text; all documents stay.
5. packing: every document's tokens are placed in sequences of 2048.

An empty table passes through every stage and gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, dart_minhash, lang_cnn, packing, quality_rules, secret_scan
from tessera.sources.tables import load_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.session(spark)
    return lang_cnn.keep_languages(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.session(spark)
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.session(spark)
    return dart_minhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.session(spark)
    clean = secret_scan.redact(docs)
    if "n_chars" in docs.columns:  # n_chars goes with the text
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.session(spark)
    return packing.op6(docs)


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates),
          ("secrets", secrets), ("packing", pack)]

#: Neither the network of stage 1 nor the sketches of stage 3 can be said in
#: SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    common.session(spark)
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
