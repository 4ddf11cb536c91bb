"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (byte_bpe, common, dart_minhash, lang_cnn, lexical_rank, merkle, packing,
                         posting_ann, quality_bayes, quality_rules, secret_scan, suffix_dedup,
                         token_count, warc)
from tessera.sources.tables import load_table


def _table(name: str, operator):
    """A query that applies ``operator`` to the whole table ``name``."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        common.session(spark)
        return operator(load_table(spark, sf_dir, name))

    query.__doc__ = operator.__doc__
    return query


def op1_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality classifier over all documents, fitted on ``labels``."""
    common.session(spark)
    return quality_bayes.op1(load_table(spark, sf_dir, "documents"),
                             load_table(spark, sf_dir, "labels"))


def op13_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item, over all documents."""
    common.session(spark)
    return lexical_rank.op13(load_table(spark, sf_dir, "documents"),
                             load_table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality_bayes": op1_quality_bayes,
    "op2_byte_bpe": _table("documents", byte_bpe.op2),
    "op3_posting_ann": _table("embeddings", posting_ann.op3),
    "op4_token_counts": _table("documents", token_count.op4),
    "op5_dart_minhash": _table("documents", dart_minhash.op5),
    "op6_pattern_packing": _table("documents", packing.op6),
    "op7_secret_scan": _table("documents", secret_scan.op7),
    "op8_quality_rules": _table("documents", quality_rules.op8),
    "op9_warc": _table("pages", warc.op9),
    "op10_language_id": _table("documents", lang_cnn.op10),
    "op11_suffix_dedup": _table("documents", suffix_dedup.op11),
    "op12_merkle_manifest": _table("documents", merkle.op12),
    "op13_lexical_rank": op13_lexical_rank,
}

ORACLE_SQL = {
    "op8_quality_rules": quality_rules.oracle_sql(),
    "op9_warc": warc.ORACLE,
    "op11_suffix_dedup": suffix_dedup.ORACLE,
    "op12_merkle_manifest": merkle.oracle_sql(),
    "op13_lexical_rank": lexical_rank.ORACLE,
}
