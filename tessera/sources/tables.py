"""The parquet tables a job starts from."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet`` (a file or a directory of parts).  Column
    pruning and filters reach the scan because callers select/filter lazily."""
    return spark.read.parquet(os.path.join(base, f"{name}.parquet"))

# The conditions under which Spark finds no Parquet file, that is
# no folder, a folder without files, and a stream's sink before its first batch
NOTHING_WRITTEN = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "_LEGACY_ERROR_TEMP_1134")
