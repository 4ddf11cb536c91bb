"""Sinks (K1-K6).  Everything is written by the executors in parallel; only
bounded report tables are coalesced to one file."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_texts(df: DataFrame, path: str, key: str = "doc_id", text_col: str = "text",
                one_file_per_key: bool = False, mode: str = "overwrite") -> None:
    """K1: documents as ``(key, text)`` parquet, or one text file per key
    (``<path>/<key>=<value>/part-*.txt``) when a file layout is wanted."""
    if one_file_per_key:
        # a unique key lives in one task, so each key gets one file without a shuffle
        df.select(key, text_col).write.mode(mode).partitionBy(key).text(path)
    else:
        df.select(key, text_col).write.mode(mode).parquet(path)


def append_split(df: DataFrame, path: str, split_col: str = "split") -> None:
    """K5, incremental: add rows to ``split=...`` directories.  What is there
    stays; the writer commits the new files together."""
    df.write.mode("append").partitionBy(split_col).parquet(path)


def write_windows(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: token windows as JSON lines ``(source, chunk_id, input_ids, labels)``."""
    df.write.mode(mode).json(path)


def write_split(df: DataFrame, path: str, split_col: str = "split",
                mode: str = "overwrite") -> None:
    """K5: materialise a split as ``split=train`` / ``split=eval`` directories.
    Input files are never moved or deleted."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)


def write_report_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: a report (bounded: questions x grid) as one CSV with a header."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


# File-name prefixes of the two reports.
REPORT_PREFIXES = {"benchmark": "benchmark_results", "compare": "comparison_results"}


def report_name(index_path: str, model_name: str, prefix: str = "benchmark") -> str:
    """K4 file name from the index location and the model name (last path
    parts), e.g. ``benchmark_<index>_<model>.csv``; the answering scripts'
    reports have the prefixes ``REPORT_PREFIXES``."""
    index = os.path.basename(os.path.dirname(index_path.rstrip("/"))) or \
        os.path.basename(index_path.rstrip("/"))
    model = os.path.basename(model_name.rstrip("/"))
    return f"{prefix}_{index}_{model}.csv"


def run_summary(spark, **values) -> DataFrame:
    """K6: a one-row summary table (counts, seconds, sizes, paths)."""
    cols = sorted(values)
    return spark.createDataFrame([tuple(values[c] for c in cols)], cols)


def observed(df: DataFrame, name: str, **aggs):
    """K6 counts without a second pass: ``df.observe`` attaches metrics that are
    filled when the (single) action over ``df`` runs."""
    from pyspark.sql import Observation
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [v.alias(k) for k, v in aggs.items()]
    return df.observe(obs, *exprs), obs


def export_text_files(df: DataFrame, out_dir: str, name_col: str = "stem",
                      text_col: str = "text", suffix: str = ".txt") -> int:
    """K1 file layout: one ``<name><suffix>`` file per row in ``out_dir`` (a
    mounted folder or an object store), staged by the executors and moved into
    place when all of them are done; returns the number of files."""
    from tessera.sources.textfiles import write_text_files
    return write_text_files(df, out_dir, name_col, text_col, suffix)
