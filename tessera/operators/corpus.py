"""Corpus build (job A): split, skip finished work, page concatenation, names.

* ``split_exact`` (T1/T2): a repeatable permutation (md5 of seed and key),
  the first ``floor(n * ratio)`` rows are train, the rest eval.  The boundary
  key is selected by digit histograms; there is no sort.
* ``split_fraction`` (T2, scale mode): train iff md5 fraction < ratio.  Narrow,
  no shuffle at all; the train share is ``ratio`` only approximately.
* ``skip_done`` (J4): left-anti join against what is finished.
* ``concat_pages`` (A6): ordered concatenation of page texts, no separator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordering import md5_fraction, md5_order_key, order_boundary
from tessera.functions.text import file_stem, window_file_name  # noqa: F401


def split_exact(df: DataFrame, key: str = "doc_id", ratio: float = 0.9, seed=42,
                split_col: str = "split") -> DataFrame:
    """Adds ``split`` in {'train', 'eval'} (the eval ratio is the remainder).

    Only the boundary is global: the ``cut``-th key in the permutation order is
    found by histograms of its md5 digits (``order_boundary``), without a sort;
    the table itself (text and all) is then split by a narrow comparison with
    that key, with no shuffle and no copy of the wide rows.  ``key`` should be
    unique: rows of one key always share a side.  Rows with a null key count
    towards the size and are eval unless everything is train."""
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must be in [0, 1]")
    order_key = md5_order_key(seed, key)
    size = {}

    def cut(n):
        size["n"], size["cut"] = n, int(n * ratio)
        return size["cut"]

    edge = order_boundary(df.select(F.col(key), order_key.alias("_k")), "_k", key, cut)
    if size["cut"] >= size["n"]:
        return df.withColumn(split_col, F.lit("train"))
    if edge is None:  # the boundary lies among the null keys
        before = order_key.isNotNull()
    else:
        before = (order_key < F.lit(edge["_k"])) | \
            ((order_key == F.lit(edge["_k"])) & (F.col(key) < F.lit(edge[key])))
    return df.withColumn(split_col, F.when(before, F.lit("train")).otherwise(F.lit("eval")))


def split_fraction(df: DataFrame, key: str = "doc_id", ratio: float = 0.9, seed=42,
                   split_col: str = "split") -> DataFrame:
    return df.withColumn(split_col, F.when(md5_fraction(seed, key) < ratio, F.lit("train"))
                         .otherwise(F.lit("eval")))


def skip_done(todo: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``todo`` whose key is not in ``done`` (safe to run again)."""
    return todo.join(done.select(key), key, "left_anti")


def skip_counts(todo: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """A1: ``(processed, skipped)`` in one pass (a left join on the distinct
    done keys, counted with ``count_if``)."""
    flags = done.select(key).distinct().withColumn("_done", F.lit(True))
    j = todo.select(key).join(flags, key, "left")
    return j.agg(F.count_if(F.col("_done").isNull()).alias("processed"),
                 F.count_if(F.col("_done")).alias("skipped"))


def concat_pages(pages: DataFrame, doc_col: str = "doc_id", page_col: str = "page_no",
                 text_col: str = "text") -> DataFrame:
    """``(doc_col, n_pages, text)``: pages in order, glued with no separator
    (one group per document, bounded by the document's own size)."""
    return (pages.groupBy(doc_col)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(page_col).alias("p"),
                                                      F.col(text_col).alias("t"))))
                 .alias("_pg"))
            .select(doc_col, F.size("_pg").alias("n_pages"),
                    F.array_join(F.transform("_pg", lambda s: s["t"]), "").alias("text")))


def names(df: DataFrame, path_col: str = "path", index_col: str | None = None) -> DataFrame:
    """Stem of a path and the window file name derived from it."""
    base = F.regexp_extract(F.col(path_col), r"([^/]*)$", 1)
    out = df.withColumn("base", base).withColumn("stem", file_stem(F.col(path_col)))
    if index_col:
        out = out.withColumn("window_name", window_file_name(F.col("base"), F.col(index_col)))
    return out
