"""One row in, many rows out: word chunks, token windows, padding.

All forms are narrow (no shuffle): arrays are built with ``sequence`` +
``transform`` + ``slice`` inside the row and exploded with ``posexplode``, so
the ordinal (``chunk_id``, 0-based per document) comes for free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import let, words


def _starts(n: Column, step: int) -> Column:
    # sequence(0, -1, step) throws, so an empty input gets an empty array
    return F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))) \
        .otherwise(F.array().cast("array<int>"))


def word_chunk_array(text, size: int) -> Column:
    """Disjoint ``size``-word pieces of ``text.split()``, joined by one space."""
    if size < 1:
        raise ValueError("size must be >= 1")
    return let(words(text), lambda ws: F.transform(
        _starts(F.size(ws), size), lambda i: F.array_join(F.slice(ws, i + 1, size), " ")))


def word_chunks(df: DataFrame, size: int = 1500, text_col: str = "text",
                keep: tuple = ("doc_id",)) -> DataFrame:
    """``(keep..., chunk_id, text)``; empty pieces are dropped."""
    out = df.select(*keep, F.posexplode(word_chunk_array(F.col(text_col), size))
                    .alias("chunk_id", "text"))
    return out.filter(F.col("text") != "")


def window_array(ids, max_length: int, stride: int, min_tokens: int = 10) -> Column:
    """Overlapping windows of an id array.

    Starts at 0, step, 2*step, ... while start < n, with step = max_length -
    stride (a trailing window inside the previous one is still emitted);
    windows shorter than ``min_tokens`` are dropped before numbering."""
    if stride >= max_length:
        raise ValueError("stride must be smaller than max_length")
    if stride < 0:
        raise ValueError("stride must be >= 0")
    step = max_length - stride
    ids = F.col(ids) if isinstance(ids, str) else ids
    wins = F.transform(_starts(F.size(ids), step),
                       lambda i: F.slice(ids, i + 1, max_length))
    return F.filter(wins, lambda w: F.size(w) >= min_tokens)


def pad_right(arr, length: int, pad) -> Column:
    """P12/C2 padding: right-pad to ``length`` (never truncates)."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    n = F.greatest(F.lit(length) - F.size(arr), F.lit(0))
    return F.concat(arr, F.array_repeat(F.lit(pad).cast("int"), n))


def token_windows(df: DataFrame, ids_col: str = "input_ids", max_length: int = 2048,
                  stride: int = 512, min_tokens: int = 10, pad_id: int | None = None,
                  keep: tuple = ("doc_id",)) -> DataFrame:
    """``(keep..., chunk_id, input_ids, labels)``; with ``pad_id`` windows are
    right-padded to ``max_length`` and labels equal input_ids, pads included."""
    out = df.select(*keep, F.posexplode(window_array(ids_col, max_length, stride, min_tokens))
                    .alias("chunk_id", "input_ids"))
    if pad_id is not None:
        out = out.withColumn("input_ids", pad_right("input_ids", max_length, pad_id))
    return out.withColumn("labels", F.col("input_ids"))


def default_attention_mask(df: DataFrame, ids_col: str = "input_ids",
                           mask_col: str = "attention_mask") -> DataFrame:
    """A missing mask becomes ones over the full length, pads included."""
    ones = F.array_repeat(F.lit(1), F.size(ids_col))
    if mask_col in df.columns:
        return df.withColumn(mask_col, F.coalesce(F.col(mask_col), ones))
    return df.withColumn(mask_col, ones)


def truncate(arr, max_len: int) -> Column:
    """T5: keep the first ``max_len`` elements before a model sees them."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    return F.slice(arr, 1, max_len)
