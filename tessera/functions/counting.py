"""Counts of what the words of many texts hold."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Different items that a task counts before it passes their counts on.
COUNTED_ITEMS = 1 << 18


def _columns(keys: list, width: int) -> list:
    """One string column for each part of the items ``keys``."""
    if width == 1:
        return [pa.array(keys, pa.string())]
    return [pa.array(part, pa.string()) for part in (zip(*keys) if keys else [[]] * width)]


def item_counts(texts: DataFrame, items, names: tuple) -> DataFrame:
    """``(*names, n long)``: how often every item that ``items(words)`` gives for
    the ``str.split`` words of a text occurs in the one column of ``texts``.  An
    item is a string, or a tuple of as many strings as there are ``names``.

    A task adds up at most ``COUNTED_ITEMS`` different items and those of one
    text before it passes them on; Spark adds these partial counts."""
    def run(batches):
        seen = Counter()

        def counted():
            return pa.RecordBatch.from_arrays(
                [*_columns(list(seen), len(names)), pa.array(list(seen.values()), pa.int64())],
                [*names, "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(items(text.split()))
                if len(seen) >= COUNTED_ITEMS:
                    yield counted()
                    seen.clear()
        if seen:
            yield counted()

    schema = ", ".join([f"`{name}` string" for name in names] + ["n long"])
    return texts.mapInArrow(run, schema).groupBy(*names).agg(F.sum("n").alias("n"))


def row_item_counts(rows: DataFrame, text_col: str, items, names: tuple, n_col: str) -> DataFrame:
    """``rows`` with, in place of ``text_col``, one row for every different item of
    its text: the item (``names``) and how often the text holds it (``n_col``)."""
    keep = [c for c in rows.columns if c != text_col]

    def run(batches):
        for batch in batches:
            at, keys, times = [], [], []
            for i, text in enumerate(batch.column(text_col).to_pylist()):
                seen = Counter(items((text or "").split()))
                at += [i] * len(seen)
                keys += seen
                times += seen.values()
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in keep), *_columns(keys, len(names)),
                 pa.array(times, pa.int64())], [*keep, *names, n_col])

    kept = rows.select(*keep).schema
    for name in names:
        kept = kept.add(name, "string")
    return rows.mapInArrow(run, kept.add(n_col, "long"))
