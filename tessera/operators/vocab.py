"""C4 default encoder: a vocabulary table built from the corpus itself.

Tokens are the whitespace words of the text (case kept).  Ids are ranks by
(count desc, token asc), starting at ``first_id`` (0 is the pad id).  The
ranking uses a distributed sort with per-partition offsets, never one task.
Encoding looks the commonest tokens, a table bounded in bytes, up where the text
lies; only the distinct rarer tokens of a slice of the text are joined, by shuffle,
with the rest of the vocabulary and regrouped by slice (bounded in bytes).  A
vocabulary within the bound has no rest: nothing is shuffled then.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.counting import item_counts
from tessera.functions.ordering import global_index
from tessera.functions.text import words

PAD_ID = 0
# bytes of token text that are shipped to every task
MAX_BROADCAST_BYTES = 16 << 20
# bytes of text whose words are looked up at once
SLICE_BYTES = 4 << 20
# spans of ids in which the hot tokens' bytes are counted
ID_SPANS = 4096
# a cold token's place in its slice's list, told from ids (32 bits) by this offset
_COLD = 1 << 32


def token_occurrences(docs: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, pos, token)`` of every word."""
    return docs.select(key, F.posexplode(words(F.col(text_col))).alias("pos", "token"))


def build_vocabulary(docs: DataFrame, text_col: str = "text", first_id: int = 1,
                     key: str = "doc_id") -> DataFrame:
    """``(token, id, n)``.  Tokens are counted where the text lies and these
    partial counts added, so hot tokens do not skew the shuffle."""
    counts = item_counts(docs.select(text_col), lambda tokens: tokens, ("token",))
    ranked = global_index(counts, [F.col("n").desc(), F.col("token").asc()], "id")
    # materialised once: every later use (size check, broadcast, joins) reads it
    return ranked.select("token", (F.col("id") + first_id).cast("int").alias("id"),
                         "n").checkpoint(eager=True)


def encode(docs: DataFrame, vocab: DataFrame, text_col: str = "text", key: str = "doc_id",
           unk_id: int | None = None, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``(key, input_ids array<int>)`` in text order; unknown tokens map to
    ``unk_id`` or are dropped when it is None.  ``vocab`` has distinct tokens, the
    commonest with the smallest ids; the bound decides where a token is looked up,
    never the result.  Keys may repeat or be null."""
    vocab = vocab.select("token", F.col("id").cast("long").alias("id")).filter("id IS NOT NULL")
    cut = _first_cold_id(vocab, max_broadcast_bytes)
    if cut is None:
        return _look_up(docs, vocab, text_col, key, unk_id).select(key, _as_ids(F.col("_ids")))
    # read twice below: the slices and their numbers are fixed here
    coded = _look_up(docs, vocab.filter(F.col("id") < cut), text_col, key, None,
                     keep_cold=True).checkpoint(eager=True)
    tokens = coded.select("_slice", F.posexplode("_cold").alias("_nth", "token"))
    rest = vocab.filter(F.col("id") >= cut).withColumnRenamed("id", "_id")
    found = (tokens.join(rest, "token", "left").groupBy("_slice")
             .agg(F.sort_array(F.collect_list(F.struct("_nth", "_id"))).alias("_found"))
             .withColumn("_found", F.transform("_found", lambda x: x["_id"])))
    cold, slices = F.size("_cold") > 0, ["_slice", "_keys", "_ends", "_ids"]
    whole = (coded.filter(cold).select(slices).join(found, "_slice").unionByName(
        coded.filter(~cold).select(*slices, F.array().cast("array<bigint>").alias("_found"))))
    return _filled(whole, docs.schema[key], unk_id)


def _filled(slices: DataFrame, key: T.StructField, unk_id: int | None) -> DataFrame:
    """The rows of ``slices``, with the found ids in place of their words' places."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("_ids")[i].values.to_numpy().copy()
                ends = batch.column("_ends")[i].values.to_numpy()
                found = batch.column("_found")[i].values
                lost = np.asarray(found.is_null())
                cold = np.flatnonzero(ids >= _COLD)
                place = ids[cold] - _COLD
                ids[cold] = found.fill_null(0 if unk_id is None else unk_id).to_numpy()[place]
                if unk_id is None:
                    known = np.ones(len(ids), bool)
                    known[cold] = ~lost[place]
                    ids, ends = ids[known], np.concatenate(([0], np.cumsum(known)))[ends]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_keys")[i].values, pa.ListArray.from_arrays(
                        ends.astype(np.int32), pa.array(ids.astype(np.int32)))],
                    [key.name, "input_ids"])

    schema = T.StructType([T.StructField(key.name, key.dataType),
                           T.StructField("input_ids", T.ArrayType(T.IntegerType()))])
    return slices.mapInArrow(run, schema)


def _as_ids(ids) -> Column:
    return ids.cast("array<int>").alias("input_ids")


def _first_cold_id(vocab: DataFrame, max_bytes: int) -> int | None:
    """The smallest id beyond the tokens that fit into ``max_bytes`` in order of
    their ids; None when all fit.  At most ``ID_SPANS`` + 1 sums are collected."""
    low, high, total = vocab.agg(F.min("id"), F.max("id"),
                                 F.sum(F.octet_length("token") + 16)).first()
    if total is None or total <= max_bytes:
        return None
    step = (high - low) // ID_SPANS + 1
    sums = (vocab.groupBy(F.floor((F.col("id") - low) / step).alias("span"))
            .agg(F.sum(F.octet_length("token") + 16).alias("bytes")).orderBy("span").collect())
    used = 0
    for r in sums:
        used += r.bytes
        if used > max_bytes:
            return low + r.span * step
    return None


def _text_slices(batch) -> Iterator:
    """Runs of a batch's rows with about ``SLICE_BYTES`` of text (one longer
    text stands alone)."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
    lo, used = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > lo and used + n > SLICE_BYTES:
            yield batch.slice(lo, i - lo)
            lo, used = i, 0
        used += n
    if batch.num_rows > lo:
        yield batch.slice(lo)


def _gathered(batches) -> Iterator:
    """Batches joined until they hold ``SLICE_BYTES`` of text, or the input ends."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def joined(waiting):
        return pa.Table.from_batches(waiting).combine_chunks().to_batches()

    waiting, used = [], 0
    for batch in batches:
        waiting.append(batch)
        used += pc.sum(pc.binary_length(batch.column(1))).as_py() or 0
        if used >= SLICE_BYTES:
            yield from joined(waiting)
            waiting, used = [], 0
    if waiting:
        yield from joined(waiting)


def _look_up(docs, vocab, text_col, key, unk_id, keep_cold=False) -> DataFrame:
    """One scan of the text and no shuffle: each task holds the table ``vocab``,
    as Arrow columns, and looks the distinct words of a slice up.  The result is
    ``(key, _ids)``, or with ``keep_cold`` a row for each slice: its number, the
    keys, the rows' ends among its ids, the ids, and the distinct words that the
    table lacks, for which ``_COLD`` + their place there stands among the ids."""
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    table = vocab.select("token", "id").toArrow().combine_chunks()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    bc = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())
    kind, longs = docs.schema[key].dataType, T.ArrayType(T.LongType())
    if keep_cold:
        fields = [T.StructField("_slice", T.LongType()), T.StructField("_keys", T.ArrayType(kind)),
                  T.StructField("_ends", T.ArrayType(T.IntegerType())),
                  T.StructField("_ids", longs), T.StructField("_cold", T.ArrayType(T.StringType()))]
    else:
        fields = [T.StructField(key, kind), T.StructField("_ids", longs)]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        with pa.ipc.open_stream(pa.py_buffer(bc.value)) as stream:
            table = stream.read_all().combine_chunks()
        ids_of = table.column("id").to_numpy()
        # null is no token: it stands for the words that the table lacks
        hot = table.column("token").combine_chunks().cast(pa.large_string())
        for batch in (part for b in _gathered(batches) for part in _text_slices(b)):
            flat, ends = [], [0]
            for text in batch.column(1).to_pylist():
                flat += (text or "").split()
                ends.append(len(flat))
            ends = np.array(ends, np.int32)
            coded = pa.array(flat, pa.large_string()).dictionary_encode()
            at = pc.index_in(coded.dictionary, value_set=hot)
            lacks = np.asarray(at.is_null())
            # the id of every distinct word; of those that lack, their order
            id_of = np.full(len(lacks), -1 if unk_id is None else unk_id, np.int64)
            id_of[~lacks] = ids_of[at.drop_null().to_numpy()]
            if keep_cold:
                id_of[lacks] = _COLD + np.arange(lacks.sum())
            word = coded.indices.to_numpy()
            ids = id_of[word]
            if keep_cold:
                one = lambda column: pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
                cold = coded.dictionary.filter(pa.array(lacks)).cast(pa.string())
                cols = [batch.column(2).slice(0, 1), *map(one, (
                    batch.column(0), pa.array(ends), pa.array(ids), cold))]
            else:
                if unk_id is None:
                    known = ~lacks[word]
                    ids, ends = ids[known], np.concatenate(([0], np.cumsum(known)))[ends]
                cols = [batch.column(0), pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(ids))]
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])

    number = [F.monotonically_increasing_id().alias("_slice")] if keep_cold else []
    return docs.select(key, text_col, *number).mapInArrow(run, T.StructType(fields))


def encode_with(docs: DataFrame, make_tokenizer, text_col: str = "text",
                out_col: str = "input_ids", add_special_tokens: bool = True) -> DataFrame:
    """C4 with a plug-in tokenizer: ``make_tokenizer()`` returns an object with
    ``encode(text, add_special_tokens=...) -> list[int]``, built once per task;
    Arrow batches in, ``array<int>`` out."""
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = make_tokenizer()
        for texts in batches:
            yield texts.map(lambda t: [] if t is None else
                            list(tok.encode(t, add_special_tokens=add_special_tokens)))

    return docs.withColumn(out_col, _encode(F.col(text_col)))


def pad_id_of(tokenizer) -> int:
    """Pad id, falling back to the end-of-sequence id when a tokenizer has none."""
    pad = getattr(tokenizer, "pad_token_id", None)
    return pad if pad is not None else tokenizer.eos_token_id
