"""Operator 4: token counts by overlap resynchronisation.

Texts up to ``chunk_chars`` are encoded in one piece.  A longer ("huge") text
is cut into chunks that overlap by ``overlap_chars``; the chunks are dealt over
the cluster and encoded with offsets, and neighbours are spliced at a boundary
inside their common stretch that is *proven stable*:

* no vocabulary piece holds the word mark after another character (checked
  against the model when it is loaded), so no merge ever crosses a place where
  a space follows a non-space; and
* both encodings do have a token boundary there.

If the stretch holds no such place, or the two encodings disagree, the
documents concerned are encoded again with an overlap eight times wider, until
a chunk covers the whole text.  Only counts leave the tasks.

Defined cases: a null or empty text has 0 bytes and 0 tokens; copies of a huge
text are encoded once; repeated rows and null ids pass through one for one; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_arrow_columns, col, tokenizer_file, worker_cache, written

MODEL = "piece_bpe_32k.model"
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
LIMIT = 4096
MARK = "▁"

CHUNK_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("chunk", T.IntegerType()),
    T.StructField("piece", T.StringType()), T.StructField("overlap", T.IntegerType()),
    T.StructField("first", T.BooleanType()), T.StructField("last", T.BooleanType())])

SPLICE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("chunk", T.IntegerType()),
    T.StructField("last", T.BooleanType()),
    T.StructField("head", T.LongType()), T.StructField("head_tokens", T.LongType()),
    T.StructField("tail", T.LongType()), T.StructField("tail_tokens", T.LongType())])


class Model:
    """The sentencepiece model, the bytes each piece covers, and whether a
    space is a stable boundary."""

    def __init__(self, path: str):
        import numpy as np
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.stable_space = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.covers = np.array([1 if sp.is_byte(i) else len(p.replace(MARK, " ").encode())
                                for i, p in enumerate(pieces)])

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.sp.encode(texts, num_threads=1, return_type="numpy")]

    def starts(self, text: str):
        """Byte offset at which each token begins.  Pieces cover their own
        bytes and one byte of added space before the text; where that does not
        add up, the library's own offsets are taken."""
        import numpy as np

        size = self.covers[self.sp.encode(text, return_type="numpy")]
        ends = np.cumsum(size) - 1
        if len(ends) and ends[-1] == len(text.encode()):
            return np.concatenate(([0], ends[:-1]))
        chars = self.sp.encode(text, return_type="offset_mapping")["offsets"]
        before = np.concatenate(([0], np.cumsum([len(c.encode()) for c in text])))
        return before[[a for a, _ in chars]]


def _model(path: str) -> Model:
    return worker_cache(("pieces", path), lambda: Model(path))


def stable_place(text: str, low: int, high: int) -> int | None:
    """First position in ``(low, high)`` where a space follows a character that
    is neither a space nor the word mark itself."""
    at = low
    while True:
        at = text.find(" ", at + 1, high)
        if at <= low:
            return None
        if text[at - 1] not in (" ", MARK):
            return at


def cut_chunks(key: str, text: str, size: int, overlap: int):
    """``(key, chunk, piece, overlap, first, last)`` rows of one text.  A chunk
    reaches ``overlap`` characters into the next one."""
    n = len(text)
    starts = list(range(0, max(1, n), size))
    if len(starts) > 1 and n - starts[-1] <= overlap:
        starts.pop()
    for i, s in enumerate(starts):
        last = i + 1 == len(starts)
        yield key, i, text[s:] if last else text[s:s + size + overlap], overlap, i == 0, last


def splice_row(model: Model, key, chunk, piece, size, overlap, first, last):
    """Places and token counts at the two ends of a chunk.  Positions are
    relative to the neighbours' common stretch, so both can be compared."""
    head, head_tokens, tail, tail_tokens = 0, 0, None, None
    begins = model.starts(piece)

    def tokens_before(place):
        """Tokens left of ``place``; None if no token begins there."""
        if place is None:
            return None
        at = len(piece[:place].encode())
        i = int(begins.searchsorted(at))
        return i if i < len(begins) and begins[i] == at else None

    if not first:
        head = stable_place(piece, 0, overlap) if model.stable_space else None
        head_tokens = tokens_before(head)
    if last:
        tail, tail_tokens = -1, len(begins)
    elif model.stable_space:
        place = stable_place(piece, size, size + overlap)
        tail_tokens = tokens_before(place)
        tail = place - size if place is not None else None
    return key, chunk, last, head, head_tokens, tail, tail_tokens


def _chunk_table(huge: DataFrame, size: int, overlap: int) -> DataFrame:
    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for row in cut_chunks(key, text, size, overlap):
                    rows.append(dict(zip(CHUNK_SCHEMA.names, row)))
                    if len(rows) == 64:
                        yield pa.RecordBatch.from_pylist(rows, CHUNK_ARROW())
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, CHUNK_ARROW())

    def CHUNK_ARROW():
        import pyarrow as pa

        return pa.schema([("key", pa.string()), ("chunk", pa.int32()), ("piece", pa.string()),
                          ("overlap", pa.int32()), ("first", pa.bool_()), ("last", pa.bool_())])

    cutted = huge.select("key", "text").mapInArrow(cut, CHUNK_SCHEMA)
    # copies of a text give the same chunks: one of each stays, and the shuffle
    # deals the chunks of a document over the cluster
    return cutted.groupBy("key", "chunk").agg(
        *[F.first(c).alias(c) for c in ("piece", "overlap", "first", "last")])


def _splices(chunks: DataFrame, path: str | None, size: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        model = _model(path or tokenizer_file(MODEL))
        schema = pa.schema([("key", pa.string()), ("chunk", pa.int32()), ("last", pa.bool_()),
                            *[(n, pa.int64()) for n in SPLICE_SCHEMA.names[3:]]])
        for batch in batches:
            rows = [dict(zip(SPLICE_SCHEMA.names, splice_row(
                model, r["key"], r["chunk"], r["piece"], size, r["overlap"], r["first"], r["last"])))
                for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return chunks.select("key", "chunk", "piece", "overlap", "first", "last").mapInArrow(
        run, SPLICE_SCHEMA)


def huge_counts(huge: DataFrame, model: str | None, chunk_chars: int,
                overlap_chars: int) -> DataFrame:
    """``(key, n_tokens)`` of each distinct huge text; ``huge`` has ``key`` and
    ``text``."""
    done, todo, size, overlap = [], huge, chunk_chars, overlap_chars
    while True:
        rows = written(_splices(_chunk_table(todo, size, overlap), model, size), "splices")
        # a chunk's tail place must be its right neighbour's head place
        left = rows.select("key", (F.col("chunk") + 1).alias("chunk"),
                           F.col("tail").alias("left_tail"))
        joined = rows.join(left, ["key", "chunk"], "left")
        ok = F.col("head_tokens").isNotNull() & F.col("tail_tokens").isNotNull() & (
            (F.col("chunk") == 0) | (F.col("head") == F.col("left_tail")))
        sums = joined.groupBy("key").agg(
            F.sum(F.col("tail_tokens") - F.col("head_tokens")).alias("n_tokens"),
            F.min(F.coalesce(ok, F.lit(False))).alias("ok"))
        sums = written(sums, "splice_sums")
        done.append(sums.filter("ok").select("key", "n_tokens"))
        failed = sums.filter("NOT ok").select("key")
        if failed.isEmpty():
            break
        overlap *= 8
        size = max(size, overlap)
        todo = huge.join(failed, "key", "left_semi")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def count_tokens(df: DataFrame, text: str = "text", model: str | None = None,
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``df`` without its text, plus ``n_bytes`` (UTF-8) and ``n_tokens``.  ``model`` is a file
    that every executor can read; the default is the installed public one."""
    if not 0 < overlap_chars <= chunk_chars:
        raise ValueError("0 < overlap_chars <= chunk_chars")
    schema = T.StructType([T.StructField("_short", T.LongType())])

    def run(batches):
        import pyarrow as pa

        m = _model(model or tokenizer_file(MODEL))
        for batch in batches:
            texts = batch.field("text").to_pylist()
            yield pa.StructArray.from_arrays(
                [pa.array(m.counts([t or "" for t in texts]), pa.int64())], ["_short"])

    body = col(df, text)
    huge = F.coalesce(F.length(body) > chunk_chars, F.lit(False))
    own = ("n_bytes", "n_tokens", "key", "_body", "_huge", "_short")
    kept = [c for c in df.columns if c.lower() not in own and c != text]
    base = df.select(
        *[col(df, c) for c in kept],
        F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"),
        body.alias("_body"), huge.alias("_huge"))
    names = [F.col("`" + c.replace("`", "``") + "`") for c in kept]
    short = add_arrow_columns(base.filter("NOT _huge"), {"text": F.col("_body")}, schema, run)
    source = df.select(body.alias("text")).filter(F.length("text") > chunk_chars)
    long = huge_counts(source.withColumn("key", F.sha2("text", 256)), model,
                       chunk_chars, overlap_chars)
    keyed = base.filter("_huge").select(*names, "n_bytes", F.sha2("_body", 256).alias("key"))
    return short.select(*names, "n_bytes", F.col("_short").alias("n_tokens")).unionByName(
        keyed.join(long, "key").select(*names, "n_bytes", "n_tokens"))


def op4(docs: DataFrame) -> DataFrame:
    out = count_tokens(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_tokens",
                      (F.col("n_tokens") > LIMIT).alias("over_limit"))
