"""Text -> vectors, pooling, normalisation.

* ``hash_embedding``: the built-in embedder (no weights needed): lower-cased
  whitespace words are hashed with MD5 by built-in expressions, dealt into
  ``dim`` buckets, counted and L2-normalised in Arrow batches.  Narrow.
* ``embed_with``: a plug-in model given as a factory, run through
  ``predict_batch_udf`` (Arrow batches of ``batch_size`` rows; the model is
  built once per Python worker).
* ``mean_pool``: masked mean of token vectors per group: one running vector per
  group and task, merged group by group; no group is ever collected.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import lower_words
from tessera.functions.vectors import l2_normalize

HASH_DIM = 64
# values of the hexadecimal digits that hashes are written in
_HEX = np.zeros(256, np.int64)
_HEX[list(b"0123456789abcdef")] = np.arange(16)
# texts whose counts are held as one matrix
_ROWS_AT_ONCE = 1024
# bytes of running vectors a pooling task holds before it hands them on
_RUNNING_BYTES = 64 << 20


def hash_bucket(word, dim: int = HASH_DIM) -> Column:
    """Bucket of a word: first 16 bits of its MD5, modulo ``dim``."""
    return F.pmod(F.conv(F.substring(F.md5(word), 1, 4), 16, 10).cast("int"), F.lit(dim))


def _unit_counts(row: np.ndarray, bucket: np.ndarray, n: int, dim: int) -> np.ndarray:
    """(n, dim) unit count vectors of ``(row, bucket)`` pairs, a row without
    any staying zero.  Sums of squared counts are whole numbers, so the result
    does not depend on any order."""
    counts = np.bincount(row * dim + bucket, minlength=n * dim).reshape(n, dim).astype(np.float64)
    norm = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return np.divide(counts, norm, out=counts, where=norm > 0)


def _as_lists(matrix: np.ndarray) -> pa.Array:
    n, dim = matrix.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * dim, matrix.ravel())


def _flat_buckets(heads: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all lists of the batch, whose words came as ``word_heads``, and
    the number of each list; null counts as empty."""
    sizes = heads.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = heads.flatten().cast(pa.binary(4))
    digits = np.frombuffer(flat.buffers()[1], np.uint8, 4 * len(flat), 4 * flat.offset) \
        if len(flat) else np.zeros(0, np.uint8)
    return _HEX[digits.reshape(-1, 4)] @ np.array([4096, 256, 16, 1]) % dim, sizes


def _slices(n: int):
    """Row ranges of a batch whose count matrices stay small."""
    return ((lo, min(lo + _ROWS_AT_ONCE, n)) for lo in range(0, n, _ROWS_AT_ONCE))


def word_buckets(text, dim: int = HASH_DIM) -> Column:
    """Bucket of every lower-cased whitespace word of ``text``, in order."""
    text = F.col(text) if isinstance(text, str) else text
    return F.transform(lower_words(text), lambda w: hash_bucket(w, dim))


def word_heads(text) -> Column:
    """First four digits of the MD5 of every lower-cased whitespace word of
    ``text``, in order: ``hash_bucket`` less its arithmetic, which costs more than
    half of the digest where it is done word by word."""
    text = F.col(text) if isinstance(text, str) else text
    return F.transform(lower_words(text), lambda w: F.substring(F.md5(w), 1, 4))


def chunk_hash_embeddings(text, chunk_words: int, dim: int = HASH_DIM) -> Column:
    """Hash embeddings of the disjoint ``chunk_words``-word chunks of ``text``
    (same values as ``hash_embedding`` of each chunk's text): every word is
    hashed once per document and the chunks count their buckets."""
    @F.arrow_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def count(heads: pa.Array) -> pa.Array:
        flat, sizes = _flat_buckets(heads, dim)
        chunks = -(-sizes // chunk_words)
        first = np.concatenate(([0], np.cumsum(chunks)))
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        row = np.repeat(first[:-1], sizes) + place // chunk_words
        vectors = _as_lists(_unit_counts(row, flat, int(first[-1]), dim))
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), vectors)

    return count(word_heads(text))


def hash_embedding(text, dim: int = HASH_DIM) -> Column:
    """``array<double>`` of unit length (zero vector for a text without words
    or a null text).

    Words are split and hashed by built-in functions; a batch's buckets are
    counted at once (``bincount``).  Narrow, no shuffle."""
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def count(heads: pa.Array) -> pa.Array:
        parts = []
        for lo, hi in _slices(len(heads)):
            flat, sizes = _flat_buckets(heads.slice(lo, hi - lo), dim)
            row = np.repeat(np.arange(hi - lo), sizes)
            parts.append(_as_lists(_unit_counts(row, flat, hi - lo, dim)))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))

    return count(word_heads(text))


def embed_with(df: DataFrame, make_model: Callable, text_col: str = "text",
               out_col: str = "embedding", batch_size: int = 8,
               max_chars: int | None = None) -> DataFrame:
    """Plug-in embedder: ``make_model()`` returns ``f(np.ndarray[str]) ->
    np.ndarray[(n, dim)]``; outputs are L2-normalised."""
    from pyspark.ml.functions import predict_batch_udf

    def make_predict():
        import numpy as np
        from tessera.operators.perplexity import cut_tokens
        model = make_model()

        def predict(texts):
            if getattr(model, "max_tokens", None):  # T5: token cut before the model
                texts = np.array([cut_tokens(model, t) for t in texts], dtype=object)
            v = np.asarray(model(texts), dtype=np.float32)
            n = np.linalg.norm(v, axis=1, keepdims=True)
            return np.where(n > 0, v / np.where(n > 0, n, 1), v)
        return predict

    udf = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size)
    text = F.col(text_col)
    if max_chars:
        text = F.substring(text, 1, max_chars)
    return df.withColumn(out_col, udf(text))


def mean_pool(tokens: DataFrame, group_col: str, vec_col: str = "vec",
              mask_col: str | None = "mask") -> DataFrame:
    """A5: ``sum(vec * mask) / max(sum(mask), 1e-9)`` per dimension and group.

    ``(group_col, pooled array<double>)``.  A task keeps one running vector and
    weight per group it meets, so a group that holds a third of all tokens
    costs one row a task; these rows meet sorted by group and are added up one
    group at a time.  A null vector takes no part, a null component or mask
    counts as zero; where widths differ a group is as wide as its widest vector."""
    mask = F.col(mask_col).cast("double") if mask_col else F.lit(1.0)
    tokens = tokens.filter(F.col(vec_col).isNotNull()).select(
        F.col(group_col).alias("_g"), F.col(vec_col).cast("array<double>").alias("_s"),
        F.coalesce(mask, F.lit(0.0)).alias("_m"))
    kind = tokens.schema["_g"].dataType
    running = T.StructType([T.StructField("_g", kind), T.StructField("_s", T.ArrayType(T.DoubleType())),
                            T.StructField("_w", T.ArrayType(T.DoubleType()))])

    def partial(batches):
        groups = _Running()
        for batch in batches:
            mask = batch.column("_m").to_numpy(zero_copy_only=False)
            groups.add(batch.column("_g"), batch.column("_s"), mask=mask)
            if groups.bytes > _RUNNING_BYTES:
                yield groups.batch(batch.schema.field("_g").type)
                groups = _Running()
        if groups.sums:
            yield groups.batch(batch.schema.field("_g").type)

    def merge(batches):
        groups = _Running()
        for batch in batches:
            if not batch.num_rows:
                continue
            groups.add(batch.column("_g"), batch.column("_s"), weights=batch.column("_w"))
            last = batch.column("_g")[-1].as_py()
            open_ = groups.take(last)  # its rows may go on in the next batch
            if groups.sums:
                yield groups.pooled(batch.schema.field("_g").type)
            groups = open_
        if groups.sums:
            yield groups.pooled(batch.schema.field("_g").type)

    return (tokens.mapInArrow(partial, running)
            .repartition("_g").sortWithinPartitions("_g")
            .mapInArrow(merge, T.StructType([T.StructField("_g", kind),
                                             T.StructField("pooled", T.ArrayType(T.DoubleType()))]))
            .withColumnRenamed("_g", group_col))


class _Running:
    """Running vector sums and weights of the groups met so far."""

    def __init__(self):
        self.sums, self.weights, self.bytes = {}, {}, 0

    def add(self, groups, vectors, mask=None, weights=None):
        """Add the rows of a batch; a row's weight is its ``mask`` in every
        dimension it has, or the list in ``weights``."""
        widths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        starts = np.cumsum(widths) - widths
        flat = vectors.flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
        heavy = None if weights is None else weights.flatten().to_numpy(zero_copy_only=False)
        coded = groups.dictionary_encode(null_encoding="encode")
        keys, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        for width in np.unique(widths):  # one width as a rule
            rows = np.flatnonzero(widths == width)
            rows = rows[np.argsort(codes[rows], kind="stable")]
            cells = starts[rows, None] + np.arange(width)
            values = flat[cells]
            if heavy is None:
                values = values * mask[rows, None]
                counted = np.broadcast_to(mask[rows, None], values.shape)
            else:
                counted = heavy[cells]
            heads = np.flatnonzero(np.diff(codes[rows], prepend=-1))
            if not width:
                continue
            for code, s, w in zip(codes[rows[heads]], np.add.reduceat(values, heads, axis=0),
                                  np.add.reduceat(counted, heads, axis=0)):
                self._put(keys[code], s, w)

    def _put(self, key, s, w):
        if key not in self.sums:
            self.bytes += 16 * len(s) + 200
        elif len(self.sums[key]) == len(s):
            s, w = self.sums[key] + s, self.weights[key] + w
        else:
            wide = max(len(s), len(self.sums[key]))
            s, w = (np.pad(a, (0, wide - len(a))) + np.pad(b, (0, wide - len(b)))
                    for a, b in ((self.sums[key], s), (self.weights[key], w)))
        self.sums[key], self.weights[key] = s, w

    def take(self, key) -> "_Running":
        """Move one group into an object of its own."""
        out = _Running()
        if key in self.sums:
            out._put(key, self.sums.pop(key), self.weights.pop(key))
        return out

    def batch(self, kind):
        lists = pa.list_(pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(self.sums), kind), pa.array(list(self.sums.values()), lists),
             pa.array(list(self.weights.values()), lists)], ["_g", "_s", "_w"])

    def pooled(self, kind):
        means = [s / np.maximum(self.weights[key], 1e-9) for key, s in self.sums.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(self.sums), kind), pa.array(means, pa.list_(pa.float64()))],
            ["_g", "pooled"])


def normalize(df: DataFrame, vec_col: str = "embedding", out_col: str | None = None) -> DataFrame:
    """V3: L2-normalise rows (zero vector unchanged)."""
    return df.withColumn(out_col or vec_col, l2_normalize(vec_col))
