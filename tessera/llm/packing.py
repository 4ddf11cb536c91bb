"""Operator 6: best-fit packing by fitted length patterns.

1. Texts become token ids (the public word vocabulary, each text closed by id
   0), longer ones are cut into pieces of ``capacity`` tokens.
2. The histogram of piece lengths, at most ``capacity`` rows, goes to the
   driver.  Every pattern of at most three lengths that exactly fills a
   sequence is enumerated, and non-negative least squares fits how often each
   pattern repeats.
3. Repeats are rounded, as far as the stock of each length reaches; the
   residual pieces go, longest first, into the fullest sequence that still has
   room, or open a new one.
4. The resulting recipe speaks of the i-th piece of a length.  Pieces are
   numbered within their length by salted windows and look their place up.

Only the histogram and the recipe, both bounded by ``capacity``, pass through
the driver; no task holds more than a salted group.

Defined cases: a null or empty text is the single id 0; repeated rows are
packed one by one; null ids are kept; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import bytescan
from tessera.llm.common import col, tokenizer_file, worker_cache, written

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
CLOSING_ID = 0
#: Bytes of cached units in a worker, and of text worked on at once.
CACHE_BYTES = 24 << 20
SLICE_BYTES = 1 << 20

# The vocabulary's contractions and special strings.
_CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")
_SPECIAL = re.compile("<\\|(?:start|end)oftext\\|>")

# Byte classes of the vocabulary's split pattern: white space is dropped, runs of
# letters and runs of others stay together, a digit stands alone.
_SPACE, _LETTER, _DIGIT, _OTHER, _WIDE = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[32, *range(9, 14)]] = _SPACE
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[128:] = _WIDE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def units(buf, offsets):
    """Lower-cased bytes, and start, end and row of every unit: the split
    pattern's matches in ASCII words; words with other bytes stay whole, as they
    are.  The vocabulary never merges across units."""
    starts, ends, rows = bytescan.word_spans(buf, offsets)
    if not len(starts):
        return buf, starts, ends, rows
    wide = np.logical_or.reduceat(buf > 127, starts)  # up to the next word: white space
    step = np.zeros(len(buf) + 1, np.int8)
    step[starts[wide]] = 1
    step[ends[wide]] -= 1
    whole = np.cumsum(step[:-1], dtype=np.int8) > 0
    low = np.where(whole, buf, _LOWER[buf])
    buf = low
    kind = _CLASS[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    # an apostrophe alone between other classes takes a contraction's letters
    lone = np.flatnonzero((buf[:-1] == 39) & (kind[1:] == _LETTER))
    end = offsets[np.searchsorted(offsets, lone, "right")]
    opens = (kind[lone - 1] != _OTHER) | np.isin(lone, offsets)
    lone, end = lone[opens], end[opens]
    take = np.zeros(len(lone), np.int64)
    for c in _CONTRACTIONS:
        hit = (buf[lone + 1] == ord(c[0])) & (lone + 1 + len(c) <= end)
        if len(c) == 2:
            hit &= buf[np.minimum(lone + 2, len(buf) - 1)] == ord(c[1])
        take[hit] = len(c)
    lone, take = lone[take > 0], take[take > 0]
    edge[lone + 1] = False
    edge[lone + 1 + take] = True
    edge[1:-1] &= ~(whole[1:] & whole[:-1])
    edge[offsets] = True
    edge[starts] = True
    edge[ends] = True
    at = np.flatnonzero(edge)
    begin, stop = at[:-1], at[1:]
    ok = kind[begin] != _SPACE
    begin, stop = begin[ok], stop[ok]
    return low, begin, stop, np.searchsorted(offsets, begin, "right") - 1


class WordEncoder:
    """The tokenizer behind a cache of units: sorted 64-bit hashes and the ids
    they stand for, bounded in bytes."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        import os

        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.cache_bytes = cache_bytes
        known = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(known.values()) + 1, bool)
        self.ends_word[[i for t, i in known.items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.at, self.count = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and id counts of single ASCII units, encoded many to a text: a
        unit's last id, and no other, is one that ends a word."""
        texts = [" ".join(parts[i:i + 64]) for i in range(0, len(parts), 64)]
        ids = np.concatenate([np.array(x, np.int32) for x in self._library(texts)])
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(parts):
            raise ValueError("the vocabulary does not mark the ends of units")
        return ids, np.diff(ends, prepend=0)

    def _learn(self, keys: np.ndarray, parts: list[bytes]) -> None:
        text = [p.decode() for p in parts]
        single = np.array([t.isascii() for t in text])
        order = np.argsort(~single, kind="stable")
        keys, text = keys[order], [text[i] for i in order]
        n = int(single.sum())
        flat, count = self._together(text[:n]) if n else (np.zeros(0, np.int32),) * 2
        rest = self._library(text[n:]) if n < len(text) else []
        count = np.concatenate((count, [len(x) for x in rest])).astype(np.int64)
        ids = [flat, np.array([i for x in rest for i in x], np.int32)]
        at = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate((self.ids, *ids)).astype(np.int32)
        order = np.argsort(np.concatenate((self.keys, keys)), kind="stable")
        self.keys = np.concatenate((self.keys, keys))[order]
        self.at = np.concatenate((self.at, at))[order]
        self.count = np.concatenate((self.count, count)).astype(np.int32)[order]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        import pyarrow as pa

        return self.encode_rows(*bytescan.text_buffer(pa.array(texts, pa.large_string())))

    def encode_rows(self, buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of every text of a buffer."""
        flat, cut = self._encode(buf, offsets)
        out = np.split(flat, cut[1:-1]) if len(offsets) > 1 else []
        for r in _special_rows(buf, offsets):
            text = buf[offsets[r]:offsets[r + 1]].tobytes().decode()
            out[r] = np.array(self._library([text])[0], np.int32)
        return out

    def _encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts, where each text's ids begin)``."""
        if 20 * len(self.keys) + 4 * len(self.ids) > self.cache_bytes:
            self._clear()
        buf, starts, ends, rows = units(buf, offsets)
        key, first, back = np.unique(bytescan.word_hashes(buf, starts, ends), return_index=True,
                                     return_inverse=True)
        spot = np.searchsorted(self.keys, key)
        old = np.zeros(len(key), bool)
        if len(self.keys):
            old = self.keys[np.minimum(spot, len(self.keys) - 1)] == key
        if not old.all():
            new = first[~old]
            self._learn(key[~old], [buf[a:b].tobytes() for a, b in zip(starts[new], ends[new])])
            spot = np.searchsorted(self.keys, key)
        part = spot[back]
        count = self.count[part]
        stop = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
        ids = self.ids[np.arange(stop[-1]) + np.repeat(self.at[part] - stop[:-1], count)]
        return ids, stop[np.searchsorted(rows, np.arange(len(offsets)))]


def _special_rows(buf, offsets) -> set[int]:
    """Rows that hold one of the vocabulary's special strings."""
    at = np.flatnonzero((buf[:-1] == ord("<")) & (buf[1:] == ord("|")))
    rows = np.unique(np.searchsorted(offsets, at, "right") - 1)
    return {int(r) for r in rows if _SPECIAL.search(
        buf[offsets[r]:offsets[r + 1]].tobytes().decode())}


def pieces(df: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY,
           vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, on
    request, the ids."""
    key_type = df.select(col(df, key)).schema[0].dataType
    fields = [T.StructField("doc_id", key_type), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches):
        import pyarrow as pa

        path = vocabulary or tokenizer_file(VOCABULARY)
        encoder = worker_cache(("words", path), lambda: WordEncoder(path))
        for batch in batches:
            buf, off = bytescan.text_buffer(batch.column(1))
            row, nth, start, length, crc, ids_out = [], [], [], [], [], []
            for a, b in bytescan.row_slices(off, SLICE_BYTES):
                rows = encoder.encode_rows(buf[off[a]:off[b]], off[a:b + 1] - off[a])
                for i, ids in enumerate(rows, a):
                    ids = np.concatenate((ids, [CLOSING_ID])).astype("<u4")
                    for n, s in enumerate(range(0, len(ids), capacity)):
                        chunk = ids[s:s + capacity]
                        row.append(i)
                        nth.append(n)
                        start.append(s)
                        length.append(len(chunk))
                        crc.append(zlib.crc32(chunk.tobytes()))
                        if with_ids:
                            ids_out.append(chunk.astype(np.int32))
            cols = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(nth, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.array(ids_out, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])

    return df.select(col(df, key).alias("doc_id"), col(df, text).alias("text")).mapInArrow(
        run, T.StructType(fields))


def patterns(capacity: int, present: np.ndarray) -> np.ndarray:
    """All ways to fill ``capacity`` with at most three of the ``present``
    lengths, largest first; 0 stands for no length."""
    have = np.zeros(capacity + 1, bool)
    have[present] = True
    have[0] = True
    a, b = np.meshgrid(present, np.concatenate(([0], present)), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = capacity - a - b
    ok = (c >= 0) & (c <= b) & (b <= a)
    a, b, c = a[ok], b[ok], c[ok]
    ok = have[c]
    return np.stack((a[ok], b[ok], c[ok]), 1)


def non_negative_fit(cols: np.ndarray, target: np.ndarray, rounds: int = 120) -> np.ndarray:
    """Non-negative least squares ``min |A x - target|``, ``x >= 0``, by
    multiplicative updates.  ``cols[j]`` names the rows (0 is none) in which
    column j counts one each time it is named, so ``A`` is never built."""
    goal = target.astype(float).copy()
    goal[0] = 0
    wanted = goal[cols].sum(1)
    x = np.full(len(cols), goal.sum() / max(1, 3 * len(cols)))
    for _ in range(rounds):
        made = np.zeros(len(goal))
        for part in cols.T:
            made += np.bincount(part, x, len(goal))
        made[0] = 0
        x *= wanted / np.maximum(made[cols].sum(1), 1e-9)
    return x


def whole_repeats(x: np.ndarray) -> np.ndarray:
    """Round repeats so that running sums stay within one of the exact ones:
    neighbouring patterns share their longest length, whose total then fits."""
    ends = np.floor(np.cumsum(x) + 0.5)
    return np.diff(np.concatenate(([0], ends))).astype(np.int64)


@dataclass
class Group:
    """``times`` equal sequences: runs of ``(length, copies)`` and free room."""

    runs: list
    room: int
    times: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Sequences for a histogram of lengths, as groups of equal ones."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    groups: list[Group] = []
    cols = patterns(capacity, np.flatnonzero(left))
    repeats = whole_repeats(non_negative_fit(cols, left)) if len(cols) else np.zeros(0)
    stock = left.tolist()
    for j in np.flatnonzero(repeats).tolist():
        need: dict[int, int] = {}
        for length in cols[j].tolist():
            if length:
                need[length] = need.get(length, 0) + 1
        times = min(int(repeats[j]), *(stock[x] // k for x, k in need.items()))
        if times > 0:
            for x, k in need.items():
                stock[x] -= times * k
            groups.append(Group(list(need.items()), 0, times))
    return best_fit(groups, dict(enumerate(stock)), capacity)


def best_fit(groups: list[Group], left: dict[int, int], capacity: int) -> list[Group]:
    """Put the pieces of ``left``, longest first, where least room remains."""
    by_room: dict[int, list[Group]] = {}
    for g in groups:
        by_room.setdefault(g.room, []).append(g)
    has = np.zeros(capacity + 1, bool)
    has[list(by_room)] = True
    for length in sorted((x for x, n in left.items() if n > 0), reverse=True):
        n = left[length]
        while n > 0:
            at = length + int(np.argmax(has[length:])) if has[length:].any() else -1
            if at < 0:
                each = min(n, capacity // length)
                times = n // each
                made = Group([(length, each)], capacity - each * length, times)
                n -= each * times
            else:
                g = by_room[at].pop()
                if not by_room[at]:
                    has[at] = False
                each = max(1, min(at // length, n // g.times))
                times = min(g.times, n)
                if times < g.times:
                    by_room[at].append(Group(list(g.runs), g.room, g.times - times))
                    has[at] = True
                made = Group([*g.runs, (length, each)], at - each * length, times)
                n -= each * times
            by_room.setdefault(made.room, []).append(made)
            has[made.room] = True
    return [g for room in sorted(by_room) for g in by_room[room]]


def recipe(groups: list[Group]) -> np.ndarray:
    """Rows ``length, first ordinal, first sequence, sequences, offset``: the
    pieces of a length, from an ordinal on, fill one position of a group."""
    rows, taken, base = [], {}, 0
    for g in groups:
        at = 0
        for length, each in g.runs:
            lo = taken.get(length, 0)
            rows.append((length, lo, base, g.times, at))
            taken[length] = lo + each * g.times
            at += length * each
        base += g.times
    out = np.array(rows, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def place(piece_rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``piece_rows`` (a written table with ``length`` and a distinct ``row``)
    plus ``sequence_id`` and ``offset``."""
    counts = {r["length"]: r["count"] for r in piece_rows.groupBy("length").count().collect()}
    table = recipe(plan(counts, capacity))
    salts = max(64, sum(counts.values()) // 200_000)
    salted = piece_rows.withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    ranked = salted.withColumn("_rank", F.row_number().over(
        Window.partitionBy("length", "_salt").orderBy("row")))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("length", "_salt", (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"))
    numbered = ranked.join(before, ["length", "_salt"]).withColumn(
        "_ordinal", F.col("_rank") + F.col("_before") - 1)
    schema = T.StructType([*piece_rows.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    names = piece_rows.columns

    def run(batches):
        import pyarrow as pa

        keys = (table[:, 0] << 44) | table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            ordinal = batch.column("_ordinal").to_numpy()
            r = table[np.searchsorted(keys, (length << 44) | ordinal, "right") - 1]
            nth = ordinal - r[:, 1]
            times = np.maximum(r[:, 3], 1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(r[:, 2] + nth % times),
                 pa.array(r[:, 4] + nth // times * length)], schema.names)

    return numbered.select(*names, "_ordinal").mapInArrow(run, schema)


def pack(df: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY,
         vocabulary: str | None = None) -> DataFrame:
    """Every piece of every text with its sequence and its place there."""
    rows = pieces(df, text, key, capacity, vocabulary)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "pieces")
    return place(rows, capacity).drop("row")


def op6(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "piece", "start", "length", "ids_crc32",
                             "sequence_id", "offset")
