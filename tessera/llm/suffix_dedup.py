"""Operator 11: repeated passages by a logarithmic family of suffix arrays.

A document loses every byte that lies in a 50-byte string which also starts in a
document with a smaller id.  Documents arrive in batches of ascending ids.

* Sparse suffixes: of the 35 places where a 16-byte gram begins inside a
  50-byte window, the one with the smallest hash is the window's anchor.  Equal
  windows have equal anchors, so only suffixes that begin at anchors (about one
  in 17) are filed.  A run is a stretch of windows with one anchor; its context
  is the text they cover (50 to 84 bytes).
* Suffix arrays: each text segment of a batch sorts its anchored suffixes by
  their first 16 bytes, cut into buckets by a hash of these bytes.  Per bucket,
  one task merges the batch's arrays and scans them against the arrays of all
  levels; suffixes that share their 16 bytes with another document are flagged,
  on both sides.
* Long matches: flagged suffixes send their contexts, each distinct one once per
  segment, to their bucket again.  There all 50-byte windows are compared and
  each gets the smallest document id that holds it.
* Levels: a batch enters as a level of size one; while two levels have the same
  size, their arrays are merged bucket by bucket into one of twice the size.

Suffixes with more than ``HOT`` occurrences (a line in a third of all documents)
travel as single windows, dealt out by the window's own hash and folded once
per segment, so no bucket holds a hot passage's surroundings.

Segments are tables bucketed by segment number below ``spark.checkpoint.dir``: each
text is shuffled once, and later passes meet it where it lies.  Windows are told
apart by two 64-bit hashes of their halves.

Defined cases: a null text is empty; texts below 50 bytes lose nothing; equal
ids are not smaller than each other; a null id is neither smaller nor larger,
so its row stays whole and removes nothing; repeated rows get equal results;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import bytescan
from tessera.llm.common import col, shared_path, written

LENGTH, GRAM = 50, 16
SPAN = LENGTH - GRAM + 1
#: Text bytes of a segment and of a bucket's share; batches of the registered query.
SEGMENT_BYTES, BUCKET_BYTES, BATCHES = 8 << 20, 8 << 20, 4
#: Occurrences from which a suffix travels window by window.
HOT = 20_000
BLOCK = 1 << 17

_U = np.uint64
_BYTE32 = (bytescan.seeded(256, 11) >> _U(32)).astype(np.uint32) | np.uint32(1)
_BYTE64 = bytescan.seeded(256, 12)
_MULT = bytescan.seeded(8, 13)


# -- text to anchored suffixes ------------------------------------------------

def _doubled(x, size, mult):
    """Hashes of ``size`` (a power of two) neighbours from those of one."""
    n, j = 1, 0
    while n < size:
        x = x[:-n] * mult[j] + x[n:]
        n, j = 2 * n, j + 1
    return x


def runs(buf, offsets):
    """``(anchor, first window, last window, row)`` of every run of a batch of
    texts.  A run may be cut where a block ends, which changes no window."""
    n = len(buf)
    ends = offsets[1:]
    edge = np.zeros(n + 1, np.int8)
    lo = np.maximum(offsets[:-1], ends - LENGTH + 1)
    some = lo < ends
    edge[lo[some]] += 1
    edge[ends[some]] -= 1
    blocked = np.cumsum(edge[:n], dtype=np.int8) > 0
    mult = (_MULT >> _U(32)).astype(np.uint32) | np.uint32(1)
    out = []
    for i in range(0, n - LENGTH + 1, BLOCK):
        part = buf[i:min(n, i + BLOCK + LENGTH - 1)]
        h = _doubled(_BYTE32[part], GRAM, mult)
        h = h ^ (h >> np.uint32(15))
        h = h * np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        key = (h.astype(_U) << _U(32)) | np.arange(len(h), dtype=_U)
        size = 1
        while size * 2 <= SPAN:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < SPAN:
            rest = SPAN - size
            key = np.minimum(key[:-rest], key[rest:])
        at = (key & _U(0xFFFFFFFF)).astype(np.int64)
        free = ~blocked[i:i + len(at)]
        new = at[1:] != at[:-1]
        first = np.flatnonzero(free & np.concatenate(([True], new | ~free[:-1])))
        last = np.flatnonzero(free & np.concatenate((new | ~free[1:], [True])))
        out.append((at[first] + i, first + i, last + i))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    anchor, first, last = (np.concatenate(x) for x in zip(*out))
    return anchor, first, last, np.searchsorted(offsets, first, "right") - 1


def gram_words(buf, anchor):
    """The 16 bytes at each anchor as two big-endian words, so that words sort
    as the suffixes do."""
    words = buf[anchor[:, None] + np.arange(GRAM)].view(">u8")
    return words[:, 0].astype(_U), words[:, 1].astype(_U)


def gram_hash(w0, w1):
    return bytescan.splitmix(w0 ^ bytescan.splitmix(w1))


def window_halves(buf):
    """Two 64-bit hashes (first and last 32 bytes) of every 50-byte window."""
    h = bytescan.splitmix(_doubled(_BYTE64[buf], 32, _MULT))
    return h[:len(buf) - LENGTH + 1], h[LENGTH - 32:]


# -- packed arrays ------------------------------------------------------------

def _zip(array) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _unzip(data: bytes, kind):
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _zip_words(w0, w1) -> bytes:
    """Sorted words, byte column by byte column: neighbours share prefixes."""
    wide = np.stack((w0, w1), 1).astype(">u8").view(np.uint8).reshape(-1, GRAM)
    return _zip(wide.T)


def _unzip_words(data: bytes):
    flat = _unzip(data, np.uint8).reshape(GRAM, -1)
    wide = np.ascontiguousarray(flat.T).view(">u8")
    return wide[:, 0].astype(_U), wide[:, 1].astype(_U)


def _cuts(keys):
    """Starts of the runs of equal values in sorted ``keys`` arrays."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    differ = np.zeros(n - 1, bool)
    for k in keys:
        differ |= k[1:] != k[:-1]
    return np.flatnonzero(np.concatenate(([True], differ)))


def _table(schema: str, columns):
    """An Arrow table of ``name type`` columns."""
    import pyarrow as pa

    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = columns or [[]] * len(fields)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns)})


# -- segments -----------------------------------------------------------------

@dataclass
class Batch:
    """Texts of one batch: a table bucketed by ``seg`` (``seg, fp, doc_id, copies, text``)."""

    number: int
    name: str
    segments: int


def fold_copies(docs: DataFrame) -> DataFrame:
    """Exact copies folded as far as one Arrow batch sees them, and counted; the
    smallest id stays."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            t = pa.Table.from_batches([batch]).append_column("at", pa.array(np.arange(len(batch))))
            t = t.sort_by([("fp", "ascending"), ("doc_id", "ascending")])
            first = _cuts([np.array(t.column("fp").to_pylist(), object)])
            out = batch.take(t.column("at").take(pa.array(first)).combine_chunks())
            copies = np.diff(np.append(first, len(t)))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(copies, pa.int64())],
                                             [*out.schema.names, "copies"])

    return docs.select("doc_id", "fp", "text").mapInArrow(
        run, "doc_id long, fp string, text string, copies long")


def store_batch(docs: DataFrame, number: int) -> Batch:
    """File a batch (``doc_id, fp, text``, no nulls) by segment."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // SEGMENT_BYTES))
    name = f"tessera_segments_{uuid.uuid4().hex[:12]}"
    seg = F.pmod(F.conv(F.substring("fp", 1, 12), 16, 10).cast("long"), F.lit(n)).cast("int")
    cut = fold_copies(docs).withColumn("seg", seg).select("seg", "fp", "doc_id", "copies", "text")
    (cut.repartition(n, "seg").write.bucketBy(n, "seg").option("path", shared_path(spark, "segments"))
     .format("parquet").saveAsTable(name))
    return Batch(number, name, n)


def _segment(table):
    """``(bytes, offsets, ids, fingerprints, copies)`` of a segment's distinct texts, by
    fingerprint: the same order in every pass."""
    table = table.sort_by([("fp", "ascending"), ("doc_id", "ascending")])
    fp = np.array(table.column("fp").to_pylist(), object)
    ids = table.column("doc_id").to_numpy()
    first = _cuts([fp])
    import pyarrow as pa

    buf, off = bytescan.text_buffer(table.column("text").take(pa.array(first)))
    copies = np.add.reduceat(table.column("copies").to_numpy(), first)
    return buf, off, ids[first], fp[first], copies


# -- pass 1: suffix arrays and the merge-scan ----------------------------------

_PIECES = "bucket int, level int, grams binary, segs binary, counts binary"
_SCAN = "kind string, seg long, bucket int, grams binary, segs binary, counts binary"


def suffix_arrays(spark, batch: Batch, buckets: int) -> DataFrame:
    """One sorted piece per segment and bucket (level -1: a new batch)."""
    base = batch.number << 32

    def run(table):
        buf, off, _, _, _ = _segment(table)
        seg = base + table.column("seg")[0].as_py()
        anchor, _, _, row = runs(buf, off)
        w0, w1 = gram_words(buf, anchor)
        bucket = (gram_hash(w0, w1) % _U(buckets)).astype(np.int64)
        order = np.lexsort((row, w1, w0, bucket))
        w0, w1, bucket, row = w0[order], w1[order], bucket[order], row[order]
        keep = _cuts([bucket, w0, w1, row])  # one entry per document
        w0, w1, bucket = w0[keep], w1[keep], bucket[keep]
        head = _cuts([bucket, w0, w1])
        count = np.diff(np.append(head, len(w0)))
        w0, w1, bucket = w0[head], w1[head], bucket[head]
        cut = np.append(_cuts([bucket]), len(bucket))
        rows = [(int(bucket[a]), -1, _zip_words(w0[a:b], w1[a:b]),
                 _zip(np.full(b - a, seg, np.int64)),
                 _zip(count[a:b].astype(np.int32))) for a, b in zip(cut, cut[1:])]
        return _table(_PIECES, list(zip(*rows)))

    return spark.table(batch.name).groupBy("seg").applyInArrow(_typed(run), _PIECES)


def _typed(fn):
    """``fn`` with the Arrow annotations that Spark looks for."""
    import pyarrow as pa

    def run(table):
        return fn(table)

    run.__annotations__ = {"table": pa.Table, "return": pa.Table}
    return run


def _typed_pair(fn):
    import pyarrow as pa

    def run(left, right):
        return fn(left, right)

    run.__annotations__ = {"left": pa.Table, "right": pa.Table, "return": pa.Table}
    return run


def _merged(table, levels=None):
    """All pieces of a bucket in suffix order: words, segment, count, level."""
    parts = [(*_unzip_words(g), _unzip(s, np.int64), _unzip(c, np.int32), lv)
             for g, s, c, lv in zip(*(table.column(n).to_pylist()
                                      for n in ("grams", "segs", "counts", "level")))]
    w0, w1, seg, count = (np.concatenate([p[i] for p in parts]) for i in range(4))
    fresh = np.repeat([p[4] < 0 for p in parts], [len(p[0]) for p in parts])
    order = np.lexsort((seg, w1, w0))
    return w0[order], w1[order], seg[order], count[order], fresh[order]


def merge_scan(pieces: DataFrame) -> DataFrame:
    """Scan a batch's arrays against the levels, bucket by bucket.  Rows
    ``flags`` name, per segment, the suffixes that some other document shares
    with the batch; rows ``array`` hold the batch's merged suffix array."""

    def run(table):
        w0, w1, seg, count, fresh = _merged(table)
        bucket = table.column("bucket")[0].as_py()
        head = _cuts([w0, w1])
        size = np.diff(np.append(head, len(w0)))
        total = np.add.reduceat(count.astype(np.int64), head) if len(head) else head
        new = np.logical_or.reduceat(fresh, head) if len(head) else head
        shared = np.repeat((total > 1) & new, size)
        hot = np.repeat(total > HOT, size)
        at = np.flatnonzero(shared)
        at = at[np.argsort(seg[at], kind="stable")]
        cut = np.append(_cuts([seg[at]]), len(at))
        rows = [("flags", int(seg[at[a]]), bucket, _zip_words(w0[at[a:b]], w1[at[a:b]]), None,
                 _zip(hot[at[a:b]].astype(np.int32))) for a, b in zip(cut, cut[1:]) if b > a]
        own = np.flatnonzero(fresh)
        if len(own):
            rows.append(("array", None, bucket, _zip_words(w0[own], w1[own]), _zip(seg[own]),
                         _zip(count[own])))
        return _table(_SCAN, list(zip(*rows)))

    return pieces.groupBy("bucket").applyInArrow(_typed(run), _SCAN)


def merge_levels(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two levels' arrays as one, merged bucket by bucket."""

    def run(table):
        w0, w1, seg, count, _ = _merged(table)
        return _table(_PIECES, [[table.column("bucket")[0].as_py()], [0], [_zip_words(w0, w1)],
                                [_zip(seg)], [_zip(count)]])

    return a.unionByName(b).groupBy("bucket").applyInArrow(_typed(run), _PIECES)


# -- pass 2: contexts and windows ---------------------------------------------

_CONTEXTS = ("bucket int, seg long, sizes binary, text binary, low binary, high binary, "
             "times binary, rows binary, starts binary")
_SPANS = "seg long, rows binary, starts binary, ends binary, lows binary"


def contexts(spark, batch: Batch, flags: DataFrame, buckets: int, answer: bool) -> DataFrame:
    """The flagged contexts of a batch's segments, each distinct one once per
    segment; with ``answer``, also where they occur."""
    base = batch.number << 32
    mine = flags.filter((F.col("seg") >= base) & (F.col("seg") < base + (1 << 32))).select(
        (F.col("seg") - base).cast("int").alias("seg"), "grams", "counts")

    def run(left, right):
        if not left.num_rows or not right.num_rows:
            return _table(_CONTEXTS, [])
        buf, off, ids, _, _ = _segment(left)
        seg = base + left.column("seg")[0].as_py()
        marks = [gram_hash(*_unzip_words(g)) for g in right.column("grams").to_pylist()]
        marks = np.concatenate(marks)
        heat = np.concatenate([_unzip(c, np.int32) for c in right.column("counts").to_pylist()])
        order = np.argsort(marks)
        marks, heat = marks[order], heat[order] > 0
        anchor, first, last, row = runs(buf, off)
        g = gram_hash(*gram_words(buf, anchor))
        at = np.minimum(np.searchsorted(marks, g), len(marks) - 1)
        sel = np.flatnonzero(marks[at] == g)
        hot = heat[at[sel]]
        first, last, row, g = first[sel], last[sel], row[sel], g[sel]
        # hot suffixes: one context per window, dealt by the window itself
        wide = last[hot] - first[hot] + 1
        step = np.arange(int(wide.sum())) - np.repeat(np.cumsum(wide) - wide, wide)
        single = np.repeat(first[hot], wide) + step
        first = np.concatenate((first[~hot], single))
        last = np.concatenate((last[~hot], single))
        row = np.concatenate((row[~hot], np.repeat(row[hot], wide)))
        g = np.concatenate((g[~hot], np.zeros(len(single), _U)))
        if not len(first):
            return _table(_CONTEXTS, [])
        size = last - first + LENGTH
        k0, k1 = _context_hashes(buf, first, size)
        alone = len(g) - len(single)
        g[alone:] = k0[alone:]
        bucket = (g % _U(buckets)).astype(np.int64)
        order = np.lexsort((ids[row], k1, k0, size, bucket))
        first, size, row, bucket = first[order], size[order], row[order], bucket[order]
        k0, k1 = k0[order], k1[order]
        head = _cuts([bucket, size, k0, k1])
        times = np.diff(np.append(head, len(first)))
        low, high = ids[row[head]], ids[row[np.append(head[1:], len(first)) - 1]]
        cut = np.append(_cuts([bucket[head]]), len(head))
        rows = []
        for a, b in zip(cut, cut[1:]):
            lo, hi = head[a], head[b] if b < len(head) else len(first)
            n = size[head[a:b]]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            text = buf[np.repeat(first[head[a:b]], n) + step]
            own = row[lo:hi]
            where = (_zip(own.astype(np.int32)),
                     _zip((first[lo:hi] - off[own]).astype(np.int64))) if answer else (None, None)
            rows.append((int(bucket[lo]), seg if answer else None, _zip(n.astype(np.uint8)),
                         _zip(text), _zip(low[a:b]), _zip(high[a:b]),
                         _zip(times[a:b].astype(np.int32)), *where))
        return _table(_CONTEXTS, list(zip(*rows)))

    table = spark.table(batch.name)
    return table.groupBy("seg").cogroup(mine.groupBy("seg")).applyInArrow(
        _typed_pair(run), _CONTEXTS)


def _context_hashes(buf, first, size):
    """Two 64-bit hashes of each context, a slice of contexts at a time."""
    k0, k1 = np.zeros(len(first), _U), np.zeros(len(first), _U)
    m0, m1 = bytescan.seeded(LENGTH + SPAN, 21), bytescan.seeded(LENGTH + SPAN, 22)
    place = np.arange(LENGTH + SPAN)
    for a in range(0, len(first), 1 << 14):
        b = a + (1 << 14)
        at = first[a:b, None] + place
        inside = place < size[a:b, None]
        x = _BYTE64[buf[np.minimum(at, len(buf) - 1)]]
        x[~inside] = 0
        k0[a:b] = (x * m0).sum(1, dtype=_U)
        k1[a:b] = (x * m1).sum(1, dtype=_U)
    return bytescan.splitmix(k0 + size.astype(_U)), bytescan.splitmix(k1)


def window_owners(found: DataFrame) -> DataFrame:
    """Compare all windows of a bucket's contexts: for the batch's segments,
    the stretches of windows that a document with a smaller id holds, with
    that id."""

    def run(table):
        cols = {n: table.column(n).to_pylist() for n in
                ("seg", "sizes", "text", "low", "high", "times", "rows", "starts")}
        sizes = [_unzip(x, np.uint8).astype(np.int64) for x in cols["sizes"]]
        n_ctx = np.array([len(x) for x in sizes])
        size = np.concatenate(sizes)
        buf = np.concatenate([_unzip(x, np.uint8) for x in cols["text"]])
        low = np.concatenate([_unzip(x, np.int64) for x in cols["low"]])
        high = np.concatenate([_unzip(x, np.int64) for x in cols["high"]])
        begin = np.cumsum(size) - size
        wide = size - LENGTH + 1
        w_off = np.concatenate(([0], np.cumsum(wide)))
        ctx = np.repeat(np.arange(len(size)), wide)
        at = np.repeat(begin - w_off[:-1], wide) + np.arange(w_off[-1])
        h0, h1 = window_halves(buf)
        h0, h1 = h0[at], h1[at]
        order = np.lexsort((h1, h0))
        head = _cuts([h0[order], h1[order]])
        least = np.minimum.reduceat(low[ctx[order]], head)
        owner = np.empty(len(at), np.int64)
        owner[order] = np.repeat(least, np.diff(np.append(head, len(at))))
        del h0, h1, order, at
        hit = owner < high[ctx]
        new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (ctx[1:] != ctx[:-1])
                              | (hit[1:] != hit[:-1])))
        first = np.flatnonzero(hit & new)
        last = np.flatnonzero(hit & np.concatenate((new[1:], [True])))
        whose, low_id = ctx[first], owner[first]
        from_, to = first - w_off[whose], last - w_off[whose] + 1
        rows = []
        ctx_off = np.concatenate(([0], np.cumsum(n_ctx)))
        for i, seg in enumerate(cols["seg"]):
            if seg is None:
                continue
            a, b = np.searchsorted(whose, [ctx_off[i], ctx_off[i + 1]])
            if a == b:
                continue
            times = _unzip(cols["times"][i], np.int32).astype(np.int64)
            base = np.cumsum(times) - times
            mine = whose[a:b] - ctx_off[i]
            n = times[mine]
            pick = np.repeat(base[mine], n) + np.arange(int(n.sum())) - np.repeat(
                np.cumsum(n) - n, n)
            start = _unzip(cols["starts"][i], np.int64)[pick]
            rows.append((seg, _zip(_unzip(cols["rows"][i], np.int32)[pick]),
                         _zip(start + np.repeat(from_[a:b], n)),
                         _zip(start + np.repeat(to[a:b], n)), _zip(np.repeat(low_id[a:b], n))))
        return _table(_SPANS, list(zip(*rows)))

    return found.groupBy("bucket").applyInArrow(_typed(run), _SPANS)


# -- pass 3: removal ----------------------------------------------------------

_KEPT = "batch int, fp string, first_id long, n_removed long, n_spans long, kept_sha256 string"


def removal(spark, batch: Batch, spans: DataFrame) -> DataFrame:
    """What distinct texts lose, for those that lose something or have copies."""
    base, number = batch.number << 32, batch.number
    mine = spans.withColumn("seg", (F.col("seg") - base).cast("int"))

    def run(left, right):
        if not left.num_rows:
            return _table(_KEPT, [])
        buf, off, ids, fp, copies = _segment(left)
        parts = [[_unzip(x, k) for x in right.column(n).to_pylist()] for n, k in
                 (("rows", np.int32), ("starts", np.int64), ("ends", np.int64),
                  ("lows", np.int64))]
        row, start, end, low = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in parts)
        ok = low < ids[row]
        row, start, end = row[ok], start[ok], end[ok] + LENGTH - 1
        order = np.argsort(row, kind="stable")
        row, start, end = row[order], start[order], end[order]
        cut = np.searchsorted(row, np.arange(len(ids) + 1))
        rows = []
        for r in np.flatnonzero((np.diff(cut) > 0) | (copies > 1)):
            a, b = cut[r], cut[r + 1]
            text = buf[off[r]:off[r + 1]]
            edge = np.zeros(len(text) + 1, np.int32)
            np.add.at(edge, start[a:b], 1)
            np.add.at(edge, end[a:b], -1)
            gone = np.cumsum(edge[:-1]) > 0
            n_spans = np.count_nonzero(gone[1:] & ~gone[:-1]) + int(len(gone) and gone[0])
            rows.append((number, fp[r], int(ids[r]), int(gone.sum()), n_spans,
                         hashlib.sha256(text[~gone].tobytes()).hexdigest()))
        return _table(_KEPT, list(zip(*rows)))

    return spark.table(batch.name).groupBy("seg").cogroup(mine.groupBy("seg")).applyInArrow(
        _typed_pair(run), _KEPT)


class SuffixFamily:
    """The levels and their texts.  ``add`` takes the next batch (``doc_id, fp,
    text`` with ``fp`` the text's SHA-256, ids at or above all before) and
    returns what its distinct texts lose."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.batches: list[Batch] = []
        self.levels: list[tuple[int, DataFrame]] = []
        self.waiting: DataFrame | None = None

    def _settle(self) -> None:
        """File the last batch's array; merge levels of equal size."""
        if self.waiting is None:
            return
        self.levels.append((1, self.waiting))
        self.waiting = None
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, b), (_, a) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * size, written(merge_levels(a, b), "level")))

    def add(self, docs: DataFrame) -> DataFrame:
        self._settle()
        spark = self.spark
        batch = store_batch(docs, len(self.batches))
        pieces = suffix_arrays(spark, batch, self.buckets)
        for _, level in self.levels:
            pieces = pieces.unionByName(level)
        scan = written(merge_scan(pieces), "merge-scan")
        flags = scan.filter("kind = 'flags'").select("seg", "grams", "counts")
        self.waiting = scan.filter("kind = 'array'").select(
            "bucket", F.lit(0).alias("level"), "grams", "segs", "counts")
        found = contexts(spark, batch, flags, self.buckets, True)
        for old in self.batches:
            found = found.unionByName(contexts(spark, old, flags, self.buckets, False))
        self.batches.append(batch)
        return written(removal(spark, batch, window_owners(found)), "removed")

    def close(self) -> None:
        for b in self.batches:
            self.spark.sql(f"DROP TABLE IF EXISTS {b.name}")


def dedup(df: DataFrame, text: str = "text", key: str = "doc_id",
          batches: int = BATCHES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row; ids
    are fed in ``batches`` ranges of ascending ids."""
    spark = df.sparkSession
    docs = df.select(col(df, key).cast("long").alias("doc_id"),
                     F.coalesce(col(df, text), F.lit("")).alias("text"))
    docs = docs.withColumn("fp", F.sha2("text", 256))
    live = docs.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    total, least = live.agg(F.sum(F.octet_length("text")), F.min("doc_id")).first()
    bounds = []
    if total:
        wanted = [i / batches for i in range(1, batches)]
        bounds = sorted({int(b) for b in live.approxQuantile("doc_id", wanted, 0.01)
                         if b > least})
    family = SuffixFamily(spark, max(1, -(-(total or 0) // BUCKET_BYTES)))
    number = F.lit(0)
    lost = spark.createDataFrame([], _KEPT)
    for i, (lo, hi) in enumerate(zip([None, *bounds], [*bounds, None])):
        part = live
        if lo is not None:
            part = part.filter(F.col("doc_id") >= lo)
            number = F.when(F.col("doc_id") >= lo, i).otherwise(number)
        if hi is not None:
            part = part.filter(F.col("doc_id") < hi)
        if total:
            lost = lost.unionByName(family.add(part))
    family.close()
    size = F.octet_length("text").cast("long")
    rows = docs.select("doc_id", "fp", size.alias("n_bytes"), number.alias("batch"))
    out = rows.join(lost, ["batch", "fp"], "left")
    copy = F.col("doc_id") > F.col("first_id")  # the same text stands in a smaller id
    known = F.col("doc_id").isNotNull() & F.col("first_id").isNotNull()
    own = F.coalesce("n_removed", F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_bytes",
        F.when(known & copy, F.col("n_bytes")).when(known, own).otherwise(F.lit(0)).cast("long")
        .alias("n_removed"),
        F.when(known & copy, F.lit(1)).when(known, F.coalesce("n_spans", F.lit(0)))
        .otherwise(F.lit(0)).cast("long").alias("n_spans"),
        F.when(known & copy, F.sha2(F.lit(""), 256)).when(known, F.coalesce("kept_sha256", "fp"))
        .otherwise(F.col("fp")).alias("kept_sha256"))


def op11(docs: DataFrame) -> DataFrame:
    """Repeated passages of 50 bytes or more removed from all documents."""
    return dedup(docs)


ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
    octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, {2 * LENGTH}) AS s FROM (
  SELECT r, doc_id, h, unnest(range(0, n - {LENGTH - 1})) AS i FROM t)),
o AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
hit AS (SELECT r, i, true AS starts FROM w JOIN o USING (s) WHERE o.least < w.doc_id),
b AS (SELECT r, i, substr(h, 2 * i + 1, 2) AS c FROM (
  SELECT r, h, unnest(range(0, n)) AS i FROM t)),
f AS (SELECT r, i, c, max(coalesce(starts, false)) OVER (PARTITION BY r ORDER BY i
    ROWS BETWEEN {LENGTH - 1} PRECEDING AND CURRENT ROW) AS gone FROM b LEFT JOIN hit USING (r, i)),
g AS (SELECT *, lag(gone, 1, false) OVER (PARTITION BY r ORDER BY i) AS before FROM f),
s AS (SELECT r, count(*) FILTER (gone) AS n_removed, count(*) FILTER (gone AND NOT before) AS n_spans,
    coalesce(string_agg(c, '' ORDER BY i) FILTER (NOT gone), '') AS kept FROM g GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM t LEFT JOIN s USING (r)
"""
