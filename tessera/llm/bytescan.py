"""Vectorised scans over the UTF-8 bytes of an Arrow string column.

A batch of texts is one ``uint8`` buffer plus row offsets.  Word and shingle
hashes are computed for the whole buffer at once; nothing here loops over
characters or words.
"""

from __future__ import annotations

import numpy as np

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def text_buffer(arr):
    """``(bytes uint8[n], offsets int64[rows + 1])`` of an Arrow string or
    binary array; a null row is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if pa.types.is_binary(arr.type) else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(arr.buffers()[1], np.int64 if wide else np.int32)
    off = raw[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def row_slices(offsets, max_bytes):
    """Cut rows into runs of at most ``max_bytes`` (one longer row stands
    alone): yields ``(first_row, end_row)``."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1
        end = min(n, max(at + 1, end))
        yield at, end
        at = end


def splitmix(x):
    """Finaliser that spreads 64-bit values; wraps modulo 2^64."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def seeded(count, seed):
    """``count`` odd 64-bit constants that follow from ``seed``."""
    with np.errstate(over="ignore"):
        base = np.uint64(seed) * np.uint64(0xD1342543DE82EF95)
        return splitmix(np.arange(count, dtype=np.uint64) + base) | np.uint64(1)


def word_spans(buf, offsets):
    """Start, end and row of every run of bytes other than ASCII white space
    (``\\x09-\\x0D`` and ``\\x20``)."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def word_hashes(buf, starts, ends, seed=1):
    """A 64-bit hash of each word's bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    byte = seeded(256, seed)
    size = ends - starts
    flat = np.arange(int(size.sum()), dtype=np.int64)
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    pos = flat - np.repeat(at, size)
    val = byte[buf[pos + np.repeat(starts, size)]]
    low = seeded(1 << 12, seed + 1)
    with np.errstate(over="ignore"):
        val = val * low[pos & 4095]
        if int(size.max()) > 4096:  # a word's hash must not depend on its neighbours
            far = pos > 4095
            val[far] *= splitmix((pos[far] >> 12).astype(np.uint64)) | np.uint64(1)
        total = np.add.reduceat(val, at)
        return splitmix(total ^ size.astype(np.uint64))


def shingle_hashes(words, rows, n_rows, width=5, seed=7):
    """Hash of every run of ``width`` words of a row, as ``(row, hash)``.  A row
    with fewer words, but at least one, has its whole word sequence as its
    single shingle; a row without words has none."""
    mult = seeded(width + 1, seed)
    count = np.bincount(rows, minlength=n_rows) if len(rows) else np.zeros(n_rows, np.int64)
    first = np.concatenate(([0], np.cumsum(count)[:-1])) if n_rows else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        parts_r, parts_h = [], []
        n = len(words) - width + 1
        if n > 0:
            at = np.flatnonzero(rows[:n] == rows[width - 1:])
            h = np.zeros(len(at), np.uint64)
            for j in range(width):
                h = h + words[at + j] * mult[j]
            parts_r.append(rows[at])
            parts_h.append(splitmix(h))
        short = np.flatnonzero((count > 0) & (count < width))
        if len(short):
            h = count[short].astype(np.uint64) * mult[width]
            for j in range(width - 1):
                has = count[short] > j
                h[has] += words[first[short[has]] + j] * mult[j]
            parts_r.append(short)
            parts_h.append(splitmix(h ^ np.uint64(0x5555555555555555)))
    if not parts_r:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(parts_r), np.concatenate(parts_h)
