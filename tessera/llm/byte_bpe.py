"""Operator 2: byte-level BPE encoding and decoding.

Encoding of an Arrow batch, without a regular expression:

1. the UTF-8 bytes become code points, and each code point a class symbol
   (letter, number, white space, other, contraction start ...) that already
   holds what little lookahead the split pattern needs;
2. each symbol is a transition function over eight token states.  Blocks of
   symbols are composed into one function each, the functions are composed by
   an associative doubling scan, and every block is replayed from its now known
   start state: the positions where a token begins fall out;
3. the slices between boundaries are looked up in a bounded cache; all misses
   of a batch are merged together, one vectorised merge round at a time.

``encode`` keeps each token's byte offset, ``decode`` places every token's
bytes at its offset.

Defined cases: a null or empty text has no tokens and decodes to empty bytes;
repeated rows and null ids pass through one for one; an input column named
like an output is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import bytescan
from tessera.llm.common import add_arrow_columns, col, tokenizer_file, worker_cache

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# Symbols: what a character is, with its lookahead folded in.
LETTER, NUMBER, OTHER, SHORT_MARK, LONG_MARK, SPACE_RUN, LAST_SPACE, LAST_BLANK = range(8)
# States: the token that the previous character left open.
DONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, OPEN_SPACE, IN_SPACES, ONE_MORE, TWO_MORE = range(8)

BLOCK = 128
BATCH_BYTES = 1 << 20
CACHE_PIECES = 300_000
CACHE_BYTES = 24 << 20
VECTOR_LIMIT = 64


def class_table() -> np.ndarray:
    """Class of every code point: letter, number, white space (``SPACE_RUN``)
    or other.  The library's own Unicode tables are read once per worker (one
    list of all letters, one of all numbers ...), so that both agree on the
    Unicode version; texts are then cut by this array alone."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE_RUN, r"\s")):
        listed = tiktoken.Encoding("classes", pat_str=name, mergeable_ranks=single,
                                   special_tokens={}).encode_ordinary(every)
        out[np.frombuffer(bytes(listed).decode().encode("utf-32-le"), np.uint32)] = kind
    return out


def transition_tables() -> tuple[np.ndarray, np.ndarray]:
    """``next[symbol, state]`` and ``begins[symbol, state]``; symbols 8..15 are
    the same at the start of a text, where every state counts as ``DONE``."""
    nxt = np.zeros((16, 8), np.uint8)
    begins = np.zeros((16, 8), bool)
    joins = {LETTER: (IN_LETTERS, {IN_LETTERS, OPEN_SPACE}),
             NUMBER: (IN_NUMBERS, {IN_NUMBERS, OPEN_SPACE}),
             OTHER: (IN_OTHERS, {IN_OTHERS, OPEN_SPACE}),
             SPACE_RUN: (IN_SPACES, {IN_SPACES}),
             LAST_SPACE: (OPEN_SPACE, set()), LAST_BLANK: (DONE, set())}
    for state in range(8):
        for symbol, (to, held) in joins.items():
            nxt[symbol, state], begins[symbol, state] = to, state not in held
        for symbol, rest in ((SHORT_MARK, ONE_MORE), (LONG_MARK, TWO_MORE)):
            inside = state in (IN_OTHERS, OPEN_SPACE)
            nxt[symbol, state] = IN_OTHERS if inside else rest
            begins[symbol, state] = not inside
    for state, to in ((TWO_MORE, ONE_MORE), (ONE_MORE, DONE)):  # inside 's, 're ...
        nxt[LETTER, state], begins[LETTER, state] = to, False
    nxt[8:] = nxt[:8, DONE][:, None]
    begins[8:] = True
    return nxt, begins


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte position of each."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    if len(at) == len(buf):
        return buf.astype(np.uint32), at
    lead = buf[at].astype(np.uint32)
    out = lead.copy()
    last = len(buf) - 1
    for low, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        high = {0xC0: 0xE0, 0xE0: 0xF0, 0xF0: 0x100}[low]
        sel = np.flatnonzero((lead >= low) & (lead < high))
        if len(sel):
            v = lead[sel] & bits
            for j in range(1, more + 1):
                v = (v << 6) | (buf[np.minimum(at[sel] + j, last)] & 0x3F)
            out[sel] = v
    return np.minimum(out, 0x10FFFF), at


def symbols(cp: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbol of every code point; ``first`` marks the start of each text."""
    n = len(cp)
    sym = classes[cp]
    ends = np.empty(n, bool)
    ends[:-1], ends[-1] = first[1:], True
    blank = sym == SPACE_RUN
    follows = np.zeros(n, bool)  # a non-blank character of the same text follows
    follows[:-1] = ~blank[1:] & ~ends[:-1]
    last = np.flatnonzero(blank & follows)
    sym[last] = np.where(cp[last] == 32, LAST_SPACE, LAST_BLANK)
    marks = np.flatnonzero(cp == 39)
    if len(marks):
        pad = np.concatenate((cp, np.zeros(2, cp.dtype)))
        one = np.where(ends[marks], 0, pad[marks + 1])
        over = ends[marks] | np.concatenate((ends, [True]))[marks + 1]
        two = np.where(over, 0, pad[marks + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
                | (one == ord("l")) & (two == ord("l")))
        sym[marks[short]] = SHORT_MARK
        sym[marks[long]] = LONG_MARK
    return sym + first.astype(np.uint8) * 8


def scan(sym: np.ndarray, nxt: np.ndarray, begins: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Where a token begins, by an associative scan of transition functions."""
    n = len(sym)
    rows = -(-n // block)
    grid = np.zeros(rows * block, np.uint8)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(rows, block).T).astype(np.intp) * 8
    flat, flag = nxt.ravel(), begins.ravel()
    # each block's function: the state it ends in, for each state it may start in
    fn = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for j in range(block):
        if fn.shape[1] == 8 and (fn == fn[:, :1]).all():
            fn = fn[:, :1]  # all start states have met
        fn = flat[grid[j][:, None] + fn]
    fn = np.broadcast_to(fn, (rows, 8)).copy()
    # compose the functions of all blocks before each one
    step = 1
    while step < rows:
        if (fn == fn[:, :1]).all():
            break  # constant functions: nothing before them matters
        fn[step:] = np.take_along_axis(fn[step:], fn[:-step].astype(np.intp), 1)
        step *= 2
    state = np.full(rows, DONE, np.uint8)
    state[1:] = fn[:-1, DONE]
    out = np.empty((block, rows), bool)
    for j in range(block):
        at = grid[j] + state
        out[j] = flag[at]
        state = flat[at]
    return out.T.reshape(-1)[:n]


def boundaries(buf: np.ndarray, offsets: np.ndarray, classes: np.ndarray, tables) -> np.ndarray:
    """Byte positions at which a token-to-be begins, for a batch of texts."""
    if len(buf) == 0:
        return np.zeros(0, np.int64)
    cp, at = code_points(buf)
    first = np.zeros(len(cp) + 1, bool)
    first[np.searchsorted(at, offsets[:-1])] = True
    return at[scan(symbols(cp, first[:-1], classes), *tables)]


class PairTable:
    """Open-addressing table from a pair of token ids to the merged id."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = rank
        self.bits = max(10, int(len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.vals = np.zeros(1 << self.bits, np.int32)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        vals = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.singly = None
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]  # the last of equal slots stays
            won = self.keys[slot] == keys
            self.vals[slot[won]] = vals[won]
            keys, vals, slot = keys[~won], vals[~won], (slot[~won] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def one_by_one(self):
        """Look-up of single keys, for words too long to merge side by side; its
        table is built when the first such word comes."""
        if self.singly is None:
            used = self.keys != -1
            self.singly = dict(zip(self.keys[used].tolist(), self.vals[used].tolist()))
        return self.singly.get

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or a value above every rank."""
        keys = (a.astype(np.int64) << 32) | b
        out = np.full(len(keys), NO_MERGE, np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            seen = self.keys[slot]
            hit = seen == keys[left]
            out[left[hit]] = self.vals[slot[hit]]
            go = ~hit & (seen != -1)
            left, slot = left[go], (slot[go] + 1) & (len(self.keys) - 1)
        return out


NO_MERGE = 1 << 30


class Vocabulary:
    """Ranks, the pair table and the bytes of every token in one flat array."""

    def __init__(self, path: str):
        import base64

        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in rows}
        self.pairs = PairTable(self.ranks)
        self.single = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        size = max(self.ranks.values()) + 1
        by_id = [b""] * size
        for token, rank in self.ranks.items():
            by_id[rank] = token
        self.length = np.array([len(t) for t in by_id], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.length)[:-1]))
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        self.classes, self.tables = class_table(), transition_tables()
        self._clear()

    def _clear(self):
        self.cache, self.cached_bytes = {}, 0
        self.ids = np.zeros(0, np.int32)  # of all cached pieces, one after the other
        self.at, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merge many short pieces side by side: in each round every piece
        applies its lowest-ranked, leftmost pair.  ``(piece, id)`` in order."""
        size = np.array([len(p) for p in pieces])
        owner = np.repeat(np.arange(len(pieces)), size)
        ids = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full(len(ids), NO_MERGE, np.int64)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner] = self.pairs.find(ids[inner], ids[inner + 1])
        done_owner, done_ids = [], []
        while len(ids):
            heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.minimum.reduceat((rank << 32) | np.arange(len(rank)), heads)
            live = (best >> 32) < NO_MERGE
            at = best[live] & 0xFFFFFFFF
            spans = np.diff(np.concatenate((heads, [len(ids)])))
            keep = np.repeat(live, spans)
            if not keep.all():
                done_owner.append(owner[~keep])
                done_ids.append(ids[~keep])
            ids[at] = rank[at]
            rank[at] = rank[at + 1]
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            ids, owner, rank, at = ids[keep], owner[keep], rank[keep], moved[at]
            for left in (at, at - 1):
                left = left[(left >= 0) & (left + 1 < len(ids))]
                same = owner[left] == owner[left + 1]
                ok = left[same]
                rank[ok] = self.pairs.find(ids[ok], ids[ok + 1])
                rank[left[~same]] = NO_MERGE
            if len(at):
                tail = at[at + 1 == len(ids)]
                rank[tail] = NO_MERGE
        owner, ids = np.concatenate(done_owner), np.concatenate(done_ids)
        order = np.argsort(owner, kind="stable")
        return owner[order], ids[order]

    def merge_long(self, piece: bytes) -> list[int]:
        """Merge one long piece with a heap over a linked list."""
        ids = self.single[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        rank = self.pairs.find(ids[:-1], ids[1:])
        heap = [(int(r), i) for i, r in enumerate(rank) if r < NO_MERGE]
        heapq.heapify(heap)
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        look = self.pairs.one_by_one()

        def pair(i):
            j = after[i]
            return look((ids[i] << 32) | ids[j], NO_MERGE) if j < n else NO_MERGE

        current = rank.tolist() + [NO_MERGE]
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or current[i] != r:
                continue
            j = after[i]
            ids[i], alive[j], after[i] = r, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (i, before[i]):
                if k >= 0:
                    current[k] = pair(k)
                    if current[k] < NO_MERGE:
                        heapq.heappush(heap, (current[k], k))
        return [x for x, a in zip(ids, alive) if a]

    def _extend(self, pieces: list[bytes], count: np.ndarray, ids: np.ndarray) -> None:
        n = len(self.cache)
        self.cache.update(zip(pieces, range(n, n + len(pieces))))
        self.cached_bytes += sum(map(len, pieces))
        first = len(self.ids) + np.concatenate(([0], np.cumsum(count)[:-1]))
        self.at = np.concatenate((self.at, first))
        self.count = np.concatenate((self.count, count))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))

    def learn(self, pieces: list[bytes]) -> None:
        """Add distinct new pieces to the cache."""
        whole = [r for r in map(self.ranks.get, pieces) if r is not None]
        if whole:
            self._extend([p for p in pieces if p in self.ranks],
                         np.ones(len(whole), np.int64), np.array(whole))
            pieces = [p for p in pieces if p not in self.ranks]
        short = [p for p in pieces if len(p) <= VECTOR_LIMIT]
        if short:
            owner, ids = self.merge_many(short)
            self._extend(short, np.bincount(owner, minlength=len(short)), ids)
        for p in pieces:
            if len(p) > VECTOR_LIMIT:
                ids = np.array(self.merge_long(p))
                self._extend([p], np.array([len(ids)]), ids)

    def encode(self, buf: np.ndarray, offsets: np.ndarray):
        """Ids, byte offset in its text of each id, and ids per text."""
        if len(self.cache) > CACHE_PIECES or self.cached_bytes > CACHE_BYTES:
            self._clear()
        starts = boundaries(buf, offsets, self.classes, self.tables)
        if not len(starts):
            z = np.zeros(0, np.int32)
            return z, z, np.zeros(len(offsets) - 1, np.int64)
        data = buf.tobytes()
        cuts = starts.tolist()
        cuts.append(len(data))
        keys = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        found = list(map(self.cache.get, keys))
        if None in found:
            self.learn(list({k for k, i in zip(keys, found) if i is None}))
            found = map(self.cache.__getitem__, keys)
        piece = np.fromiter(found, np.int64, len(keys))
        count, at = self.count[piece], self.at[piece]
        total = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.arange(total[-1]) + np.repeat(at - total[:-1], count)]
        size = self.length[ids]
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        per_row = np.bincount(np.searchsorted(offsets, begin, "right") - 1,
                              minlength=len(offsets) - 1)
        return ids, (begin - np.repeat(offsets[:-1], per_row)).astype(np.int32), per_row

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens, one after the other."""
        size = self.length[ids]
        at = np.concatenate(([0], np.cumsum(size)))
        return self.flat[np.arange(at[-1]) + np.repeat(self.start[ids] - at[:-1], size)]


def _vocabulary(path: str) -> Vocabulary:
    return worker_cache(("byte_bpe", path), lambda: Vocabulary(path))


def _encoded(voc: Vocabulary, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(where each text's ids end, ids, byte positions)`` of an Arrow column."""
    buf, off = bytescan.text_buffer(texts)
    ids, begins, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [[0]]
    for a, b in bytescan.row_slices(off, BATCH_BYTES):
        i, o, c = voc.encode(buf[off[a]:off[b]], off[a:b + 1] - off[a])
        ids.append(i)
        begins.append(o)
        counts.append(c)
    ends = np.concatenate(counts).cumsum().astype(np.int32)
    return ends, np.concatenate(ids), np.concatenate(begins)


def _decoded(voc: Vocabulary, ends: np.ndarray, flat: np.ndarray):
    """Arrow binary array: the bytes of every list of ids."""
    import pyarrow as pa

    data = voc.decode(flat)
    at = np.concatenate(([0], np.cumsum(voc.length[flat])))[ends].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer(at.tobytes()), pa.py_buffer(data.tobytes())])


def encode(df: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``df`` plus ``ids array<int>`` and ``token_offsets array<int>`` (byte
    position of each token in its text).  ``vocabulary`` is a rank file that
    every executor can read; the default is the installed public one."""
    schema = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("token_offsets", T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        import pyarrow as pa

        voc = _vocabulary(vocabulary or tokenizer_file(VOCABULARY))
        for batch in batches:
            ends, *parts = _encoded(voc, batch.field("text"))
            lists = [pa.ListArray.from_arrays(ends, x) for x in parts]
            yield pa.StructArray.from_arrays(lists, ["ids", "token_offsets"])

    return add_arrow_columns(df, {"text": col(df, text)}, schema, run)


def decode(df: DataFrame, ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``df`` plus ``decoded binary``: the bytes the ids stand for."""
    schema = T.StructType([T.StructField("decoded", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        voc = _vocabulary(vocabulary or tokenizer_file(VOCABULARY))
        for batch in batches:
            lists = batch.field("ids")
            ends = np.concatenate(([0], np.cumsum(np.asarray(
                lists.value_lengths().fill_null(0), np.int64))))
            flat = np.asarray(lists.flatten(), np.int64)
            out = _decoded(voc, ends, flat)
            yield pa.StructArray.from_arrays([out], ["decoded"])

    return add_arrow_columns(df, {"ids": col(df, ids)}, schema, run)


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids, joined by commas."""
    return F.sha2(F.concat_ws(",", ids.cast("array<string>")), 256)


def round_trip(df: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``df`` plus ``ids array<int>`` and ``decoded binary``: each batch is
    encoded and its ids are decoded again in the same worker."""
    schema = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        voc = _vocabulary(vocabulary or tokenizer_file(VOCABULARY))
        for batch in batches:
            ends, ids, _ = _encoded(voc, batch.field("text"))
            yield pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(ends, ids), _decoded(voc, ends, ids)], ["ids", "decoded"])

    return add_arrow_columns(df, {"text": col(df, text)}, schema, run)


def op2(docs: DataFrame) -> DataFrame:
    return round_trip(docs.select("doc_id", "text")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
