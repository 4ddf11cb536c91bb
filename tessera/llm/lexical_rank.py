"""Operator 13: ranked lexical search by multi-query common subexpressions.

Every item (query) is a set of terms and a document's score for it is a sum of
per-term values, so items that share terms share partial sums.

1. Items are numbered, cut into blocks of bounded size, and their distinct terms
   gathered per block; every block meets all documents.
2. Terms held by exactly the same items form one shared term set, a leaf.  Items
   become sequences of leaves in one fixed order (most shared first); pairs of
   neighbours that occur in two or more items are replaced by a new node until
   no pair does.  What is left is a DAG whose nodes are shared partial sums.
3. One pass over the texts writes each document's length and its counts of the
   block's terms; sums over that table give N, L and the document frequencies.
4. A second pass materialises, for a run of documents, the accumulator of every
   leaf and of every inner node once, adds an item's score up from its top
   nodes, and keeps the best rows per item and task.  A last window merges them.

Terms are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z in
lower case.  Weights and scores are the integers of ``weight`` and ``values``.

Defined cases: a null text, or one without terms, is no document (not in N); an
item without terms gets no rows; items are rows, so equal items are ranked one
by one; equal scores go by ascending document id, null ids last; extra columns
are ignored; an empty table on either side gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.ordering import global_index
from tessera.llm import bytescan
from tessera.llm.common import col, written

TOP = 50
#: Items of one block: at most so many, and so many bytes of distinct terms.
BLOCK_ITEMS, BLOCK_BYTES = 2048, 8 << 20
#: Accumulator cells held at a time (documents x nodes) and bytes scanned at a time.
CELLS, SLICE_BYTES = 2 << 20, 2 << 20

# What a term is, as a pattern, and the letters that are lowered.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def values(w, tf, length, n_docs: int, total: int):
    """Per-posting integers of a document with ``length`` terms."""
    m = 50 + (50 * length * n_docs) // total
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


# -- the sharing plan ---------------------------------------------------------

def sharing_plan(items: list[list[int]], n_terms: int):
    """``(leaf of each term, inner nodes as pairs, top nodes of each item)``.
    Leaves are numbered from 0, inner nodes follow and name earlier nodes only."""
    holders: dict[int, list[int]] = {}
    for i, terms in enumerate(items):
        for t in terms:
            holders.setdefault(t, []).append(i)
    leaf_of = np.full(n_terms, -1, np.int64)
    leaves: dict[tuple, int] = {}
    for t, who in holders.items():
        leaf_of[t] = leaves.setdefault(tuple(who), len(leaves))
    order = sorted(leaves.items(), key=lambda x: (-len(x[0]), x[1]))
    tops: list[list[int]] = [[] for _ in items]
    for who, leaf in order:
        for i in who:
            tops[i].append(leaf)
    pairs: list[tuple[int, int]] = []
    while True:
        seen: dict[tuple[int, int], int] = {}
        for seq in tops:
            for pair in zip(seq, seq[1:]):
                seen[pair] = seen.get(pair, 0) + 1
        names: dict[tuple[int, int], int] = {}
        for i, seq in enumerate(tops):
            out, at = [], 0
            while at < len(seq):
                pair = tuple(seq[at:at + 2])
                # a pair gives way to a more frequent one that begins inside it
                ahead = seen.get(tuple(seq[at + 1:at + 3]), 0)
                if seen.get(pair, 0) >= max(2, ahead):
                    if pair not in names:
                        names[pair] = len(leaves) + len(pairs)
                        pairs.append(pair)
                    out.append(names[pair])
                    at += 2
                else:
                    out.append(seq[at])
                    at += 1
            tops[i] = out
        if not names:
            return leaf_of, np.array(pairs, np.int64).reshape(-1, 2), tops


# -- texts to postings --------------------------------------------------------

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_spans(buf, offsets):
    """Start, end and row of every term."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = _INSIDE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


class Vocabulary:
    """A block's terms, found by hash and confirmed byte by byte."""

    def __init__(self, terms: list[bytes]):
        size = np.array([len(t) for t in terms], np.int64)
        self.buf = np.frombuffer(b"".join(terms), np.uint8)
        self.start = np.cumsum(size) - size
        self.size = size
        hashes = bytescan.word_hashes(self.buf, self.start, self.start + size)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms of a block have one 64-bit hash")

    def find(self, buf, starts, ends):
        """Term number of each span, -1 for other words."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.hashes) or not len(starts):
            return out
        h = bytescan.word_hashes(buf, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        term = self.order[at]
        hit = np.flatnonzero((self.hashes[at] == h) & (self.size[term] == ends - starts))
        if not len(hit):
            return out
        size = (ends - starts)[hit]
        base = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(base, size)
        same = (buf[np.repeat(starts[hit], size) + step]
                == self.buf[np.repeat(self.start[term[hit]], size) + step])
        good = np.logical_and.reduceat(same, base)
        out[hit[good]] = term[hit[good]]
        return out


def postings(docs: DataFrame, terms: list[bytes], text: str, key: str) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document with at least one term."""
    key_type = docs.select(col(docs, key)).schema[0].dataType
    ints = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([T.StructField("doc_id", key_type), T.StructField("n", T.LongType()),
                           T.StructField("terms", ints), T.StructField("counts", ints)])

    def run(batches):
        import pyarrow as pa

        known = Vocabulary(terms)
        for batch in batches:
            whole, off = bytescan.text_buffer(batch.column(1))
            for a, b in bytescan.row_slices(off, SLICE_BYTES):
                buf = _FOLD[whole[off[a]:off[b]]]
                starts, ends, rows = term_spans(buf, off[a:b + 1] - off[a])
                n = np.bincount(rows, minlength=b - a)
                term = known.find(buf, starts, ends)
                hit = term >= 0
                pair, tf = np.unique(rows[hit] * max(1, len(terms)) + term[hit],
                                     return_counts=True)
                row = pair // max(1, len(terms))
                keep = np.flatnonzero(n)
                at = np.searchsorted(row, np.append(keep, b - a)).astype(np.int32)
                at = pa.array(at, pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in
                         (pair - row * max(1, len(terms)), tf)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(a + keep)), pa.array(n[keep], pa.int64()),
                     *lists], schema.names)

    return docs.select(col(docs, key).alias("doc_id"), col(docs, text).alias("text")).mapInArrow(
        run, schema)


# -- scoring ------------------------------------------------------------------

def best_rows(found: DataFrame, weights, plan, n_items: int, n_docs: int, total: int,
              top: int) -> DataFrame:
    """The ``top`` best ``(item, doc_id, score)`` rows of each item and task."""
    leaf_of, pairs, tops = plan
    n_leaves = int(leaf_of.max()) + 1 if len(leaf_of) else 0
    n_nodes = n_leaves + len(pairs)
    key_type = found.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()),
                           T.StructField("doc_id", key_type), T.StructField("score", T.LongType())])

    def run(batches):
        import pyarrow as pa

        item = np.zeros(0, np.int64)
        score = np.zeros(0, np.int64)
        doc = None
        floor = np.ones(n_items, np.int64)
        step = max(1, CELLS // max(1, n_nodes + n_items))
        for batch in batches:
            for a in range(0, len(batch), step):
                part = batch.slice(a, step)
                lists, counts = part.column(2), part.column(3)
                off = lists.offsets.to_numpy().astype(np.int64)
                term = lists.values.to_numpy()[off[0]:off[-1]]
                c_off = counts.offsets.to_numpy()
                tf = counts.values.to_numpy()[c_off[0]:c_off[-1]].astype(np.int64)
                size = len(part)
                row = np.repeat(np.arange(size), np.diff(off))
                worth = values(weights[term], tf, part.column(1).to_numpy()[row], n_docs, total)
                acc = np.zeros((n_nodes, size), np.int64)
                np.add.at(acc.reshape(-1), leaf_of[term] * size + row, worth)
                for j, (left, right) in enumerate(pairs, n_leaves):
                    np.add(acc[left], acc[right], out=acc[j])
                sums = np.zeros((n_items, size), np.int64)
                for i, nodes in enumerate(tops):
                    if nodes:
                        np.sum(acc[nodes], axis=0, out=sums[i])
                who, at = np.nonzero(sums >= floor[:, None])
                if not len(who):
                    continue
                score = np.concatenate((score, sums[who, at]))
                item = np.concatenate((item, who))
                new = part.column(0).take(pa.array(at))
                doc = new if doc is None else pa.concat_arrays([doc, new])
                ids = doc.fill_null(0).to_numpy(zero_copy_only=False)
                order = np.lexsort((ids, doc.is_null().to_numpy(zero_copy_only=False),
                                    -score, item))
                first = np.searchsorted(item[order], np.arange(n_items + 1))
                nth = np.arange(len(order)) - first[item[order]]
                order = order[nth < top]
                item, score, doc = item[order], score[order], doc.take(pa.array(order))
                first = np.searchsorted(item, np.arange(n_items + 1))
                full = np.flatnonzero(np.diff(first) == top)
                floor[full] = score[first[full] + top - 1]
        if doc is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), doc, pa.array(score, pa.int64())], schema.names)

    return found.mapInArrow(run, schema)


def numbered_items(items: DataFrame, text: str, key: str) -> DataFrame:
    """``item_no, item_id, item_terms``: the distinct terms of each item."""
    low = F.translate(col(items, text), UPPER, LOWER)
    terms = F.array_sort(F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))))
    named = items.select(col(items, key).alias("item_id"),
                         F.coalesce(terms, F.array().cast("array<string>")).alias("item_terms"))
    return global_index(named, ["item_id", "item_terms"], "item_no")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, text: str = "text",
           key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's best documents."""
    queries = written(numbered_items(items, item_text, item_key), "items")
    size = F.octet_length(F.array_join("item_terms", " "))
    n, widest = queries.agg(F.count(F.lit(1)), F.max(size)).first()
    per_block = max(1, min(BLOCK_ITEMS, BLOCK_BYTES // max(1, widest or 1)))
    blocks = [_block(docs, queries, lo, min(n, lo + per_block), top, text, key)
              for lo in range(0, max(n, 1), per_block)]
    out = blocks[0]
    for more in blocks[1:]:
        out = out.unionByName(more)
    return out


def _block(docs, queries, lo, hi, top, text, key):
    rows = queries.filter(F.col("item_no").between(lo, hi - 1)).orderBy("item_no").collect()
    words = sorted({t for r in rows for t in r["item_terms"]})
    number = {t: i for i, t in enumerate(words)}
    sets = [[number[t] for t in r["item_terms"]] for r in rows]
    found = written(postings(docs, [t.encode() for t in words], text, key), "postings")
    n_docs, total = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    holding = dict(found.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([weight(n_docs, holding.get(i, 0)) for i in range(len(words))], np.int64)
    best = best_rows(found, weights, sharing_plan(sets, len(words)), len(rows), n_docs, total or 1,
                     top)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = queries.select("item_id", (F.col("item_no") - lo).cast("int").alias("item")).filter(
        F.col("item").between(0, hi - lo - 1))
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def op13(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search(docs, items)


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
    regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS terms
  FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT row_no, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
tf AS (SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM d)
  GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * max(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, totals GROUP BY term),
q AS (SELECT item_no, item_id, unnest(terms) AS term FROM (
  SELECT row_number() OVER () AS item_no, item_id, list_distinct(
    regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS terms
  FROM benchmark WHERE text IS NOT NULL)),
scored AS (
  SELECT item_no, item_id, lengths.doc_id, row_no,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN lengths USING (row_no), totals
  GROUP BY item_no, item_id, lengths.doc_id, row_no),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_no
    ORDER BY score DESC, doc_id ASC NULLS LAST) AS r FROM scored WHERE score > 0)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= {TOP}
"""
