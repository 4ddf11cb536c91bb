"""Operator 5: near-duplicate documents by DartMinHash.

A text is a weighted set: its five-word shingles, weighted by how often they
occur (a text of one to four words is its own single shingle).  Similarity is
the weighted Jaccard similarity ``sum(min) / sum(max)``; documents linked at
``threshold`` or more, directly or through others, form a class.

* Darts: each weight axis is cut into dyadic regions; in a region darts arrive
  by rank as a Poisson process whose hashed arrivals depend on the shingle
  only.  A text keeps the darts inside its weights up to a rank chosen so that
  about ``k (ln k + 2)`` darts fall on it, hashes each to one of ``k``
  coordinates and keeps the earliest per coordinate; empty coordinates are
  filled by doubling the rank.  Cost: shingles plus darts, not their product.
* Banding: ``BANDS`` x ``ROWS`` coordinates are joined on equal bands.  Exact
  copies are folded into one node first.  In a bucket every node is compared
  with the bucket's most connected node only (a star); where a bucket then
  still holds several classes, nodes of different classes are compared if
  their sizes and unshared shingles allow the similarity at all (an exact
  bound, see ``possible_pairs``).  Nothing is capped.
* Every candidate link is verified exactly on the two texts' shingles.
* Classes are connected components of the verified links.

Defined cases: a null text or one without words is in a class of its own;
repeated rows and exact copies share a class, whatever their ids; the class id
is the smallest document id of the class (null if all are null); extra columns
pass through; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import bytescan
from tessera.llm.common import add_arrow_columns, col, worker_cache, written

THRESHOLD = 0.8
WIDTH = 5
BANDS, ROWS = 28, 5
SLICE_BYTES = 2 << 20
MAX_ROUNDS = 60
#: Second sketch, for nodes of mixed buckets only.
SKETCH_BITS, SKETCH_SIGMAS = 2048, 4.5
#: A node takes about 60 bytes in a broadcast table.
BROADCAST_ROWS = 400_000


def weighted_shingles(buf, offsets, width=WIDTH):
    """``(row, shingle, weight)`` of a batch of texts, sorted by row; the
    shingle is a 48-bit hash here, which is ample for a sketch."""
    n_rows = len(offsets) - 1
    starts, ends, rows = bytescan.word_spans(buf, offsets)
    words = bytescan.word_hashes(buf, starts, ends)
    row, h = bytescan.shingle_hashes(words, rows, n_rows, width)
    key = np.sort((row.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)))
    if not len(key):
        return np.zeros(0, np.int64), key, np.zeros(0)
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    weight = np.diff(np.concatenate((heads, [len(key)])))
    key = key[heads]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), weight.astype(float)


def _unit(x):
    """Uniform numbers in (0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0


def dart_sketch(row, shingle, weight, n_rows, k):
    """``(rows x k)`` dart identifiers; 0 in every coordinate of an empty row."""
    out = np.zeros((n_rows, k), np.uint64)
    if not len(row):
        return out
    total = np.bincount(row, weight, n_rows)
    todo = np.flatnonzero(total > 0)
    reach = np.zeros(n_rows)
    reach[todo] = k * (np.log(k) + 2) / total[todo]
    # dyadic regions of the weight axis: [2^v - 1, 2^(v+1) - 1)
    parts = []
    v = 0
    while True:
        low = 2.0 ** v - 1
        sel = np.flatnonzero(weight > low)
        if not len(sel):
            break
        salt = bytescan.seeded(1, 1000 + v)[0]
        parts.append((row[sel], bytescan.splitmix(shingle[sel] ^ salt), weight[sel], 2.0 ** v, low))
        v += 1
    while len(todo):
        active = np.zeros(n_rows, bool)
        active[todo] = True
        best = np.full(n_rows * k, np.inf)
        ident = np.zeros(n_rows * k, np.uint64)
        darts = []
        for r, h, w, span, low in parts:
            sel = np.flatnonzero(active[r])
            r, h, w = r[sel], h[sel], w[sel]
            rank = np.zeros(len(r))
            limit = reach[r]
            n = 0
            while len(r):
                h = bytescan.splitmix(h + np.uint64(0x632BE59BD9B4E019))
                rank = rank - np.log(_unit(h)) / span
                inside = rank <= limit
                r, h, w, rank, limit = r[inside], h[inside], w[inside], rank[inside], limit[inside]
                dart = bytescan.splitmix(h ^ np.uint64(0xA0761D6478BD642F))
                hit = low + span * _unit(bytescan.splitmix(dart)) < w
                slot = r[hit] * k + (dart[hit] % np.uint64(k)).astype(np.int64)
                darts.append((slot, rank[hit], dart[hit]))
                n += 1
        slot, rank, dart = (np.concatenate(x) for x in zip(*darts))
        np.minimum.at(best, slot, rank)
        won = rank == best[slot]
        ident[slot[won]] = dart[won]
        full = np.isfinite(best.reshape(n_rows, k)[todo]).all(axis=1)
        out[todo[full]] = ident.reshape(n_rows, k)[todo[full]]
        todo = todo[~full]
        reach[todo] *= 2
    return out


def band_keys(sketch, bands=BANDS, rows=ROWS):
    """One 64-bit key per band of a sketch."""
    n = len(sketch)
    parts = sketch.reshape(n, bands, rows)
    mult = bytescan.seeded(rows, 99)
    with np.errstate(over="ignore"):
        key = (parts * mult).sum(axis=2, dtype=np.uint64) + bytescan.seeded(bands, 77)
    return bytescan.splitmix(key)


def signatures(df: DataFrame, text: str = "text", bands: int = BANDS, rows: int = ROWS,
               width: int = WIDTH) -> DataFrame:
    """``df`` plus ``bands array<long>`` (null for a text without words)."""
    schema = T.StructType([T.StructField("bands", T.ArrayType(T.LongType(), False))])

    def run(batches):
        import pyarrow as pa

        worker_cache("dart_minhash", dict)  # gives back what another operator held
        for batch in batches:
            buf, off = bytescan.text_buffer(batch.field("text"))
            n = len(off) - 1
            keys, words = np.zeros((n, bands), np.uint64), np.zeros(n, bool)
            for a, b in bytescan.row_slices(off, SLICE_BYTES):
                r, s, w = weighted_shingles(buf[off[a]:off[b]], off[a:b + 1] - off[a], width)
                keys[a:b] = band_keys(dart_sketch(r, s, w, b - a, bands * rows), bands, rows)
                words[a + np.unique(r)] = True
            ends = np.concatenate(([0], np.cumsum(np.where(words, bands, 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, keys[words].view(np.int64).ravel(),
                                             mask=pa.array(~words))
            yield pa.StructArray.from_arrays([lists], ["bands"])

    return add_arrow_columns(df, {"text": col(df, text)}, schema, run)


def shingle_sets(df: DataFrame, width: int = WIDTH) -> DataFrame:
    """``node, items``: sorted 64-bit hashes of (shingle, occurrence), so that
    the Jaccard similarity of two item sets is the weighted similarity."""
    schema = T.StructType([T.StructField("items", T.ArrayType(T.LongType(), False))])

    def run(batches):
        import pyarrow as pa

        worker_cache("dart_minhash", dict)  # gives back what another operator held
        for batch in batches:
            buf, off = bytescan.text_buffer(batch.field("text"))
            chunks, counts = [np.zeros(0, np.uint64)], np.zeros(len(off) - 1, np.int64)
            for a, b in bytescan.row_slices(off, SLICE_BYTES):
                o = off[a:b + 1] - off[a]
                starts, ends, rows = bytescan.word_spans(buf[off[a]:off[b]], o)
                words = bytescan.word_hashes(buf[off[a]:off[b]], starts, ends)
                row, h = bytescan.shingle_hashes(words, rows, b - a, width)
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                nth = np.arange(len(h)) - np.repeat(at, np.diff(np.concatenate((at, [len(h)]))))
                with np.errstate(over="ignore"):
                    item = bytescan.splitmix(h + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                item = item[np.lexsort((item, row))]
                chunks.append(item)
                counts[a:b] = np.bincount(row, minlength=b - a)
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, np.concatenate(chunks).view(np.int64))
            yield pa.StructArray.from_arrays([lists], ["items"])

    return add_arrow_columns(df, {"text": F.col("text")}, schema, run).select("node", "items")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs (a, b)`` whose item sets (``node, items``) have the
    similarity."""
    # each member's items move once; a hot leader's are only joined at the end
    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a"))

    def run(batches):
        import pyarrow as pa

        worker_cache("dart_minhash", dict)  # gives back what another operator held
        for batch in batches:
            out = np.zeros(len(batch))
            sides = [batch.column(n) for n in (2, 3)]
            flat = [np.asarray(s.flatten()) for s in sides]
            at = [np.concatenate(([0], np.cumsum(np.asarray(s.value_lengths())))) for s in sides]
            for i in range(len(batch)):
                x, y = (f[t[i]:t[i + 1]] for f, t in zip(flat, at))
                # items are distinct within a side: what meets itself is shared
                z = np.sort(np.concatenate((x, y)))
                shared = int((z[1:] == z[:-1]).sum())
                out[i] = shared / max(1, len(z) - shared)
            good = pa.array(np.flatnonzero(out >= threshold))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(good), batch.column(1).take(good), pa.array(out).take(good)],
                ["a", "b", "similarity"])

    # the threshold is applied in the same pass: as a filter above a function it
    # would be pushed below the projection, and every pair be compared twice
    return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary, similarity double")


def item_sets(nodes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``node, items`` of the listed nodes; copies of a text are folded."""
    wanted = written(nodes.select("node").distinct(), "wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)  # else a shuffle join; the text then moves once
    once = (texts.join(wanted, "node", "left_semi").groupBy("node")
            .agg(F.first("text").alias("text")))
    return written(shingle_sets(once, width), "shingles")


def bit_sketches(sets: DataFrame) -> DataFrame:
    """``node, bits``: one bit of the earliest dart of ``SKETCH_BITS`` coordinates."""

    def run(batches):
        import pyarrow as pa

        worker_cache("dart_minhash", dict)  # gives back what another operator held
        for batch in batches:
            out = []
            lists = batch.column(1)
            flat = np.asarray(lists.flatten()).view(np.uint64)
            ends = np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths()))))
            for a in range(0, len(lists), 64):
                b = min(len(lists), a + 64)
                size = np.diff(ends[a:b + 1])
                items = flat[ends[a]:ends[b]]
                darts = dart_sketch(np.repeat(np.arange(b - a), size), items, np.ones(len(items)),
                                    b - a, SKETCH_BITS)
                bits = (bytescan.splitmix(darts) & np.uint64(1)).astype(np.uint8)
                out.append(np.packbits(bits, axis=1).view(np.int64))
            if out:
                words = np.concatenate(out)
                at = (np.arange(len(words) + 1) * words.shape[1]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(at, words.ravel())], ["node", "bits"])

    return written(sets.select("node", "items").mapInArrow(run, "node binary, bits array<long>"),
                   "bits")


def possible_pairs(rest: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of different classes that share a bucket of ``rest
    (band, key, node, root)`` and may still have the similarity.

    Items that no other node of ``rest`` has can be in no overlap.  With ``n``
    items of which ``m`` are not a node's own, ``min(m) >= t / (1 + t) (n + n')``
    must hold for a pair.  First nodes go that cannot meet this even with the
    smallest other node of their buckets, then pairs are formed under the same
    condition (exact bounds) and if their long bit sketches differ no more than
    a pair at the threshold does within ``SKETCH_SIGMAS`` deviations (chance
    of losing such a pair: 3 in a million)."""
    share = threshold / (1 + threshold)
    items = sets.join(rest.select("node").distinct(), "node", "left_semi").select(
        "node", F.size("items").alias("n"), F.explode("items").alias("item"))
    own = (items.groupBy("item").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node"))
           .filter("c = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own")))
    sizes = sets.select("node", F.size("items").alias("n")).join(own, "node", "left").select(
        "node", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("m"))
    left = written(rest.join(sizes, "node"), "bounds")
    for _ in range(2):
        buckets = left.groupBy("band", "key").agg(
            F.min("n").alias("least"), F.min("root").alias("r1"), F.max("root").alias("r2"))
        left = written(left.join(buckets.filter("r1 <> r2").drop("r1", "r2"), ["band", "key"]).filter(
            F.col("m") + 1e-9 >= share * (F.col("n") + F.col("least"))).drop("least"), "bounds")
    left = left.join(bit_sketches(sets.join(left.select("node").distinct(), "node", "left_semi")),
                     "node")
    other = left.select("band", "key", F.col("node").alias("b"), F.col("root").alias("root_b"),
                        F.col("n").alias("n_b"), F.col("m").alias("m_b"), F.col("bits").alias("bits_b"))
    feasible = F.least("m", "m_b") + 1e-9 >= share * (F.col("n") + F.col("n_b"))
    # bits agree with probability (1 + similarity) / 2
    differ = F.aggregate(F.zip_with("bits", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda a, c: a + c)
    agree = (1 + threshold) / 2
    spread = SKETCH_SIGMAS * float(np.sqrt(agree * (1 - agree) / SKETCH_BITS))
    feasible = feasible & (differ <= F.lit(int(np.ceil((1 - agree + spread) * SKETCH_BITS))))
    return (left.join(other, (left["band"] == other["band"]) & (left["key"] == other["key"])
                      & (F.col("root") < F.col("root_b")) & feasible)
            .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links (a, b)``: the smallest node it
    is connected with.  Labels travel along links and are then shortened by
    looking up the label's own label, so long chains take few rounds."""
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"),
                                                             F.col("a").alias("b"))), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    for _ in range(MAX_ROUNDS):
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = step.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = written(step.join(up, "root").select(
            "node", "old", F.least("root", "top").alias("root")), "labels")
        labels = jumped.select("node", "root")
        if jumped.filter("root <> old").isEmpty():
            return labels
    raise RuntimeError("the links did not settle")


def text_classes(df: DataFrame, text: str = "text", key: str = "doc_id",
                 threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                 width: int = WIDTH) -> DataFrame:
    """``doc_id, node, root`` per row of ``df``: the fingerprint of its text
    and that of the first text of its class (null without words)."""
    base = df.select(col(df, key).alias("doc_id"), col(df, text).alias("text"))
    node = F.unhex(F.md5("text"))
    texts = base.select(node.alias("node"), "text")
    signed = signatures(base.withColumn("node", node), "text", bands, rows, width)
    signed = written(signed.select("doc_id", "node", "bands"), "signatures")
    # one row per different text
    nodes = signed.filter(F.col("bands").isNotNull()).groupBy("node").agg(
        F.first("bands").alias("bands"))
    keys = written(nodes.select("node", F.posexplode("bands").alias("band", "key")), "bands")
    counts = keys.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(keys.join(counts, ["band", "key"]), "buckets")
    # the first node of a bucket is the one that meets most others in all bands
    score = shared.groupBy("node").agg(F.sum("n").alias("score"))
    members = written(shared.drop("n").join(score, "node"), "members")
    first = members.groupBy("band", "key").agg(
        F.max(F.struct("score", "node"))["node"].alias("a"))
    stars = written(members.join(first, ["band", "key"]).filter("node <> a").select(
        "a", F.col("node").alias("b")).distinct(), "pairs")
    sets = item_sets(members, texts, width)
    links = written(verified(stars, sets, threshold), "links")
    roots = components(links)
    # buckets that still hold several classes: compare across them
    placed = members.drop("score").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    mixed = placed.groupBy("band", "key").agg(
        F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2").select("band", "key")
    rest = written(placed.join(mixed, ["band", "key"]).select("band", "key", "node", "root"), "mixed")
    checked = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    across = written(possible_pairs(rest, sets, threshold).join(checked, ["a", "b"], "left_anti"),
                     "across")
    if not across.isEmpty():
        more = written(verified(across, sets, threshold), "links")
        if not more.isEmpty():
            roots = components(links.unionByName(more))
    worded = signed.select("doc_id", F.when(F.col("bands").isNotNull(), F.col("node")).alias("node"))
    return worded.join(roots, "node", "left").select(
        "doc_id", "node", F.coalesce("root", "node").alias("root"))


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``doc_id, class_id, class_size`` per row of ``df``."""
    named = text_classes(df, text, key, **options)
    worded = named.filter(F.col("root").isNotNull())
    classes = worded.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    alone = named.filter(F.col("root").isNull()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return worded.join(classes, "root").select("doc_id", "class_id", "class_size").unionByName(alone)


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df`` that stay when every class keeps the row with its
    smallest id (one of them, if that row is repeated).  Texts without words
    all stay."""
    named = text_classes(df, text, key, **options).filter(F.col("root").isNotNull())
    rows = written(named.groupBy("root", "node", "doc_id").agg(F.count(F.lit(1)).alias("n")), "rows")
    first = rows.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("first"))
    ranked = rows.join(first, "root").select(
        "node", "doc_id", "n", (F.col("node") == F.col("first.node")).alias("same"),
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")).alias("chosen"))
    ranked = ranked.select("node", "doc_id", "n", (F.col("same") & F.col("chosen")).alias("stays"))
    fate = written(ranked.filter("NOT stays OR n > 1").select(
        F.col("node").alias("_node"), F.col("doc_id").alias("_id"), "stays"), "fate")
    if fate.count() <= BROADCAST_ROWS:
        fate = F.broadcast(fate)
    marked = df.select(F.struct(*[col(df, c).alias(c) for c in df.columns]).alias("_row"),
                       F.unhex(F.md5(col(df, text))).alias("_text"), col(df, key).alias("_key"))
    met = marked.join(fate, F.col("_text").eqNullSafe(F.col("_node"))
                      & F.col("_key").eqNullSafe(F.col("_id")), "left")
    whole = met.filter(F.col("stays").isNull()).select("_row")
    repeated = met.filter("stays").groupBy("_text").agg(F.first("_row").alias("_row")).select("_row")
    return whole.unionByName(repeated).select(*[F.col("_row")[c].alias(c) for c in df.columns])


def op5(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
