"""Operator 3: approximate nearest neighbours by balanced posting lists.

* Fit: a bounded, documented sample (``fit_rows``) is cut by balanced
  bisection into posting lists of equal size; their means are the centroids,
  joined by a neighbour graph that every task searches in memory.
* Index: *every* vector is filed.  A vector near a boundary is replicated to
  several lists: those whose centroid is at most ``1 + CLOSE`` times as far as
  the nearest one and not shadowed: no chosen centroid lies nearer to it than
  centroids usually lie to their nearest neighbour (``spacing``).  In high
  dimensions a vector is farther from every centroid than these are from each
  other, so the gap is measured against their own spacing.
* Search: a query walks the graph for the ``beam`` nearest centroids and keeps
  those whose distance ratio to the nearest one is within a limit.  Both are
  calibrated on the true neighbours, found by brute force, of a bounded set of
  queries: the beam reaches ``coverage`` of them, the ratio prunes lists that
  hold the last 1 in 100 only.  Neighbouring lists form shards of bounded size, an overfull
  list is dealt over several blocks; each block answers its queries by one
  matrix product and returns at most k rows per query.

Largest inner product is nearest distance once every vector is lifted by
``sqrt(R^2 - |x|^2)`` (R the largest norm) and the query by 0.  Candidates
within rounding of the k-th are scored again, one dimension after the other
in double precision, and ordered by score and id, so ties and copies fall
alike on any partitioning.

Defined cases: vectors that are null, empty, zero, hold null or non-finite
components, or have another length than most, and rows without id, take no
part; repeated ids count once, with their best score; fewer candidates than k
give all of them; without vectors the result is empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import col, written

#: Bounds of the fitting sample, of the centroids and of the calibration.
FIT_ROWS = 16_384
MAX_LISTS = 2_048
CALIBRATION_QUERIES = 96
COVERAGE = 0.955
RATIO_COVERAGE = 0.99
LIST_ROWS = 128
#: Bytes of one block of vectors (float64) and cells of a score matrix.
BLOCK_BYTES, CELLS = 32 << 20, 4 << 20
QUERY_BLOCK = 4_096
EXACT_ROWS = 8_192
CLOSE = 0.1
REPLICAS = 4
DEGREE = 24
WALK = 24

VECTOR = "id long, vec binary"


def bisect(x: np.ndarray, lists: int, seed: int = 5) -> list[np.ndarray]:
    """Row numbers of ``lists`` clusters of (nearly) equal size: halves are cut
    at the median along the line between two means."""
    rng = np.random.default_rng(seed)

    def cut(rows, parts):
        if parts == 1 or len(rows) < 2:
            return [rows]
        y = x[rows]
        a, b = y[rng.choice(len(y), 2, replace=False)]
        for _ in range(6):
            side = ((y - a) ** 2).sum(1) > ((y - b) ** 2).sum(1)
            if side.all() or not side.any():
                break
            a, b = y[~side].mean(0), y[side].mean(0)
        order = rows[np.argsort(y @ (b - a), kind="stable")]
        left = parts // 2
        at = len(order) * left // parts
        return cut(order[:at], left) + cut(order[at:], parts - left)

    return [r for r in cut(np.arange(len(x)), lists) if len(r)]


@dataclass
class Index:
    """Centroids, their neighbour graph, the radius that lifts vectors and the
    usual distance of a centroid to its nearest neighbour."""

    centroids: np.ndarray
    graph: np.ndarray
    radius2: float
    dim: int
    spacing: float

    @staticmethod
    def fit(sample: np.ndarray, radius2: float, rows: int) -> "Index":
        lifted = lift(sample, radius2)
        lists = int(np.clip(rows // LIST_ROWS, 1, min(MAX_LISTS, max(1, len(sample) // 8))))
        cents = np.array([lifted[r].mean(0) for r in bisect(lifted, lists)])
        graph = neighbour_graph(cents)
        gap = np.sqrt(((cents - cents[graph[:, 0]]) ** 2).sum(1))
        return Index(cents, graph, radius2, sample.shape[1], float(np.median(gap)))

    def nearest(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search on the graph: the ``beam`` nearest centroids found for
        each row of ``x`` (lifted), nearest first, and their distances."""
        n, lists = len(x), len(self.centroids)
        beam = min(beam, lists)
        if beam == lists:  # the walk would visit every node anyway
            d = distances(x, self.centroids)
            order = np.argsort(d, axis=1, kind="stable")
            return order, np.take_along_axis(d, order, 1)
        rows = np.arange(n)[:, None]
        entry = np.linspace(0, lists - 1, min(lists, max(beam, 32)), dtype=np.int64)
        entry = np.unique(entry)
        d = distances(x, self.centroids[entry])
        first = np.argsort(d, axis=1, kind="stable")[:, :beam]
        node, dist = entry[first], np.take_along_axis(d, first, 1)
        if node.shape[1] < beam:
            pad = beam - node.shape[1]
            node = np.concatenate((node, np.full((n, pad), -1)), 1)
            dist = np.concatenate((dist, np.full((n, pad), np.inf)), 1)
        seen = np.zeros((n, lists + 1), bool)
        seen[:, entry] = True
        open_ = np.isfinite(dist)
        while open_.any():
            # expand the nearest few open nodes of every row
            order = np.argsort(np.where(open_, dist, np.inf), axis=1, kind="stable")[:, :4]
            can = np.take_along_axis(open_, order, 1)
            np.put_along_axis(open_, order, np.take_along_axis(open_, order, 1) & False, 1)
            chosen = np.where(can, np.take_along_axis(node, order, 1), -1)
            near = np.where(chosen[:, :, None] >= 0, self.graph[chosen], lists).reshape(n, -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = lists
            near = np.where(seen[rows, near], lists, near)
            seen[rows, near] = True
            seen[:, lists] = False
            r, c = np.nonzero(near < lists)
            nd = np.full(near.shape, np.inf)
            nd[r, c] = np.sqrt(np.maximum(((x[r] - self.centroids[near[r, c]]) ** 2).sum(1), 0))
            node = np.concatenate((node, near), 1)
            dist = np.concatenate((dist, nd), 1)
            open_ = np.concatenate((open_, np.isfinite(nd)), 1)
            keep = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            node, dist, open_ = (np.take_along_axis(t, keep, 1) for t in (node, dist, open_))
        return node, dist

    def file(self, x: np.ndarray) -> list[list[int]]:
        """Posting lists of each vector (not lifted yet): the nearest one, and
        close ones that no chosen centroid shadows."""
        node, dist = self.nearest(lift(x, self.radius2), 4 * REPLICAS)
        out = []
        for ns, ds in zip(node, dist):
            chosen = [int(ns[0])]
            for c, d in zip(ns[1:], ds[1:]):
                if len(chosen) == REPLICAS or not d <= ds[0] * (1 + CLOSE):
                    break
                gap = np.sqrt(((self.centroids[chosen] - self.centroids[c]) ** 2).sum(1))
                if (gap >= self.spacing).all():
                    chosen.append(int(c))
            out.append(chosen)
        return out


def lift(x: np.ndarray, radius2: float) -> np.ndarray:
    extra = np.sqrt(np.maximum(radius2 - (x * x).sum(1), 0))
    return np.concatenate((x, extra[:, None]), 1)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * (x @ c.T)
    return np.sqrt(np.maximum(d, 0))


def neighbour_graph(cents: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Each centroid's nearest others, plus a ring so that all are reached."""
    n = len(cents)
    out = np.empty((n, min(degree, max(1, n - 1)) + 1), np.int64)
    for a in range(0, n, 512):
        d = distances(cents[a:a + 512], cents)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a:a + 512, :-1] = np.argsort(d, axis=1, kind="stable")[:, :out.shape[1] - 1]
    out[:, -1] = (np.arange(n) + 1) % n
    return out


def top_k(queries: np.ndarray, q_ids: np.ndarray, vectors: np.ndarray, v_ids: np.ndarray, k: int,
          allowed: np.ndarray | None = None, list_of: np.ndarray | None = None):
    """Best ``k`` rows of a block for every query, as ``(query_id, vec_id,
    score)``.  A query sees the rows for which ``allowed[q, l]`` holds with one
    of their lists ``l`` in ``list_of[v]``."""
    out_q, out_v, out_s = [], [], []
    size = np.sqrt((vectors * vectors).sum(1)).max(initial=0.0)
    step = max(1, min(256, CELLS // max(1, len(vectors))))
    for a in range(0, len(queries), step):
        q = queries[a:a + step]
        s = q @ vectors.T
        if allowed is not None:
            seen = allowed[a:a + step][:, list_of[:, 0]]
            for more in list_of.T[1:]:
                seen |= allowed[a:a + step][:, more]
            s[~seen] = -np.inf
        s[q_ids[a:a + step, None] == v_ids[None, :]] = -np.inf
        slack = 1e-12 * size * np.sqrt((q * q).sum(1))
        if s.shape[1] > k:
            # repeated ids may share places: look as deep as the block has them
            depth = min(s.shape[1], k * repeats_of(v_ids))
            cut = -np.partition(-s, depth - 1, axis=1)[:, depth - 1]
        else:
            cut = np.full(len(q), -np.inf)
        r, c = np.nonzero((s >= (cut - slack)[:, None]) & np.isfinite(s))
        score = np.zeros(len(r))
        for j in range(q.shape[1]):  # a fixed order of summation
            score += q[r, j] * vectors[c, j]
        ids = v_ids[c]
        order = np.lexsort((-score, ids, r))
        r, ids, score = r[order], ids[order], score[order]
        once = np.ones(len(r), bool)
        once[1:] = (r[1:] != r[:-1]) | (ids[1:] != ids[:-1])
        r, ids, score = r[once], ids[once], score[once]
        order = np.lexsort((ids, -score, r))
        r, ids, score = r[order], ids[order], score[order]
        heads = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1]))) if len(r) else np.zeros(0, int)
        nth = np.arange(len(r)) - np.repeat(heads, np.diff(np.concatenate((heads, [len(r)]))))
        best = nth < k
        out_q.append(q_ids[a:a + step][r[best]])
        out_v.append(ids[best])
        out_s.append(score[best])
    if not out_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def repeats_of(ids: np.ndarray) -> int:
    """How often the commonest id of a block occurs."""
    return int(np.unique(ids, return_counts=True)[1].max(initial=1))


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a binary Arrow column of float64 vectors."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _places(column):
    """Row, place in the row and value of every element of a list column."""
    lists = column.combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size), (
        lists.flatten().to_numpy(zero_copy_only=False))


def vectors_of(df: DataFrame, key: str = "vec_id", embedding: str = "embedding",
               dim: int | None = None) -> DataFrame:
    """``id, vec`` (float64 bytes) of the rows that take part."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(1)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ok = np.flatnonzero((size == dim) if dim else size > 0)
            ids = batch.column(0).take(pa.array(ok))
            x = lists.take(pa.array(ok)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(size[ok]))).astype(int)
            good, raw = [], []
            for i, (a, b) in enumerate(zip(ends, ends[1:])):
                v = x[a:b]
                if np.isfinite(v).all() and v.any():
                    good.append(i)
                    raw.append(v.tobytes())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(good, pa.int64())),
                                              pa.array(raw, pa.binary())], ["id", "vec"])

    rows = df.select(col(df, key).cast("long").alias("id"), col(df, embedding).alias("e"))
    return rows.filter("id IS NOT NULL AND e IS NOT NULL").mapInArrow(run, VECTOR)


def _collect(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    got = rows.collect()
    ids = np.array([r["id"] for r in got], np.int64)
    return ids, np.frombuffer(b"".join(bytes(r["vec"]) for r in got), np.float64).reshape(-1, dim)


def exact(vectors: DataFrame, q_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Brute force for a bounded set of queries: ``query_id, vec_id, score, vec``."""
    dim = queries.shape[1]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            v = _matrix(batch.column(1), dim)
            ids = batch.column(0).to_numpy()
            for a in range(0, len(v), EXACT_ROWS):
                q, w, s = top_k(queries, q_ids, v[a:a + EXACT_ROWS], ids[a:a + EXACT_ROWS], k)
                at = dict(zip(ids.tolist(), range(len(ids))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(w), pa.array(s),
                     batch.column(1).take(pa.array([at[i] for i in w.tolist()], pa.int64()))],
                    ["query_id", "vec_id", "score", "vec"])

    found = vectors.mapInArrow(run, "query_id long, vec_id long, score double, vec binary")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def calibrate(index: Index, vectors: DataFrame, queries: DataFrame, k: int,
              coverage: float = COVERAGE) -> tuple[float, float, int]:
    """``(ratio limit, least distance that ratios are taken of, beam)`` from the
    true neighbours of a bounded set of queries: the beam is the number of lists
    that reaches ``coverage`` of them, the ratio covers ``RATIO_COVERAGE``."""
    q_ids, q = _collect(queries.orderBy(F.xxhash64("id"), "id").limit(CALIBRATION_QUERIES), index.dim)
    if not len(q_ids):
        return 1.0, 0.0, 1
    hits = exact(vectors, q_ids, q, k).select("query_id", F.col("vec_id").alias("id"), "vec").collect()
    lifted = np.concatenate((q, np.zeros((len(q), 1))), 1)
    to = distances(lifted, index.centroids)
    if not hits:
        return 1.0, 0.0, 1
    # a query that sits on a centroid must not shut out every other list
    floor = max(float(np.median(to.min(axis=1))) / 2, 1e-12)
    ratio = to / np.maximum(to.min(axis=1, keepdims=True), floor)
    place = np.argsort(np.argsort(to, axis=1, kind="stable"), axis=1, kind="stable")
    row = {i: n for n, i in enumerate(q_ids.tolist())}
    x = np.frombuffer(b"".join(bytes(h["vec"]) for h in hits), np.float64).reshape(-1, index.dim)
    filed = [(row[h["query_id"]], lists) for h, lists in zip(hits, index.file(x))]

    def covering(table, share):
        need = sorted(min(table[r, c] for c in lists) for r, lists in filed)
        return need[min(len(need) - 1, int(np.ceil(share * len(need))))]

    limit = float(covering(ratio, max(coverage, RATIO_COVERAGE))) + 1e-9
    wide = int(covering(place, coverage)) + 1
    return limit, floor, min(len(index.centroids), wide + wide // 8)


def chosen_lists(index: Index, lifted: np.ndarray, rule: tuple[float, float, int],
                 rows_in: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists nearest first for each query, and which of them it probes: those of
    the walk that the ratio does not prune, and more, nearest first, until
    ``enough`` rows are in reach."""
    limit, floor, take = rule
    beam = max(take, WALK)  # a walk that keeps few nodes goes astray
    while True:
        node, dist = index.nearest(lifted, beam)
        if beam >= len(index.centroids) or (rows_in[node].sum(axis=1) >= enough).all():
            break
        beam *= 2
    before = np.cumsum(rows_in[node], axis=1) - rows_in[node]
    pruned = dist > np.maximum(dist[:, :1], floor) * limit
    beyond = np.arange(node.shape[1])[None] >= take
    return node, ~(pruned | beyond) | (before < enough)


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id",
            embedding: str = "embedding", fit_rows: int = FIT_ROWS,
            coverage: float = COVERAGE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` rows of ``df`` found with
    the largest inner product for each row of ``queries`` (same columns)."""
    schema = "query_id long, rank int, vec_id long, score double"
    empty = df.sparkSession.createDataFrame([], schema)
    sizes = (df.select(F.size(col(df, embedding)).alias("n")).filter("n > 0").groupBy("n").count()
             .orderBy(F.desc("count"), F.desc("n")).limit(1).collect())
    if not sizes:
        return empty
    dim = sizes[0]["n"]
    vectors = vectors_of(df, key, embedding, dim)
    asked = vectors_of(queries, key, embedding, dim)

    def norms(batches):
        import pyarrow as pa

        for batch in batches:
            v = _matrix(batch.column(1), dim)
            yield pa.RecordBatch.from_arrays([pa.array((v * v).sum(1))], ["n2"])

    stats = vectors.mapInArrow(norms, "n2 double").agg(F.count("n2"), F.max("n2")).collect()[0]
    if not stats[0]:
        return empty
    share = min(1 << 30, (2 * fit_rows << 30) // stats[0])
    _, sample = _collect(vectors.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share)
                         .orderBy(F.xxhash64("id"), "id").limit(fit_rows), dim)
    if not len(sample):
        _, sample = _collect(vectors.limit(fit_rows), dim)
    index = Index.fit(sample, float(stats[1]), stats[0])
    n_lists, block_rows = len(index.centroids), max(1, BLOCK_BYTES // (8 * dim))
    rule = calibrate(index, vectors, asked, k, coverage)

    def file(batches):
        import pyarrow as pa

        for batch in batches:
            for a in range(0, len(batch), 2048):
                part = batch.slice(a, 2048)
                lists = index.file(_matrix(part.column(1), dim))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lists, pa.list_(pa.int32()))],
                    ["id", "vec", "lists"])

    filed = written(vectors.mapInArrow(file, VECTOR + ", lists array<int>"), "postings")
    counts = {r["list"]: r["count"] for r in filed.select(F.explode("lists").alias("list"))
              .groupBy("list").count().collect()}
    # neighbouring lists form shards; an overfull one is dealt over blocks
    shard_of, blocks, held = np.zeros(len(index.centroids), np.int64), [1], 0
    for c in range(len(index.centroids)):
        n = counts.get(c, 0)
        if held and held + n > block_rows:
            blocks.append(1)
            held = 0
        shard_of[c] = len(blocks) - 1
        held += n
        blocks[-1] = max(1, -(-held // block_rows))
    # lists are taken, nearest first, until k rows are sure to be among them:
    # a row stands in at most REPLICAS lists, and one may be the query itself
    rows_in = np.array([counts.get(c, 0) for c in range(len(index.centroids))])
    enough = REPLICAS * (k + 1)
    n_queries = asked.count()
    q_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    shard = F.array(*[F.lit(int(s)) for s in shard_of])
    deal = F.array(*[F.lit(int(b)) for b in blocks])
    # a vector goes once to each shard that holds one of its lists
    postings = filed.select(
        "id", "vec", "lists", F.explode(F.array_distinct(F.transform(
            "lists", lambda c: F.get(shard, c)))).alias("shard"))
    postings = postings.select(
        "id", "vec", "lists", "shard",
        F.pmod(F.xxhash64("id"), F.get(deal, F.col("shard"))).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block"))

    def probe(batches):
        import pyarrow as pa

        for batch in batches:
            for a in range(0, len(batch), 1024):
                part = batch.slice(a, 1024)
                x = _matrix(part.column(1), dim)
                lifted = np.concatenate((x, np.zeros((len(x), 1))), 1)
                node, ok = chosen_lists(index, lifted, rule, rows_in, enough)
                row, shards, lists = [], [], []
                for i in range(len(x)):
                    own = node[i][ok[i]]
                    for s in np.unique(shard_of[own]).tolist():
                        row.append(i)
                        shards.append(s)
                        lists.append(own[shard_of[own] == s].astype(np.int32))
                row = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(1).take(row),
                     pa.array(lists, pa.list_(pa.int32())), pa.array(shards, pa.int32())],
                    ["id", "vec", "lists", "shard"])

    probes = asked.mapInArrow(probe, VECTOR + ", lists array<int>, shard int")
    probes = probes.select(
        "id", "vec", "lists", "shard",
        F.explode(F.sequence(F.lit(0), F.get(deal, F.col("shard")) - 1)).alias("block"),
        F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int").alias("q_block"))

    def answer(left, right):
        import pyarrow as pa

        names = ["query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()),
                             pa.array([], pa.float64())], names)
        v, q = (_matrix(t.column("vec"), dim) for t in (left, right))
        ids, q_ids = left.column("id").to_numpy(), right.column("id").to_numpy()
        # rows x lists, padded with one list that nobody probes
        list_of = np.full((len(ids), REPLICAS), n_lists)
        r, at, flat = _places(left.column("lists"))
        list_of[r, at] = flat
        allowed = np.zeros((len(q_ids), n_lists + 1), bool)
        r, _, flat = _places(right.column("lists"))
        allowed[r, flat] = True
        a, b, s = top_k(q, q_ids, v, ids, k, allowed, list_of)
        return pa.table([pa.array(a), pa.array(b), pa.array(s)], names)

    by = ("shard", "block", "q_block")
    found = postings.groupBy(*by).cogroup(probes.groupBy(*by)).applyInArrow(
        answer, "query_id long, vec_id long, score double")
    # a vector found in two shards stays once
    spread = found.repartition("query_id")
    once = spread.withColumn("_n", F.row_number().over(
        Window.partitionBy("query_id", "vec_id").orderBy(F.desc("score")))).filter("_n = 1")
    return once.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3(embeddings: DataFrame) -> DataFrame:
    queries = embeddings.filter(F.col("vec_id") % 20 == 0)
    return nearest(embeddings, queries)
