"""Cell-partitioned approximate search.

* ``train_centroids`` (A8): Spark ML k-means on a weighted coreset that one pass
  over the vectors gathers (``coreset``); ``nlist`` defaults to ``min(4096, n // 10)``.  The centroid table is bounded (nlist x dim), so
  it is the one side shipped to every task.
* ``assign_cells``: nearest centroid(s) of every row by an Arrow batch
  function (ties -> lowest cell id).  The store is written partitioned by
  ``cell_id`` so a search reads only probed cells (partition pruning).
* ``search_ivf`` (V5/J6): queries probe their ``nprobe`` nearest cells; exact
  distances inside them, by the block join of ``knn``.
* PQ (V6): residuals to the cell centre are cut into ``m`` sub-vectors, each
  quantised by its own 2**nbits-word k-means codebook; search adds ``m`` table
  look-ups per vector (asymmetric distance), no refinement.
* ``calibrate_nprobe`` (V7, re-aimed HNSW): the smallest nprobe whose recall@k
  against exact search on the given queries reaches a target.

Rows with a null vector take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators import knn

MAX_NLIST = 4096
# rows encoded at once inside a task
_ENCODE_ROWS = 256
# weighted points that k-means is trained on: per centre, and at least
CORESET_PER_CENTRE = 20
MIN_CORESET = 10_000
MIN_TASK_POINTS = 1024
# centres up to which Spark ML seeds its rounds (its last step, on the driver,
# takes time with the square of the centres); points of a task in a round beyond
MAX_ML_CENTRES = 1000
ROUND_POINTS = 8192
# drawn points per centre among which the seeds beyond are chosen
SEED_POINTS_PER_CENTRE = 8


def default_nlist(n: int) -> int:
    nlist = min(MAX_NLIST, n // 10)
    if nlist < 1:
        raise ValueError("IVF needs at least 10 vectors")
    return nlist


def _reduced(points: np.ndarray, weights: np.ndarray, size: int, rng) -> tuple:
    """At most ``size`` weighted points that stand for ``points``: drawn with
    replacement, half by weight and half by the share of the squared distance
    to the mean, and weighted by the inverse of their chance.  The total weight
    is kept."""
    if len(points) <= size:
        return points, weights
    total = weights.sum()
    spread_ = weights * ((points - weights @ points / total) ** 2).sum(axis=1)
    chance = 0.5 * weights / total
    chance += 0.5 * spread_ / spread_.sum() if spread_.sum() > 0 else chance
    drawn, times = np.unique(rng.choice(len(points), size, p=chance / chance.sum()), return_counts=True)
    kept = times * weights[drawn] / chance[drawn]
    return points[drawn], kept * (total / kept.sum())


def _stacked(parts: list) -> tuple:
    return np.concatenate([p for p, _ in parts]), np.concatenate([w for _, w in parts])


def coreset(df: DataFrame, vec_col: str, size: int, seed: int = 1, fan_in: int = 8) -> DataFrame:
    """``(_p array<double>, _w double)``: at most ``size`` weighted vectors that
    stand for all vectors of ``df`` in k-means.

    One pass over the vectors: a task keeps its share of weighted points (four
    times ``size`` over the number of tasks, at least 1,024) and folds further
    vectors into them block by block; the tasks' points are merged ``fan_in``
    sets at a time until one is left, so no task ever holds more than
    ``fan_in * size`` points.  Where no task meets more vectors than its share
    and all are at most ``size``, they stay as they are, with weight 1.  Null
    vectors take no part.  The same partitions give the same points, also when
    a task runs again."""
    if size < 1:
        raise ValueError("a coreset needs at least one point")
    spark = df.sparkSession
    from tessera.session import checkpoint_dir
    checkpoint_dir(spark)
    schema = "_task int, _p array<double>, _w double"
    vectors = df.filter(F.col(vec_col).isNotNull()).select(
        F.col(vec_col).cast("array<double>").alias("_p"))
    share = min(size, max(MIN_TASK_POINTS, -(-4 * size // max(1, vectors.rdd.getNumPartitions()))))

    def out(task, points, weights):
        n, dim = points.shape
        lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * dim, points.ravel())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, task, np.int32)), lists, pa.array(weights)], ["_task", "_p", "_w"])

    def local(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        rng = np.random.default_rng((seed, task))
        kept, waiting, n = None, [], 0

        def folded():
            new = _stacked(waiting)
            return _reduced(*(new if kept is None else _stacked([kept, new])), share, rng)

        for batch in batches:
            if not batch.num_rows:
                continue
            mat, _ = knn._flat_vectors(batch.column("_p"), None)
            waiting.append((mat, np.ones(len(mat))))
            n += len(mat)
            if n >= share:
                kept, waiting, n = folded(), [], 0
        if waiting:
            kept = folded()
        if kept is not None:
            yield out(task, *kept)

    def merged(key, table):
        task = key[0].as_py()
        table = table.sort_by([("_task", "ascending"), ("_i", "ascending")])
        mat, _ = knn._flat_vectors(table.column("_p"), None)
        points, weights = _reduced(mat, table.column("_w").to_numpy(),
                                   size, np.random.default_rng((seed, level, task)))
        return pa.Table.from_batches([out(task, points, weights)])

    points = vectors.mapInArrow(local, schema).checkpoint(eager=True)
    level, tasks = 0, (points.agg(F.max("_task")).first()[0] or 0) + 1
    while tasks > 1:
        level += 1
        # the order of drawing is the order of the points, wherever they lie
        points = (points.withColumn("_i", F.monotonically_increasing_id())
                  .withColumn("_set", F.expr(f"_task div {fan_in}").cast("int"))
                  .groupBy("_set").applyInArrow(merged, schema).checkpoint(eager=True))
        tasks = -(-tasks // fan_in)
    return points.select("_p", "_w")


def default_coreset_size(k: int) -> int:
    return max(MIN_CORESET, CORESET_PER_CENTRE * k)


def _seeds(mat: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most ``k`` distinct points by weighted k-means++."""
    rng = np.random.default_rng(seed)
    mat, weights = _reduced(mat, weights, SEED_POINTS_PER_CENTRE * k, rng)
    sq, far = (mat * mat).sum(axis=1), np.full(len(mat), np.inf)
    at, chosen = int(rng.choice(len(mat), p=weights / weights.sum())), []
    while True:
        chosen.append(at)
        far = np.minimum(far, np.maximum(0, sq + sq[at] - 2 * (mat @ mat[at])))
        far[far < 1e-14 * (1 + sq)] = 0  # copies of a chosen point
        share = np.cumsum(weights * far)
        if len(chosen) == k or not share[-1] > 0:
            return mat[chosen]
        at = min(int(np.searchsorted(share, rng.random() * share[-1], "right")), len(mat) - 1)


def _many_centres(points: DataFrame, k: int, seed: int, max_iter: int, tol: float = 1e-4
                  ) -> np.ndarray:
    """Lloyd's rounds for many centres, a job each.  The seeds are chosen in one
    task among the points of a coreset, which is bounded by ``k``; in a round
    every task sums its points by centre, and the sums are added by centre."""
    spark = points.sparkSession

    def choose(batches):
        mat, weights = _stacked([(knn._flat_vectors(b.column("_p"), None)[0],
                                  b.column("_w").to_numpy()) for b in batches if b.num_rows])
        centres = _seeds(mat, weights, k, seed)
        yield pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(np.arange(len(centres) + 1, dtype=np.int32)
                                      * centres.shape[1], centres.ravel())], ["c"])

    centres, dim = knn._flat_vectors(points.coalesce(1).mapInArrow(
        choose, "c array<double>").toArrow().column("c"), None)
    dealt = points.withColumn("_i", F.monotonically_increasing_id()).repartition(
        -(-points.count() // ROUND_POINTS), "_i").sortWithinPartitions("_i").checkpoint(eager=True)
    schema = "cell int, task int, w double, s array<double>"

    def rows(cell, task, w, s):
        return [pa.array(cell, pa.int32()), pa.array(np.full(len(cell), task, np.int32)), pa.array(w),
                pa.ListArray.from_arrays(np.arange(len(cell) + 1, dtype=np.int32) * dim, s.ravel())]

    def one_round(bc):
        def sums(batches):
            from pyspark import TaskContext
            c = bc.value
            half = (c * c).sum(axis=1) / 2
            w, s = np.zeros(len(c)), np.zeros((len(c), dim))
            for batch in batches:
                for lo in range(0, batch.num_rows, _ENCODE_ROWS):
                    part = batch.slice(lo, _ENCODE_ROWS)
                    mat, _ = knn._flat_vectors(part.column("_p"), dim)
                    own = part.column("_w").to_numpy()
                    near = (half[None] - mat @ c.T).argmin(axis=1)
                    np.add.at(w, near, own)
                    np.add.at(s, near, mat * own[:, None])
            cell = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays(
                rows(cell, TaskContext.get().partitionId(), w[cell], s[cell]),
                ["cell", "task", "w", "s"])

        def added(table):
            table = table.sort_by([("cell", "ascending"), ("task", "ascending")])
            cell = table.column("cell").to_numpy()
            heads = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            mat, _ = knn._flat_vectors(table.column("s"), dim)
            return pa.table(rows(cell[heads], 0, np.add.reduceat(table.column("w").to_numpy(), heads),
                                 np.add.reduceat(mat, heads, axis=0)), ["cell", "task", "w", "s"])

        return dealt.select("_p", "_w").mapInArrow(sums, schema).groupBy(
            (F.col("cell") % 16).alias("_run")).applyInArrow(added, schema).toArrow()

    for _ in range(max_iter):
        bc = spark.sparkContext.broadcast(centres)
        got = one_round(bc)
        bc.unpersist()
        cell = got.column("cell").to_numpy()
        new = centres.copy()
        new[cell] = knn._flat_vectors(got.column("s"), dim)[0] / got.column("w").to_numpy()[:, None]
        moved, centres = ((new - centres) ** 2).sum(axis=1).max(), new
        if moved <= tol ** 2:
            break
    return centres


def _weighted_kmeans(points: DataFrame, k: int, seed: int, max_iter: int) -> np.ndarray:
    """Lloyd's rounds on weighted points ``(_p, _w)``."""
    if k > MAX_ML_CENTRES:
        return _many_centres(points, k, seed, max_iter)
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    data = points.select(array_to_vector("_p").alias("features"), F.col("_w").alias("weight"))
    # k-means|| initialisation: a few extra passes, but better-balanced cells
    # than random centres (recall@5 0.72 vs 0.67 at nprobe 16 on the test vectors)
    model = KMeans(k=k, seed=seed, maxIter=max_iter, initMode="k-means||",
                   weightCol="weight").fit(data)
    return np.asarray(model.clusterCenters(), dtype=np.float64)


def train_centroids(vectors: DataFrame, vec_col: str = "embedding", nlist: int | None = None,
                    seed: int = 1, max_iter: int = 20, sample_fraction: float | None = None,
                    coreset_size: int | None = None) -> DataFrame:
    """``(cell_id int, centroid array<double>)``, trained on a coreset of every
    vector (one pass; ``coreset_size`` points, by default 20 a cell and at least
    10,000) or, if the caller asks for it, of a seeded sample of
    ``sample_fraction``."""
    vectors = vectors.filter(F.col(vec_col).isNotNull())
    k = nlist or default_nlist(vectors.count())
    if sample_fraction is not None:
        vectors = vectors.sample(fraction=sample_fraction, seed=seed)
    points = coreset(vectors, vec_col, coreset_size or default_coreset_size(k), seed)
    centers = _weighted_kmeans(points, k, seed, max_iter)
    spark = vectors.sparkSession
    return spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)],
                                 "cell_id int, centroid array<double>")


def _centroid_matrix(centroids: DataFrame) -> np.ndarray:
    t = centroids.orderBy("cell_id").select("cell_id", "centroid").toArrow()
    ids = t.column("cell_id").to_numpy()
    if not np.array_equal(ids, np.arange(len(ids))):
        raise ValueError("cell ids must be 0..nlist-1")
    mat, _ = knn._flat_vectors(t.column("centroid"), None)
    return mat


def _nearest(vecs: np.ndarray, cents: np.ndarray, n: int) -> np.ndarray:
    """(rows, n) nearest centroid ids, ties to the lowest id."""
    _, ids, _ = knn.nearest_rows(vecs, cents, np.arange(len(cents)), n)
    return ids.reshape(len(vecs), n)


def assign_cells(df: DataFrame, centroids: DataFrame, vec_col: str = "embedding",
                 nprobe: int = 1, out_col: str = "cell_id") -> DataFrame:
    """Adds ``cell_id`` (nprobe=1) or ``cells array<int>`` nearest first; rows
    with a null vector have no cell and go."""
    cents = _centroid_matrix(centroids)
    bc = df.sparkSession.sparkContext.broadcast(cents)
    n = min(nprobe, cents.shape[0])
    cols = df.columns

    def run(batches):
        c = bc.value
        for rb in batches:
            if rb.num_rows == 0:
                continue
            vecs, _ = knn._flat_vectors(rb.column(vec_col), c.shape[1])
            near = _nearest(vecs, c, n).astype(np.int32)
            arrays = [rb.column(x) for x in cols]
            if nprobe == 1:
                arrays.append(pa.array(near[:, 0], pa.int32()))
            else:
                arrays.append(pa.array(list(near), pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=cols + [out_col])

    from pyspark.sql import types as T
    out_type = T.IntegerType() if nprobe == 1 else T.ArrayType(T.IntegerType())
    return df.filter(F.col(vec_col).isNotNull()).mapInArrow(
        run, T.StructType(df.schema.fields + [T.StructField(out_col, out_type)]))


def _asked(queries: DataFrame, q_id_col: str, q_vec_col: str) -> DataFrame:
    return queries.filter(F.col(q_vec_col).isNotNull()).select(
        F.col(q_id_col).cast("long").alias("q_id"), F.col(q_vec_col).alias("vector"))


def _packs(vectors: DataFrame, n_cells: int, dim: int, rows: int | None = None) -> knn.Packs:
    """The cells of ``vectors (cell, ...)`` in packs; counts by cell are collected."""
    counts = {r[0]: r[1] for r in vectors.groupBy("cell").count().collect()}
    return knn.Packs(counts, n_cells, knn.block_rows(
        vectors.sparkSession, sum(counts.values()), dim, rows))


def _probed(queries: DataFrame, cents: np.ndarray, nprobe: int):
    """``queries`` with a limit column, and the rule that marks the ``nprobe``
    nearest cells."""
    bc = queries.sparkSession.sparkContext.broadcast(cents)
    n = min(nprobe, len(cents))

    def wanted(vecs, limit):
        want = np.zeros((len(vecs), len(bc.value)), bool)
        np.put_along_axis(want, _nearest(vecs, bc.value, n).astype(np.int64), True, axis=1)
        return want

    return queries.withColumn("limit", F.lit(float("inf"))), wanted


def search_ivf_grouped(store: DataFrame, centroids: DataFrame, queries: DataFrame, k: int = 5,
                       nprobe: int = 1, *, id_col: str = "row_id", vec_col: str = "embedding",
                       q_id_col: str = "q_id", q_vec_col: str = "embedding",
                       cell_col: str = "cell_id", vectors_per_group: int | None = None,
                       queries_per_group: int | None = None) -> DataFrame:
    """Exact top-k inside the ``nprobe`` nearest cells of every query: the
    block join by packs of cells, at most ``vectors_per_group`` vectors and
    ``queries_per_group`` queries a group (by default as ``knn.block_rows``)."""
    v = store.filter(F.col(vec_col).isNotNull()).select(
        F.col(cell_col).alias("cell"), F.col(id_col).cast("long").alias("id"),
        F.col(vec_col).alias("payload"))
    cents = _centroid_matrix(centroids)
    q = _asked(queries, q_id_col, q_vec_col)
    per_block = knn.block_rows(q.sparkSession, q.count(), cents.shape[1], queries_per_group)
    found, _ = knn.pack_search(v, *_with_packs(v, q, cents, nprobe, vectors_per_group),
                               knn.flat_kernel, k, id_col, per_block)
    return knn.rank_hits(found, k, id_col)


def _with_packs(v, q, cents, nprobe, vectors_per_group=None):
    asked, wanted = _probed(q, cents, nprobe)
    return asked, _packs(v, len(cents), cents.shape[1], vectors_per_group), wanted


def search_ivf(store: DataFrame, centroids: DataFrame, queries: DataFrame, k: int = 5,
               nprobe: int = 1, *, id_col: str = "row_id", vec_col: str = "embedding",
               q_id_col: str = "q_id", q_vec_col: str = "embedding",
               cell_col: str = "cell_id",
               max_block_bytes: int = knn.PACK_BYTES) -> DataFrame:
    """``search_ivf_grouped`` with query blocks of at most ``max_block_bytes``."""
    return search_ivf_grouped(
        store, centroids, queries, k, nprobe, id_col=id_col, vec_col=vec_col, q_id_col=q_id_col,
        q_vec_col=q_vec_col, cell_col=cell_col,
        queries_per_group=knn.queries_per_block(queries, q_vec_col, max_block_bytes))


# ------------------------------------------------------------------ certified search
def cell_radii(store: DataFrame, centroids: DataFrame, vec_col: str = "embedding",
               cell_col: str = "cell_id") -> DataFrame:
    """``(cell, radius)``: how far a cell's farthest row lies from its centre
    (partial maxima, one row per cell)."""
    bc = store.sparkSession.sparkContext.broadcast(_centroid_matrix(centroids))

    def run(batches):
        far: dict[int, float] = {}
        for batch in batches:
            if batch.num_rows:
                vecs, _ = knn._flat_vectors(batch.column("v"), bc.value.shape[1])
                cell = batch.column("cell").to_numpy().astype(np.int64)
                dist = np.sqrt(((vecs - bc.value[cell]) ** 2).sum(axis=1))
                for c in np.unique(cell):
                    far[int(c)] = max(far.get(int(c), 0.0), float(dist[cell == c].max()))
        yield pa.RecordBatch.from_arrays([pa.array(list(far), pa.int32()),
                                          pa.array(list(far.values()), pa.float64())],
                                         ["cell", "radius"])

    v = store.filter(F.col(vec_col).isNotNull()).select(F.col(cell_col).alias("cell"),
                                                        F.col(vec_col).alias("v"))
    return v.mapInArrow(run, "cell int, radius double").groupBy("cell").agg(
        F.max("radius").alias("radius"))


def search_ivf_exact(store: DataFrame, centroids: DataFrame, queries: DataFrame, k: int = 5, *,
                     radii: DataFrame | None = None, first: int = 2, id_col: str = "row_id",
                     vec_col: str = "embedding", q_id_col: str = "q_id",
                     q_vec_col: str = "embedding", cell_col: str = "cell_id",
                     max_block_bytes: int = knn.PACK_BYTES
                     ) -> tuple[DataFrame, DataFrame]:
    """Exact top-k by cells: ``(hits, cells read per query)``.

    The ``first`` nearest cells give every query an upper bound on its k-th
    distance.  By the triangle inequality no row of a cell lies nearer than the
    distance to its centre less its radius; cells whose bound is beyond the k-th
    distance are never read, all others are.  A query travels once to each pack
    of cells, however many of them it reads.  ``radii`` (``cell_radii``) may be
    kept with the store."""
    radius = {r["cell"]: r["radius"] for r in
              (radii or cell_radii(store, centroids, vec_col, cell_col)).collect()}
    cents = _centroid_matrix(centroids)  # bounded: nlist x dim
    reach = np.array([radius.get(c, -1.0) for c in range(len(cents))])
    bc = queries.sparkSession.sparkContext.broadcast((cents, reach))
    q = _asked(queries, q_id_col, q_vec_col)

    def ways(wanted):
        """The cells that ``wanted(distances, bounds, limit)`` marks, given each
        query's k-th distance so far."""
        def marked(vecs, limit):
            mat, far = bc.value
            dist = np.zeros((len(vecs), len(mat)))
            for j in range(mat.shape[1]):
                dist += (vecs[:, j, None] - mat[None, :, j]) ** 2
            dist = np.sqrt(dist)
            dist[:, far < 0] = np.inf  # empty cells
            # a margin for rounding keeps the bound on the safe side
            low = np.maximum(0, dist - far[None] - 1e-6 * (1 + dist))
            return wanted(dist, low, limit)
        return marked

    def nearest(dist, low, limit):
        rank = np.argsort(np.argsort(dist, axis=1, kind="stable"), axis=1, kind="stable")
        return (rank < first) & np.isfinite(dist)

    def remaining(dist, low, limit):
        return ~nearest(dist, low, limit) & np.isfinite(dist) & (low <= limit[:, None])

    v = store.filter(F.col(vec_col).isNotNull()).select(
        F.col(cell_col).alias("cell"), F.col(id_col).cast("long").alias("id"),
        F.col(vec_col).alias("payload"))
    packs = _packs(v, len(cents), cents.shape[1])
    per_block = knn.block_rows(q.sparkSession, q.count(), cents.shape[1],
                               knn.queries_per_block(q, "vector", max_block_bytes))

    def look(asked, wanted):
        found, sent = knn.pack_search(v, asked, packs, ways(wanted), knn.flat_kernel, k, id_col,
                                      per_block)
        return knn.rank_hits(found, k, id_col).checkpoint(eager=True), sent.select("q_id", "n")

    near, start = look(q.withColumn("limit", F.lit(float("inf"))), nearest)
    kth = near.filter(F.col("rank") == k).select("q_id", F.sqrt("d2").alias("limit"))
    known = q.join(kth, "q_id", "left").select(
        "q_id", "vector", F.coalesce("limit", F.lit(float("inf"))).alias("limit"))
    further, rest = look(known, remaining)
    both = near.unionByName(further).select("q_id", id_col, "d2")
    read = start.unionAll(rest).groupBy("q_id").agg(F.sum("n").alias("cells_read"))
    return knn.rank_hits(both, k, id_col), read


# ------------------------------------------------------------------ PQ
def train_pq(store: DataFrame, centroids: DataFrame, m: int = 8, nbits: int = 8,
             vec_col: str = "embedding", cell_col: str = "cell_id", seed: int = 1,
             max_iter: int = 20, sample_fraction: float | None = None,
             coreset_size: int | None = None) -> DataFrame:
    """``(sub int, code int, centroid array<double>)``: one codebook per
    sub-space, trained on a coreset of the residuals to the cell centre of every
    vector (or of a seeded sample, if the caller asks for one).  All sub-spaces
    share the coreset, so the vectors are read once."""
    cents = _centroid_matrix(centroids)
    dim = cents.shape[1]
    if dim % m:
        raise ValueError("dimension must be a multiple of m")
    ksub = 1 << nbits
    n = store.count()
    if n < ksub:
        raise ValueError(f"PQ training needs at least {ksub} vectors")
    train = store if sample_fraction is None else store.sample(fraction=sample_fraction, seed=seed)
    cdf = store.sparkSession.createDataFrame([(i, c.tolist()) for i, c in enumerate(cents)],
                                             f"{cell_col} int, _c array<double>")
    res = (train.join(F.broadcast(cdf), cell_col)
           .select(F.zip_with(F.col(vec_col).cast("array<double>"), F.col("_c"),
                              lambda a, b: a - b).alias("_r")))
    res = coreset(res, "_r", coreset_size or default_coreset_size(ksub), seed)
    dsub = dim // m

    def fit(s):
        sub = res.select(F.slice("_p", s * dsub + 1, dsub).alias("_p"), "_w")
        book = _weighted_kmeans(sub, ksub, seed + s, max_iter)
        if book.shape[0] < ksub:
            # k-means returns fewer centres when the data has fewer distinct
            # points; repeat them so every sub-space has 2**nbits code words
            book = book[np.arange(ksub) % book.shape[0]]
        return [(s, j, book[j].tolist()) for j in range(book.shape[0])]

    # the m fits are independent Spark jobs: submit them concurrently so the
    # cluster runs their tasks side by side instead of m rounds of small jobs
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=m) as pool:
        rows = [r for part in pool.map(fit, range(m)) for r in part]
    return store.sparkSession.createDataFrame(rows, "sub int, code int, centroid array<double>")


def _codebook_array(codebook: DataFrame) -> np.ndarray:
    t = codebook.orderBy("sub", "code").toArrow()
    subs = t.column("sub").to_numpy()
    m = int(subs.max()) + 1
    mat, dsub = knn._flat_vectors(t.column("centroid"), None)
    return mat.reshape(m, -1, dsub)


def encode_pq(store: DataFrame, centroids: DataFrame, codebook: DataFrame,
              vec_col: str = "embedding", cell_col: str = "cell_id",
              id_col: str = "row_id") -> DataFrame:
    """``(row_id, cell_id, codes array<smallint>)`` — nearest code per sub-space."""
    bc = store.sparkSession.sparkContext.broadcast((_centroid_matrix(centroids),
                                                    _codebook_array(codebook)))

    def run(batches):
        cents, book = bc.value
        m, ksub, dsub = book.shape
        for rb in batches:
            if rb.num_rows == 0:
                continue
            vecs, _ = knn._flat_vectors(rb.column(vec_col), cents.shape[1])
            cells = rb.column(cell_col).to_numpy(zero_copy_only=False).astype(np.int64)
            r = (vecs - cents[cells]).reshape(len(vecs), m, dsub)
            codes = np.empty((len(vecs), m), np.int16)
            for lo in range(0, len(vecs), _ENCODE_ROWS):
                part = r[lo:lo + _ENCODE_ROWS]
                for s in range(m):  # rows x code words x sub-dimension doubles at a time
                    d = ((part[:, s, None, :] - book[s][None]) ** 2).sum(axis=2)
                    codes[lo:lo + _ENCODE_ROWS, s] = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [rb.column(id_col), rb.column(cell_col), pa.array(list(codes), pa.list_(pa.int16()))],
                names=[id_col, cell_col, "codes"])

    return store.select(id_col, cell_col, vec_col).mapInArrow(
        run, f"{id_col} long, {cell_col} int, codes array<smallint>")


def _proposed(codes, cents, codebook, q, k, nprobe, id_col, cell_col, vectors_per_group=None,
              queries_per_group=None):
    """``(candidates (q_id, id, d2, pack), packs, queries of a block)`` by code."""
    book = _codebook_array(codebook)
    bc = codes.sparkSession.sparkContext.broadcast((cents, book))

    def kernel(cell, q_mat, payload, ids, k, limit):
        cents, book = bc.value
        m, ksub, _ = book.shape
        if len(ids) >= ksub:
            return asymmetric_rows(q_mat - cents[cell], book, payload, ids, k)
        # fewer rows than code words: the same distances, from the decoded rows
        code = knn._flat_vectors(payload, m)[0].astype(np.int64)
        rows = np.concatenate([book[s][code[:, s]] for s in range(m)], axis=1) + cents[cell]
        return knn.nearest_rows(q_mat, rows, ids, k, limit)

    v = codes.select(F.col(cell_col).alias("cell"), F.col(id_col).cast("long").alias("id"),
                     F.col("codes").alias("payload"))
    asked, packs, wanted = _with_packs(v, q, cents, nprobe, vectors_per_group)
    per_block = knn.block_rows(q.sparkSession, q.count(), cents.shape[1], queries_per_group)
    found, _ = knn.pack_search(v, asked, packs, wanted, kernel, k, id_col, per_block)
    return found, packs, per_block


def search_pq(codes: DataFrame, centroids: DataFrame, codebook: DataFrame, queries: DataFrame,
              k: int = 5, nprobe: int = 1, *, id_col: str = "row_id", cell_col: str = "cell_id",
              q_id_col: str = "q_id", q_vec_col: str = "embedding",
              vectors_per_group: int | None = None,
              queries_per_group: int | None = None) -> DataFrame:
    """Approximate top-k by asymmetric distance: for each probed cell, a
    per-query table of sub-space distances; a vector costs ``m`` look-ups.  A
    cell with fewer rows than code words costs less decoded than by its table."""
    found, _, _ = _proposed(codes, _centroid_matrix(centroids), codebook,
                            _asked(queries, q_id_col, q_vec_col), k, nprobe, id_col, cell_col,
                            vectors_per_group, queries_per_group)
    return knn.rank_hits(found, k, id_col)


def asymmetric_rows(residual: np.ndarray, book: np.ndarray, payload, ids: np.ndarray, k: int):
    """``(query row, id, d2)``: the ``k`` best codes of one block for query
    residuals.  A sub-block of queries holds its distance table (queries x m x
    code words) and one queries x codes matrix, nothing larger."""
    m, ksub, dsub = book.shape
    code, _ = knn._flat_vectors(payload, m)
    code = code.astype(np.int64)
    out = []
    step = knn.sub_block(len(ids))
    for lo in range(0, len(residual), step):
        rq = residual[lo:lo + step].reshape(-1, m, dsub)
        d2 = np.zeros((len(rq), len(ids)))
        for s in range(m):
            table = np.zeros((len(rq), ksub))
            for j in range(dsub):
                table += (rq[:, s, j, None] - book[s][None, :, j]) ** 2
            d2 += table[:, code[:, s]]
        if len(ids) > k:
            cut = np.partition(d2, k - 1, axis=1)[:, k - 1]
            row, at = np.nonzero(d2 <= cut[:, None] + 10.0 ** -knn._DIGITS)
        else:
            row, at = np.divmod(np.arange(d2.size), max(1, len(ids)))
        row, found, best = knn.first_k(row, ids[at], d2[row, at], k)
        out.append((row + lo, found, best))
    return tuple(np.concatenate(x) for x in zip(*out))


def search_pq_refined(codes: DataFrame, store: DataFrame, centroids: DataFrame,
                      codebook: DataFrame, queries: DataFrame, k: int = 5, nprobe: int = 1,
                      expand: int = 8, *, id_col: str = "row_id", vec_col: str = "embedding",
                      cell_col: str = "cell_id", q_id_col: str = "q_id",
                      q_vec_col: str = "embedding") -> DataFrame:
    """Two phases: the codes propose ``expand * k`` rows a query, the stored
    vectors of these rows are scored again and the best ``k`` stay.  For the
    second phase a query goes once to each pack of cells that it has proposals
    in, with their ids; no vector is repeated for a proposal."""
    cents = _centroid_matrix(centroids)
    q = _asked(queries, q_id_col, q_vec_col)
    found, packs, per_block = _proposed(codes, cents, codebook, q, expand * k, nprobe, id_col,
                                        cell_col)
    best = Window.partitionBy("q_id").orderBy(F.round("d2", knn._DIGITS), F.col(id_col))
    ids = (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= expand * k)
           .groupBy("q_id", "pack").agg(F.collect_list(id_col).alias("ids")))
    asked = ids.join(q, "q_id").select("pack", "q_id", "vector", "ids").checkpoint(eager=True)
    v = store.filter(F.col(vec_col).isNotNull()).select(
        F.col(cell_col).alias("cell"), F.col(id_col).cast("long").alias("id"),
        F.col(vec_col).alias("payload"))
    return knn.rank_hits(knn.rescore(v, asked, packs, k, id_col, per_block), k, id_col)


def calibrate_refined(codes: DataFrame, store: DataFrame, centroids: DataFrame, codebook: DataFrame,
                      sample_queries: DataFrame, k: int, target: float,
                      **names: str) -> tuple[int, int, list]:
    """``(nprobe, expand, curve)``: the cheapest of the doubling steps whose
    measured recall@k on the sample reaches ``target``.  Probes first: cells
    that the exact search inside them cannot do without; then candidates."""
    nprobe, _ = calibrate_nprobe(store, centroids, sample_queries, k, (1 + target) / 2, **names)
    exact = knn.knn_search(store, sample_queries, k, **{
        n: v for n, v in names.items() if n != "cell_col"}).checkpoint(eager=True)
    expand, curve = 4, []
    most = max(1, -(-store.count() // k))
    while True:
        got = search_pq_refined(codes, store, centroids, codebook, sample_queries, k, nprobe,
                                expand, **names)
        curve.append((expand, recall_at_k(got, exact, names.get("id_col", "row_id"))))
        if curve[-1][1] >= target or expand >= most:
            return nprobe, expand, curve
        expand = min(most, expand * 2)


# ------------------------------------------------------------------ recall
def recall_at_k(approx: DataFrame, exact: DataFrame, id_col: str = "row_id") -> float:
    """Share of exact top-k rows the approximate search also returned."""
    got = approx.select("q_id", id_col).join(exact.select("q_id", id_col), ["q_id", id_col]).count()
    total = exact.count()
    if not total:
        raise ValueError("recall of nothing: the exact search has no rows")
    return got / total


def calibrate_nprobe(store: DataFrame, centroids: DataFrame, sample_queries: DataFrame, k: int,
                     target: float, *, id_col: str = "row_id", vec_col: str = "embedding",
                     q_id_col: str = "q_id", q_vec_col: str = "embedding",
                     cell_col: str = "cell_id") -> tuple[int, list]:
    """Smallest nprobe (1, 2, 4, ... nlist) with recall@k >= target on the
    sample; ``nprobe = nlist`` is exact, so the target is always reachable."""
    nlist = centroids.count()
    exact = knn.knn_search(store, sample_queries, k, id_col=id_col, vec_col=vec_col,
                           q_id_col=q_id_col, q_vec_col=q_vec_col).checkpoint(eager=True)
    curve = []
    nprobe = 1
    while True:
        approx = search_ivf(store, centroids, sample_queries, k, nprobe, id_col=id_col,
                            vec_col=vec_col, q_id_col=q_id_col, q_vec_col=q_vec_col,
                            cell_col=cell_col)
        r = recall_at_k(approx, exact, id_col)
        curve.append((nprobe, r))
        if r >= target or nprobe >= nlist:
            return nprobe, curve
        nprobe = min(nlist, nprobe * 2)
