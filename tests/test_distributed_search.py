"""The block join: near ties, copies, memory of the PQ kernel, null vectors."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import ivf, knn


def brute(vecs, ids, q, k):
    d = np.array([((v - q) ** 2).sum() for v in vecs])
    return [int(ids[i]) for i in np.lexsort((ids, np.round(d, 9)))[:k]]


@pytest.mark.parametrize("block", [20_000, 13])
def test_two_hundred_copies_that_differ_in_the_last_bit(spark, block):
    rng = np.random.default_rng(3)
    base = np.abs(rng.normal(size=64))
    vecs = np.array([base * r / np.linalg.norm(base * r) for r in range(1, 201)])
    ids = rng.permutation(200)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vecs)],
                               "row_id long, embedding array<double>").repartition(7)
    qs = vecs[::10] + 0.0
    asked = spark.createDataFrame([(i, q.tolist()) for i, q in enumerate(qs)],
                                  "q_id long, embedding array<double>")
    got = {}
    for r in knn.knn_search(df, asked, 5, vectors_per_group=block).collect():
        got.setdefault(r.q_id, []).append((r.rank, r.row_id))
    for i, q in enumerate(qs):
        assert [v for _, v in sorted(got[i])] == brute(vecs, ids, q, 5) == [0, 1, 2, 3, 4]


def test_shifted_vectors_keep_their_order():
    rng = np.random.default_rng(4)
    vecs = rng.normal(size=(500, 16)) + 1e4
    row, ids, _ = knn.nearest_rows(vecs[:20], vecs, np.arange(500), 7)
    for i in range(20):
        assert ids[row == i].tolist() == brute(vecs, np.arange(500), vecs[i], 7)


def test_null_vectors_take_no_part_anywhere(spark):
    rows = [(i, [float(i), float(i % 3)]) for i in range(30)] + [(99, None)]
    vec = spark.createDataFrame(rows, "row_id long, embedding array<double>")
    q = spark.createDataFrame([(0, [1.0, 1.0]), (1, None)], "q_id long, embedding array<double>")
    assert {r.q_id for r in knn.knn_search(vec, q, 3).collect()} == {0}
    cents = ivf.train_centroids(vec, nlist=3)
    filed = ivf.assign_cells(vec, cents)
    assert filed.count() == 30
    for search in (ivf.search_ivf, ivf.search_ivf_grouped):
        hits = search(filed, cents, q, 3, 3).collect()
        assert {r.q_id for r in hits} == {0} and 99 not in {r.row_id for r in hits}


def test_recall_of_nothing_is_an_error(spark):
    none = spark.createDataFrame([], "q_id long, row_id long")
    with pytest.raises(ValueError):
        ivf.recall_at_k(none, none)


def test_pq_kernels_are_bounded_at_dim_384(spark):
    rng = np.random.default_rng(5)
    m, ksub, dsub = 8, 256, 48
    book = rng.normal(size=(m, ksub, dsub))
    codes = pa.array(rng.integers(0, ksub, (4000, m)).astype(np.int16).tolist(), pa.list_(pa.int16()))
    residual = rng.normal(size=(2000, m * dsub))
    tracemalloc.start()
    row, ids, d2 = ivf.asymmetric_rows(residual, book, codes, np.arange(4000), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20  # 2,000 x 4,000 doubles alone would be 64 MB per copy
    code = np.array(codes.to_pylist())
    for q in (0, 1999):
        rq = residual[q].reshape(m, dsub)
        want = sum(((rq[s] - book[s][code[:, s]]) ** 2).sum(1) for s in range(m))
        assert ids[row == q].tolist() == np.lexsort((np.arange(4000), np.round(want, 9)))[:5].tolist()


def test_rows_beyond_a_known_distance_are_not_measured():
    rng = np.random.default_rng(5)
    vecs = rng.normal(size=(400, 8))
    d2 = ((vecs[:20, None] - vecs[None]) ** 2).sum(axis=2)
    limit = np.sort(d2, axis=1)[:, 6]
    limit[::2] = np.inf
    row, ids, _ = knn.nearest_rows(vecs[:20], vecs, np.arange(400), 50, limit)
    for i in range(20):
        assert ids[row == i].tolist() == brute(vecs, np.arange(400), vecs[i], 50 if i % 2 == 0 else 7)


def test_a_pack_tells_its_kernel_the_distances_so_far(spark):
    rng = np.random.default_rng(6)
    vecs = rng.normal(size=(2000, 4))
    df = spark.createDataFrame([(i, i // 100, v.tolist()) for i, v in enumerate(vecs)],
                               "row_id long, cell_id int, embedding array<double>")
    asked = df.select(F.col("row_id").alias("q_id"), F.col("embedding").alias("vector"),
                      F.lit(float("inf")).alias("limit"))

    def kernel(cell, q_mat, payload, ids, k, limit):
        row, ids, d2 = knn.flat_kernel(cell, q_mat, payload, ids, k, limit)
        # the last of the 20 cells: all distances are known, few rows are left to measure
        assert cell < 19 or (np.isfinite(limit).all() and len(row) < len(q_mat) * k)
        return row, ids, d2

    v = df.select(F.col("cell_id").alias("cell"), F.col("row_id").alias("id"),
                  F.col("embedding").alias("payload"))
    found, _ = knn.pack_search(v, asked, knn.Packs({c: 100 for c in range(20)}, 20, 2000),
                               lambda vecs, limit: np.ones((len(vecs), 20), bool),
                               kernel, 3, "row_id", 700)
    got = {}
    for r in knn.rank_hits(found, 3, "row_id").collect():
        got.setdefault(r.q_id, []).append((r.rank, r.row_id))
    for i in range(0, 2000, 37):
        assert [x for _, x in sorted(got[i])] == brute(vecs, np.arange(2000), vecs[i], 3)
