"""Queries without a SQL twin, checked against brute force on small tables."""

import numpy as np
from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from tessera.operators import ivf, splitter
from tessera.plans.registry import QUERIES


def test_recursive_chunks_query_vs_python(spark):
    got = sorted((r.doc_id, r.chunk_id, r.text, r.n_chars)
                 for r in QUERIES["recursive_chunks"](spark, SF_SMALL).collect())
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = sorted((d.doc_id, i, c, len(c)) for d in docs
                  for i, c in enumerate(splitter.split_text(
                      d.text.replace("\r\n", "\n").replace("\r", "\n"), 400, 50)))
    assert got == want


def _emb(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("row_id"), "embedding")
    rows = emb.orderBy("row_id").collect()
    ids = np.array([r.row_id for r in rows])
    vecs = np.array([r.embedding for r in rows], dtype=np.float64)
    return emb, ids, vecs


def _top(d, ids, k):
    order = np.lexsort((ids, np.round(d, 9)))
    return [int(ids[i]) for i in order[:k] if np.isfinite(d[i])]


def test_ivf_nprobe1_vs_numpy(spark):
    emb, ids, vecs = _emb(spark)
    cents = ivf.train_centroids(emb).checkpoint(eager=True)
    c = np.array([r.centroid for r in cents.orderBy("cell_id").collect()])
    filed = ivf.assign_cells(emb, cents)
    cell_of = {r.row_id: r.cell_id for r in filed.collect()}
    hits = ivf.search_ivf(filed, cents, emb.withColumnRenamed("row_id", "q_id"), 5, 1)
    got = {}
    for r in hits.collect():
        got.setdefault(r.q_id, []).append((r.rank, r.row_id))
    cells = np.array([cell_of[int(i)] for i in ids])
    for qi in range(0, len(ids), 50):
        q = vecs[qi]
        dc = ((c - q) ** 2).sum(axis=1)
        probe = np.lexsort((np.arange(len(c)), np.round(dc, 9)))[0]
        d = np.where(cells == probe, ((vecs - q) ** 2).sum(axis=1), np.inf)
        assert [v for _, v in sorted(got.get(int(ids[qi]), []))] == _top(d, ids, 5)


def test_pq_adc_vs_numpy(spark):
    emb, ids, vecs = _emb(spark)
    cents = ivf.train_centroids(emb).checkpoint(eager=True)
    filed = ivf.assign_cells(emb, cents).checkpoint(eager=True)
    book = ivf.train_pq(filed, cents, 8, 8).checkpoint(eager=True)
    codes = ivf.encode_pq(filed, cents, book).checkpoint(eager=True)
    c = np.array([r.centroid for r in cents.orderBy("cell_id").collect()])
    bk = np.array([r.centroid for r in book.orderBy("sub", "code").collect()]).reshape(8, 256, -1)
    cd = {r.row_id: (r.cell_id, np.array(r.codes)) for r in codes.collect()}
    # codes are the nearest code word of each residual sub-vector
    r0 = int(ids[0])
    cell, code = cd[r0]
    res = (vecs[0] - c[cell]).reshape(8, -1)
    assert list(((res[:, None, :] - bk) ** 2).sum(axis=2).argmin(axis=1)) == list(code)
    hits = ivf.search_pq(codes, cents, book, emb.withColumnRenamed("row_id", "q_id"), 5, 2)
    got = {}
    for r in hits.collect():
        got.setdefault(r.q_id, []).append((r.rank, r.row_id, r.d2))
    for qi in range(0, len(ids), 100):
        q = vecs[qi]
        dc = ((c - q) ** 2).sum(axis=1)
        probes = set(np.lexsort((np.arange(len(c)), np.round(dc, 9)))[:2])
        d = np.full(len(ids), np.inf)
        for j, rid in enumerate(ids):
            cl, co = cd[int(rid)]
            if cl in probes:
                rq = (q - c[cl]).reshape(8, -1)
                d[j] = sum(((rq[s] - bk[s, co[s]]) ** 2).sum() for s in range(8))
        mine = sorted(got.get(int(ids[qi]), []))
        assert [v for _, v, _ in mine] == _top(d, ids, 5)
        assert np.allclose([x for _, _, x in mine], sorted(d[np.isfinite(d)])[:len(mine)])
