"""Few queries go to the vectors; certified cells; refined codes; dead letters; numbered rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from sf_paths import SF_SMALL

from tessera.operators import batching, ivf, knn
from tessera.session import scratch_path
from tessera.streaming import ingest


def vectors(spark):
    return spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("row_id"), "embedding")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_both_sides_of_the_bound_agree(spark):
    v = vectors(spark)
    v = v.unionByName(v.withColumn("row_id", F.col("row_id") + 10_000))  # ties by id
    v = v.unionByName(spark.createDataFrame([(77_777, None)], v.schema)).repartition(5)
    q = vectors(spark).filter("row_id % 20 = 0").withColumnRenamed("row_id", "q_id")
    few = rows(knn.knn_search(v, q, 7))
    assert few == rows(knn.knn_search(v, q, 7, few_query_bytes=0))
    assert few == rows(knn.knn_search(v.repartition(1), q.repartition(9), 7))
    assert len(few) == 7 * q.count()
    assert knn.knn_search(v.limit(0), q, 3).count() == 0
    assert knn.knn_search(v, q.limit(0), 3).count() == 0
    assert knn.knn_search(vectors(spark).limit(2), q, 5).count() == 2 * q.count()


def test_vectors_are_not_exchanged(spark):
    q = vectors(spark).limit(3).withColumnRenamed("row_id", "q_id")
    plan = knn.knn_search(vectors(spark), q, 5)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan
    for part in plan.split("Exchange")[1:]:  # what an exchange carries
        assert "embedding" not in part.split("\n")[0] and "payload" not in part.split("\n")[0]


def clustered(spark, n=4000, dim=16, clusters=40):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(clusters, dim)) * 4
    x = centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, dim)) * 0.3
    return spark.createDataFrame([(i, [float(f) for f in r]) for i, r in enumerate(x)],
                                 "row_id long, embedding array<float>").repartition(4)


def test_certified_cells_equal_the_flat_search(spark):
    v = clustered(spark).checkpoint(eager=True)
    cents = ivf.train_centroids(v, nlist=40, max_iter=5).checkpoint(eager=True)
    filed = ivf.assign_cells(v, cents).checkpoint(eager=True)
    q = v.filter("row_id % 40 = 0").withColumnRenamed("row_id", "q_id")
    hits, read = ivf.search_ivf_exact(filed, cents, q, 5)
    assert rows(hits) == rows(knn.knn_search(v, q, 5))
    mean = read.agg(F.avg("cells_read")).first()[0]
    assert 2 <= mean < 10  # of 40
    few, _ = ivf.search_ivf_exact(filed.limit(3), cents, q.limit(4), 5)
    assert few.count() == 12


def test_refined_codes_reach_the_recall(spark):
    v = vectors(spark)
    cents = ivf.train_centroids(v, max_iter=5).checkpoint(eager=True)
    filed = ivf.assign_cells(v, cents).checkpoint(eager=True)
    book = ivf.train_pq(filed, cents, 8, 8, max_iter=5).checkpoint(eager=True)
    codes = ivf.encode_pq(filed, cents, book).checkpoint(eager=True)
    q = v.withColumnRenamed("row_id", "q_id").checkpoint(eager=True)
    nprobe, expand, curve = ivf.calibrate_refined(codes, filed, cents, book,
                                                  q.filter("q_id % 5 = 0"), 5, 0.9)
    exact = knn.knn_search(v, q, 5)
    got = ivf.search_pq_refined(codes, filed, cents, book, q, 5, nprobe, expand)
    assert ivf.recall_at_k(got, exact) >= 0.88 and curve[-1][1] >= 0.9
    plain = ivf.search_pq(codes, cents, book, q, 5, nprobe)
    assert ivf.recall_at_k(got, exact) > ivf.recall_at_k(plain, exact)
    same = got.join(exact, ["q_id", "row_id"]).filter(got["d2"] != exact["d2"])
    assert same.count() == 0  # measured, not estimated


def test_rejected_files_are_tried_again(spark):
    root = scratch_path(spark, "dead")
    src = f"{root}/in"
    os.makedirs(src)

    def put(name, data):
        with open(f"{src}/{name}", "wb") as f:
            f.write(data)

    def make():
        def extract(data):
            if data.startswith(b"bad"):
                raise ValueError("cannot read this")
            return data.decode().split("\f")
        return extract

    def run():
        return ingest.ingest_binary_counts(spark, src, f"{root}/out", f"{root}/ckpt", make,
                                           max_attempts=2)

    put("a.pdf", b"one\ftwo")
    put("b.pdf", b"bad one")
    put("c.pdf", b"bad too")
    assert run() == {"ok": 1, "failed": 2, "given_up": 0, "retried": 0, "rows": 1}
    put("b.pdf", b"mended")
    os.utime(f"{src}/b.pdf", (2_000_000_000, 2_000_000_000))
    assert run() == {"ok": 1, "failed": 0, "given_up": 1, "retried": 2, "rows": 2}
    assert run() == {"ok": 0, "failed": 0, "given_up": 0, "retried": 0, "rows": 2}
    put("c.pdf", b"now good")  # given up, but changed since
    os.utime(f"{src}/c.pdf", (2_000_000_100, 2_000_000_100))
    assert run() == {"ok": 1, "failed": 0, "given_up": 0, "retried": 1, "rows": 3}
    texts = sorted(r.text for r in spark.read.parquet(f"{root}/out").collect())
    assert texts == ["mended", "now good", "onetwo"]
    states = {r["path"][-5:]: r["state"] for r in ingest.dead_letters(spark, f"{root}/out").collect()}
    assert states == {"b.pdf": "done", "c.pdf": "done"}


def test_null_and_repeated_ids_are_numbered(spark):
    docs = spark.createDataFrame([(1, "a b c"), (None, "d e f"), (2, "g h"), (2, "g h")],
                                 "doc_id long, text string")
    counts = docs.select("doc_id", F.lit(1).alias("n"))
    items = docs.withColumn("chunk_id", F.lit(0))
    with pytest.raises(ValueError, match="null or repeated"):
        batching.assign_item_batches(counts, items, 2)
    numbered = batching.number_documents(docs, [F.col("doc_id").asc_nulls_first(), "text"])
    items = numbered.select("doc_row", "doc_id", F.posexplode(F.split("text", " ")).alias("chunk_id", "w"))
    counts = numbered.select("doc_row", F.size(F.split("text", " ")).alias("n"))
    got = batching.assign_item_batches(counts, items, 2, key="doc_row").collect()
    assert len(got) == 10 and len({(r["batch_id"], r["slot"]) for r in got}) == 10
    assert sorted(r["w"] for r in got) == sorted("abcdefghgh")
