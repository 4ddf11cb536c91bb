"""Hash vectors counted in batches, pooling by running sums, the split boundary
by digit histograms."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.ordering import md5_order_key, order_boundary
from tessera.operators import corpus, embed


def _unit(text, dim=64):
    v = np.zeros(dim)
    for w in (text or "").lower().split():
        v[int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % dim] += 1
    n = np.sqrt((v * v).sum())
    return list(v / n if n else v)


TEXTS = [None, "", "  ", "one", "One one TWO", "a b c d e f g " * 900, "été 中文 x"]


def test_hash_vectors_equal_a_plain_count(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 300)], "id int, text string")
    got = {r.id: r.e for r in df.select("id", embed.hash_embedding("text").alias("e")).collect()}
    assert all(got[i] == _unit(t) for i, t in enumerate(TEXTS * 300))


def test_chunk_vectors_equal_the_vector_of_each_chunk(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    got = {r.id: r.e for r in df.select("id", embed.chunk_hash_embeddings("text", 50).alias("e")).collect()}
    for i, t in enumerate(TEXTS):
        words = (t or "").split()
        assert got[i] == [_unit(" ".join(words[j:j + 50])) for j in range(0, len(words), 50)]


def test_pooling_of_hot_null_and_ragged_groups(spark, monkeypatch):
    monkeypatch.setattr(embed, "_RUNNING_BYTES", 2000)  # tasks hand on many times
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        group = None if i % 10 == 0 else "hot" if i % 3 == 0 else f"g{i % 40}"
        vec = None if i % 17 == 0 else [float(x) for x in rng.normal(size=2 if group == "g1" and i % 2 else 5)]
        rows.append((group, int(rng.integers(0, 3)), vec))
    rows += [("off", 0, [1.0] * 5), ("off", None, [2.0] * 5), ("gap", 1, [1.0, None, 3.0]), ("none", 1, None)]
    df = spark.createDataFrame(rows, "g string, mask int, vec array<double>").repartition(13)
    pooled = embed.mean_pool(df, "g")
    got = {r.g: r.pooled for r in pooled.collect()}
    want = {}
    for g, m, v in rows:
        if v is not None:
            s, w = want.setdefault(g, (np.zeros(5), np.zeros(5)))
            s[:len(v)] += np.array([x or 0.0 for x in v]) * (m or 0)
            w[:len(v)] += m or 0
    assert got.keys() == want.keys() and len(got["gap"]) == 3
    for g, p in got.items():
        mean = want[g][0] / np.maximum(want[g][1], 1e-9)
        assert p == pytest.approx(mean[:len(p)], abs=1e-9)
    assert embed.mean_pool(df.limit(0), "g").count() == 0


def test_pooling_moves_a_row_per_group_and_task(spark):
    df = spark.range(0, 4000, 1, 4).select(
        (F.col("id") % 3).alias("g"), F.lit(1).alias("mask"),
        F.array_repeat(F.col("id").cast("double"), 384).alias("vec"))
    plan = embed.mean_pool(df, "g")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    got = {r.g: r.pooled for r in embed.mean_pool(df, "g").collect()}
    assert all(len(p) == 384 and p[0] == pytest.approx(np.arange(g, 4000, 3).mean())
               for g, p in got.items())


@pytest.mark.parametrize("n", [0, 1, 7, 9000])
def test_split_boundary_is_the_ranked_key(spark, n):
    df = spark.range(0, n, 1, 5).withColumnRenamed("id", "doc_id")
    order = sorted(range(n), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    for ratio in (0.0, 0.37, 0.9, 1.0):
        split = corpus.split_exact(df, ratio=ratio)
        train = {r.doc_id for r in split.filter("split = 'train'").collect()}
        assert train == set(order[:int(n * ratio)])


def test_split_sorts_nothing_and_takes_null_keys(spark):
    df = spark.createDataFrame([(i if i % 4 else None, "t") for i in range(400)], "doc_id long, text string")
    split = corpus.split_exact(df, ratio=0.5)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    got = {r.split: r.n for r in split.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"train": 200, "eval": 200}
    late = corpus.split_exact(df, ratio=0.9)  # the boundary lies among the null keys
    assert late.filter("split = 'train'").count() == 300


def test_many_rows_of_one_key_end_the_selection(spark):
    df = spark.range(10000).select(F.lit(7).alias("k"))
    keys = df.select("k", md5_order_key(1, "k").alias("_k"))
    assert order_boundary(keys, "_k", "k", lambda n: n // 2)["k"] == 7
