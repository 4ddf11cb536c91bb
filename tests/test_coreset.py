"""k-means trained on a weighted coreset gathered in one pass."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import ivf


@pytest.fixture(scope="module")
def clustered(spark):
    """30,000 vectors in 40 clusters of uneven size, one holding a third."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8)) * 6
    which = np.where(rng.random(30_000) < 1 / 3, 0, rng.integers(0, 40, 30_000))
    mat = centres[which] + rng.normal(size=(30_000, 8))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(mat.tolist())],
                               "row_id long, embedding array<double>").repartition(12, "row_id")
    return df.checkpoint(eager=True), mat


def _objective(mat, centres):
    d = ((mat[:, None] - centres[None]) ** 2).sum(axis=2) if len(mat) * len(centres) < 2e7 else None
    return float(d.min(axis=1).sum())


def _full(df, k, seed):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    data = df.select(array_to_vector("embedding").alias("features")).cache()
    model = KMeans(k=k, seed=seed, maxIter=20, initMode="k-means||").fit(data)
    data.unpersist()
    return np.asarray(model.clusterCenters())


def test_objective_is_within_five_percent_of_full_training(spark, clustered):
    df, mat = clustered
    got = ivf.train_centroids(df, nlist=40, coreset_size=4000).orderBy("cell_id").collect()
    ours = _objective(mat, np.array([r.centroid for r in got]))
    best = min(_objective(mat, _full(df, 40, seed)) for seed in (1, 2, 3))
    assert len(got) == 40 and ours <= 1.05 * best


def test_total_weight_and_size_hold_on_every_level(spark, clustered):
    df, mat = clustered
    points = ivf.coreset(df, "embedding", 500, fan_in=2)  # four levels of merging
    rows = points.collect()
    assert 300 <= len(rows) <= 500
    assert sum(r._w for r in rows) == pytest.approx(len(mat))
    mean = np.average([r._p for r in rows], axis=0, weights=[r._w for r in rows])
    assert np.abs(mean - mat.mean(axis=0)).max() < 1.0
    again = ivf.coreset(df, "embedding", 500, fan_in=2).collect()
    assert sorted(map(tuple, (r._p for r in rows))) == sorted(map(tuple, (r._p for r in again)))


def test_few_vectors_stay_as_they_are(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0] if i % 9 else None) for i in range(200)],
                               "row_id long, embedding array<float>").repartition(5)
    rows = ivf.coreset(df, "embedding", 1000).collect()
    assert sorted(r._p[0] for r in rows) == [i for i in range(200) if i % 9]
    assert {r._w for r in rows} == {1.0}
    assert ivf.coreset(df.limit(0), "embedding", 10).count() == 0


def test_equal_vectors(spark):
    df = spark.range(5000).select(F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    rows = ivf.coreset(df, "embedding", 100).collect()
    assert sum(r._w for r in rows) == pytest.approx(5000)
    assert len(rows) <= 100 and {tuple(r._p) for r in rows} == {(1.0, 2.0)}
