"""Plug-in extension points and the remaining sinks."""

import os

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import embed, splitter
from tessera.session import scratch_path
from tessera.sources import sinks


def test_splitter_length_function():
    # a "token" length: words; chunks of at most 4 words, no overlap
    chunks = splitter.split_text("a b c d e f g", 4, 0, length=lambda s: len(s.split()))
    assert chunks == ["a b c d", "e f g"]


def test_plugin_embedder_batches(spark):
    def make_model():
        def model(texts):
            # a tiny deterministic "network": letter counts of a few letters
            return np.array([[t.count(c) for c in "aeiou"] for t in texts], dtype=np.float32)
        return model

    df = spark.createDataFrame([(i, "banana" * (i + 1)) for i in range(20)] + [(99, "xyz")],
                               "id long, text string")
    out = embed.embed_with(df, make_model, batch_size=8).orderBy("id").collect()
    v = np.array(out[0].embedding)
    assert abs(np.linalg.norm(v) - 1) < 1e-6 and v[0] > 0 and v[1] == 0
    assert out[-1].embedding == [0.0] * 5            # zero vector stays zero


def test_binary_stream_ingest(spark):
    from tessera.streaming.ingest import ingest_binary
    root = scratch_path(spark, "bin-stream")
    src = os.path.join(root, "in")
    os.makedirs(src)

    def put(name, pages):
        with open(os.path.join(src, name), "wb") as f:
            f.write("\f".join(pages).encode())

    def make_extractor():
        return lambda data: data.decode().split("\f")

    args = (src, f"{root}/out", f"{root}/ckpt", make_extractor)
    put("a.pdf", ["end of 2021.", "in forecasting"])
    assert ingest_binary(spark, *args) == 1
    put("b.pdf", ["x"])
    assert ingest_binary(spark, *args) == 2
    assert ingest_binary(spark, *args) == 2
    texts = sorted(r.text for r in spark.read.parquet(f"{root}/out").collect())
    assert texts == ["end of 2021.in forecasting", "x"]


def test_report_csv_and_summary(spark):
    df = spark.createDataFrame([("q", 3, True, "a", 1.0, 0.5, 0.5, 1.0)],
                               "question string, k int, rerank boolean, answer string, "
                               "total_time double, retrieval_time double, generation_time double, "
                               "time_per_token double")
    path = scratch_path(spark, "report")
    sinks.write_report_csv(df, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == df.columns and back.count() == 1
    assert sinks.report_name("data/vector_db/index.bin", "models/gen-3b") == \
        "benchmark_vector_db_gen-3b.csv"
    s = sinks.run_summary(spark, n_documents=3, seconds=1.5).first()
    assert (s.n_documents, s.seconds) == (3, 1.5)
    obs_df, obs = sinks.observed(df, "m", n_rerank=F.count_if("rerank"))
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 1 and obs.get["n_rerank"] == 1
