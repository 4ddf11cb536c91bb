"""Split, skip, page concat, training-data operators, perplexity, streaming."""

import os

from pyspark.sql import functions as F

from sf_paths import SF
from tessera.operators import batching, corpus
from tessera.operators import perplexity as ppl
from tessera.session import scratch_path


def test_split_exact_counts(spark):
    for n, train in [(76, 68), (10, 9), (1, 0), (0, 0)]:
        df = spark.range(n).withColumnRenamed("id", "doc_id")
        s = corpus.split_exact(df, "doc_id", 0.9, 42)
        assert s.filter("split = 'train'").count() == train
        assert s.count() == n


def test_split_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    s = corpus.split_exact(docs.repartition(4), "doc_id", 0.9, 42)
    tr = s.filter("split = 'train'").agg(F.count("*"), F.sum("doc_id")).first()
    assert tuple(tr) == (900, 448984)
    f = corpus.split_fraction(docs, "doc_id", 0.9, 42).filter("split = 'train'").count()
    assert f == 895


def test_split_partition_invariant(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    a = {r.doc_id: r.split for r in corpus.split_exact(docs.repartition(1), "doc_id").collect()}
    b = {r.doc_id: r.split for r in corpus.split_exact(docs.repartition(17), "doc_id").collect()}
    assert a == b


def test_page_concat(spark):
    pages = spark.createDataFrame([(0, 1, "in forecasting"), (0, 0, "end of 2021.")],
                                  "doc_id long, page_no int, text string")
    assert corpus.concat_pages(pages).first().text == "end of 2021.in forecasting"
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    out = corpus.concat_pages(conv, "conv_id", "turn", "text")
    assert out.count() == 100
    assert out.agg(F.sum(F.length("text"))).first()[0] == 283228


def test_skip(spark):
    todo = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    done = spark.createDataFrame([(2,), (2,)], "doc_id long")
    assert [r.doc_id for r in corpus.skip_done(todo, done).orderBy("doc_id").collect()] == [1, 3]
    assert tuple(corpus.skip_counts(todo, done).first()) == (2, 1)


def test_collate_golden(spark):
    df = spark.createDataFrame([(0, 0, [5, 6, 7]), (0, 1, [8])], "batch_id long, slot int, input_ids array<int>")
    r = batching.collate(df).filter("slot = 1").first()
    assert (r.input_ids, r.labels, r.attention_mask) == ([8, 0, 0], [8, -100, -100], [1, 0, 0])


def test_shards_and_steps(spark):
    docs = spark.range(1000).withColumnRenamed("id", "doc_id")
    s = batching.shard(docs, "doc_id", 3)
    counts = {r.shard: r["count"] for r in s.groupBy("shard").count().collect()}
    assert counts == {0: 334, 1: 334, 2: 334}
    assert s.select("doc_id").distinct().count() == 1000
    b = spark.range(5).withColumnRenamed("id", "batch_id")
    plan = batching.step_plan(b, accumulation=2).orderBy("batch_id").collect()
    assert [r.batch_id for r in plan if r.update_after] == [0, 2, 4]


def test_batches_drop_last(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    out = batching.assign_batches(df, [F.col("k")], 4, drop_last=True)
    assert out.count() == 8
    keep = batching.assign_batches(df, [F.col("k")], 4, drop_last=False)
    assert keep.agg(F.max("batch_id")).first()[0] == 2


def test_perplexity_macro_average(spark):
    import math
    losses = spark.createDataFrame([(0.0,), (math.log(3),)], "loss double")
    r = ppl.macro_perplexity(ppl.chunk_perplexity(losses)).first()
    assert abs(r.perplexity - 2.0) < 1e-12
    empty = spark.createDataFrame([], "loss double")
    assert ppl.macro_perplexity(ppl.chunk_perplexity(empty)).first().perplexity == float("inf")


def test_unigram_perplexity_on_documents(spark):
    from tessera.plans.registry import q_perplexity_unigram
    r = q_perplexity_unigram(spark, SF).first()
    assert r.n_chunks == 108 and abs(r.perplexity - 16922.96) < 0.01


def test_streaming_ingest_is_incremental(spark):
    from tessera.streaming.ingest import ingest_texts
    root = scratch_path(spark, "stream-test")
    src = os.path.join(root, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("first")
    args = (src, f"{root}/out", f"{root}/ckpt")
    assert ingest_texts(spark, *args) == 1
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("second")
    assert ingest_texts(spark, *args) == 2
    assert ingest_texts(spark, *args) == 2
