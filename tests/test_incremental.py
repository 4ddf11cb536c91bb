"""Finished work stays: corpus runs, store growth, given masks, small shards."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from tessera.operators import batching, perplexity, reports, vocab
from tessera.operators import store as vstore
from tessera.operators.generate import DigestExtract, generation_params
from tessera.plans import jobs
from tessera.session import scratch_path
from tessera.sources import files, sinks
from tessera.streaming import ingest


def _write(folder, names):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with open(f"{folder}/{n}.txt", "w") as f:
            f.write(f"text of {n}")


def test_second_run_keeps_the_first(spark):
    root = scratch_path(spark, "inc")
    _write(f"{root}/in", ["a", "b", "c"])
    assert jobs.run_corpus(spark, f"{root}/in", f"{root}/out").first()[:] == (3, 0, 0)
    _write(f"{root}/in", ["d"])
    assert jobs.run_corpus(spark, f"{root}/in", f"{root}/out").first()[:] == (1, 3, 0)
    assert jobs.run_corpus(spark, f"{root}/in", f"{root}/out").first()[:] == (0, 4, 0)
    out = spark.read.parquet(f"{root}/out")
    assert sorted(r.stem for r in out.collect()) == ["a", "b", "c", "d"]


def test_broken_and_empty_binary_files_are_counted(spark):
    root = scratch_path(spark, "bin")
    os.makedirs(f"{root}/in")
    for name, data in (("ok", b"one\ftwo"), ("none", b"%"), ("broken", b"\xff\xfe")):
        with open(f"{root}/in/{name}.pdf", "wb") as f:
            f.write(data)

    def make():
        return lambda data: [] if data == b"%" else data.decode("utf-8").split("\f")

    pages = files.extract_pages(files.read_binary(spark, f"{root}/in"), make).collect()
    assert sum(p.error is not None for p in pages) == 1 and len(pages) == 4
    got = jobs.run_corpus(spark, f"{root}/in", f"{root}/out", binary_extractor=make).first()
    assert got[:] == (2, 0, 1)
    texts = {r.stem: r.text for r in spark.read.parquet(f"{root}/out").collect()}
    assert texts == {"ok": "onetwo", "none": ""}
    assert jobs.run_corpus(spark, f"{root}/in", f"{root}/out", binary_extractor=make).first()[:] == (0, 2, 1)


@pytest.mark.parametrize("kind", ["Flat", "IVF", "PQ", "HNSW"])
def test_documents_added_to_a_store_are_found(spark, kind):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    root = scratch_path(spark, f"grow-{kind}")
    options = {"chunker": "words", "chunk_words": 32}
    n = vstore.build_store(docs, root, kind, **options).first().n_chunks
    new = spark.createDataFrame([(10**6, "zebra quagga okapi", "zoo")], "doc_id long, text string, source string")
    assert vstore.add_documents(root, new, **options) == n + 1
    st = vstore.load_store(spark, root)
    assert st.manifest["n_vectors"] == n + 1 and st.manifest["dim"] == 64
    q = spark.createDataFrame([(1, "zebra quagga okapi")], "q_id long, question string")
    hit = jobs.search(spark, root, q, 1).first()
    assert hit.doc_id == 10**6 and hit.metadata.source == "zoo"


def test_store_with_a_plug_in_embedder(spark):
    def make():
        return lambda texts: np.array([[t.count(c) for c in "aeiou"] for t in texts], dtype=np.float32)

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20)
    root = scratch_path(spark, "plug")
    assert vstore.build_store(docs, root, make_embedder=make).first().dim == 5
    q = spark.createDataFrame([(1, "a e i o u")], "q_id long, question string")
    assert jobs.search(spark, root, q, 3, make_embedder=make).count() == 3


def test_collate_keeps_a_given_mask(spark):
    df = spark.createDataFrame([(0, [1, 2, 3], [1, 1, 0]), (0, [1, 2, 3, 4], None)],
                               "batch_id long, input_ids array<int>, attention_mask array<int>")
    rows = {len([x for x in r.input_ids if x]): r for r in batching.collate(df).collect()}
    assert rows[3].attention_mask == [1, 1, 0, 0] and rows[4].attention_mask == [1, 1, 1, 1]
    assert rows[3].labels == [1, 2, 3, -100]


@pytest.mark.parametrize("n,world", [(1, 4), (3, 7), (5, 2), (0, 3)])
def test_every_worker_gets_as_many(spark, n, world):
    rows = batching.shard(spark.range(n).withColumnRenamed("id", "doc_id"), "doc_id", world).collect()
    per = [sum(r.shard == w for r in rows) for w in range(world)]
    assert per == [-(-n // world)] * world


def test_item_batches_equal_sorted_batches(spark):
    rng = np.random.default_rng(1)
    counts = [(int(d), int(c)) for d, c in enumerate(rng.integers(0, 6, 40))]
    docs = spark.createDataFrame(counts, "doc_id long, n long")
    items = spark.createDataFrame([(d, i) for d, c in counts for i in range(c)], "doc_id long, chunk_id int")
    for drop in (True, False):
        a = batching.assign_item_batches(docs, items.repartition(5), 4, drop)
        b = batching.assign_batches(items, [F.col("doc_id"), F.col("chunk_id")], 4, drop)
        assert sorted(map(tuple, a.select("doc_id", "chunk_id", "batch_id", "slot").collect())) == sorted(
            map(tuple, b.select("doc_id", "chunk_id", "batch_id", "slot").collect()))
        n = items.count()
        sizes = {r.batch_id: r.n_rows for r in batching.batch_table(spark, n, 4, drop).collect()}
        assert sizes == {r.batch_id: r["count"] for r in a.groupBy("batch_id").count().collect()}


def test_repeated_questions_stay_one_row_each(spark):
    t = spark.createDataFrame([(1, "q", "a", 1.0), (2, "q", "b", 2.0)],
                              "q_id long, question string, answer string, time double")
    assert sorted(r.time_difference for r in reports.compare_models(t, t).collect()) == [0.0, 0.0]


def test_samples_reader_reads_the_window_sink(spark):
    root = scratch_path(spark, "win")
    win = spark.createDataFrame([(1, 0, [1, 2], [1, 2])], "doc_id long, chunk_id int, input_ids array<int>, "
                                                          "labels array<int>")
    sinks.write_windows(win, root)
    back = files.read_samples(spark, root, keys="doc_id long, chunk_id int").first()
    assert (back.doc_id, back.input_ids, back.attention_mask) == (1, [1, 2], None)
    assert files.read_samples(spark, root).first().labels == [1, 2]


def test_encode_forms_agree(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, ""), (-2, None), (-3, " \x1f　 ")], "doc_id long, text string"))
    v = vocab.build_vocabulary(docs)
    for unk in (None, 7):
        some = v.filter("id % 5 <> 0")
        a = {r.doc_id: r.input_ids for r in vocab.encode(docs, some, unk_id=unk).collect()}
        assert a[-1] == a[-2] == a[-3] == []
        for limit in (0, 1500):
            coded = vocab.encode(docs, some, unk_id=unk, max_broadcast_bytes=limit)
            assert a == {r.doc_id: r.input_ids for r in coded.collect()}
    plan = vocab.encode(docs, v)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_hot_tokens_fill_their_bytes(spark):
    v = spark.createDataFrame([(f"w{i:04d}", i) for i in range(1, 9001)], "token string, id int")
    size = 5 + 16
    for limit in (0, size, 100 * size, 4500 * size, 9000 * size - 1):
        cut = vocab._first_cold_id(v, limit)
        hot = v.filter(v.id < cut).count()
        assert hot * size <= limit < (hot + 3) * size + size  # whole spans of 3 ids
    assert vocab._first_cold_id(v, 9000 * size) is None
    assert vocab._first_cold_id(v.limit(0), 0) is None


def test_rows_without_cold_words_are_not_joined(spark):
    v = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "token string, id int")
    docs = spark.createDataFrame([(1, "a a"), (2, "a c b c"), (3, "x")], "doc_id long, text string")
    got = vocab.encode(docs, v, max_broadcast_bytes=34)
    assert sorted(map(tuple, got.collect())) == [(1, [1, 1]), (2, [1, 3, 2, 3]), (3, [])]


def _count_builds(spark, make_udf_frame):
    """Model builds in one partition of many Arrow batches."""
    acc = spark.sparkContext.accumulator(0)
    make_udf_frame(acc).write.format("noop").mode("overwrite").save()
    return acc.value


def test_plug_ins_are_built_once_per_task(spark):
    df = spark.range(20_000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit(0).alias("chunk_id"),
                                                     F.lit("a b").alias("text"))

    def scorer(acc):
        def make():
            acc.add(1)
            return lambda texts: [0.5] * len(texts)
        return perplexity.plugin_losses(df, make)

    def tokenizer(acc):
        class Tok:
            def encode(self, text, add_special_tokens=True):
                return [1]

        def make():
            acc.add(1)
            return Tok()
        return vocab.encode_with(df, make)

    assert _count_builds(spark, scorer) == 1
    assert _count_builds(spark, tokenizer) == 1


def test_scorer_texts_are_cut_to_its_tokens():
    class Scorer:
        max_tokens = 3

        def tokenize(self, text):
            return text.split()

        def detokenize(self, tokens):
            return " ".join(tokens)

    assert perplexity.cut_tokens(Scorer(), "a b c d e") == "a b c"
    assert perplexity.cut_tokens(Scorer(), "a b") == "a b" and perplexity.cut_tokens(len, "a b c d") == "a b c d"


def test_grid_answers_depend_on_k(spark):
    qs = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(
        F.col("item_id").alias("q_id"), F.col("text").alias("question"))
    root = scratch_path(spark, "grid")
    jobs.build_store(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), root, chunker="words")
    hits = jobs.search(spark, root, qs, 7)
    grid = reports.benchmark_grid(qs, hits, DigestExtract).collect()
    for q in {r.q_id for r in grid}:
        for rerank in (False, True):
            answers = [r.answer for r in grid if r.q_id == q and r.rerank == rerank]
            assert len(answers) == 3 and len(set(answers)) == 3


def test_sampling_follows_the_temperature():
    assert generation_params()["do_sample"] is True
    assert generation_params(temperature=0.0)["do_sample"] is False
    assert generation_params(temperature=0.0, do_sample=True)["do_sample"] is True


def test_empty_folder_is_an_empty_pass(spark):
    root = scratch_path(spark, "empty")
    os.makedirs(f"{root}/in")
    assert ingest.ingest_texts(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt") == 0
    _write(f"{root}/in", ["x"])
    assert ingest.ingest_texts(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt") == 1


def test_cli_answer_compare_extract_and_incremental_corpus(spark, capsys):
    from tessera.__main__ import main
    root = scratch_path(spark, "cli2")
    _write(f"{root}/in", ["a", "b"])
    main(["build-corpus", "--input-dir", f"{root}/in", "--output-dir", f"{root}/corpus"])
    with open(f"{root}/done.txt", "w") as f:
        f.write("c\n")
    _write(f"{root}/in", ["c", "d"])
    main(["build-corpus", "--input-dir", f"{root}/in", "--output-dir", f"{root}/corpus", "--done", f"{root}/done.txt"])
    assert sorted(r.stem for r in spark.read.parquet(f"{root}/corpus").collect()) == ["a", "b", "d"]
    main(["build-store", "--data-dir", f"{root}/in", "--output-dir", f"{root}/store"])
    with open(f"{root}/q.txt", "w") as f:
        f.write("text of a\ntext of a\n")
    for cmd in ("answer", "compare"):
        main([cmd, "--store", f"{root}/store", "--questions", f"{root}/q.txt", "--output", f"{root}/{cmd}"])
    assert os.listdir(f"{root}/compare") == ["comparison_results_store_hash.csv"]
    report = spark.read.option("header", True).csv(f"{root}/compare/comparison_results_store_hash.csv")
    assert report.count() == 2
    main(["extract", "--input-dir", f"{root}/in", "--output", f"{root}/extract"])
    with open(f"{root}/p.txt", "w") as f:
        f.write("Question: why?")
    main(["extract", "--prompt-file", f"{root}/p.txt"])
    assert "Question: why?" in capsys.readouterr().out


def _ingested(spark, out):
    return sorted((os.path.basename(r.path), r.text) for r in spark.read.parquet(out).collect())


def test_the_driver_keeps_lists_not_files(spark):
    root = scratch_path(spark, "lists")
    _write(f"{root}/in", [f"a {i}+%" for i in range(25)])
    args = (spark, f"{root}/in", f"{root}/out", f"{root}/ckpt")
    assert ingest.ingest_texts(*args, max_files_per_batch=10) == 25
    _write(f"{root}/in", ["b"])
    for _ in range(2):
        assert ingest.ingest_texts(*args, max_files_per_batch=10) == 26
    # what the stream's source keeps on the driver: 3 lists and 1, not 26 files
    log = spark.read.text(f"{root}/ckpt/sources/0").filter("value LIKE '{%'").distinct()
    assert log.count() == 4
    assert len(_ingested(spark, f"{root}/out")) == len({n for n, _ in _ingested(spark, f"{root}/out")}) == 26


def test_a_pass_that_broke_off_is_taken_up(spark):
    root = scratch_path(spark, "broken")
    _write(f"{root}/in", ["a", "b", "c"])
    args = (spark, f"{root}/in", f"{root}/out", f"{root}/ckpt")

    def fails(stream):
        return stream.select("path", F.when(F.col("text") == "text of b", F.raise_error(F.lit("no"))).otherwise(
            F.col("text")).alias("text"))

    with pytest.raises(Exception):
        ingest.ingest_texts(*args, transform=fails, max_files_per_batch=1)
    _write(f"{root}/in", ["d"])
    assert ingest.ingest_texts(*args, max_files_per_batch=1) == 4
    assert _ingested(spark, f"{root}/out") == [(f"{n}.txt", f"text of {n}") for n in "abcd"]


def test_a_stream_of_text_files_goes_on_by_lists(spark, monkeypatch):
    from tessera.sources import listing
    root = scratch_path(spark, "older")
    _write(f"{root}/in", ["a b+%41", "c"])
    args = (spark, f"{root}/in", f"{root}/out", f"{root}/ckpt")
    with monkeypatch.context() as older:
        older.setattr(listing, "names", lambda *a: None)
        assert ingest.ingest_texts(*args) == 2
    assert ingest.ingest_texts(*args) == 2
    _write(f"{root}/in", ["d"])
    assert ingest.ingest_texts(*args) == 3
    assert [n for n, _ in _ingested(spark, f"{root}/out")] == ["a%20b+%2541.txt", "c.txt", "d.txt"]
