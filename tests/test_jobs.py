"""End-to-end jobs on small inputs (files written to the checkpoint folder)."""

import os

from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from tessera.operators.generate import EchoExtract
from tessera.plans import jobs
from tessera.session import scratch_path


def _questions(spark):
    return spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(
        F.col("item_id").alias("q_id"), F.col("text").alias("question"))


def test_store_search_answer_benchmark_compare(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    root = scratch_path(spark, "job-store")
    summary = jobs.build_store(docs, root, "Flat", chunker="recursive").first()
    assert summary.n_chunks > 0 and summary.index_type == "Flat"
    q = _questions(spark)
    hits = jobs.search(spark, root, q, 5, rerank=True)
    assert hits.count() == 5 * q.count()
    ans = jobs.answer(spark, root, q, lambda: EchoExtract(8), show_retrieved=True)
    r = ans.first()
    assert len(r.retrieved_chunks) == 5 and r.performance.total_time >= r.performance.generation_time
    grid = jobs.benchmark(spark, root, q, lambda: EchoExtract(8))
    assert grid.count() == 6 * q.count()
    assert grid.columns == ["question", "k", "rerank", "answer", "total_time", "retrieval_time",
                            "generation_time", "time_per_token"]
    cmp = jobs.compare(spark, root, q, lambda: EchoExtract(8), lambda: EchoExtract(8))
    assert len(cmp.columns) == 8 and cmp.count() >= q.count()


def test_ivf_and_hnsw_stores(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for kind in ("IVF", "HNSW", "PQ"):
        root = scratch_path(spark, f"job-{kind}")
        s = jobs.build_store(docs, root, kind, chunker="words", chunk_words=32).first()
        assert s.index_type == kind
        hits = jobs.search(spark, root, _questions(spark), 3)
        assert hits.count() > 0


def test_build_corpus_with_binary_extractor(spark):
    root = scratch_path(spark, "pdfs")
    os.makedirs(root)
    for i in range(5):
        with open(os.path.join(root, f"doc{i}.pdf"), "wb") as f:
            f.write(f"page one of {i}\fpage two".encode())
    with open(os.path.join(root, "broken.pdf"), "wb") as f:
        f.write(b"\xff\xfe")

    def make_extractor():
        return lambda data: data.decode("utf-8").split("\f")

    done = spark.createDataFrame([("doc0",)], "stem string")
    out = jobs.build_corpus(spark, root, scratch_path(spark, "corpus"), done=done,
                            binary_extractor=make_extractor)
    counts = {r.split: r["count"] for r in out.collect()}
    assert sum(counts.values()) == 4


def test_token_windows_with_plugin_tokenizer(spark):
    class Tok:
        pad_token_id = None
        eos_token_id = 2

        def encode(self, text, add_special_tokens=True):
            ids = [3 + (ord(c) % 50) for c in text]
            return ([1] + ids) if add_special_tokens else ids

    docs = spark.createDataFrame([(0, "x" * 35)], "doc_id long, text string")
    w = jobs.token_windows(docs, None, 16, 4, make_tokenizer=Tok).orderBy("chunk_id").collect()
    assert w[0].input_ids[0] == 1 and all(len(r.input_ids) == 16 for r in w)
    assert w[-1].input_ids[-1] == 2          # padded with the eos id


def test_export_text_files_and_rescan(spark):
    from tessera.sources import files, sinks
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("stem"), "text")
    out = scratch_path(spark, "export")
    sinks.export_text_files(docs, out)
    sinks.export_text_files(docs, out)                   # a re-run replaces, never duplicates
    back = files.read_texts(spark, out, ".txt")
    assert back.count() == docs.count() == len(os.listdir(out))
    joined = back.withColumn("stem", F.regexp_extract("path", r"([^/]*)\.txt$", 1)).join(
        docs.withColumnRenamed("text", "orig"), "stem")
    assert joined.filter(F.col("text") != F.col("orig")).count() == 0


def test_add_vectors(spark):
    from tessera.operators import store as vstore
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    root = scratch_path(spark, "add")
    n = vstore.build_store(docs, root, "Flat", chunker="words", chunk_words=200).first().n_chunks
    extra = spark.createDataFrame([(10**12, [0.0] * 64)], "row_id long, embedding array<double>")
    assert vstore.add_vectors(root, extra) == n + 1


def test_extract_and_prompt_file(spark):
    docs = spark.createDataFrame([(1, "Droughts damage crops.")], "doc_id long, text string")
    out = jobs.extract(docs, lambda: EchoExtract(3, marker="Text: ")).first()
    assert out.prompt.endswith("\n\nText: Droughts damage crops.") and out.answer == "Droughts damage crops."
    path = scratch_path(spark, "prompt")
    os.makedirs(path)
    with open(f"{path}/prompt.txt", "w") as f:
        f.write("Question: why?\n\nAnswer:")
    r = jobs.run_prompt_file(spark, f"{path}/prompt.txt", lambda: EchoExtract(2)).first()
    assert r.answer == "Question: why?"


def test_named_batch_is_added_once_after_a_broken_attempt(spark, monkeypatch):
    import pytest
    from tessera.operators import store as vstore
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    old, new = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    options = {"chunker": "words", "chunk_words": 100}
    for kind in ("Flat", "PQ"):
        root = scratch_path(spark, f"named-{kind}")
        first = vstore.build_store(old, root, kind, nlist=4, nbits=4, **options).first().n_chunks
        chunks = vstore.chunk_documents(new, **options).checkpoint(eager=True)
        vectors = vstore.embedded(chunks, "text")
        total = first + chunks.count()

        def tables():
            names = ("vectors", "chunks") + (("codes",) if kind == "PQ" else ())
            return [spark.read.parquet(f"{root}/{n}").select("row_id").distinct().count() for n in names] + \
                [spark.read.parquet(f"{root}/{n}").count() for n in names]

        with pytest.raises(Exception):  # vectors are written, chunks are not
            vstore.add_vectors(root, vectors, chunks.drop("text"), batch_id="b1")
        with monkeypatch.context() as m:  # all tables are written, the manifest is not
            m.setattr(vstore, "_write_manifest", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                vstore.add_vectors(root, vectors, chunks, batch_id="b1")
        assert vstore.load_store(spark, root).manifest["n_vectors"] == first
        for _ in range(2):
            assert vstore.add_vectors(root, vectors, chunks, batch_id="b1") == total
            assert set(tables()) == {total}
        assert vstore.load_store(spark, root).manifest["n_vectors"] == total
