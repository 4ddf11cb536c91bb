"""C1-C3 goldens (FIXTURES section 4) and properties."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import chunking, splitter


def _windows(spark, ids, max_length, stride, min_tokens=10, pad=None):
    df = spark.createDataFrame([(0, ids)], "doc_id long, input_ids array<int>")
    out = chunking.token_windows(df, "input_ids", max_length, stride, min_tokens, pad)
    return [r.input_ids for r in out.orderBy("chunk_id").collect()]


def test_token_windows_trailing_window_kept(spark):
    assert _windows(spark, list(range(1, 9)), 5, 2, 0) == [[1, 2, 3, 4, 5], [4, 5, 6, 7, 8], [7, 8]]


def test_token_windows_edges(spark):
    w = _windows(spark, list(range(1730)), 1730, 512)
    assert [len(x) for x in w] == [1730, 512]
    assert _windows(spark, list(range(9)), 1730, 512) == []
    assert [len(x) for x in _windows(spark, list(range(10)), 1730, 512)] == [10]
    assert [len(x) for x in _windows(spark, list(range(1227)), 1730, 512)] == [1227]
    assert _windows(spark, [], 1730, 512) == []
    with pytest.raises(ValueError):
        chunking.window_array("x", 5, 5)


def test_token_windows_padding_and_mask(spark):
    df = spark.createDataFrame([(0, [7] * 10)], "doc_id long, input_ids array<int>")
    out = chunking.default_attention_mask(chunking.token_windows(df, "input_ids", 12, 2, 10, 0))
    r = out.first()
    assert r.input_ids == [7] * 10 + [0, 0] and r.labels == r.input_ids
    assert r.attention_mask == [1] * 12


def test_word_chunks(spark):
    df = spark.createDataFrame([(0, "a b  c\nd e")], "doc_id long, text string")
    got = [r.text for r in chunking.word_chunks(df, 2).orderBy("chunk_id").collect()]
    assert got == ["a b", "c d", "e"]


@pytest.mark.parametrize("text,size,overlap,want", [
    ("aaa bbb ccc ddd", 10, 3, ["aaa bbb", "ccc ddd"]),
    ("aaa bbb ccc ddd", 10, 4, ["aaa bbb", "bbb ccc", "ccc ddd"]),
    ("p1\n\np2 is longer text\nline", 10, 0, ["p1", "p2 is", "longer", "text", "line"]),
    ("abcdefghijklmnop", 5, 2, ["abcde", "defgh", "ghijk", "jklmn", "mnop"]),
    ("", 10, 2, []),
    (" \n ", 10, 2, []),
])
def test_splitter_goldens(text, size, overlap, want):
    assert splitter.split_text(text, size, overlap) == want


def test_splitter_in_spark_matches_python(spark):
    texts = ["aaa bbb ccc ddd", "p1\r\n\r\np2 is longer text\rline", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = splitter.recursive_chunks(df, 10, 3).orderBy("doc_id", "chunk_id").collect()
    want = [(i, c) for i, t in enumerate(texts)
            for c in splitter.split_text(t.replace("\r\n", "\n").replace("\r", "\n"), 10, 3)]
    assert [(r.doc_id, r.text) for r in got] == want


# a directory of train/eval text files to check the splitter's chunk count on
CORPUS = os.environ.get("TESSERA_CORPUS_DIR", "")


@pytest.mark.skipif(not os.path.isdir(CORPUS), reason="set TESSERA_CORPUS_DIR to run")
def test_splitter_on_corpus():
    n, longest = 0, 0
    for f in sorted(glob.glob(f"{CORPUS}/*/*.txt")):
        text = open(f, encoding="utf-8").read()
        chunks = splitter.split_text(text, 400, 50)
        n += len(chunks)
        longest = max([longest] + [len(c) for c in chunks])
    assert (n, longest) == (2702, 400)


def test_word_chunk_property(spark):
    """Chunks joined by a space give back the words, in order."""
    from sf_paths import SF
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(50)
    ch = chunking.word_chunks(docs, 37)
    got = (ch.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list(
        F.struct("chunk_id", "text"))).getField("text"), " ").alias("t")))
    rows = {r.doc_id: r.t for r in got.collect()}
    for r in docs.collect():
        assert rows.get(r.doc_id, "") == " ".join(r.text.split())


def _chunk_rules(spark, folder, rows):
    from tessera.plans.registry import q_recursive_chunk_rules
    spark.createDataFrame(rows, "doc_id long, text string").write.mode("overwrite").parquet(
        f"{folder}/documents.parquet")
    got = q_recursive_chunk_rules(spark, str(folder)).collect()
    return sorted(((r.doc_id, r.all_short, r.all_contained, r.in_order, r.words_kept) for r in got), key=str)


def test_chunk_rules_hold_on_every_document(spark, tmp_path):
    prose = " ".join(f"word{i}" for i in range(300))
    rows = [(1, prose), (1, prose), (1, "other text of the same id"), (None, "no id"), (2, "a\r\nb\rc"),
            (3, "x" * 399 + " " + "y" * 398 + "\n\n" + "z" * 1000), (4, "same " * 400), (5, "  "), (6, None),
            (7, "\t".join(f"{i}" * 60 for i in range(100, 120))), (8, " " * 380 + "x " + "v" * 397)]
    want = [(d, True, True, True, True) for d, text in rows if text and text.strip()]
    assert _chunk_rules(spark, tmp_path, rows) == sorted(want, key=str)


@pytest.mark.parametrize("fault,rule", [("order", 3), ("long", 4), ("none", 4)])
def test_chunk_rules_find_faults(spark, monkeypatch, tmp_path, fault, rule):
    plain = splitter.recursive_chunks

    def faulty(*args, **kwargs):
        ch = plain(*args, **kwargs)
        if fault == "order":
            return ch.withColumn("chunk_id", -F.col("chunk_id"))
        return ch.filter(~F.col("text").contains("L" * 380)) if fault == "long" else ch.filter("false")

    text = " ".join(f"word{i}" for i in range(200)) + "\n\n" + "L" * 380
    assert _chunk_rules(spark, tmp_path, [(1, text)]) == [(1, True, True, True, True)]
    monkeypatch.setattr(splitter, "recursive_chunks", faulty)
    got = _chunk_rules(spark, tmp_path, [(1, text)])
    assert len(got) == 1 and [i for i, ok in enumerate(got[0]) if ok is False] == [rule]
