"""Edge cases: empty text, fewer vectors than k, too few vectors for IVF,
zero vectors, unknown tokens."""

import pytest

from tessera.operators import chunking, embed, ivf, knn, retrieval, vocab


def test_empty_and_blank_documents(spark):
    docs = spark.createDataFrame([(0, ""), (1, " \n "), (2, "a b")], "doc_id long, text string")
    assert [r.text for r in chunking.word_chunks(docs, 5).collect()] == ["a b"]
    v = vocab.build_vocabulary(docs)
    enc = {r.doc_id: r.input_ids for r in vocab.encode(docs, v).collect()}
    assert enc[0] == [] and enc[1] == [] and len(enc[2]) == 2
    win = chunking.token_windows(vocab.encode(docs, v), "input_ids", 4, 1, 1)
    assert win.count() == 1
    emb = docs.select("doc_id", embed.hash_embedding("text").alias("e")).collect()
    assert emb[0].e == [0.0] * 64


def test_fewer_vectors_than_k(spark):
    vec = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(3)],
                                "row_id long, embedding array<double>")
    q = spark.createDataFrame([(0, [0.0, 0.0])], "q_id long, embedding array<double>")
    hits = knn.knn_search(vec, q, 5).orderBy("rank").collect()
    assert [h.row_id for h in hits] == [0, 1, 2] and [h.rank for h in hits] == [1, 2, 3]


def test_empty_query_table(spark):
    vec = spark.createDataFrame([(1, [1.0])], "row_id long, embedding array<double>")
    q = spark.createDataFrame([], "q_id long, embedding array<double>")
    assert knn.knn_search(vec, q, 5).count() == 0


def test_ivf_needs_ten_vectors(spark):
    vec = spark.createDataFrame([(i, [float(i)]) for i in range(9)], "row_id long, embedding array<double>")
    with pytest.raises(ValueError):
        ivf.train_centroids(vec)


def test_dimension_mismatch_is_an_error(spark):
    vec = spark.createDataFrame([(1, [1.0, 2.0])], "row_id long, embedding array<double>")
    q = spark.createDataFrame([(0, [1.0, 2.0, 3.0])], "q_id long, embedding array<double>")
    with pytest.raises(Exception):
        knn.knn_search(vec, q, 1).collect()


def test_unknown_tokens(spark):
    train = spark.createDataFrame([(0, "a b")], "doc_id long, text string")
    other = spark.createDataFrame([(1, "a z b")], "doc_id long, text string")
    v = vocab.build_vocabulary(train)
    assert vocab.encode(other, v).first().input_ids == [1, 2]
    assert vocab.encode(other, v, unk_id=99).first().input_ids == [1, 99, 2]


def test_missing_source_becomes_unknown(spark):
    docs = spark.createDataFrame([(0, "x y", None)], "doc_id long, text string, source string")
    ch = retrieval.chunk_table(docs, 1).orderBy("chunk_id").collect()
    assert [c.metadata.source for c in ch] == ["unknown", "unknown"]
    assert [c.metadata.chunk_id for c in ch] == [0, 1]
    assert ch[1].row_id == (0 << 20) + 1


def test_row_id_layout_is_checked(spark):
    bad = spark.createDataFrame([(1 << 50, "x")], "doc_id long, text string")
    with pytest.raises(Exception):
        retrieval.chunk_table(bad, 1).collect()


def test_ivf_forms_with_no_queries(spark):
    vec = spark.createDataFrame([(i, [float(i), float(i % 3)]) for i in range(30)],
                                "row_id long, embedding array<double>")
    cents = ivf.train_centroids(vec, nlist=3)
    filed = ivf.assign_cells(vec, cents)
    q = spark.createDataFrame([], "q_id long, embedding array<double>")
    assert ivf.search_ivf(filed, cents, q, 3, 2).count() == 0
    assert ivf.search_ivf_grouped(filed, cents, q, 3, 2).count() == 0


@pytest.mark.parametrize("limit", [0, 17, 40, vocab.MAX_BROADCAST_BYTES])
def test_encoding_keeps_repeated_and_null_ids_apart(spark, limit):
    rows = [(1, "a b"), (1, "c a a"), (None, "b c"), (None, ""), (2, None), (1, "a b"), (3, "b zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ids = {"a": 1, "b": 2, "c": 3}
    v = spark.createDataFrame(list(ids.items()), "token string, id int")
    for unk in (None, 9):
        got = vocab.encode(docs, v, unk_id=unk, max_broadcast_bytes=limit).collect()
        want = [(i, [ids.get(w, unk) for w in (t or "").split() if unk or w in ids]) for i, t in rows]
        assert sorted(map(repr, ((r.doc_id, r.input_ids) for r in got))) == sorted(map(repr, want))
