"""Counts and look-ups of words: what is exchanged follows the different words."""

from collections import Counter

from tessera.functions import counting
from tessera.operators import perplexity, vocab


def texts(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


ROWS = ["a b a\x1cc", None, "", " b　b\n", "d é a", "a b a\x1cc"]


def test_counts_of_words_and_pairs(spark, monkeypatch):
    words = [(t or "").split() for t in ROWS]
    for most in (1, 3, 1 << 18):
        monkeypatch.setattr(counting, "COUNTED_ITEMS", most)
        one = counting.item_counts(texts(spark, ROWS).select("text"), lambda w: w, ("token",))
        assert {r.token: r.n for r in one.collect()} == Counter(w for ws in words for w in ws)
        two = counting.item_counts(texts(spark, ROWS).select("text"), perplexity._pairs, ("v", "w"))
        assert {(r.v, r.w): r.n for r in two.collect()} == Counter(
            p for ws in words for p in zip(ws, ws[1:]))


def test_a_words_row_is_made_for_different_words_only(spark):
    docs = texts(spark, ["x y " * 500] * 20).coalesce(2)
    counts = counting.item_counts(docs.select("text"), lambda w: w, ("token",))
    assert "Generate" not in plan(counts) and "MapInArrow" in plan(counts)
    losses = perplexity.bigram_losses(docs, docs, key=("doc_id",))
    assert "Generate" not in plan(losses)
    assert {r.n_tokens for r in losses.collect()} == {1000}


def test_rare_words_are_joined_once_a_slice(spark):
    docs = texts(spark, [f"a r1 r2 r3 a r{i % 4}" for i in range(400)] + [None, ""]).coalesce(2)
    table = spark.createDataFrame([("a", 1), ("r1", 2), ("r2", 3), ("r3", 4)], "token string, id int")
    coded = vocab._look_up(docs, table.filter("id < 2"), "text", "doc_id", None, keep_cold=True).collect()
    assert sum(len(r["_cold"]) for r in coded) == 4 * len(coded) <= 8  # 400 rows with 4 each
    ids = {f"r{i}": i + 1 for i in (1, 2, 3)} | {"a": 1}
    for unk in (None, 0):
        got = dict(vocab.encode(docs, table, unk_id=unk, max_broadcast_bytes=20).collect())
        for doc_id, text in docs.collect():
            want = [ids.get(w, unk) for w in (text or "").split()]
            assert got[doc_id] == [x for x in want if x is not None]
    assert vocab.encode(docs.limit(0), table, max_broadcast_bytes=20).count() == 0
