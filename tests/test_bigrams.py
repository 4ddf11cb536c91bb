"""Back-off bigrams against a plain count."""

import math
from collections import Counter

import pytest

from tessera.operators import perplexity as ppl

TRAIN = ["the cat sat on the mat", "the dog sat", "A cat sat", "", None, "one"]
EVAL = [(1, 0, "the cat ran"), (1, 1, "dog dog"), (2, 0, "the the the unseen words"), (3, 0, ""),
        (None, 0, "sat on sat on sat on")]


def _model(d=0.75):
    pairs = Counter()
    for text in TRAIN:
        ws = (text or "").lower().split()
        pairs.update(zip(ws, ws[1:]))
    cv, tv, f = Counter(), Counter(), Counter()
    for (v, w), n in pairs.items():
        cv[v] += n
        tv[v] += 1
        f[w] += 1
    b, t = len(pairs), len(f)

    def p(v, w):
        low = (max(f[w] - d, 0) + d * t / (t + 1)) / b
        return low if not cv[v] else (max(pairs[v, w] - d, 0) + d * tv[v] * low) / cv[v]
    return p, set(f), set(cv)


def test_losses_equal_a_plain_model(spark):
    train = spark.createDataFrame([(t,) for t in TRAIN], "text string")
    chunks = spark.createDataFrame(EVAL, "doc_id long, chunk_id int, text string")
    got = {(r.doc_id, r.chunk_id): (r.n_tokens, r.loss)
           for r in ppl.bigram_losses(train, chunks).collect()}
    p, _, _ = _model()
    want = {}
    for doc, chunk, text in EVAL:
        ws = text.split()
        if ws:
            want[doc, chunk] = (len(ws), sum(-math.log(p(v, w)) for v, w in zip([None] + ws, ws)) / len(ws))
    assert got.keys() == want.keys()
    for k, (n, loss) in got.items():
        assert n == want[k][0] and loss == pytest.approx(want[k][1], abs=1e-12)


def test_probabilities_add_up_to_one():
    p, words, histories = _model()
    for v in histories | {None}:  # one word that train does not know
        assert sum(p(v, w) for w in words | {"<unseen>"}) == pytest.approx(1.0)


def test_train_without_pairs(spark):
    train = spark.createDataFrame([("one",), (None,)], "text string")
    chunks = spark.createDataFrame([(1, 0, "a b")], "doc_id long, chunk_id int, text string")
    assert [(r.n_tokens, r.loss) for r in ppl.bigram_losses(train, chunks).collect()] == [(2, 0.0)]
    with pytest.raises(ValueError):
        ppl.bigram_losses(train, chunks, discount=1.0)
