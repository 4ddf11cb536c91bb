"""Perplexity of held-out text.

Chunks of ``chunk_words`` words are scored; a chunk's perplexity is
``exp(mean token loss)`` (A3) and the report is the unweighted mean over
chunks (A2), infinity when there is no chunk.

Two built-in scorers are counted from the train split and stay in Spark SQL:
unigrams with add-one smoothing, and interpolated back-off bigrams whose
back-off weighs a word by the number of words it follows.

The scorer may also be a plug-in (``make_scorer() -> f(list[str]) -> list[float]``
mean losses, run as an Arrow batch UDF).  Token occurrences join the
(aggregated) train counts, which AQE broadcasts where their measured size allows
and otherwise splits at hot tokens, then average per chunk and over chunks.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.counting import item_counts, row_item_counts
from tessera.functions.text import lower_words
from tessera.operators.chunking import word_chunks


def unigram_losses(train: DataFrame, eval_chunks: DataFrame, text_col: str = "text",
                   key=("doc_id", "chunk_id")) -> DataFrame:
    """``(key..., n_tokens, loss)`` with p(w) = (c(w) + 1) / (N + V + 1)."""
    from tessera.session import checkpoint_dir
    checkpoint_dir(train.sparkSession)
    tok = train.select(F.explode(lower_words(F.col(text_col))).alias("token"))
    counts = tok.groupBy("token").agg(F.count(F.lit(1)).alias("c")).checkpoint(eager=True)
    stats = counts.agg(F.sum("c").alias("N"), F.count(F.lit(1)).alias("V")).first()
    n_total, v = (stats["N"] or 0), stats["V"]
    denom = float(n_total + v + 1)
    occ = eval_chunks.select(*key, F.explode(lower_words(F.col(text_col))).alias("token"))
    j = occ.join(counts, "token", "left")
    nll = -F.log((F.coalesce(F.col("c"), F.lit(0)) + F.lit(1.0)) / F.lit(denom))
    return j.groupBy(*key).agg(F.count(F.lit(1)).alias("n_tokens"), F.avg(nll).alias("loss"))


def _pairs(words: list):
    """Every two neighbouring words."""
    return zip(words, words[1:])


def _pairs_from_start(words: list):
    """Every word with the word before it, None before the first."""
    return zip([None, *words[:-1]], words)


def bigram_losses(train: DataFrame, eval_chunks: DataFrame, text_col: str = "text",
                  key=("doc_id", "chunk_id"), discount: float = 0.75) -> DataFrame:
    """``(key..., n_tokens, loss)`` under interpolated bigrams with absolute
    discount d.  With c(v,w) the train pairs, c(v) their sum over w, t(v) and
    f(w) the different words after v and before w, and T(x) how many words have
    an f, B the different pairs:

        low(w)   = (max(f(w) - d, 0) + d * T / (T + 1)) / B
        p(w | v) = (max(c(v,w) - d, 0) + d * t(v) * low(w)) / c(v)

    p is low where v never came before a word in train or w opens a chunk, and
    low is 1 where train holds no pair at all.  ``T + 1`` leaves room for one unseen word.  Pairs
    do not cross documents or chunks.  Train pairs are counted where the text lies,
    and so are a chunk's before they are joined: a frequent pair costs one row a chunk."""
    if not 0.0 < discount < 1.0:
        raise ValueError("discount must be between 0 and 1")
    from tessera.session import checkpoint_dir
    checkpoint_dir(train.sparkSession)

    one = F.count(F.lit(1))
    seen = item_counts(train.select(F.lower(F.col(text_col))), _pairs, ("v", "w")).withColumnRenamed(
        "n", "c").checkpoint(eager=True)
    before = seen.groupBy("v").agg(F.sum("c").alias("cv"), one.alias("tv"))
    follows = seen.groupBy("w").agg(one.alias("f")).checkpoint(eager=True)
    total = follows.agg(F.sum("f").alias("B"), one.alias("T")).first()
    b, t = total["B"] or 0, total["T"]
    asked = row_item_counts(eval_chunks.select(*key, F.lower(F.col(text_col)).alias("_text")), "_text",
                            _pairs_from_start, ("v", "w"), "_n")
    j = asked.join(seen, ["v", "w"], "left").join(before, "v", "left").join(follows, "w", "left")
    d = F.lit(float(discount))
    zero = F.lit(0.0)
    low = (F.greatest(F.coalesce("f", F.lit(0)) - d, zero) + d * F.lit(t / (t + 1.0))) / F.lit(float(b)) \
        if b else F.lit(1.0)
    p = F.when(F.col("cv").isNull(), low).otherwise(
        (F.greatest(F.coalesce("c", F.lit(0)) - d, zero) + d * F.col("tv") * low) / F.col("cv"))
    return j.groupBy(*key).agg(F.sum("_n").alias("n_tokens"),
                               (F.sum(-F.log(p) * F.col("_n")) / F.sum("_n")).alias("loss"))


def cut_tokens(model, text):
    """T5 in front of a plug-in: at most ``model.max_tokens`` of its tokens."""
    limit = getattr(model, "max_tokens", None)
    if text is None or not limit or not hasattr(model, "tokenize"):
        return text
    tokens = model.tokenize(text)
    return text if len(tokens) <= limit else model.detokenize(tokens[:limit])


def plugin_losses(eval_chunks: DataFrame, make_scorer: Callable, text_col: str = "text",
                  key=("doc_id", "chunk_id")) -> DataFrame:
    """``(key..., loss)`` from a model scorer (one mean loss per chunk), built
    once per task.  A scorer with a ``tokenize(text) -> list`` and a
    ``max_tokens`` gets its texts cut to that many tokens (T5) if it also has
    ``detokenize(tokens) -> text``."""
    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = make_scorer()
        for texts in batches:
            yield pd.Series(f([cut_tokens(f, t) for t in texts]), dtype="float64")
    return eval_chunks.select(*key, score(F.col(text_col)).alias("loss"))


def eval_chunks(eval_docs: DataFrame, chunk_words: int = 1500, text_col: str = "text") -> DataFrame:
    return word_chunks(eval_docs, chunk_words, text_col, ("doc_id",))


def chunk_perplexity(losses: DataFrame) -> DataFrame:
    """A3: ``exp(loss)`` per chunk."""
    return losses.withColumn("perplexity", F.exp("loss"))


def macro_perplexity(per_chunk: DataFrame) -> DataFrame:
    """A2: ``(n_chunks, perplexity)``; infinity when there is no chunk."""
    return per_chunk.agg(F.count(F.lit(1)).alias("n_chunks"),
                         F.coalesce(F.avg("perplexity"), F.lit(float("inf"))).alias("perplexity"))
