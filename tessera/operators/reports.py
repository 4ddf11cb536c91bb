"""Answers, the k x rerank benchmark grid and the model comparison.

Everything is one question *table*, not a loop over questions: the search
runs once at the largest k, smaller k are prefixes of the same hits, the
rerank is a window over each (question, k) group, and one generation pass
serves all grid cells.  Retrieval time is the search stage's wall time spread
over its questions (a batch engine has no per-row retrieval clock).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import words
from tessera.operators import prompts
from tessera.operators.generate import generate
from tessera.operators.rerank import OVERLAP_WEIGHT, term_overlap

# The benchmark grid.
K_VALUES = (3, 5, 7)
RERANK_VALUES = (False, True)


def timed_hits(hits: DataFrame, n_questions: int) -> tuple[DataFrame, float]:
    """Materialise the (small: questions x k) hit table once and return it
    with the search seconds per question.  The checkpoint lives in the shared
    checkpoint folder, so a lost executor does not force a new search."""
    t0 = time.perf_counter()
    done = hits.checkpoint(eager=True)
    return done, (time.perf_counter() - t0) / max(n_questions, 1)


def per_token(total, n_words):
    """``total / words`` with 0 when the answer has no words."""
    return F.coalesce(F.try_divide(total, n_words.cast("double")), F.lit(0.0))


def grid_contexts(hits: DataFrame, k_values=K_VALUES, rerank_values=RERANK_VALUES) -> DataFrame:
    """``(q_id, question, k, rerank, context)`` for every grid cell from one
    search at ``max(k)``.  Group sizes are bounded by max(k)."""
    scored = hits.withColumn("overlap", term_overlap(F.col("question"), F.col("text"))) \
        .withColumn("score", F.col("similarity") * (1 + OVERLAP_WEIGHT * F.col("overlap")))
    cells = (scored.withColumn("k", F.explode(F.array(*[F.lit(k) for k in k_values])))
             .filter(F.col("rank") <= F.col("k"))
             .withColumn("rerank", F.explode(F.array(*[F.lit(r) for r in rerank_values]))))
    w = Window.partitionBy("q_id", "k", "rerank").orderBy(
        F.when(F.col("rerank"), -F.round("score", 9)).otherwise(F.lit(0.0)), F.col("rank"))
    cells = cells.withColumn("pos", F.row_number().over(w))
    ctx = prompts.contexts(cells.withColumn("key", F.struct("q_id", "k", "rerank")),
                           key="key", rank_col="pos")
    return ctx.select("key.q_id", "key.k", "key.rerank", "context")


def answer_table(prompts_df: DataFrame, make_generator, retrieval_time: float = 0.0,
                 **params) -> DataFrame:
    """R5 -> R6 -> timings over a table with a ``prompt`` column."""
    g = generate(prompts_df, make_generator, **params)
    ans = prompts.strip_echo(F.col("output"), F.col("prompt"))
    return (g.withColumn("answer", ans)
            .withColumn("retrieval_time", F.lit(float(retrieval_time)))
            .withColumn("total_time", F.col("retrieval_time") + F.col("generation_time"))
            .withColumn("n_words", F.size(words("answer")))
            .withColumn("time_per_token", per_token(F.col("total_time"), F.col("n_words"))))


def benchmark_grid(questions: DataFrame, hits_at_max_k: DataFrame, make_generator,
                   retrieval_time: float = 0.0, k_values=K_VALUES, **params) -> DataFrame:
    """``(q_id, question, k, rerank, answer, total_time, retrieval_time,
    generation_time, time_per_token, n_words)``."""
    ctx = grid_contexts(hits_at_max_k, k_values)
    cells = (questions.select("q_id", "question")
             .withColumn("k", F.explode(F.array(*[F.lit(k) for k in k_values])))
             .withColumn("rerank", F.explode(F.array(*[F.lit(r) for r in RERANK_VALUES])))
             .join(ctx, ["q_id", "k", "rerank"], "left"))
    cells = cells.withColumn("prompt", prompts.rag_prompt("question", "context"))
    return answer_table(cells, make_generator, retrieval_time, **params)


def compare_models(rag: DataFrame, ft: DataFrame) -> DataFrame:
    """``rag (question, answer, time)`` vs ``ft (question, answer, time)``
    -> the 8-column comparison report, one row per question asked: tables that
    carry ``q_id`` are joined on it, so a repeated question stays one row each;
    without it questions must be distinct."""
    by_id = "q_id" in rag.columns and "q_id" in ft.columns
    key = ["q_id"] if by_id else ["question"]
    r = rag.select(*key, *(["question"] if by_id else []), F.col("answer").alias("rag_answer"), F.col("time").alias("rag_time"))
    f = ft.select(*key, F.col("answer").alias("ft_answer"), F.col("time").alias("ft_time"))
    j = r.join(f, key)
    return j.select(
        "question", "rag_answer", "ft_answer", "rag_time", "ft_time",
        (F.col("rag_time") - F.col("ft_time")).alias("time_difference"),
        per_token(F.col("rag_time"), F.size(words("rag_answer"))).alias("rag_time_per_token"),
        per_token(F.col("ft_time"), F.size(words("ft_answer"))).alias("ft_time_per_token"))
