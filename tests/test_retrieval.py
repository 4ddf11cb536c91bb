"""Rerank, contexts, prompts and reports."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import generate, prompts, reports
from tessera.operators.rerank import rerank


def test_rerank_golden(spark):
    hits = spark.createDataFrame(
        [(0, "Sea level rise", 1, 0.80, "forest fire"), (0, "Sea level rise", 2, 0.70, "SEA level rise sea"),
         (0, "Sea level rise", 3, 0.80, "forest fire")],
        "q_id long, question string, rank int, similarity double, text string")
    out = rerank(hits).orderBy("rank").collect()
    assert [r.prev_rank for r in out] == [2, 1, 3]
    assert [r.overlap for r in out] == [3, 0, 0]
    assert [round(r.score, 9) for r in out] == [0.91, 0.8, 0.8]


def test_context_and_prompts(spark):
    hits = spark.createDataFrame([(0, 2, "y"), (0, 1, "x")], "q_id long, rank int, text string")
    ctx = prompts.contexts(hits).first().context
    assert ctx == "[Document 1]: x\n\n[Document 2]: y"
    df = spark.createDataFrame([("Q?", None)], "q string, c string")
    p = df.select(prompts.rag_prompt("q", "c")).first()[0]
    assert p.endswith("Context:\n\n\nQuestion: Q?\n\nAnswer:")
    assert df.select(prompts.plain_prompt("q")).first()[0] == "Question: Q?\n\nAnswer:"


def test_echo_stub_and_report_arithmetic(spark):
    stub = generate.EchoExtract(3)
    assert stub("head Context:\nA b c d") == "head Context:\nA b c d A b c"
    df = spark.createDataFrame([("P Context:\none two three",)], "prompt string")
    out = reports.answer_table(df, lambda: stub).first()
    assert out.answer == "one two three" and out.n_words == 3
    assert out.time_per_token == pytest.approx(out.total_time / 3)
    t = spark.createDataFrame([(6.0, "a b c"), (6.0, "")], "t double, a string")
    from tessera.functions.text import words
    got = [r[0] for r in t.select(reports.per_token(F.col("t"), F.size(words("a")))).collect()]
    assert got == [2.0, 0.0]


def test_grid_has_six_cells_per_question(spark):
    hits = spark.createDataFrame(
        [(q, "w x", r, 1.0 - r / 10, f"w t{r}") for q in range(10) for r in range(1, 8)],
        "q_id long, question string, rank int, similarity double, text string")
    qs = spark.createDataFrame([(q, "w x") for q in range(10)], "q_id long, question string")
    grid = reports.benchmark_grid(qs, hits, lambda: generate.EchoExtract(4))
    assert grid.count() == 60
    r = grid.filter("q_id = 0 AND k = 3 AND NOT rerank").first()
    assert r.answer == "[Document 1]: w t1"


def test_compare_models(spark):
    rag = spark.createDataFrame([("q", "a b", 4.0)], "question string, answer string, time double")
    ft = spark.createDataFrame([("q", "", 1.0)], "question string, answer string, time double")
    r = reports.compare_models(rag, ft).first()
    assert (r.time_difference, r.rag_time_per_token, r.ft_time_per_token) == (3.0, 2.0, 0.0)


def test_batched_generator(spark):
    class Batched:
        calls = 0

        def generate_batch(self, prompts, **params):
            assert len(prompts) <= 4
            return [p + " " + p.upper() for p in prompts]

    df = spark.createDataFrame([(i, f"q{i}") for i in range(10)], "id long, prompt string")
    out = generate.generate(df.coalesce(1), Batched, batch_size=4).orderBy("id").collect()
    assert [r.output for r in out][:2] == ["q0 Q0", "q1 Q1"]
    assert all(r.generation_time >= 0 for r in out)
