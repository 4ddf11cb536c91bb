"""Words are split and hashed as Python and the bucket expression do, at less cost."""

import re

from pyspark.sql import functions as F

from tessera.functions.text import PY_WHITESPACE, words
from tessera.operators import embed

ODD = [None, "", " \n ", "One\x1ctwo　THREE", "ÉtÉ 中文 İx", "w" * 70_000,
       "a b c᠎d​e f", " ".join(f"w{i}" for i in range(3000))]


def test_every_white_space_of_python_splits_and_no_other_character(spark):
    codes = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000] + [0xFEFF, 0x1F600]
    df = spark.createDataFrame([(c, f"a{chr(c)}b") for c in codes], "c int, t string")
    got = {r.c: r.w for r in df.select("c", words("t").alias("w")).collect()}
    assert got == {c: f"a{chr(c)}b".split() for c in codes}


def test_a_letter_is_not_asked_for_every_range():
    # ranges stand behind one that holds them all; Latin-1 is single characters
    latin, behind = re.fullmatch(r"\[(.*?)\[\\u1680-\\u3000&&\[(.*)\]\]\]", PY_WHITESPACE).groups()
    assert "-" not in latin and behind


def test_vectors_count_the_buckets_of_the_expression(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD * 5)], "id int, t string").coalesce(1)
    for dim in (64, 7, 100_000 // 64):
        got = df.select("t", embed.word_buckets("t", dim).alias("b"), embed.hash_embedding("t", dim).alias("e"),
                        embed.chunk_hash_embeddings("t", 1 << 20, dim).alias("c")).collect()
        for r in got:
            counts = [0.0] * dim
            for b in r.b or []:
                counts[b] += 1
            norm = sum(x * x for x in counts) ** 0.5
            assert r.e == [x / norm if norm else 0.0 for x in counts]
            assert r.c == ([r.e] if r.b else [])


def test_no_number_is_parsed_word_by_word(spark):
    plan = spark.range(1).select(embed.hash_embedding(F.col("id").cast("string")).alias("e")) \
        ._jdf.queryExecution().toString()
    assert "md5(" in plan and "conv(" not in plan
