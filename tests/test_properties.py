"""Property tests on generated inputs; each
property runs one Spark job over all generated examples."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions.text import py_strip, words
from tessera.operators import splitter

WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 " + "".join(
    chr(c) for c in range(0x2000, 0x200B)) + "    　"
ALPHABET = st.sampled_from(list(WS) + list("ab€é𝔸-.,"))
TEXTS = st.lists(st.text(ALPHABET, max_size=30), min_size=1, max_size=40)


def test_whitespace_set_is_pythons():
    assert sorted(c for c in map(chr, range(0x3001)) if c.isspace()) == sorted(WS)


@settings(max_examples=5, deadline=None)
@given(TEXTS)
def test_words_and_strip_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", words("t").alias("w"), py_strip(F.col("t")).alias("s")).collect()
    for r in rows:
        assert r.w == texts[r.i].split()
        assert r.s == texts[r.i].strip()


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(list("ab \n")), max_size=300),
       st.integers(min_value=2, max_value=40), st.integers(min_value=0, max_value=20))
def test_splitter_invariants(text, size, overlap):
    overlap = min(overlap, size - 1)
    chunks = splitter.split_text(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    assert all(c == c.strip() for c in chunks)
    if overlap == 0:
        # no overlap: the chunks cover the text's non-whitespace characters in order
        assert "".join("".join(c.split()) for c in chunks) == "".join(text.split())
