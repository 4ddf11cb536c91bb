"""Scalar helpers against Python's own string semantics."""

from pyspark.sql import functions as F

from tessera.functions.text import file_stem, py_strip, strip_prefix, window_file_name, words


def _one(spark, col, value):
    return spark.createDataFrame([(value,)], "x string").select(col(F.col("x")).alias("y")).first()[0]


def test_words_matches_python_split(spark):
    samples = [" a b\x1cc ", "", " \n ", "a  b\tc　d", "x\x85y z"]
    for s in samples:
        assert _one(spark, words, s) == s.split(), s


def test_py_strip(spark):
    for s in ["  ans \n", " x ", "", "a b"]:
        assert _one(spark, py_strip, s) == s.strip()


def test_stem_like_splitext(spark):
    import os.path
    for p in ["dir/b.c.pdf", "x.txt", "noext", ".hid", "..b", "t.", "a/b/.c.d"]:
        want = os.path.splitext(os.path.basename(p))[0]
        assert _one(spark, file_stem, p) == want, p


def test_window_name_replaces_every_occurrence(spark):
    df = spark.createDataFrame([("a.txt.txt", 3)], "n string, i int")
    got = df.select(window_file_name(F.col("n"), F.col("i"))).first()[0]
    assert got == "a.txt.txt".replace(".txt", "_3.jsonl") == "a_3.jsonl_3.jsonl"


def test_strip_echo(spark):
    df = spark.createDataFrame([("Q  ans \n", "Q"), ("ans ", "Q")], "o string, p string")
    got = [r[0] for r in df.select(strip_prefix(F.col("o"), F.col("p"))).collect()]
    assert got == ["ans", "ans "]
