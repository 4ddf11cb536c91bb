"""Long words, texts full of findings, gzip members, rare languages, bulk of equal ids."""

import gzip
import random
import time

import public_tokenizers as P
import pytest
import tiktoken
from llm_helpers import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import byte_bpe, common, lang_cnn, packing, secret_scan, warc


def test_a_word_of_320000_letters_is_merged_quickly():
    path = P.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = byte_bpe.Vocabulary(path)
    rng = random.Random(1)
    word = "".join(rng.choices("etaoinshrdlu", k=320_000)).encode()
    began = time.perf_counter()
    got = vocabulary.merge_long(word)
    assert time.perf_counter() - began < 6
    library = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=vocabulary.ranks,
                                special_tokens={})
    assert got == library.encode_ordinary(word.decode())


def test_many_findings_are_swept_once():
    text = "".join(f"token={'ab1' * 8} {n:024d}\n" for n in range(8_000))
    spans = secret_scan.base_spans(text)

    class Nothing:
        @staticmethod
        def encode_ordinary(part):
            return [0]

    began = time.perf_counter()
    assert secret_scan.random_spans(text, Nothing, spans) == []
    assert time.perf_counter() - began < 4
    assert secret_scan.merged_spans([(5, 9, "a"), (0, 2, "b"), (2, 3, "c"), (6, 12, "d")]) == [
        (0, 3), (5, 12)]


def test_every_gzip_member_is_read(spark, tmp_path):
    common.session(spark)
    records = [b"".join(warc.record_parts(str(n), str(n), f"http://x/{n}", b"page %d" % n,
                                          __import__("hashlib").sha1(b"page %d" % n).hexdigest(),
                                          None, 4096)) + b"\r\n\r\n" for n in range(5)]
    info = warc.header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:i>")], 2) + b"hi\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in [info, *records]))
    assert warc.read_records(spark, str(tmp_path)).count() == 6
    got = sorted(r["page_id"] for r in warc.read_pages(spark, str(tmp_path)).collect())
    assert got == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="cut short"):
        warc.gunzip(gzip.compress(b"x" * 99)[:-6])


def test_a_long_page_and_clashing_names(spark):
    common.session(spark)
    rows = [(1, "http://a", "w" * 700_000, "clash"), (2, None, "v" * 9_000, "clash"),
            (3, "http://c", "v" * 9_000, "clash"), (4, "http://d", None, "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    df = df.withColumn("digest", F.lit("clash")).withColumn("segment", F.lit(3))
    got = {r[0]: (r[1], r[3], r[4]) for r in warc.op9(df).collect()}
    assert got == {1: (700_000, "response", None), 2: (9_000, "revisit", 3),
                   3: (9_000, "response", None), 4: (0, "response", None)}


def test_rare_languages_are_learned(spark):
    common.session(spark)
    rows = [(n, f"{chr(97 + n % 26)}{chr(97 + n // 26 % 26)} " * 30, f"l{n % 300:03d}")
            for n in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = lang_cnn.fit(df, per_language=2, windows_per_doc=1)
    assert len(network.languages) == 300


def test_bulk_of_equal_and_null_ids_is_packed_whole(spark):
    common.session(spark)
    rows = [(None, "same text")] * 700 + [(7, "same text")] * 700 + [(8, None)] * 300
    got = packing.op6(documents(spark, rows)).collect()
    assert len(got) == 1700
    used = {}
    for r in got:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_units_are_the_vocabularys_own():
    library = Tokenizer.from_file(P.path(packing.VOCABULARY))
    encoder = packing.WordEncoder(P.path(packing.VOCABULARY), cache_bytes=2_000)
    pieces = ["don't", "'s", "''t", "-'t", "5's", "I'LL", "a'", "<|endoftext|>", "<|", "É", "naïve",
              "'é", "\x1c", "\x85", "\xa0", "　", "中文", "123", "!?", "'", "́", "Σας", "\0",
              "<|ENDOFTEXT|>", "'ve'", "s'd", "\t", "\n"]
    rng = random.Random(7)
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randrange(14)))
             for _ in range(2_000)]
    for a in range(0, len(texts), 100):
        for text, ids in zip(texts[a:a + 100], encoder.encode(texts[a:a + 100])):
            assert list(ids) == library.encode(text, add_special_tokens=False).ids, text
    assert encoder.encode([]) == []
