"""Operators 2, 4 and 6 against the public libraries."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import LONG_TEXT, documents, empty
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import byte_bpe, bytescan, common, packing, token_count

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    with open(P.path(byte_bpe.VOCABULARY), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary(P.path(byte_bpe.VOCABULARY))


def encode_all(vocabulary, texts, block=1 << 16):
    buf, off = bytescan.text_buffer(pa.array(texts, pa.string()))
    out = []
    for a, b in bytescan.row_slices(off, block):
        ids, begins, counts = vocabulary.encode(buf[off[a]:off[b]], off[a:b + 1] - off[a])
        ends = np.concatenate(([0], np.cumsum(counts)))
        out += [(ids[x:y].tolist(), begins[x:y].tolist()) for x, y in zip(ends, ends[1:])]
    return out


ALPHABET = ["a", "b", "e", "s", "t", "re", "'", " ", "  ", "\n", "\t", "1", "23", "!", "'s", "'ll",
            "é", "ß", "中", "　", "\x85", "\x1c", "😀", "The", "ing", " the", "'ve", "²"]


def test_boundaries_and_ids_match_the_library(vocabulary, library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(4000)]
    texts += ["", "a" * 900, "ab" * 400, " " * 500, "'" * 300, "\n" * 129, LONG_TEXT[:5000]]
    got = encode_all(vocabulary, texts)
    assert [ids for ids, _ in got] == [library.encode_ordinary(t) for t in texts]
    for t, (ids, begins) in zip(texts, got):
        assert vocabulary.decode(np.array(ids, np.int64)).tobytes() == t.encode()
        sizes = [len(library.decode_single_token_bytes(i)) for i in ids]
        assert begins == [sum(sizes[:i]) for i in range(len(ids))] or len(ids) > 300


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(vocabulary, library, texts):
    assert [i for i, _ in encode_all(vocabulary, texts)] == [library.encode_ordinary(t) for t in texts]


def test_scan_does_not_depend_on_the_block(vocabulary):
    text = ("it's   a test\n\n of 're 've blocks " * 40).encode()
    buf = np.frombuffer(text, np.uint8)
    cp, _ = byte_bpe.code_points(buf)
    first = np.zeros(len(cp), bool)
    first[0] = True
    sym = byte_bpe.symbols(cp, first, vocabulary.classes)
    want = byte_bpe.scan(sym, *vocabulary.tables, block=len(sym))
    for block in (1, 2, 3, 7, 64):
        assert (byte_bpe.scan(sym, *vocabulary.tables, block=block) == want).all()


def test_cache_eviction_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 3)
    texts = ["one two three four", "five six seven", "one two", "eight nine ten"] * 3
    assert [encode_all(vocabulary, [t])[0][0] for t in texts] == [library.encode_ordinary(t) for t in texts]


def test_op2_edges(spark, library):
    common.session(spark)
    rows = byte_bpe.op2(documents(spark)).collect()
    source = collections.Counter((r.doc_id, r.text or "") for r in documents(spark).collect())
    want = collections.Counter()
    for (i, t), n in source.items():
        ids = library.encode_ordinary(t)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(t.encode()).hexdigest()] += n
    assert collections.Counter(tuple(r) for r in rows) == want
    clash = byte_bpe.decode(byte_bpe.encode(documents(spark, clash=True)))
    assert clash.columns.count("ids") == 1 and "kept" in clash.columns
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in clash.collect())
    assert byte_bpe.op2(empty(spark)).count() == 0


@pytest.fixture(scope="module")
def pieces_model():
    return sentencepiece.SentencePieceProcessor(model_file=P.path(token_count.MODEL))


@pytest.mark.parametrize("chunk,overlap", [(32_768, 256), (500, 32), (64, 4), (100, 100)])
def test_token_counts(spark, pieces_model, chunk, overlap):
    common.session(spark)
    docs = documents(spark, clash=True)
    got = token_count.count_tokens(docs, chunk_chars=chunk, overlap_chars=overlap)
    want = collections.Counter((r.doc_id, len((r.text or "").encode()),
                                len(pieces_model.encode(r.text or ""))) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()) == want


def test_token_counts_of_whole_tables(spark, pieces_model):
    common.session(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in token_count.op4(docs).collect()}
    for d in docs.collect():
        n = len(pieces_model.encode(d.text))
        assert (rows[d.doc_id].n_tokens, rows[d.doc_id].over_limit) == (n, n > 4096)
    assert token_count.op4(empty(spark)).count() == 0


def test_overlap_is_widened_when_no_place_is_stable():
    model = token_count.Model(P.path(token_count.MODEL))
    text = "y" * 3000 + " end of it " + "é" * 500
    rows = [token_count.splice_row(model, k, c, p, 200, o, f, z)
            for k, c, p, o, f, z in token_count.cut_chunks("k", text, 200, 20)]
    assert any(r[6] is None for r in rows)  # a chunk inside the long word cannot be spliced


def test_stable_places_are_real_boundaries(pieces_model):
    model = token_count.Model(P.path(token_count.MODEL))
    assert model.stable_space
    for text in (LONG_TEXT[:20_000], "▁ odd ▁▁ marks " * 300, "é  中文 \n x\t y " * 400):
        rows = [token_count.splice_row(model, k, c, p, 400, o, f, z)
                for k, c, p, o, f, z in token_count.cut_chunks("k", text, 400, 64)]
        assert all(a[5] == b[3] for a, b in zip(rows, rows[1:]))
        assert sum(r[6] - r[4] for r in rows) == len(pieces_model.encode(text))


@pytest.fixture(scope="module")
def words_library():
    return Tokenizer.from_file(P.path(packing.VOCABULARY))


def test_word_cache_matches_the_library(words_library):
    rng = random.Random(5)
    odd = ["a\x1cb c", "<|endoftext|> x", "<|startoftext|>", "don't we'll 'S ''s", "ΑΣ σ x", "²³ 1２ x",
           "É́ é ́a", "中文 Straße ÷×ª", "İstanbul ſecret K", "", " 　 x\x85y"]
    odd += ["".join(rng.choices(ALPHABET, k=40)) for _ in range(500)]
    got = packing.WordEncoder(P.path(packing.VOCABULARY)).encode(odd)
    want = [e.ids for e in words_library.encode_batch(odd, add_special_tokens=False)]
    assert [g.tolist() for g in got] == want


def check_packing(rows, want, capacity=2048):
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
                               for r in rows) == want
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    return len(held), -(-total // capacity)


def expected_pieces(library, docs):
    want = collections.Counter()
    for i, text in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for n, s in enumerate(range(0, len(ids), 2048)):
            part = ids[s:s + 2048]
            want[i, n, s, len(part), zlib.crc32(part.tobytes())] += 1
    return want


def test_packing_of_whole_tables(spark, words_library):
    common.session(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = expected_pieces(words_library, [(r.doc_id, r.text) for r in docs.collect()])
    used, least = check_packing(packing.op6(docs).collect(), want)
    assert used <= least * 1.01 + 1


def test_packing_edges(spark, words_library):
    common.session(spark)
    docs = documents(spark)
    want = expected_pieces(words_library, [(r.doc_id, r.text) for r in docs.collect()])
    check_packing(packing.op6(docs).collect(), want)
    many = documents(spark, [(i, None) for i in range(3000)])
    used, least = check_packing(packing.op6(many).collect(), collections.Counter(
        {(i, 0, 0, 1, zlib.crc32(b"\0\0\0\0")): 1 for i in range(3000)}))
    assert used == least
    assert packing.op6(empty(spark)).count() == 0


def test_plan_uses_every_piece_once():
    rng = random.Random(9)
    for lengths in ([2048], [1025] * 7, list(range(1, 400)), [rng.randint(1, 2048) for _ in range(3000)],
                    [int(2048 * rng.random() ** 4) + 1 for _ in range(5000)]):
        hist = collections.Counter(min(x, 2048) for x in lengths)
        groups = packing.plan(dict(hist))
        used = collections.Counter()
        for g in groups:
            assert sum(x * n for x, n in g.runs) + g.room == 2048
            for x, n in g.runs:
                used[x] += n * g.times
        assert used == hist
        rows = packing.recipe(groups)
        for length in hist:
            own = rows[rows[:, 0] == length]
            assert own[0, 1] == 0 and (np.diff(own[:, 1]) > 0).all()


def test_sets_of_pieces_keep_their_ids(spark, words_library):
    common.session(spark)
    docs = documents(spark).filter("doc_id = 7")
    row = packing.pieces(docs, with_ids=True).collect()[0]
    assert row.ids[:-1] == words_library.encode(docs.first().text, add_special_tokens=False).ids
    assert packing.pieces(docs).select(F.sum("length")).first()[0] == len(row.ids)
