"""Operators 11 to 13 against brute force, on the rows every operator must survive."""

import hashlib
import math
import re
import zlib

import pytest
from llm_helpers import documents, empty
from pyspark.sql import functions as F

from tessera.llm import common, lexical_rank, merkle, suffix_dedup

PASSAGE = "This very passage of more than fifty bytes is shared by many documents. "


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- 11 -----------------------------------------------------------------------

def repeats(rows, size=50):
    texts = [(i, (t or "").encode()) for i, t in rows]
    out = []
    first = {}
    for i, t in texts:
        if i is not None:
            for at in range(len(t) - size + 1):
                s = t[at:at + size]
                first[s] = min(first.get(s, i), i)
    for i, t in texts:
        gone = bytearray(len(t))
        for at in range(len(t) - size + 1) if i is not None else ():
            if first[t[at:at + size]] < i:
                gone[at:at + size] = b"\1" * size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for n, g in enumerate(gone) if g and not (n and gone[n - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


REPEATED = [
    (5, PASSAGE + "tail of five"), (6, "head of six " + PASSAGE), (6, "head of six " + PASSAGE),
    (7, PASSAGE * 3), (7, "other seven " + PASSAGE), (8, PASSAGE[:49]), (9, PASSAGE[:50]),
    (10, "x" * 300), (11, "x" * 120 + "y"), (12, "naïve " + "ü" * 40 + PASSAGE), (13, None),
    (14, "ü" * 25), (15, "a" + "ü" * 25), (None, PASSAGE * 2), (None, PASSAGE * 2), (16, ""),
    (-3, "negative id " + PASSAGE[:60]), (17, "x" * 49), (18, "first. " + PASSAGE + " second"),
]


@pytest.mark.parametrize("hot", [20_000, 2])
def test_repeats_equal_brute_force(spark, monkeypatch, hot):
    common.session(spark)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SEGMENT_BYTES", 400)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 500)
    got = suffix_dedup.dedup(documents(spark, REPEATED, clash=True), batches=3)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows_of(got) == repeats(REPEATED)


def test_repeats_on_hard_rows_and_nothing(spark):
    common.session(spark)
    hard = [(1, PASSAGE), (2, None), (3, "y" * 400_000), (4, "z" + "y" * 300_000), (5, "")]
    got = {r[0]: r[1:4] for r in suffix_dedup.dedup(documents(spark, hard), batches=2).collect()}
    assert got == {1: (72, 0, 0), 2: (0, 0, 0), 3: (400_000, 0, 0), 4: (300_001, 300_000, 1),
                   5: (0, 0, 0)}
    assert suffix_dedup.op11(empty(spark)).count() == 0


def test_levels_merge_like_a_counter(spark):
    common.session(spark)
    family = suffix_dedup.SuffixFamily(spark, 2)
    sizes = []
    for n in range(4):
        batch = spark.createDataFrame([(n, hashlib.sha256(b"%d" % n).hexdigest(),
                                        f"text number {n} " + PASSAGE)],
                                      "doc_id long, fp string, text string")
        lost = family.add(batch).collect()
        assert [r["n_removed"] for r in lost] == ([] if n == 0 else [len(PASSAGE) + 1])
        sizes.append([s for s, _ in family.levels])
    family.close()
    assert sizes == [[], [1], [2], [2, 1]]


def test_anchors_depend_on_the_window_only():
    import numpy as np

    rng = __import__("random").Random(5)
    shared = bytes(rng.randrange(97, 101) for _ in range(90))
    marks = []
    for lead in (b"", b"other words before it "):
        buf = np.frombuffer(lead + shared + b" and after", np.uint8)
        anchor, first, last, row = suffix_dedup.runs(buf, np.array([0, len(buf)]))
        by_window = {w: a for a, f, z in zip(anchor, first, last) for w in range(f, z + 1)}
        assert sorted(by_window) == list(range(len(buf) - 49))
        marks.append([by_window[len(lead) + w] - len(lead) for w in range(len(shared) - 49)])
    assert marks[0] == marks[1]


# -- 12 -----------------------------------------------------------------------

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, lower=False):
    text = r["text"]
    if lower and text is not None:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    parts = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def tree(leaves):
    """Root and, per leaf, the (left, right) sibling texts upward."""
    ways = [[] for _ in leaves]
    spot = list(range(len(leaves)))
    nodes = list(leaves)
    while len(nodes) > 1:
        for n, s in enumerate(spot):
            run = nodes[s // 8 * 8:s // 8 * 8 + 8]
            ways[n].append(("".join(run[:s % 8]), "".join(run[s % 8 + 1:])))
        nodes = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
        spot = [s // 8 for s in spot]
    return nodes[0], ways


def manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        low[g] = tree([leaf(r) for r in groups[g]])
    root, tops = tree([low[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        for r, way in zip(groups[g], low[g][1]):
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            at = leaf(r, bad)
            for left, right in way + top:
                at = sha(left + at + right)
            out.append((r["doc_id"], leaf(r), low[g][0], root,
                        sha("".join(a + b for a, b in way + top)), at, at == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [8, 4096])
def test_manifest_equals_brute_force(spark, monkeypatch, block):
    common.session(spark)
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = [(n * 7 % 90, f"Text {n} With Capitals" if n % 5 else None) for n in range(83)]
    rows += [(None, "No Id"), (3, "Again"), (3, "Again")]
    df = documents(spark, rows, clash=True).withColumn(
        "lang", F.when(F.col("doc_id") % 11 == 0, F.lit("xx")).when(
            F.col("doc_id") == 1, F.lit("lone")).otherwise(F.col("lang")))
    assert rows_of(merkle.op12(df)) == manifest(df.collect())


def test_manifest_of_hard_rows_and_nothing(spark):
    common.session(spark)
    df = documents(spark)
    got = rows_of(merkle.op12(df))
    assert got == manifest(df.collect())
    one = documents(spark, [(5, "alone")])
    assert rows_of(merkle.op12(one)) == manifest(one.collect())
    assert merkle.op12(empty(spark, clash=True)).count() == 0


# -- 13 -----------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranking(docs, items, top):
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, t) for i, t in bags if t]
    n, total = len(bags), sum(len(t) for _, t in bags)
    df = {}
    for _, t in bags:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, t in bags:
            m = 50 + (50 * len(t) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1)))
                    * ((1_000_000_000 * t.count(x)) // (1000 * t.count(x) + 20 * m))
                    for x in set(terms(text)) if x in t)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        scored.sort(key=lambda x: x[:3])
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(scored[:top], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "The cat and the dog"), (1, "The cat and the dog"), (2, "the dog, the CAT; door 12345"),
         (3, None), (4, "!!!"), (None, "naïve 中文 word1 word2"), (5, "word1 word2 the cat and dog"),
         (6, "never seen"), (7, "x" * 70_000)]


@pytest.mark.parametrize("top,cells", [(50, 1 << 20), (2, 40)])
def test_ranking_equals_brute_force(spark, monkeypatch, top, cells):
    common.session(spark)
    monkeypatch.setattr(lexical_rank, "CELLS", cells)
    monkeypatch.setattr(lexical_rank, "BLOCK_ITEMS", 4 if top == 2 else 2048)
    docs = documents(spark, clash=True)
    items = spark.createDataFrame([(*i, "clash") for i in ITEMS],
                                  "item_id long, text string, doc_id string")
    got = lexical_rank.search(docs, items, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    raw = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(got) == ranking(raw, ITEMS, top)


def test_ranking_of_nothing(spark):
    common.session(spark)
    items = spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert lexical_rank.op13(empty(spark), items).count() == 0
    assert lexical_rank.op13(documents(spark), items.limit(0)).count() == 0


def test_sharing_plan_sums_every_item():
    rng = __import__("random").Random(3)
    base = [rng.sample(range(200), 12) for _ in range(6)]
    items = [sorted(set(base[i % 6] + base[i // 6 % 6] + rng.sample(range(200), 5)))
             for i in range(60)]
    leaf_of, pairs, tops = lexical_rank.sharing_plan(items, 200)
    held = {}
    for t, leaf_no in enumerate(leaf_of):
        if leaf_no >= 0:
            held.setdefault(leaf_no, []).append(t)
    n = len(held)
    for j, (a, b) in enumerate(pairs, n):
        assert a < j and b < j
        held[j] = held[a] + held[b]
    assert [sorted(t for x in top for t in held[x]) for top in tops] == items
    before = sum(len(i) for i in items)
    assert len(pairs) + sum(len(t) for t in tops) < before * 2 // 3


def test_word_hash_does_not_depend_on_long_neighbours():
    import numpy as np

    from tessera.llm import bytescan

    alone = np.frombuffer(b"cat dog", np.uint8)
    beside = np.frombuffer(b"cat dog " + b"x" * 9000, np.uint8)
    one = bytescan.word_hashes(alone, np.array([0, 4]), np.array([3, 7]))
    two = bytescan.word_hashes(beside, np.array([0, 4, 8]), np.array([3, 7, 9008]))
    assert list(one) == list(two[:2])
