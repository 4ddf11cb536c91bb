"""Operators 3 and 9 and the pipeline."""

import collections
import gzip
import hashlib

import duckdb
import numpy as np
import pytest
from llm_helpers import documents, empty
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import common, posting_ann, warc

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ready(spark):
    return common.session(spark)


# -- operator 3 ---------------------------------------------------------------

def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):  # in order; sum() compensates its rounding
        total += x * y
    return total


def brute(vectors, queries, k=20):
    out = {}
    for qi, q in queries:
        scored = sorted((-dot(q, v), i) for i, v in vectors if i != qi)
        out[qi] = [(i, -s) for s, i in scored[:k]]
    return out


def found(df):
    out = collections.defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_on_the_embeddings(ready):
    df = ready.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0])
    got = found(posting_ann.op3(df))
    assert recall(got, want) >= 0.9
    vec = dict(rows)
    for q, hits in got.items():
        for i, s in hits:
            assert s == dot(vec[q], vec[i])


def clusters(n, dim=64, centres=400):
    rng = np.random.default_rng(11)
    c = rng.normal(size=(centres, dim))
    x = c[rng.integers(0, centres, n)] + rng.normal(size=(n, dim)) * 0.5
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("table", ["sf0.1", "clustered"])
def test_a_third_of_the_lists_reaches_the_recall(ready, table):
    """The walk, the replicas and the pruning at work, on the query's own parts."""
    if table == "sf0.1":
        df = ready.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
        x = np.array([r.embedding for r in df.orderBy("vec_id").collect()], float)
        share_limit = 0.36  # nearly random vectors, 15 lists
    else:
        x = clusters(50_000)
        share_limit = 1 / 3
    some = np.random.default_rng(1).choice(len(x), min(len(x), posting_ann.FIT_ROWS), replace=False)
    index = posting_ann.Index.fit(x[some], float((x * x).sum(1).max()), len(x))
    rows = ready.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "id long, vec binary")
    rows = rows.checkpoint(eager=True)
    rule = posting_ann.calibrate(index, rows, rows.filter("id % 20 = 0"), 20)
    assert rule[2] < len(index.centroids)  # the graph is walked
    lists = index.file(x)
    replicas = np.mean([len(r) > 1 for r in lists])
    assert replicas > (0.5 if table == "sf0.1" else 0.1)
    rows_in = np.bincount(np.concatenate(lists), minlength=len(index.centroids))
    asked = np.arange(0, len(x), 20)[:400]
    lifted = np.concatenate((x[asked], np.zeros((len(asked), 1))), 1)
    node, ok = posting_ann.chosen_lists(index, lifted, rule, rows_in, 4 * 21)
    share = ok.sum(axis=1).mean() / len(index.centroids)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-score, axis=1)[:, :20]
    hit = np.mean([any(c in probed for c in lists[v]) for a in range(len(asked))
                   for probed in [set(node[a][ok[a]].tolist())] for v in near[a]])
    print(f"{table}: recall {hit:.3f}, lists probed {share:.3f}, replicated {replicas:.2f}")
    assert hit >= 0.9 and share <= share_limit


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank int").repartition(3)


def test_unequal_norms_copies_and_ties(ready):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1 + i % 5, 8)], 0, 0) for i in range(600)]
    hot = [float(np.float32(x)) for x in rng.normal(0, 12, 8)]
    rows += [(1000 + i, hot, 0, 0) for i in range(900)]      # one vector holds over half of the rows
    rows += [(1000, hot, 0, 0), (1001, hot, 0, 0)]           # repeated rows
    got = found(posting_ann.op3(frame(ready, rows)))
    once = list({i: v for i, v, *_ in rows}.items())
    want = brute(once, [r for r in once if r[0] % 20 == 0])
    assert recall(got, want) >= 0.9
    near_hot = [q for q, w in want.items() if all(i >= 1000 for i, _ in w)]
    assert near_hot and all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in near_hot)


def test_blocks_do_not_change_the_answer(ready, monkeypatch):
    df = ready.read.parquet(f"{SMALL}/embeddings.parquet")
    want = found(posting_ann.op3(df))
    monkeypatch.setattr(posting_ann, "BLOCK_BYTES", 37 * 8 * 64)
    monkeypatch.setattr(posting_ann, "QUERY_BLOCK", 3)
    assert found(posting_ann.op3(df)) == want


def test_rows_that_take_no_part(ready):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0, 0), (20, [0.0, 1.0], 0, 0), (1, [2.0, 1.0], 0, 0), (2, [2.0, 1.0], 0, 0),
            (40, None, 0, 0), (60, [0.0, 0.0], 0, 0), (3, [nan, 1.0], 0, 0), (4, [inf, 1.0], 0, 0),
            (5, [None, 1.0], 0, 0), (6, [], 0, 0), (7, [1.0, 2.0, 3.0], 0, 0), (None, [9.0, 9.0], 0, 0)]
    got = found(posting_ann.op3(frame(ready, rows)))
    assert got == {0: [(1, 2.0), (2, 2.0), (20, 0.0)], 20: [(1, 1.0), (2, 1.0), (0, 0.0)]}
    assert posting_ann.op3(frame(ready, [])).count() == 0
    assert posting_ann.op3(frame(ready, [(0, None, 0, 0)])).count() == 0
    assert posting_ann.op3(frame(ready, [(0, [1.0], 0, 0)])).count() == 0


def test_graph_walk_finds_near_centroids():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(6000, 12))
    index = posting_ann.Index.fit(x, float((x * x).sum(1).max()), 60_000)
    assert len(index.centroids) > 400
    q = posting_ann.lift(x[:300], index.radius2)
    node, dist = index.nearest(q, 16)
    full = posting_ann.distances(q, index.centroids)
    best = np.argsort(full, axis=1)[:, :16]
    assert np.mean([len(set(a) & set(b)) / 16 for a, b in zip(node, best)]) > 0.95
    assert np.allclose(np.sort(dist, 1), dist)
    sizes = [len(r) for r in posting_ann.bisect(x, 64)]
    assert max(sizes) - min(sizes) <= 8  # balanced
    assert max(len(f) for f in index.file(x[:500])) > 1  # boundary vectors are replicated


# -- operator 9 ---------------------------------------------------------------

PAGES = [(1, "http://a/\r\nx", "é" * 600, 0), (2, None, "é" * 600, 0), (2, "u", "é" * 600, 0), (9, "u", "é" * 600, 0),
         (9, "u", "é" * 600, 0), (3, "u", "short", 0), (4, "u", "short", 0), (5, "u", None, 0), (6, "u", "", 0),
         (7, "u", "WARC/1.1\r\n\r\n0\r\n\r\n" * 9000, 0), (8, "u", "z" * 999, 0), (10, "u", "z" * 999, 0),
         (None, "u", "y" * 2000, 0), (None, "u", "q" * 2000, 0), (11, "u", "q" * 2000, 0)]


def page_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type int").repartition(3)


def test_archive_round_trip(ready):
    got = collections.Counter(tuple(r) for r in warc.op9(page_frame(ready, PAGES)).collect())
    want = collections.Counter()
    for i, _, html, _ in PAGES:
        body = (html or "").encode()
        same = [p for p, _, h, _ in PAGES if (h or "") == (html or "") and p is not None]
        keeper = max(same) if same and len(body) >= 1000 else None
        revisit = keeper is not None and keeper != i
        want[i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response",
             keeper if revisit else None] += 1
    assert got == want
    assert warc.op9(page_frame(ready, [])).count() == 0


def test_segments_are_put_together(ready):
    path = common.shared_path(ready, "warc-test")
    warc.write_archives(page_frame(ready, PAGES), path, segment_bytes=333, records_per_file=40)
    records = warc.read_records(ready, path)
    assert records.filter("record_type = 'continuation'").count() > 100
    back = warc.read_pages(ready, path, with_payload=True).filter("record_type = 'response'")
    html = {(i, (h or "").encode()) for i, _, h, _ in PAGES}
    assert all((r.page_id, bytes(r.payload)) in html for r in back.collect())
    lost = records.filter("NOT (record_type = 'continuation' AND segment = 2)")
    with pytest.raises(Exception, match="segments are missing"):
        warc.reassemble(lost).count()
    with pytest.raises(Exception, match="segments are missing"):
        warc.reassemble(records.unionByName(records)).count()


def test_archives_are_plain_warc_files(ready, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write_archives(page_frame(ready, PAGES), path)
    seen = 0
    for f in (tmp_path / "w").glob("part-*"):
        for head, block in warc.parse_records(gzip.open(f).read()):
            assert int(head["content-length"]) == len(block) and head["warc-record-id"]
            seen += head["warc-type"] != "continuation"
    assert seen == len(PAGES)


def test_chunk_framing():
    for payload in (b"", b"a", b"0\r\n\r\n" * 100, bytes(range(256)) * 50):
        for size in (1, 7, 8192):
            assert warc.unframe_chunks(warc.frame_chunks(payload, size)) == payload
    assert warc.unframe_chunks(b"3;x=y\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unframe_chunks(b"5\r\nabc\r\n0\r\n\r\n")


def test_op9_matches_its_sql(ready):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    got = warc.op9(ready.read.parquet(f"{SMALL}/pages.parquet"))
    want = con.execute(warc.ORACLE)
    assert [c[0] for c in want.description] == got.columns
    assert collections.Counter(want.fetchall()) == collections.Counter(tuple(r) for r in got.collect())


# -- pipeline -----------------------------------------------------------------

def test_stages_keep_the_columns_and_take_effect(ready):
    docs = ready.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = common.written(stage(ready, docs, "/root/testdata/sf0.01"), name)
        if name != "packing":
            assert out.columns == docs.columns
            sizes.append(out.count())
            assert sizes[-1] == out.select("doc_id").distinct().count()
        before, docs = docs, out
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(r.n_chars == len(r.text) for r in before.collect())
    assert {r.doc_id for r in docs.collect()} == set(texts)
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    assert not any("token = \"" in t and "AKIA" in t for t in texts.values())


def test_clean_documents_stay(ready):
    docs = ready.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = ready.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = docs.join(labels.filter("quality = 1"), "doc_id").filter("n_chars > 300")
    kept = good.select(docs.columns)
    for _, stage in corpus_pipeline.STAGES[:2]:
        kept = common.written(stage(ready, kept, ""), "kept")
    assert kept.count() >= 0.99 * good.count()


def test_pipeline_edges(ready):
    assert [len(x) for x in corpus_pipeline.STAGES] == [2] * 5 and corpus_pipeline.ORACLE_SQL is None
    for rows in (documents(ready, clash=True), empty(ready)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = common.written(stage(ready, docs, ""), "edge")
        if not rows.count():
            assert docs.count() == 0
    assert corpus_pipeline.run(ready, SMALL).filter(F.col("offset") < 0).count() == 0
