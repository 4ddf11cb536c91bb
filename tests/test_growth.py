"""What a step plans or holds stays bounded as its input grows."""

import os
import tempfile

import numpy as np
import pytest

from tessera.operators import ivf, knn, vocab
from tessera.session import ARROW_BYTES, ARROW_ROWS, prepare, settings
from tessera.sources import files


def texts_in(n):
    root = tempfile.mkdtemp(prefix="tessera-texts-")
    for i in range(n):
        with open(f"{root}/doc{i}.txt", "w") as f:
            f.write(f"text {i}")
    return root


def test_a_stream_looks_its_files_up_in_few_tasks(spark):
    from pyspark.sql.streaming import StreamingQueryListener

    from tessera.streaming import ingest

    runs = []

    class Runs(StreamingQueryListener):
        def onQueryStarted(self, event):
            runs.append(str(event.runId))

        def onQueryProgress(self, event):
            pass

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            pass

    cores = spark.sparkContext.defaultParallelism
    src, out = texts_in(8 * cores + 40), tempfile.mkdtemp(prefix="tessera-out-")
    listener = Runs()
    spark.streams.addListener(listener)
    try:
        n = ingest.ingest_texts(spark, src, f"{out}/out", f"{out}/ckpt")
        assert n == 8 * cores + 40
    finally:
        spark.streams.removeListener(listener)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(runs[0]) for s in tracker.getJobInfo(j).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= 4 * cores


def test_settings_are_put_back(spark):
    key = ingest_key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), settings(spark, **{ingest_key: "7"}):
        assert spark.conf.get(key) == "7"
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_a_query_travels_once_to_a_pack_of_cells(spark):
    packs = knn.Packs({0: 5, 1: 4, 2: 0, 3: 25, 4: 3}, 6, 10)
    assert packs.low.tolist() == [0, 3, 3, 3, 4] and packs.high.tolist() == [2, 4, 4, 4, 5]
    assert packs.pieces.tolist() == [1, 1, 0, 3, 1, 0]
    q = spark.createDataFrame([(i, [float(i)], float("inf")) for i in range(20)],
                              "q_id long, vector array<double>, limit double")
    sent, counts = knn.sent_to_packs(q, packs, lambda v, _: np.ones((len(v), 6), bool))
    assert sent.count() == 20 * 5  # not one row a cell
    assert {(r.kind, r.key): r.n for r in counts.collect()} == {
        **{(0, c): 20 for c in (0, 1, 3, 4)}, **{(1, p): 20 for p in range(5)}}
    assert sorted({r.n for r in sent.collect()}) == [1, 2]


def test_an_exact_search_sends_few_rows(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 16)))]
    vec = spark.createDataFrame(rows, "row_id long, embedding array<double>")
    cents = spark.createDataFrame([(i, rows[i][1]) for i in range(80)],
                                  "cell_id int, centroid array<double>")
    filed = ivf.assign_cells(vec, cents).checkpoint(eager=True)
    sizes = []
    plain = knn.sent_to_packs

    def counted(*args):
        sent, counts = plain(*args)
        sizes.append(sent.count())
        return sent, counts

    monkeypatch.setattr(knn, "sent_to_packs", counted)
    q = vec.withColumnRenamed("row_id", "q_id")
    hits, _ = ivf.search_ivf_exact(filed, cents, q, 5)
    flat = knn.knn_search(vec, q, 5)
    assert hits.exceptAll(flat).count() == 0 and hits.count() == 2000
    assert max(sizes) <= 400 * 40  # 80 cells each before


def test_many_centres_lose_nothing_to_few(spark, monkeypatch):
    rng = np.random.default_rng(9)
    middle = rng.normal(size=(40, 8)) * 10
    mat = np.repeat(middle, 50, axis=0) + rng.normal(size=(2000, 8)) * 0.1
    points = spark.createDataFrame([(p.tolist(), 1.0) for p in mat], "_p array<double>, _w double")
    monkeypatch.setattr(ivf, "MAX_ML_CENTRES", 10)
    centres = ivf._weighted_kmeans(points, 40, 1, 10)
    near = ((mat[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1)
    assert centres.shape == (40, 8) and near.mean() < 8 * 0.1 ** 2 * 1.5
    again = ivf._weighted_kmeans(points, 40, 1, 10)
    assert np.array_equal(centres, again)


def test_copies_give_fewer_centres(spark):
    mat = np.repeat(np.eye(4), 25, axis=0)
    assert len(ivf._seeds(mat, np.ones(100), 9, 1)) == 4


def test_distances_held_at_once_do_not_follow_the_cell():
    assert knn.sub_block(1_000) == 256
    assert knn.sub_block(1_000_000) * 1_000_000 <= 4 << 20


def test_arrow_batches_are_bounded_for_every_query(spark):
    prepare(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= ARROW_ROWS
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= ARROW_BYTES


def test_texts_are_looked_up_in_slices(spark, monkeypatch):
    import pyarrow as pa

    texts = ["a b", None, "c " * 40, "", "a", "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["k", "t"])
    monkeypatch.setattr(vocab, "SLICE_BYTES", 10)
    parts = list(vocab._text_slices(batch))
    assert [len(p) for p in parts] == [2, 1, 3]
    assert [x for p in parts for x in p.column(1).to_pylist()] == texts


def test_slices_and_cold_words_do_not_change_the_ids(spark):
    docs = spark.createDataFrame([(1, "a b a zz"), (None, None), (2, ""), (2, "zz q a q"), (3, "new a")],
                                 "doc_id long, text string")
    table = spark.createDataFrame([("a", 1), ("b", 2), ("q", 5), ("zz", 9)], "token string, id int")

    def got(**options):
        return sorted(((r[0] or 0, r[1]) for r in vocab.encode(docs, table, **options).collect()))

    want = [(0, []), (1, [1, 2, 1, 9]), (2, []), (2, [9, 5, 1, 5]), (3, [1])]
    known = [(k, [7, 1] if k == 3 else ids) for k, ids in want]
    for bound in (1, 40, 1 << 20):
        assert got(max_broadcast_bytes=bound) == want
        assert got(max_broadcast_bytes=bound, unk_id=7) == known


def test_batches_encode_the_documents_once(spark, monkeypatch, tmp_path):
    from tessera.plans import registry

    spark.createDataFrame([(i, "w " * (20 + i)) for i in range(30)], "doc_id long, text string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    built, plain = [], vocab.build_vocabulary
    monkeypatch.setattr(vocab, "build_vocabulary", lambda *a, **k: built.append(1) or plain(*a, **k))
    assert registry.q_batch_assign(spark, str(tmp_path)).count() == 24
    assert len(built) == 1


def test_many_small_files_are_read_in_few_tasks(spark):
    least = 4 * spark.sparkContext.defaultParallelism
    root = texts_in(2 * least)
    with settings(spark, **{"spark.sql.files.maxPartitionBytes": "1b"}):
        got = files.read_texts(spark, root)
        assert got.rdd.getNumPartitions() <= least
        assert {r.text for r in got.collect()} == {f"text {i}" for i in range(2 * least)}


def test_many_hits_a_query_make_groups_of_fewer_queries(spark, monkeypatch):
    rng = np.random.default_rng(6)
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(400, 8)))],
                              "row_id long, embedding array<double>").checkpoint(eager=True)
    cents = ivf.train_centroids(v, nlist=5, max_iter=3).checkpoint(eager=True)
    filed = ivf.assign_cells(v, cents).checkpoint(eager=True)
    book = ivf.train_pq(filed, cents, 4, 4, max_iter=3).checkpoint(eager=True)
    codes = ivf.encode_pq(filed, cents, book).checkpoint(eager=True)
    q = v.withColumnRenamed("row_id", "q_id")
    dealt, plain = [], knn._dealt_queries
    monkeypatch.setattr(knn, "_dealt_queries", lambda sent, per: dealt.append(dict(per)) or plain(sent, per))
    monkeypatch.setattr(knn, "_PACK_FEWEST_QUERIES", 2)

    def found():
        dealt.clear()
        hits = ivf.search_pq_refined(codes, filed, cents, book, q, 5, 3, 8)
        return sorted(map(tuple, hits.select("q_id", "row_id", "rank", "d2").collect()))

    want, few = found(), [sum(x.values()) for x in dealt]
    monkeypatch.setattr(knn, "GROUP_HITS", 400)    # 10 queries of 40 hits
    monkeypatch.setattr(knn, "GROUP_IDS", 1000)
    monkeypatch.setattr(knn, "_PACK_HITS", 200)
    assert found() == want and len(want) == 2000
    hits, ids = (sum(x.values()) for x in dealt)
    assert hits > 2 * few[0] and ids >= few[1], (hits, ids, few)
