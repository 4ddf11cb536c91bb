"""The vector store as Parquet tables.

Layout under one root (a shared folder)::

    chunks/     row_id, doc_id, chunk_id, text, metadata       (text lives here only)
    vectors/    row_id, embedding[, cell_id]                    (partitioned by cell_id;
                PQ keeps them so that vectors can be added and measured)
    centroids/  cell_id, centroid                               (IVF, PQ, HNSW)
    codebook/   sub, code, centroid                             (PQ)
    codes/      row_id, cell_id, codes                          (PQ, partitioned by cell_id)
    manifest/   index_type, dim, nlist, nprobe, m, nbits, n_vectors, model, version;
                one row a version, the highest counts
    batches/    batch_id, state ('begun' or 'done') of named appends

Search reads ``vectors`` (or ``codes``) only; a cell-partitioned table gets
partition pruning from the probed cell list.  ``HNSW`` is re-aimed as an IVF
store whose ``nprobe`` is calibrated on sample queries to a recall target.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.ordering import md5_order_key, spread
from tessera.operators import ivf, knn, retrieval, splitter
from tessera.session import scratch_path
from tessera.operators.embed import embed_with, hash_embedding
from tessera.sources.tables import NOTHING_WRITTEN

INDEX_TYPES = ("Flat", "IVF", "PQ", "HNSW")
# queries that calibrate nprobe for the HNSW re-aim (the first ones in md5 order)
CALIBRATION_QUERIES = 1000


@dataclass
class Store:
    manifest: dict
    chunks: DataFrame
    vectors: DataFrame
    centroids: DataFrame | None = None
    codebook: DataFrame | None = None
    codes: DataFrame | None = None


def chunk_documents(docs: DataFrame, chunker: str = "recursive", chunk_size: int = 400,
                    overlap: int = 50, chunk_words: int = 64) -> DataFrame:
    """Documents ``(doc_id, text[, source])`` -> chunk table with row ids."""
    if chunker == "words":
        return retrieval.chunk_table(docs, chunk_words, source_col="source"
                                     if "source" in docs.columns else None)
    keep = ("doc_id",) + (("source",) if "source" in docs.columns else ())
    ch = splitter.recursive_chunks(docs, chunk_size, overlap, keep=keep)
    src = F.coalesce(F.col("source"), F.lit("unknown")) if "source" in docs.columns \
        else F.lit("unknown")
    return ch.select(retrieval.row_id(), "doc_id", F.col("chunk_id").cast("int").alias("chunk_id"),
                     "text", F.struct(src.alias("source"),
                                      F.col("chunk_id").cast("int").alias("chunk_id")).alias("metadata"))


def _by_cell(df: DataFrame) -> DataFrame:
    """Group rows of a cell into few files before a ``partitionBy(cell_id)``
    write.  REBALANCE lets AQE split a hot cell (one cell may hold a third of
    all vectors) over several tasks and merge small ones."""
    return df.hint("rebalance", "cell_id")


def embedded(df: DataFrame, text_col: str, embed=None, make_embedder=None,
             dim: int = 64) -> DataFrame:
    """``df`` plus ``embedding``: a plug-in factory, a column function, or the
    built-in hash embedder."""
    if make_embedder is not None:
        return embed_with(df, make_embedder, text_col, "embedding")
    embed = embed or (lambda c: hash_embedding(c, dim))
    return df.withColumn("embedding", embed(F.col(text_col)))


def build_store(docs: DataFrame, root: str, index_type: str = "Flat", *,
                chunker: str = "recursive", chunk_size: int = 400, overlap: int = 50,
                chunk_words: int = 64, dim: int = 64, embed=None, model: str = "hash",
                nlist: int | None = None, m: int = 8, nbits: int = 8,
                recall_target: float = 0.9, k: int = 5, seed: int = 1,
                make_embedder=None) -> DataFrame:
    """Load -> split -> embed -> index -> save -> one-row summary (K6).
    ``dim`` sizes the built-in embedder; the manifest records the width that
    the vectors have."""
    if index_type not in INDEX_TYPES:
        raise ValueError(f"unknown index type {index_type!r}; one of {INDEX_TYPES}")
    spark = docs.sparkSession
    t0 = time.perf_counter()
    chunks = chunk_documents(spread(docs), chunker, chunk_size, overlap, chunk_words)
    # sorted inside each file by row_id: min/max statistics of row groups let
    # the IN filter of a search skip everything but the hit chunks
    chunks.sortWithinPartitions("row_id").write.mode("overwrite").parquet(f"{root}/chunks")
    chunks = spark.read.parquet(f"{root}/chunks")
    vec = embedded(chunks, "text", embed, make_embedder, dim).select("row_id", "embedding")
    manifest = {"index_type": index_type, "dim": dim, "nlist": 0, "nprobe": 0, "m": 0,
                "nbits": 0, "model": model}
    if index_type == "Flat":
        vec.write.mode("overwrite").parquet(f"{root}/vectors")
    else:
        # embedded once, in the scratch folder: the store keeps one copy by cell
        flat_dir = scratch_path(spark, "vectors")
        vec.write.parquet(flat_dir)
        flat = spark.read.parquet(flat_dir)
        cents = ivf.train_centroids(flat, "embedding", nlist, seed)
        cents.write.mode("overwrite").parquet(f"{root}/centroids")
        cents = spark.read.parquet(f"{root}/centroids")
        manifest["nlist"] = cents.count()
        manifest["nprobe"] = 1
        (_by_cell(ivf.assign_cells(flat, cents)).write.mode("overwrite").partitionBy("cell_id")
         .parquet(f"{root}/vectors"))
        stored = spark.read.parquet(f"{root}/vectors")
        if index_type == "PQ":
            book = ivf.train_pq(stored, cents, m, nbits, seed=seed)
            book.write.mode("overwrite").parquet(f"{root}/codebook")
            book = spark.read.parquet(f"{root}/codebook")
            (_by_cell(ivf.encode_pq(stored, cents, book)).write.mode("overwrite")
             .partitionBy("cell_id").parquet(f"{root}/codes"))
            manifest.update(m=m, nbits=nbits)
        if index_type == "HNSW":
            sample = (stored.orderBy(md5_order_key(seed, "row_id"), "row_id")
                      .limit(CALIBRATION_QUERIES)
                      .select(F.col("row_id").alias("q_id"), "embedding").checkpoint(eager=True))
            nprobe, _ = ivf.calibrate_nprobe(stored, cents, sample, k, recall_target)
            manifest["nprobe"] = nprobe
    size = spark.read.parquet(f"{root}/vectors").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("d")).first()
    n_vec = size["n"]
    manifest["n_vectors"], manifest["dim"] = n_vec, size["d"] or dim
    _write_manifest(spark, root, manifest)
    return spark.createDataFrame([{
        "n_documents": docs.count(), "n_chunks": n_vec, "dim": manifest["dim"], "index_type": index_type,
        "seconds": time.perf_counter() - t0, "store_path": root}])


def load_store(spark: SparkSession, root: str) -> Store:
    """The store's tables and its manifest (the index type is restored)."""
    manifest = _read_manifest(spark, root)
    kind = manifest["index_type"]
    st = Store(manifest, spark.read.parquet(f"{root}/chunks"), spark.read.parquet(f"{root}/vectors"))
    if kind != "Flat":
        st.centroids = spark.read.parquet(f"{root}/centroids")
    if kind == "PQ":
        st.codebook = spark.read.parquet(f"{root}/codebook")
        st.codes = spark.read.parquet(f"{root}/codes")
    return st


def _read_manifest(spark: SparkSession, root: str) -> dict:
    rows = spark.read.option("mergeSchema", True).parquet(f"{root}/manifest")
    if "version" in rows.columns:
        rows = rows.orderBy(F.col("version").desc_nulls_last())
    return rows.first().asDict()


def _write_manifest(spark: SparkSession, root: str, manifest: dict, mode: str = "overwrite") -> None:
    """An append adds a row with the next version, so that the store never
    stands without a manifest."""
    row = {**manifest, "version": 0 if mode == "overwrite" else (manifest.get("version") or 0) + 1}
    spark.createDataFrame([row]).coalesce(1).write.mode(mode).parquet(f"{root}/manifest")


def _batch_state(spark: SparkSession, root: str, batch_id: str) -> str | None:
    """'done', 'begun' or None: what became of earlier attempts at a batch."""
    try:
        log = spark.read.parquet(f"{root}/batches")
    except AnalysisException as e:
        if e.getCondition() not in NOTHING_WRITTEN:
            raise
        return None
    states = {r["state"] for r in log.filter(F.col("batch_id") == batch_id).select("state")
              .distinct().collect()}
    return "done" if "done" in states else "begun" if states else None


def _log_batch(spark: SparkSession, root: str, batch_id: str, state: str) -> None:
    spark.createDataFrame([(batch_id, state)], "batch_id string, state string").coalesce(1) \
        .write.mode("append").parquet(f"{root}/batches")


def add_vectors(root: str, new_vectors: DataFrame, new_chunks: DataFrame | None = None,
                batch_id: str | None = None) -> int:
    """V8: append ``(row_id, embedding)`` rows, and the chunk rows that searches
    return for them, to a store of any index type; returns ntotal.  New vectors
    are filed under the store's cells (and coded with its codebook); the index
    is not trained again.

    A named batch is added once: when it is done a further call changes
    nothing, and after an attempt that broke off only the rows that a table
    lacks are written (told by ``row_id``, which a batch must give alike every
    time).  Attempts at one batch must not run side by side."""
    spark = new_vectors.sparkSession
    st = load_store(spark, root)
    kind = st.manifest["index_type"]
    if kind not in INDEX_TYPES:
        raise ValueError(f"unknown index type {kind!r}")
    state = None if batch_id is None else _batch_state(spark, root, batch_id)
    if state == "done":
        return st.manifest["n_vectors"]
    if batch_id is not None and state is None:
        _log_batch(spark, root, batch_id, "begun")

    def lacking(rows: DataFrame, table: DataFrame) -> DataFrame:
        return rows if state is None else rows.join(table.select("row_id"), "row_id", "left_anti")

    new = new_vectors.select("row_id", "embedding")
    if kind == "Flat":
        lacking(new, st.vectors).write.mode("append").parquet(f"{root}/vectors")
    else:
        filed_dir = scratch_path(spark, "filed")
        ivf.assign_cells(new, st.centroids).write.parquet(filed_dir)
        filed = spark.read.parquet(filed_dir)
        if kind == "PQ":
            (_by_cell(lacking(ivf.encode_pq(filed, st.centroids, st.codebook), st.codes))
             .write.mode("append").partitionBy("cell_id").parquet(f"{root}/codes"))
        _by_cell(lacking(filed, st.vectors)).write.mode("append").partitionBy("cell_id") \
            .parquet(f"{root}/vectors")
    if new_chunks is not None:
        (lacking(new_chunks.select(*st.chunks.columns), st.chunks).sortWithinPartitions("row_id")
         .write.mode("append").parquet(f"{root}/chunks"))
    total = spark.read.parquet(f"{root}/vectors").count()
    _write_manifest(spark, root, {**st.manifest, "n_vectors": total}, "append")
    if batch_id is not None:
        _log_batch(spark, root, batch_id, "done")
    return total


def add_documents(root: str, docs: DataFrame, *, chunker: str = "recursive", chunk_size: int = 400,
                  overlap: int = 50, chunk_words: int = 64, embed=None,
                  make_embedder=None, batch_id: str | None = None) -> int:
    """Documents -> chunks -> vectors -> ``add_vectors``, as ``build_store``
    makes them (give the same chunker and embedder).  Row ids follow from
    document and chunk, so a named batch may be tried again."""
    spark = docs.sparkSession
    chunk_dir = scratch_path(spark, "new-chunks")
    chunk_documents(spread(docs), chunker, chunk_size, overlap, chunk_words).write.parquet(chunk_dir)
    chunks = spark.read.parquet(chunk_dir)
    dim = load_store(spark, root).manifest["dim"]
    return add_vectors(root, embedded(chunks, "text", embed, make_embedder, dim), chunks, batch_id)


def search_store(store: Store, queries: DataFrame, k: int = 5, nprobe: int | None = None,
                 q_id_col: str = "q_id", q_vec_col: str = "embedding") -> DataFrame:
    """Top-k ``(q_id, row_id, rank, d2, similarity)`` with the store's index."""
    kind = store.manifest["index_type"]
    if kind == "Flat":
        return knn.knn_search(store.vectors, queries, k, q_id_col=q_id_col, q_vec_col=q_vec_col)
    probe = nprobe or store.manifest.get("nprobe") or 1
    if kind == "PQ":
        return ivf.search_pq(store.codes, store.centroids, store.codebook, queries, k, probe,
                             q_id_col=q_id_col, q_vec_col=q_vec_col)
    return ivf.search_ivf(store.vectors, store.centroids, queries, k, probe,
                          q_id_col=q_id_col, q_vec_col=q_vec_col)
