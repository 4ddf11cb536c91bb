"""Search a chunk store with questions, attach chunk metadata,
optionally rerank, and build contexts.

A *chunk store* is two tables keyed by ``row_id``: vectors ``(row_id,
embedding[, cell_id])`` and chunks ``(row_id, doc_id, chunk_id, text,
metadata)``.  Search reads only the vectors; text is joined afterwards for
the few hits (questions x k rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import knn
from tessera.operators.chunking import word_chunks
from tessera.operators.embed import hash_embedding
from tessera.operators.rerank import rerank as rerank_hits

# row_id = doc_id * 2**20 + chunk_id: stable across re-runs and partitionings
# (never monotonically_increasing_id).  Holds up to 2**20 chunks per document.
ROW_ID_SHIFT = 20


def row_id(doc_id="doc_id", chunk_id="chunk_id") -> Column:
    """``doc_id << 20 | chunk_id``; a document with more chunks, or a doc id
    outside ``[0, 2^43)``, is an error rather than a silent id collision."""
    d = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    c = F.col(chunk_id) if isinstance(chunk_id, str) else chunk_id
    rid = F.shiftleft(d.cast("long"), ROW_ID_SHIFT) + c.cast("long")
    ok = (c < (1 << ROW_ID_SHIFT)) & (d >= 0) & (d < (1 << (63 - ROW_ID_SHIFT)))
    bad = F.raise_error(F.lit(f"row id layout: doc_id must be in [0, 2^{63 - ROW_ID_SHIFT}) "
                              f"and a document may hold at most 2^{ROW_ID_SHIFT} chunks"))
    return F.when(ok, rid).otherwise(bad.cast("long")).alias("row_id")


def chunk_table(docs: DataFrame, chunk_words: int, text_col: str = "text",
                source_col: str | None = "source") -> DataFrame:
    """Word-chunk a document table into ``(row_id, doc_id, chunk_id, text,
    metadata struct<source, chunk_id>)`` (P7: metadata merged with chunk_id;
    P8: missing source -> 'unknown')."""
    keep = ("doc_id",) + ((source_col,) if source_col else ())
    ch = word_chunks(docs, chunk_words, text_col, keep)
    src = F.coalesce(F.col(source_col), F.lit("unknown")) if source_col else F.lit("unknown")
    return ch.select(row_id(), "doc_id", F.col("chunk_id").cast("int").alias("chunk_id"),
                     "text", F.struct(src.alias("source"),
                                      F.col("chunk_id").cast("int").alias("chunk_id"))
                     .alias("metadata"))


def hash_vectors(chunks: DataFrame, dim: int) -> DataFrame:
    return chunks.select("row_id", hash_embedding(F.col("text"), dim).alias("embedding"))


def word_chunk_vectors(docs: DataFrame, chunk_words: int, dim: int,
                       text_col: str = "text") -> DataFrame:
    """``(row_id, embedding)`` of the word chunks of ``docs`` with the default
    embedder, straight from each document's words (no chunk text is built or
    re-split).  Equal to ``hash_vectors(chunk_table(docs, chunk_words), dim)``."""
    from tessera.operators.embed import chunk_hash_embeddings
    return (docs.select("doc_id", F.posexplode(chunk_hash_embeddings(F.col(text_col), chunk_words,
                                                                     dim)).alias("chunk_id", "embedding"))
            .select(row_id(), "embedding"))


def attach_chunks(hits: DataFrame, questions: DataFrame, chunks: DataFrame) -> DataFrame:
    """Hits ``(q_id, row_id, ...)`` + question text + chunk columns: plain
    equi joins.  The hit side is questions x k rows; AQE broadcasts it where
    its measured size allows and shuffles on ``row_id`` otherwise."""
    return hits.join(questions, "q_id").join(chunks, "row_id")


def search(vectors: DataFrame, chunks: DataFrame, questions: DataFrame, k: int = 5, *,
           dim: int = 64, rerank: bool = False, q_id_col: str = "q_id",
           question_col: str = "question", embed=None) -> DataFrame:
    """``(q_id, question, rank, row_id, doc_id, chunk_id, text, metadata, d2,
    similarity[, prev_rank, overlap, score])``.  Questions whose search yields
    fewer than k hits simply get fewer rows (P6)."""
    embed = embed or (lambda c: hash_embedding(c, dim))
    q = questions.select(F.col(q_id_col).cast("long").alias("q_id"),
                         F.col(question_col).alias("question"))
    qv = q.select("q_id", embed(F.col("question")).alias("embedding"))
    hits = knn.knn_search(vectors, qv, k)
    out = attach_chunks(hits, q, chunks)
    if rerank:
        out = rerank_hits(out)
    return out
