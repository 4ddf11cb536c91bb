"""Registered queries: one per operator family of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole driver
tables.  Parameters are the module constants below (fixed, documented), and
every computed column carries the alias its SQL twin in ``oracle.py`` uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.ordering import md5_order_key, spread
from tessera.functions.text import words
from tessera.operators import (batching, chunking, corpus, embed, ivf, knn, prompts, reports,
                               retrieval, splitter, vocab)
from tessera.operators import perplexity as ppl
from tessera.operators import store as vstore
from tessera.operators.generate import DigestExtract
from tessera.operators.rerank import term_overlap
from tessera.plans import jobs
from tessera.session import prepare, scratch_path
from tessera.sources import files as file_sources
from tessera.sources import loaders, sinks
from tessera.sources.tables import load_table
from tessera.streaming import ingest

# Fixed parameters of the registered queries.
K = 5


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return load_table(spark, sf_dir, name)


def q_knn_flat(spark, sf_dir):
    """V4 + T3 + P9: exact 5-NN of every vector among all vectors."""
    emb = _t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    hits = knn.knn_search(emb, emb.withColumnRenamed("vec_id", "q_id"), K, id_col="vec_id")
    return hits.select("q_id", "vec_id", "rank", F.round("d2", 6).alias("d2"),
                       F.round("similarity", 6).alias("similarity"))


QUERIES = {
    "knn_flat": q_knn_flat,
}


# ---------------------------------------------------------------- chunk family

EVAL_CHUNK_WORDS = 1500      # C3 size of the perplexity script
WINDOW_MAX, WINDOW_STRIDE = 128, 32   # C2 at test scale (words as tokens)
MIN_WINDOW = 10
SEARCH_CHUNK_WORDS = 64     # chunk size of the text store
DIM = 64                    # hash-embedding width
SIM_THRESHOLD = 0.35


def _docs(spark, sf_dir):
    return spread(_t(spark, sf_dir, "documents"))


def _questions(spark, sf_dir):
    return _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("q_id"),
                                                 F.col("text").alias("question"))


def q_word_chunks(spark, sf_dir):
    """C3 + P5 + W1: 1,500-word chunks of every document."""
    ch = chunking.word_chunks(_docs(spark, sf_dir), EVAL_CHUNK_WORDS)
    return ch.select("doc_id", F.col("chunk_id").cast("int").alias("chunk_id"),
                     F.size(words("text")).alias("n_words"),
                     F.length("text").alias("n_chars"), "text")


def _encoded(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return vocab.encode(docs, vocab.build_vocabulary(docs))


def q_vocab_build(spark, sf_dir):
    """C4: vocabulary of the corpus (ids by count desc, token asc)."""
    return vocab.build_vocabulary(_docs(spark, sf_dir))


def q_vocab_encode(spark, sf_dir):
    """C4: every document encoded with the corpus vocabulary."""
    enc = _encoded(spark, sf_dir)
    return enc.select("doc_id", F.size("input_ids").alias("n_tokens"), "input_ids")


def q_vocab_encode_cold(spark, sf_dir):
    """C4: as ``vocab_encode``, with a hot table of 4 KB: most words of the
    vocabulary lie beyond it and are joined."""
    docs = _docs(spark, sf_dir)
    enc = vocab.encode(docs, vocab.build_vocabulary(docs), max_broadcast_bytes=4096)
    return enc.select("doc_id", F.size("input_ids").alias("n_tokens"), "input_ids")


def q_token_windows(spark, sf_dir):
    """C2 + P4 + W3: overlapping token windows (words as tokens)."""
    win = chunking.token_windows(_encoded(spark, sf_dir), "input_ids", WINDOW_MAX,
                                 WINDOW_STRIDE, MIN_WINDOW)
    return win.select("doc_id", F.col("chunk_id").cast("int").alias("chunk_id"),
                      F.size("input_ids").alias("n_tokens"), "input_ids")


def q_token_windows_padded(spark, sf_dir):
    """C2 + P12 + P13: padded windows, labels = ids, default mask."""
    win = chunking.token_windows(_encoded(spark, sf_dir), "input_ids", WINDOW_MAX,
                                 WINDOW_STRIDE, MIN_WINDOW, pad_id=vocab.PAD_ID)
    win = chunking.default_attention_mask(win)
    return win.select("doc_id", F.col("chunk_id").cast("int").alias("chunk_id"),
                      "input_ids", "labels", "attention_mask")


def q_truncate_tokens(spark, sf_dir):
    """T5: ids cut to the model limit before a model sees them."""
    enc = _encoded(spark, sf_dir)
    return enc.select("doc_id", chunking.truncate("input_ids", 512).alias("input_ids"),
                      F.size(chunking.truncate("input_ids", 512)).alias("n_tokens"))


def q_recursive_chunks(spark, sf_dir):
    """Recursive character splitter, 400 / 50."""
    ch = splitter.recursive_chunks(_docs(spark, sf_dir), 400, 50)
    return ch.select("doc_id", F.col("chunk_id").cast("int").alias("chunk_id"),
                     F.length("text").alias("n_chars"), "text")


# ---------------------------------------------------------------- vectors
def _round_vec(c):
    return F.transform(c, lambda x: F.round(x, 6))


def q_hash_embed(spark, sf_dir):
    """V1 + V3: unit hash embedding of every document."""
    docs = _docs(spark, sf_dir)
    return docs.select("doc_id", _round_vec(embed.hash_embedding("text", DIM)).alias("embedding"))


def q_l2_normalize(spark, sf_dir):
    """V3: unit-length vectors."""
    emb = _t(spark, sf_dir, "embeddings")
    return embed.normalize(emb.select("vec_id", "embedding")).select(
        "vec_id", _round_vec(F.col("embedding")).alias("embedding"))


def q_vector_norms(spark, sf_dir):
    """L2 norm of every vector."""
    from tessera.functions.vectors import l2_norm
    emb = _t(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.round(l2_norm("embedding"), 6).alias("norm"))


def q_mean_pool(spark, sf_dir):
    """A5: mean of the vectors of each label."""
    emb = _t(spark, sf_dir, "embeddings")
    pooled = embed.mean_pool(emb.select("label", F.col("embedding").alias("vec")), "label",
                             "vec", None)
    return pooled.select("label", _round_vec(F.col("pooled")).alias("pooled"))


def q_knn_similarity_filter(spark, sf_dir):
    """V4 + P9 + P6: the 5-NN of every vector kept only above a similarity."""
    emb = _t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    hits = knn.knn_search(emb, emb.withColumnRenamed("vec_id", "q_id"), K, id_col="vec_id")
    hits = hits.filter((F.round("similarity", 9) >= SIM_THRESHOLD) & (F.col("vec_id") != F.col("q_id")))
    return hits.select("q_id", "vec_id", "rank", F.round("similarity", 6).alias("similarity"))


# ---------------------------------------------------------------- search
def _store(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    chunks = retrieval.chunk_table(docs, SEARCH_CHUNK_WORDS)
    # embedded once; the search's passes read the written vectors
    root = scratch_path(spark, "chunk-vectors")
    retrieval.word_chunk_vectors(docs, SEARCH_CHUNK_WORDS, DIM).write.parquet(root)
    return spark.read.parquet(root), chunks


def _search(spark, sf_dir, k=K, rerank=False):
    vectors, chunks = _store(spark, sf_dir)
    return retrieval.search(vectors, chunks, _questions(spark, sf_dir), k, dim=DIM,
                            rerank=rerank)


def q_search_text(spark, sf_dir):
    """V9 + J1 + P9: top-5 chunks of every benchmark question."""
    h = _search(spark, sf_dir)
    return h.select("q_id", "rank", "doc_id", "chunk_id",
                    F.col("metadata.source").alias("source"),
                    F.round("similarity", 6).alias("similarity"))


def q_search_rerank(spark, sf_dir):
    """V9 + V10 + W2 + T4: search followed by the lexical rerank."""
    h = _search(spark, sf_dir, rerank=True)
    return h.select("q_id", "rank", "prev_rank", "doc_id", "chunk_id", "overlap",
                    F.round("similarity", 6).alias("similarity"),
                    F.round("score", 6).alias("score"))


def q_rerank_overlap(spark, sf_dir):
    """Shared distinct words of question and hit."""
    h = _search(spark, sf_dir)
    return h.select("q_id", "doc_id", "chunk_id",
                    F.size(F.array_distinct(words(F.lower("question")))).alias("n_query_terms"),
                    term_overlap(F.col("question"), F.col("text")).alias("overlap"))


def _contexts(spark, sf_dir, rerank=True):
    h = _search(spark, sf_dir, rerank=rerank)
    ctx = prompts.contexts(h)
    return _questions(spark, sf_dir).join(ctx, "q_id", "left")


def q_rag_context(spark, sf_dir):
    """The context block of every question."""
    return _contexts(spark, sf_dir).select("q_id", F.coalesce("context", F.lit("")).alias("context"))


def q_rag_prompt(spark, sf_dir):
    """R2: the retrieval prompt of every question."""
    c = _contexts(spark, sf_dir)
    return c.select("q_id", prompts.rag_prompt("question", "context").alias("prompt"))


def q_plain_prompt(spark, sf_dir):
    """The prompt without retrieval."""
    return _questions(spark, sf_dir).select("q_id", prompts.plain_prompt("question").alias("prompt"))


def q_extract_prompt(spark, sf_dir):
    """The extraction prompt over every document."""
    return _docs(spark, sf_dir).select("doc_id", prompts.extract_prompt("text").alias("prompt"))


def q_retrieved_nested(spark, sf_dir):
    """Hits as a nested array per question, flattened to text for the check."""
    h = _search(spark, sf_dir, rerank=True)
    item = F.struct(F.col("rank"), F.col("text"), F.col("metadata"),
                    F.round("score", 6).alias("similarity"))
    nested = h.groupBy("q_id").agg(F.sort_array(F.collect_list(item)).alias("retrieved_chunks"))
    flat = F.transform("retrieved_chunks", lambda s: F.concat_ws(
        "|", s["rank"].cast("string"), s["metadata"]["source"],
        s["metadata"]["chunk_id"].cast("string"), F.format_string("%.6f", s["similarity"]),
        F.md5(s["text"])))
    return nested.select("q_id", F.size("retrieved_chunks").alias("n_chunks"),
                         F.array_join(flat, ";").alias("retrieved"))


QUERIES.update({
    "word_chunks": q_word_chunks,
    "vocab_build": q_vocab_build,
    "vocab_encode": q_vocab_encode,
    "vocab_encode_cold": q_vocab_encode_cold,
    "token_windows": q_token_windows,
    "token_windows_padded": q_token_windows_padded,
    "truncate_tokens": q_truncate_tokens,
    "recursive_chunks": q_recursive_chunks,
    "hash_embed": q_hash_embed,
    "l2_normalize": q_l2_normalize,
    "vector_norms": q_vector_norms,
    "mean_pool": q_mean_pool,
    "knn_similarity_filter": q_knn_similarity_filter,
    "search_text": q_search_text,
    "search_rerank": q_search_rerank,
    "rerank_overlap": q_rerank_overlap,
    "rag_context": q_rag_context,
    "rag_prompt": q_rag_prompt,
    "plain_prompt": q_plain_prompt,
    "extract_prompt": q_extract_prompt,
    "retrieved_nested": q_retrieved_nested,
})


# ---------------------------------------------------------------- corpus build

SPLIT_RATIO, SPLIT_SEED = 0.9, 42


def q_split_exact(spark, sf_dir):
    """T1 + T2: repeatable permutation, first floor(0.9 n) train."""
    return corpus.split_exact(_docs(spark, sf_dir).select("doc_id"), "doc_id", SPLIT_RATIO,
                              SPLIT_SEED)


def q_split_hash(spark, sf_dir):
    """T2 (scale mode): md5 fraction below 0.9 is train."""
    return corpus.split_fraction(_t(spark, sf_dir, "documents").select("doc_id"), "doc_id",
                                 SPLIT_RATIO, SPLIT_SEED)


def q_split_counts(spark, sf_dir):
    """A4: sizes of both splits."""
    ex = q_split_exact(spark, sf_dir).withColumn("mode", F.lit("exact"))
    fr = q_split_hash(spark, sf_dir).withColumn("mode", F.lit("fraction"))
    return (ex.unionByName(fr).groupBy("mode", "split")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("sum_ids")))


def q_incremental_skip(spark, sf_dir):
    """Documents not finished yet (labelled = finished)."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return corpus.skip_done(docs, _t(spark, sf_dir, "labels"))


def q_skip_counts(spark, sf_dir):
    """A1: processed and skipped counts."""
    return corpus.skip_counts(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


def q_page_concat(spark, sf_dir):
    """Turns of each conversation glued in order, no separator."""
    conv = _t(spark, sf_dir, "conversations")
    out = corpus.concat_pages(conv, "conv_id", "turn", "text")
    return out.select("conv_id", "n_pages", F.length("text").alias("n_chars"), "text")


def q_stem_and_names(spark, sf_dir):
    """P1 + P2: stems and window file names of page paths."""
    pages = _t(spark, sf_dir, "pages").select("page_id", "url")
    out = corpus.names(pages.withColumn("path", F.col("url")), "path")
    return out.select("page_id", "base", "stem",
                      corpus.window_file_name(F.concat(F.col("base"), F.lit(".txt")),
                                              F.col("page_id")).alias("window_name"))


def _meta_chunks(spark, sf_dir):
    ch = chunking.word_chunks(_docs(spark, sf_dir), EVAL_CHUNK_WORDS, keep=("doc_id", "source", "lang"))
    meta = F.struct(F.coalesce(F.col("source"), F.lit("unknown")).alias("source"),
                    F.col("lang").alias("lang"))
    return ch.select("doc_id", F.col("chunk_id").cast("int").alias("chunk_id"), "text",
                     meta.withField("chunk_id", F.col("chunk_id").cast("int")).alias("metadata"))


def q_metadata_merge(spark, sf_dir):
    """P7 + P8: chunk metadata merged with the chunk id."""
    m = _meta_chunks(spark, sf_dir)
    return m.select("doc_id", "chunk_id", F.col("metadata.source").alias("source"),
                    F.col("metadata.lang").alias("lang"),
                    F.col("metadata.chunk_id").alias("meta_chunk_id"))


def q_metadata_json(spark, sf_dir):
    """Chunk records serialised as one JSON array per document and parsed
    back (from_json + posexplode); a round trip must keep every value."""
    m = _meta_chunks(spark, sf_dir)
    rec = F.struct("text", F.col("metadata"))
    per_doc = (m.groupBy("doc_id")
               .agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("chunk_id", rec.alias("r")))),
                                          lambda s: s["r"])).alias("json")))
    schema = "array<struct<text:string,metadata:struct<source:string,lang:string,chunk_id:int>>>"
    parsed = per_doc.select("doc_id", F.posexplode(
        file_sources.parse_metadata_json("json", schema)).alias("pos", "r"))
    return parsed.select("doc_id", F.col("pos").alias("chunk_id"),
                         F.col("r.metadata.chunk_id").alias("meta_chunk_id"),
                         F.col("r.metadata.source").alias("source"),
                         F.length("r.text").alias("n_chars"), F.md5("r.text").alias("text_md5"))


def _export_docs(docs, path):
    """One ``doc<id>.txt`` file per document in one shared folder (K1 layout)."""
    named = docs.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("stem"), "text")
    sinks.export_text_files(named, path)


def _doc_id_from_path(path_col):
    return F.regexp_extract(path_col, r"doc(\d+)\.txt$", 1).cast("long")


def q_text_scan(spark, sf_dir):
    """S1/S2 + K1: documents exported one file per document, scanned back."""
    root = scratch_path(spark, "text-export")
    _export_docs(_docs(spark, sf_dir), root)
    t = file_sources.read_texts(spark, root, ".txt")
    return t.select(_doc_id_from_path(F.col("path")).alias("doc_id"),
                    F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def q_ingest_stream(spark, sf_dir):
    """ST1: two arrivals of files (English first, then the rest) and a re-run;
    every document must land in the sink exactly once."""
    root = scratch_path(spark, "ingest")
    src, sink, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    docs = _docs(spark, sf_dir)
    _export_docs(docs.filter(F.col("lang") == "en"), src)
    ingest.ingest_texts(spark, src, sink, ckpt, recursive=False)
    _export_docs(docs.filter(F.col("lang") != "en"), src)
    ingest.ingest_texts(spark, src, sink, ckpt, recursive=False)
    ingest.ingest_texts(spark, src, sink, ckpt, recursive=False)   # nothing new: no change
    out = spark.read.parquet(sink)
    return out.select(_doc_id_from_path(F.col("path")).alias("doc_id"),
                      F.length("text").alias("n_chars"))


def q_answer_word_counts(spark, sf_dir):
    """A9 + report arithmetic: words of each answer turn and time per word (0
    when an answer has no words); the text's length stands in for the time."""
    conv = _t(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    n = F.size(words("text"))
    return conv.select("conv_id", "turn", n.alias("n_words"),
                       F.round(F.coalesce(F.try_divide(F.length("text").cast("double"),
                                                       n.cast("double")), F.lit(0.0)), 6)
                       .alias("time_per_token"))


def q_strip_echo(spark, sf_dir):
    """A generation that echoes its prompt (previous turn) is cut back."""
    from pyspark.sql.window import Window
    conv = _t(spark, sf_dir, "conversations")
    prev = F.coalesce(F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")), F.lit(""))
    g = conv.select("conv_id", "turn", prev.alias("prompt"), "text")
    out = F.concat(F.col("prompt"), F.lit(" "), F.col("text"))
    return g.select("conv_id", "turn", prompts.strip_echo(out, F.col("prompt")).alias("answer"))


QUERIES.update({
    "split_exact": q_split_exact,
    "split_hash": q_split_hash,
    "split_counts": q_split_counts,
    "incremental_skip": q_incremental_skip,
    "skip_counts": q_skip_counts,
    "page_concat": q_page_concat,
    "stem_and_names": q_stem_and_names,
    "metadata_merge": q_metadata_merge,
    "metadata_json": q_metadata_json,
    "text_scan": q_text_scan,
    "ingest_stream": q_ingest_stream,
    "answer_word_counts": q_answer_word_counts,
    "strip_echo": q_strip_echo,
})


# ---------------------------------------------------------------- answers and reports

STUB_WORDS = 8
GRID_MAX_K = max(reports.K_VALUES)


def _stub():
    return DigestExtract(STUB_WORDS)


def _rag_answers(spark, sf_dir):
    c = _contexts(spark, sf_dir, rerank=True)
    cells = c.select("q_id", "question", prompts.rag_prompt("question", "context").alias("prompt"))
    return reports.answer_table(cells, _stub)


def q_answers(spark, sf_dir):
    """R5 + R7: retrieve (k=5, rerank) -> context -> prompt -> generate -> strip."""
    a = _rag_answers(spark, sf_dir)
    return a.select("q_id", "question", "answer", "n_words")


def q_benchmark_grid(spark, sf_dir):
    """R8 + J2: one search at max(k), 6 grid cells per question (times left
    out of the check; the report has them)."""
    hits = _search(spark, sf_dir, k=GRID_MAX_K)
    g = reports.benchmark_grid(_questions(spark, sf_dir), hits, _stub)
    return g.select("q_id", "k", "rerank", "answer", "n_words")


def _stand_in_time(spark, sf_dir, answers, offset):
    """Stand-in seconds for each answer: ``events.value`` of event
    ``2 * q_id + offset`` (an equi-join from the question side), 0 without one."""
    ev = _t(spark, sf_dir, "events").select(F.col("event_id"), F.col("value").alias("time"))
    keyed = answers.withColumn("event_id", F.col("q_id") * 2 + offset)
    return keyed.join(ev, "event_id", "left").drop("event_id").withColumn(
        "time", F.coalesce("time", F.lit(0.0)))


def q_compare_models(spark, sf_dir):
    """R9 + J5: RAG answers vs the plain-prompt model, times from events."""
    qs = _questions(spark, sf_dir)
    rag = _rag_answers(spark, sf_dir).select("q_id", "question", "answer")
    rag = _stand_in_time(spark, sf_dir, rag, 0)
    ft = reports.answer_table(qs.select("q_id", "question",
                                        prompts.plain_prompt("question").alias("prompt")), _stub)
    ft = _stand_in_time(spark, sf_dir, ft.select("q_id", "question", "answer"), 1)
    rep = reports.compare_models(rag, ft)
    return rep.select("question", "rag_answer", "ft_answer",
                      *[F.round(c, 6).alias(c) for c in ("rag_time", "ft_time", "time_difference",
                                                         "rag_time_per_token", "ft_time_per_token")])


def _chunk_losses(spark, sf_dir):
    docs = corpus.split_fraction(_docs(spark, sf_dir), "doc_id", SPLIT_RATIO, SPLIT_SEED)
    train = docs.filter(F.col("split") == "train")
    chunks = ppl.eval_chunks(docs.filter(F.col("split") == "eval"), EVAL_CHUNK_WORDS)
    return ppl.chunk_perplexity(ppl.unigram_losses(train, chunks))


def q_perplexity_unigram(spark, sf_dir):
    """R10 + A2: macro-average perplexity of the eval split."""
    m = ppl.macro_perplexity(_chunk_losses(spark, sf_dir))
    return m.select("n_chunks", F.round("perplexity", 4).alias("perplexity"))


def q_chunk_perplexity(spark, sf_dir):
    """A3: exp(mean token loss) per eval chunk."""
    c = _chunk_losses(spark, sf_dir)
    return c.select("doc_id", F.col("chunk_id").cast("int").alias("chunk_id"), "n_tokens",
                    F.round("loss", 9).alias("loss"), F.round("perplexity", 4).alias("perplexity"))


def q_extract_answers(spark, sf_dir):
    """R4 + R5 + R6 over every document: the extraction prompt, one generation
    each (stub model reading after the "Text: " marker), echo stripped."""
    docs = _docs(spark, sf_dir)
    cells = docs.select("doc_id", prompts.extract_prompt("text").alias("prompt"))
    out = reports.answer_table(cells, lambda: DigestExtract(STUB_WORDS, marker="Text: "))
    return out.select("doc_id", "answer", "n_words")


# ---------------------------------------------------------------- training data
BATCH_SIZE, WORLD, ACCUM = 8, 3, 8


def _windows(enc):
    return chunking.token_windows(enc, "input_ids", WINDOW_MAX, WINDOW_STRIDE, MIN_WINDOW).select(
        "doc_id", F.col("chunk_id").cast("int").alias("chunk_id"), "input_ids", "labels")


def _window_counts(enc):
    """``(doc_id, n)``: windows of each document."""
    return enc.select("doc_id", F.size(chunking.window_array(
        "input_ids", WINDOW_MAX, WINDOW_STRIDE, MIN_WINDOW)).alias("n"))


def _batches(spark, sf_dir):
    # encoded once: counts and windows read the written ids
    enc = _encoded(spark, sf_dir).checkpoint(eager=True)
    return batching.assign_item_batches(_window_counts(enc).checkpoint(eager=True), _windows(enc),
                                        BATCH_SIZE, drop_last=True)


def q_batch_assign(spark, sf_dir):
    """Batches of 8 windows, incomplete last batch dropped."""
    return _batches(spark, sf_dir).select("doc_id", "chunk_id", "batch_id", "slot")


def q_collate_batches(spark, sf_dir):
    """Windows padded to the longest of their batch."""
    c = batching.collate(_batches(spark, sf_dir))
    return c.select("batch_id", "slot", "input_ids", "labels", "attention_mask")


def q_shard_assign(spark, sf_dir):
    """D3: documents sharded over 3 workers with wrap-around."""
    s = batching.shard(_t(spark, sf_dir, "documents").select("doc_id"), "doc_id", WORLD)
    return s.select("doc_id", "shard", "position")


def q_step_plan(spark, sf_dir):
    """Optimizer updates under accumulation 8."""
    n = _window_counts(_encoded(spark, sf_dir)).agg(F.sum("n")).first()[0] or 0
    b = batching.batch_table(spark, n, BATCH_SIZE, drop_last=True)
    return batching.step_plan(b, "batch_id", ACCUM).select("batch_id", "n_rows", "update_after",
                                                           "step")


QUERIES.update({
    "answers": q_answers,
    "benchmark_grid": q_benchmark_grid,
    "compare_models": q_compare_models,
    "extract_answers": q_extract_answers,
    "perplexity_unigram": q_perplexity_unigram,
    "chunk_perplexity": q_chunk_perplexity,
    "batch_assign": q_batch_assign,
    "collate_batches": q_collate_batches,
    "shard_assign": q_shard_assign,
    "step_plan": q_step_plan,
})


# ---------------------------------------------------------------- approximate search and store

NPROBE_CELLS = 2
RECALL_TARGET = 0.6


def _emb(spark, sf_dir):
    return _t(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def _label_centroids(spark, sf_dir):
    """Fixed cells: the mean vector of each label (deterministic, no training)."""
    pooled = embed.mean_pool(_emb(spark, sf_dir).select("label", F.col("embedding").alias("vec")),
                             "label", "vec", None)
    return pooled.select(F.col("label").cast("int").alias("cell_id"),
                         F.col("pooled").alias("centroid"))


def q_knn_cells(spark, sf_dir):
    """Vectors filed under their nearest label centroid; every vector
    searched as a query inside its 2 nearest cells."""
    cents = _label_centroids(spark, sf_dir).checkpoint(eager=True)
    emb = _emb(spark, sf_dir).select(F.col("vec_id").alias("row_id"), "embedding")
    filed = ivf.assign_cells(emb, cents)
    hits = ivf.search_ivf(filed, cents, emb.withColumnRenamed("row_id", "q_id"), K, NPROBE_CELLS)
    return hits.select("q_id", F.col("row_id").alias("vec_id"), "rank",
                       F.round("d2", 6).alias("d2"))


def _trained(spark, sf_dir):
    emb = _emb(spark, sf_dir).select(F.col("vec_id").alias("row_id"), "embedding")
    cents = ivf.train_centroids(emb).checkpoint(eager=True)
    filed = ivf.assign_cells(emb, cents).checkpoint(eager=True)
    return emb, cents, filed


def q_knn_ivf(spark, sf_dir):
    """V5: k-means cells (nlist = n/10), nprobe 1, exact inside the cell."""
    emb, cents, filed = _trained(spark, sf_dir)
    hits = ivf.search_ivf(filed, cents, emb.withColumnRenamed("row_id", "q_id"), K, 1)
    return hits.select("q_id", F.col("row_id").alias("vec_id"), "rank", F.round("d2", 6).alias("d2"))


def q_knn_pq(spark, sf_dir):
    """V6: IVF + product codes (m=8, 8 bits), asymmetric distances."""
    emb, cents, filed = _trained(spark, sf_dir)
    book = ivf.train_pq(filed, cents, 8, 8).checkpoint(eager=True)
    codes = ivf.encode_pq(filed, cents, book)
    hits = ivf.search_pq(codes, cents, book, emb.withColumnRenamed("row_id", "q_id"), K, 1)
    return hits.select("q_id", F.col("row_id").alias("vec_id"), "rank", F.round("d2", 6).alias("d2"))


def q_knn_recall_target(spark, sf_dir):
    """V7: nprobe calibrated on sample queries until recall@5 >= target."""
    emb, cents, filed = _trained(spark, sf_dir)
    queries = emb.withColumnRenamed("row_id", "q_id")
    sample = queries.orderBy(md5_order_key(SPLIT_SEED, "q_id"), "q_id").limit(
        vstore.CALIBRATION_QUERIES).checkpoint(eager=True)
    nprobe, _ = ivf.calibrate_nprobe(filed, cents, sample, K, RECALL_TARGET)
    hits = ivf.search_ivf(filed, cents, queries, K, nprobe)
    return hits.select("q_id", F.col("row_id").alias("vec_id"), "rank",
                       F.lit(nprobe).alias("nprobe"), F.round("d2", 6).alias("d2"))


def q_store_build(spark, sf_dir):
    """V11 + K3 + K6: build a Flat store of 64-word chunks; summary counts."""
    root = scratch_path(spark, "store")
    s = vstore.build_store(_t(spark, sf_dir, "documents"), root, "Flat", chunker="words",
                           chunk_words=SEARCH_CHUNK_WORDS, dim=DIM)
    return s.select("n_documents", "n_chunks", F.col("dim").cast("int").alias("dim"), "index_type")


def q_store_roundtrip(spark, sf_dir):
    """S6 + V8: the saved store, loaded back, answers like the in-memory search."""
    root = scratch_path(spark, "store")
    vstore.build_store(_t(spark, sf_dir, "documents"), root, "Flat", chunker="words",
                       chunk_words=SEARCH_CHUNK_WORDS, dim=DIM)
    st = vstore.load_store(spark, root)
    h = retrieval.search(st.vectors, st.chunks, _questions(spark, sf_dir), K, dim=DIM)
    return h.select("q_id", "rank", "doc_id", "chunk_id", F.col("metadata.source").alias("source"),
                    F.round("similarity", 6).alias("similarity"))


def q_samples_roundtrip(spark, sf_dir):
    """K2 + S4 + P13: padded windows written as JSON lines without a mask,
    read back with the fixed schema; the default mask is filled in."""
    root = scratch_path(spark, "samples")
    win = chunking.token_windows(_encoded(spark, sf_dir), "input_ids", WINDOW_MAX,
                                 WINDOW_STRIDE, MIN_WINDOW, pad_id=vocab.PAD_ID)
    sinks.write_windows(win.select("doc_id", F.col("chunk_id").cast("int").alias("chunk_id"),
                                   "input_ids", "labels"), root)
    back = file_sources.read_samples(spark, root, keys="doc_id long, chunk_id int")
    return chunking.default_attention_mask(back).select("doc_id", "chunk_id", *[
        F.col(c).cast("array<int>").alias(c) for c in ("input_ids", "labels", "attention_mask")])


QUERIES.update({
    "knn_cells": q_knn_cells,
    "knn_ivf": q_knn_ivf,
    "knn_pq": q_knn_pq,
    "knn_recall_target": q_knn_recall_target,
    "store_build": q_store_build,
    "store_roundtrip": q_store_roundtrip,
    "samples_roundtrip": q_samples_roundtrip,
})


# ---------------------------------------------------------------- further forms

NEAR_COPIES = 24


def q_knn_near_ties(spark, sf_dir):
    """V4 + T3: every question text repeated 1..24 times gives vectors that
    differ in the last bit only; the order is by id among them."""
    qs = _questions(spark, sf_dir)
    copies = qs.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(NEAR_COPIES))))
    vectors = copies.select((F.col("q_id") * 100 + F.col("r")).alias("row_id"), embed.hash_embedding(
        F.repeat(F.concat("question", F.lit(" ")), F.col("r")), DIM).alias("embedding"))
    root = scratch_path(spark, "near-ties")
    vectors.write.parquet(root)
    asked = qs.select("q_id", embed.hash_embedding("question", DIM).alias("embedding"))
    hits = knn.knn_search(spark.read.parquet(root), asked, K)
    return hits.select("q_id", "row_id", "rank", F.round("d2", 6).alias("d2"))


def q_corpus_incremental(spark, sf_dir):
    """E1 + J4 + K5: two runs of the incremental corpus build.  The first sees
    the labelled documents, the second all of them; finished ones stay."""
    from tessera.plans import jobs
    docs = _t(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("stem"),
        F.lit("").alias("path"), "text")
    root = scratch_path(spark, "corpus")
    labelled = docs.join(_t(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    first = jobs.add_to_corpus(labelled, root, ratio=SPLIT_RATIO, seed=SPLIT_SEED).first()
    second = jobs.add_to_corpus(docs, root, ratio=SPLIT_RATIO, seed=SPLIT_SEED).first()
    out = spark.read.parquet(root)
    return out.select("stem", "split", F.md5("text").alias("text_md5"),
                      F.lit(first["processed"]).cast("long").alias("first_processed"),
                      F.lit(second["processed"]).cast("long").alias("second_processed"),
                      F.lit(second["skipped"]).cast("long").alias("second_skipped"))


def q_store_append(spark, sf_dir):
    """V8: a store of the English documents, the others added later, answers
    like a store of all documents."""
    docs = _t(spark, sf_dir, "documents")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    root = scratch_path(spark, "store")
    options = {"chunker": "words", "chunk_words": SEARCH_CHUNK_WORDS}
    vstore.build_store(docs.filter(english), root, "Flat", dim=DIM, **options)
    vstore.add_documents(root, docs.filter(~english), **options)
    st = vstore.load_store(spark, root)
    h = retrieval.search(st.vectors, st.chunks, _questions(spark, sf_dir), K, dim=DIM)
    return h.select("q_id", "rank", "doc_id", "chunk_id", F.col("metadata.source").alias("source"),
                    F.round("similarity", 6).alias("similarity"))


def q_collate_given_mask(spark, sf_dir):
    """Windows that bring their own mask keep it under the padding."""
    b = _batches(spark, sf_dir).withColumn("attention_mask", F.transform(
        "input_ids", lambda x, i: F.when(i % 3 == 2, 0).otherwise(1)))
    return batching.collate(b).select("batch_id", "slot", "attention_mask")


def q_shard_small(spark, sf_dir):
    """D3: more workers than documents; every worker gets one."""
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    return batching.shard(docs, "doc_id", 2 * docs.count() + 1).select("doc_id", "shard", "position")


def q_compare_repeated(spark, sf_dir):
    """Questions asked twice give one report row each time."""
    qs = _questions(spark, sf_dir)
    twice = qs.unionByName(qs.withColumn("q_id", F.col("q_id") + 1_000_000))
    rag = reports.answer_table(twice.select("q_id", "question", prompts.rag_prompt(
        "question", "question").alias("prompt")), _stub)
    ft = reports.answer_table(twice.select("q_id", "question", prompts.plain_prompt(
        "question").alias("prompt")), _stub)
    timed = [t.select("q_id", "question", "answer", (F.col("q_id") * f).alias("time"))
             for t, f in ((rag, 0.5), (ft, 0.25))]
    return reports.compare_models(*timed).select(
        "question", "rag_answer", "ft_answer", F.round("time_difference", 6).alias("time_difference"))


def q_mean_pool_masked(spark, sf_dir):
    """A5 with a mask: every third vector is left out."""
    emb = _t(spark, sf_dir, "embeddings").select(
        "label", F.col("embedding").alias("vec"), (F.col("vec_id") % 3 != 0).cast("int").alias("mask"))
    return embed.mean_pool(emb, "label", "vec", "mask").select(
        "label", _round_vec(F.col("pooled")).alias("pooled"))


def q_split_written(spark, sf_dir):
    """K5: the split written as directories and read back."""
    root = scratch_path(spark, "split")
    docs = corpus.split_fraction(_t(spark, sf_dir, "documents"), "doc_id", SPLIT_RATIO, SPLIT_SEED)
    sinks.write_split(docs.select("doc_id", "n_chars", "split"), root)
    return spark.read.parquet(root).select("doc_id", "n_chars", "split")


def q_report_csv(spark, sf_dir):
    """K4: a report of documents by language, written as CSV and read back."""
    root = scratch_path(spark, "report")
    rep = _t(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.size(words("text"))).alias("n_words"))
    sinks.write_report_csv(rep, root)
    return spark.read.option("header", True).schema("lang string, n_docs long, n_words long").csv(root)


def q_documents_scan(spark, sf_dir):
    """Documents exported as files, scanned recursively with their source."""
    root = scratch_path(spark, "documents")
    _export_docs(_docs(spark, sf_dir), root)
    t = file_sources.read_documents(spark, root)
    return t.select(_doc_id_from_path(F.col("metadata")["source"]).alias("doc_id"),
                    F.md5("text").alias("text_md5"))


def q_chunk_metadata_scan(spark, sf_dir):
    """Chunk metadata written as JSON lines and read with the fixed schema."""
    root = scratch_path(spark, "metadata")
    _meta_chunks(spark, sf_dir).select("text", "metadata").write.json(root)
    back = file_sources.read_chunk_metadata(spark, root, json_array=False)
    return back.select(F.md5("text").alias("text_md5"), F.col("metadata")["source"].alias("source"),
                       F.col("metadata")["chunk_id"].cast("int").alias("chunk_id"))


def q_recursive_chunk_rules(spark, sf_dir):
    """C1 as rules: chunks are short, stand in their document, start in order,
    and keep every word that a chunk can hold.  Every document with a word has
    a row, also where ids repeat or are null and where no chunk came out."""
    size, overlap = 400, 50
    docs = _docs(spark, sf_dir).select("doc_id", "text", F.md5("text").alias("text_md5"))
    ch = splitter.recursive_chunks(docs, size, overlap, keep=("doc_id", "text_md5"))
    # rows alike in id and text have the same chunks, which the set keeps once
    per = ch.groupBy(F.col("doc_id").alias("of_id"), F.col("text_md5").alias("of_md5")).agg(
        F.sort_array(F.collect_set(F.struct("chunk_id", "text"))).alias("c"))
    j = docs.withColumn("text", splitter.line_ends("text")).join(
        per, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_md5") == F.col("of_md5")), "left")
    j = j.filter(F.col("c").isNotNull() | (F.size(words("text")) > 0)).withColumn(
        "c", F.coalesce("c", F.array().cast(per.schema["c"].dataType)))
    body = F.col("text")
    # the first place at or after the former chunk's start; 0 where there is none
    last = F.aggregate("c", F.lit(1), lambda at, s: F.when(
        at > 0, F.position(s["text"], body, at)).otherwise(0))
    # what stands between separators stays whole below the size; longer runs are
    # cut anywhere, and the overlap holds their words of up to its length
    runs = F.array_distinct(F.split(body, "[ \n]+"))
    whole = F.array_join(F.filter(runs, lambda r: F.length(r) < size), " ")
    cut = F.array_join(F.filter(runs, lambda r: F.length(r) >= size), " ")
    fits = F.concat(words(whole), F.filter(words(cut), lambda w: F.length(w) <= overlap))
    kept = F.flatten(F.transform("c", lambda s: words(s["text"])))
    return j.select(
        "doc_id", F.forall("c", lambda s: F.length(s["text"]) <= size).alias("all_short"),
        F.forall("c", lambda s: F.contains(body, s["text"])).alias("all_contained"),
        (last > 0).alias("in_order"),
        (F.size(F.array_except(fits, kept)) == 0).alias("words_kept"))


QUERIES.update({
    "knn_near_ties": q_knn_near_ties,
    "corpus_incremental": q_corpus_incremental,
    "store_append": q_store_append,
    "collate_given_mask": q_collate_given_mask,
    "shard_small": q_shard_small,
    "compare_repeated": q_compare_repeated,
    "mean_pool_masked": q_mean_pool_masked,
    "split_written": q_split_written,
    "report_csv": q_report_csv,
    "documents_scan": q_documents_scan,
    "chunk_metadata_scan": q_chunk_metadata_scan,
    "recursive_chunk_rules": q_recursive_chunk_rules,
})


# ---------------------------------------------------------------- loaders, certified search, ids
ITEM_WORDS = 64             # words of an item in batch_null_repeated
PQ_RECALL_TARGET = 0.9
CALIBRATION_SAMPLE = 100


def q_loader_text(spark, sf_dir):
    """X1 + K1: documents written one file each, read through the text loader."""
    root = scratch_path(spark, "loader-text")
    _export_docs(_docs(spark, sf_dir), root)
    t = loaders.load_pages(spark, root, "text", on_error="raise")
    return t.select(_doc_id_from_path(F.col("path")).alias("doc_id"), "page_no",
                    F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def q_loader_paged(spark, sf_dir):
    """Every conversation written as one file of pages (form feeds),
    read page by page."""
    root = scratch_path(spark, "loader-paged")
    turns = _t(spark, sf_dir, "conversations").filter("text IS NOT NULL")
    one = turns.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]), "\f").alias("text"))
    sinks.export_text_files(one.withColumn("stem", F.concat(F.lit("doc"), F.col("conv_id").cast(
        "string"))), root)
    t = loaders.load_pages(spark, root, "paged_text", on_error="raise")
    return t.select(_doc_id_from_path(F.col("path")).alias("conv_id"), "page_no",
                    F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def q_loader_jsonl(spark, sf_dir):
    """Documents written as JSON lines, read through the JSON-lines loader;
    the keys beside the text are metadata."""
    root = scratch_path(spark, "loader-jsonl")
    _t(spark, sf_dir, "documents").filter("text IS NOT NULL").write.json(root)
    t = loaders.load_pages(spark, root, "jsonl", glob="*.json", on_error="raise")
    m = F.col("metadata")
    return t.select(m["doc_id"].cast("long").alias("doc_id"), m["lang"].alias("lang"),
                    m["n_chars"].cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


def q_knn_ivf_exact(spark, sf_dir):
    """V5 / V7 certified: k-means cells, radius per cell, a per-query stop by the
    triangle inequality; equal to the flat search."""
    emb, cents, filed = _trained(spark, sf_dir)
    hits, _ = ivf.search_ivf_exact(filed, cents, emb.withColumnRenamed("row_id", "q_id"), K)
    return hits.select("q_id", F.col("row_id").alias("vec_id"), "rank",
                       F.round("d2", 6).alias("d2"), F.round("similarity", 6).alias("similarity"))


def q_knn_pq_refined(spark, sf_dir):
    """V6 with refinement: the codes propose, the stored vectors decide; probes
    and candidates follow from the recall measured on a sample of queries."""
    emb, cents, filed = _trained(spark, sf_dir)
    book = ivf.train_pq(filed, cents, 8, 8).checkpoint(eager=True)
    codes = ivf.encode_pq(filed, cents, book).checkpoint(eager=True)
    queries = emb.withColumnRenamed("row_id", "q_id")
    sample = queries.orderBy(md5_order_key(SPLIT_SEED, "q_id"), "q_id").limit(
        CALIBRATION_SAMPLE).checkpoint(eager=True)
    nprobe, expand, _ = ivf.calibrate_refined(codes, filed, cents, book, sample, K,
                                              PQ_RECALL_TARGET)
    hits = ivf.search_pq_refined(codes, filed, cents, book, queries, K, nprobe, expand)
    return hits.select("q_id", F.col("row_id").alias("vec_id"), "rank", F.round("d2", 6).alias("d2"))


def q_batch_null_repeated(spark, sf_dir):
    """D2 over documents whose ids are null or repeated: rows are numbered, and
    counts and items carry the number."""
    raw = _t(spark, sf_dir, "documents").select("doc_id", "text")
    ids = F.when(F.col("doc_id") % 5 != 0, F.floor(F.col("doc_id") / 2)).cast("long")
    docs = raw.withColumn("given_id", ids)
    docs = batching.number_documents(docs, [F.col("given_id").asc_nulls_first(), "doc_id"])
    items = chunking.word_chunks(docs, ITEM_WORDS, keep=("doc_row", "given_id"))
    counts = docs.select("doc_row", F.ceil(F.size(words("text")) / ITEM_WORDS).alias("n"))
    b = batching.assign_item_batches(counts, items, BATCH_SIZE, key="doc_row")
    return b.select(F.col("given_id").alias("doc_id"), F.col("doc_row").cast("long").alias("doc_row"),
                    F.col("chunk_id").cast("int").alias("chunk_id"), "batch_id", "slot",
                    F.md5("text").alias("text_md5"))


def _bigram_chunks(spark, sf_dir):
    docs = corpus.split_fraction(_docs(spark, sf_dir), "doc_id", SPLIT_RATIO, SPLIT_SEED)
    chunks = ppl.eval_chunks(docs.filter(F.col("split") == "eval"), EVAL_CHUNK_WORDS)
    return ppl.chunk_perplexity(ppl.bigram_losses(docs.filter(F.col("split") == "train"), chunks))


def q_perplexity_bigram(spark, sf_dir):
    """R10 + A3: perplexity of every eval chunk under back-off bigrams."""
    return _bigram_chunks(spark, sf_dir).select(
        "doc_id", F.col("chunk_id").cast("int").alias("chunk_id"), "n_tokens",
        F.round("loss", 7).alias("loss"), F.round("perplexity", 3).alias("perplexity"))


# ---------------------------------------------------------------- jobs
def _saved_store(spark, sf_dir):
    root = scratch_path(spark, "store")
    vstore.build_store(_t(spark, sf_dir, "documents"), root, "Flat", chunker="words",
                       chunk_words=SEARCH_CHUNK_WORDS, dim=DIM)
    return root


def q_job_windows(spark, sf_dir):
    """The window job writes JSON lines, which are read again."""
    root = scratch_path(spark, "windows")
    jobs.token_windows(_docs(spark, sf_dir), root, WINDOW_MAX, WINDOW_STRIDE)
    back = file_sources.read_samples(spark, root, keys="doc_id long, chunk_id int")
    return chunking.default_attention_mask(back).select("doc_id", "chunk_id", *[
        F.col(c).cast("array<int>").alias(c) for c in ("input_ids", "labels", "attention_mask")])


def q_job_search(spark, sf_dir):
    """The search job over a saved store, with the rerank."""
    h = jobs.search(spark, _saved_store(spark, sf_dir), _questions(spark, sf_dir), K, rerank=True)
    return h.select("q_id", "rank", "prev_rank", "doc_id", "chunk_id", "overlap",
                    F.round("similarity", 6).alias("similarity"), F.round("score", 6).alias("score"))


def q_job_answer(spark, sf_dir):
    """E5: answers over a saved store; every answer has its seconds and its hits."""
    a = jobs.answer(spark, _saved_store(spark, sf_dir), _questions(spark, sf_dir), _stub, K,
                    show_retrieved=True)
    timed = (F.col("performance.total_time") >= F.col("performance.generation_time")) & \
        (F.col("performance.retrieval_time") > 0)
    return a.select("q_id", "question", "answer", F.size("retrieved_chunks").alias("n_chunks"),
                    timed.alias("timed"))


def q_job_benchmark(spark, sf_dir):
    """The eight-column grid report over a saved store (seconds left out)."""
    g = jobs.benchmark(spark, _saved_store(spark, sf_dir), _questions(spark, sf_dir), _stub)
    return g.select("question", F.col("k").cast("int").alias("k"), "rerank", "answer")


def q_job_compare(spark, sf_dir):
    """Answers over a saved store beside a second model's (seconds left out)."""
    c = jobs.compare(spark, _saved_store(spark, sf_dir), _questions(spark, sf_dir), _stub, _stub, K)
    return c.select("question", "rag_answer", "ft_answer")


def q_job_perplexity(spark, sf_dir):
    """The perplexity job on the hashed split."""
    docs = corpus.split_fraction(_docs(spark, sf_dir), "doc_id", SPLIT_RATIO, SPLIT_SEED)
    m = jobs.perplexity(docs.filter(F.col("split") == "train"),
                        docs.filter(F.col("split") == "eval"), EVAL_CHUNK_WORDS)
    return m.select("n_chunks", F.round("perplexity", 4).alias("perplexity"))


def q_job_extract(spark, sf_dir):
    """R4 + R5: the extraction job over every document."""
    out = jobs.extract(_docs(spark, sf_dir), lambda: DigestExtract(STUB_WORDS, marker="Text: "))
    return out.select("doc_id", F.md5("prompt").alias("prompt_md5"), "answer")


def q_prompt_files(spark, sf_dir):
    """S7 + R5: prompt files, each read whole and answered once."""
    root = scratch_path(spark, "prompts")
    sinks.export_text_files(_questions(spark, sf_dir).select(
        F.concat(F.lit("prompt"), F.col("q_id").cast("string")).alias("stem"),
        prompts.plain_prompt("question").alias("text")), root)
    return jobs.run_prompt_file(spark, root, _stub).select("prompt", "answer")


def q_knn_few_rows(spark, sf_dir):
    """Fewer rows in the index (one mean vector per label) than hits asked
    for; no padding hit is returned."""
    emb = _emb(spark, sf_dir)
    means = embed.mean_pool(emb.select("label", F.col("embedding").alias("vec")), "label", "vec", None)
    hits = knn.knn_search(means.select(F.col("label").cast("long").alias("label"),
                                       F.col("pooled").alias("embedding")).checkpoint(eager=True),
                          emb.select(F.col("vec_id").alias("q_id"), "embedding"), 1000, id_col="label")
    return hits.select("q_id", "label", "rank", F.round("d2", 6).alias("d2"))


def q_store_append_named(spark, sf_dir):
    """V8: a named batch added twice is in the store once."""
    docs = _t(spark, sf_dir, "documents")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    root = scratch_path(spark, "store")
    options = {"chunker": "words", "chunk_words": SEARCH_CHUNK_WORDS}
    vstore.build_store(docs.filter(english), root, "Flat", dim=DIM, **options)
    for _ in range(2):
        vstore.add_documents(root, docs.filter(~english), batch_id="others", **options)
    h = jobs.search(spark, root, _questions(spark, sf_dir), K)
    return h.select("q_id", "rank", "doc_id", "chunk_id", F.col("metadata.source").alias("source"),
                    F.round("similarity", 6).alias("similarity"))


QUERIES.update({
    "job_windows": q_job_windows,
    "job_search": q_job_search,
    "job_answer": q_job_answer,
    "job_benchmark": q_job_benchmark,
    "job_compare": q_job_compare,
    "job_perplexity": q_job_perplexity,
    "job_extract": q_job_extract,
    "prompt_files": q_prompt_files,
    "knn_few_rows": q_knn_few_rows,
    "store_append_named": q_store_append_named,
    "perplexity_bigram": q_perplexity_bigram,
    "loader_text": q_loader_text,
    "loader_paged": q_loader_paged,
    "loader_jsonl": q_loader_jsonl,
    "knn_ivf_exact": q_knn_ivf_exact,
    "knn_pq_refined": q_knn_pq_refined,
    "batch_null_repeated": q_batch_null_repeated,
})
