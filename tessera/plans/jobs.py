"""Job entry points (one function per original command-line tool).

Each takes DataFrames or paths and returns DataFrames; nothing is collected
to the driver except bounded query blocks and small reports.

* ``build_corpus``  — text files (or binary documents + extractor) -> skip done
  -> split -> appended to a ``split=train|eval`` table, with counts of the run.
* ``token_windows`` — documents -> ids (vocabulary or plug-in tokenizer) ->
  overlapping padded windows -> JSON lines.
* ``build_store`` / ``search`` / ``answer`` / ``benchmark`` / ``compare`` —
  the retrieval side.
* ``perplexity``    — held-out chunks -> scorer -> macro average.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators import chunking, corpus, prompts, reports, retrieval, vocab
from tessera.operators import perplexity as ppl
from tessera.operators import store as vstore
from tessera.session import scratch_path
from tessera.sources import files, sinks
from tessera.sources.tables import NOTHING_WRITTEN


def finished(spark: SparkSession, out_dir: str) -> DataFrame:
    """``(stem)`` of the documents that ``out_dir`` holds (none if it is new)."""
    try:
        return spark.read.parquet(out_dir).select("stem")
    except AnalysisException as e:
        # no folder yet, or one without files; anything else is not "nothing done"
        if e.getCondition() not in NOTHING_WRITTEN:
            raise
        return spark.createDataFrame([], "stem string")


def add_to_corpus(docs: DataFrame, out_dir: str, done: DataFrame | None = None,
                  ratio: float = 0.9, seed=42, exact: bool = True) -> DataFrame:
    """One incremental run over ``docs (stem, path, text)``: what ``out_dir`` or
    ``done`` already has is skipped, the rest is split and appended; finished
    documents are never rewritten.  Returns ``(processed, skipped)``."""
    spark = docs.sparkSession
    have = finished(spark, out_dir)
    if done is not None:
        have = have.unionByName(done.select("stem"))
    have = have.distinct().checkpoint(eager=True)
    counts = corpus.skip_counts(docs, have, "stem").checkpoint(eager=True)
    todo = corpus.skip_done(docs, have, "stem")
    split = (corpus.split_exact if exact else corpus.split_fraction)(todo, "stem", ratio, seed)
    sinks.append_split(split.select("stem", "path", "text", "split"), out_dir)
    return counts


def run_corpus(spark: SparkSession, source_dir: str, out_dir: str, done: DataFrame | None = None,
               ratio: float = 0.9, seed=42, exact: bool = True, binary_extractor=None) -> DataFrame:
    """Job A over a folder; returns ``(processed, skipped, failed)``.  Binary
    documents are extracted once, into the shared scratch folder; those that
    the extractor rejects are counted and tried again by the next run."""
    failed = 0
    if binary_extractor is not None:
        binary = files.read_binary(spark, source_dir).withColumn(
            "stem", corpus.file_stem(F.col("path")))
        have = finished(spark, out_dir)
        have = have if done is None else have.unionByName(done.select("stem"))
        n_all = binary.count()
        todo = corpus.skip_done(binary, have.distinct(), "stem")
        pages_dir = scratch_path(spark, "pages")
        files.extract_pages(todo, binary_extractor).write.parquet(pages_dir)
        pages = spark.read.parquet(pages_dir)
        failed = pages.filter(F.col("error").isNotNull()).count()
        docs = corpus.concat_pages(pages.filter(F.col("error").isNull()), "path", "page_no", "text")
        docs = docs.withColumn("stem", corpus.file_stem(F.col("path")))
        got = add_to_corpus(docs, out_dir, None, ratio, seed, exact).first()
        return spark.createDataFrame(
            [(got["processed"], n_all - got["processed"] - failed, failed)],
            "processed long, skipped long, failed long")
    docs = files.read_texts(spark, source_dir, ".txt").withColumn(
        "stem", corpus.file_stem(F.col("path")))
    got = add_to_corpus(docs, out_dir, done, ratio, seed, exact)
    return got.withColumn("failed", F.lit(failed).cast("long"))


def build_corpus(spark: SparkSession, source_dir: str, out_dir: str, done: DataFrame | None = None,
                 ratio: float = 0.9, seed=42, exact: bool = True,
                 binary_extractor=None) -> DataFrame:
    """Job A, then the sizes ``(split, count)`` of the whole corpus; input
    files are never moved, finished documents never touched."""
    run_corpus(spark, source_dir, out_dir, done, ratio, seed, exact, binary_extractor)
    return spark.read.parquet(out_dir).groupBy("split").count()


def token_windows(docs: DataFrame, out_dir: str | None = None, max_length: int = 2048,
                  stride: int = 512, make_tokenizer=None, pad_id: int | None = None,
                  key: str = "doc_id") -> DataFrame:
    """Job B: ``(key, chunk_id, input_ids, labels)`` windows, padded."""
    if make_tokenizer is None:
        ids = vocab.encode(docs, vocab.build_vocabulary(docs, key=key), key=key)
        pad = vocab.PAD_ID if pad_id is None else pad_id
    else:
        ids = vocab.encode_with(docs.select(key, "text"), make_tokenizer).select(key, "input_ids")
        pad = pad_id if pad_id is not None else vocab.pad_id_of(make_tokenizer())
    win = chunking.token_windows(ids, "input_ids", max_length, stride, 10, pad, keep=(key,))
    if out_dir:
        sinks.write_windows(win, out_dir)
    return win


def build_store(docs: DataFrame, root: str, index_type: str = "Flat", **options) -> DataFrame:
    """Job C (see ``operators.store.build_store``)."""
    return vstore.build_store(docs, root, index_type, **options)


def search(spark: SparkSession, root: str, questions: DataFrame, k: int = 5,
           rerank: bool = False, dim: int | None = None, embed=None,
           nprobe: int | None = None, make_embedder=None) -> DataFrame:
    """Questions ``(q_id, question)`` against a saved store.  The embedder must
    be the store's: ``embed`` (Column -> Column) or the plug-in factory
    ``make_embedder`` (see ``embed.embed_with``)."""
    st = vstore.load_store(spark, root)
    q = questions.select(F.col("q_id").cast("long"), "question")
    qv = vstore.embedded(q, "question", embed, make_embedder, dim or st.manifest["dim"]).select(
        "q_id", "embedding")
    hits = vstore.search_store(st, qv, k, nprobe)
    out = retrieval.attach_chunks(hits, q, st.chunks)
    if rerank:
        from tessera.operators.rerank import rerank as rr
        out = rr(out)
    return out


def answer(spark: SparkSession, root: str, questions: DataFrame, make_generator, k: int = 5,
           rerank: bool = True, show_retrieved: bool = False, make_embedder=None,
           **params) -> DataFrame:
    """R7 over a question table: ``question, answer, performance{...}
    [, retrieved_chunks]``."""
    n_q = questions.count()
    hits, per_q = reports.timed_hits(search(spark, root, questions, k, rerank,
                                            make_embedder=make_embedder), n_q)
    ctx = prompts.contexts(hits)
    cells = (questions.select("q_id", "question").join(ctx, "q_id", "left")
             .withColumn("prompt", prompts.rag_prompt("question", "context")))
    ans = reports.answer_table(cells, make_generator, per_q, **params)
    out = ans.select("q_id", "question", "answer", F.struct(
        "total_time", "retrieval_time", "generation_time").alias("performance"))
    if show_retrieved:
        item = F.struct(F.col("rank"), F.col("text"), F.col("metadata"),
                        F.col("score" if rerank else "similarity").alias("similarity"))
        nested = hits.groupBy("q_id").agg(F.sort_array(F.collect_list(item)).alias("_r"))
        nested = nested.select("q_id", F.transform("_r", lambda s: s.dropFields("rank"))
                               .alias("retrieved_chunks"))
        out = out.join(nested, "q_id", "left")
    return out


def benchmark(spark: SparkSession, root: str, questions: DataFrame, make_generator,
              k_values=reports.K_VALUES, make_embedder=None, **params) -> DataFrame:
    """One search at max(k), the 8-column grid report."""
    n_q = questions.count()
    hits, per_q = reports.timed_hits(search(spark, root, questions, max(k_values),
                                            make_embedder=make_embedder), n_q)
    g = reports.benchmark_grid(questions, hits, make_generator, per_q, k_values, **params)
    return schemas.conform(g, schemas.BENCHMARK_REPORT)


def compare(spark: SparkSession, root: str, questions: DataFrame, make_rag_generator,
            make_plain_generator, k: int = 5, rerank: bool = True, make_embedder=None,
            **params) -> DataFrame:
    """RAG answers vs a second model on the plain prompt; ``params`` are
    generation options for both."""
    rag = answer(spark, root, questions, make_rag_generator, k, rerank,
                 make_embedder=make_embedder, **params).select(
        "q_id", "question", "answer", F.col("performance.total_time").alias("time"))
    plain = questions.select("q_id", "question", prompts.plain_prompt("question").alias("prompt"))
    ft = reports.answer_table(plain, make_plain_generator, 0.0, **params).select(
        "q_id", "answer", F.col("generation_time").alias("time"))
    return schemas.conform(reports.compare_models(rag, ft), schemas.COMPARISON_REPORT)


def extract(docs: DataFrame, make_generator, instruction: str | None = None,
            key: str = "doc_id", **params) -> DataFrame:
    """R4 + R5: the triple-extraction instruction over every document, one
    generation each: ``(key, prompt, answer, generation_time)``.  The reply is
    returned as text (never parsed, like the original tool)."""
    p = prompts.extract_prompt("text") if instruction is None else \
        prompts.extract_prompt("text", instruction)
    cells = docs.select(key, p.alias("prompt"))
    out = reports.answer_table(cells, make_generator, 0.0, **params)
    return out.select(key, "prompt", "answer", "generation_time")


def run_prompt_file(spark: SparkSession, path: str, make_generator, **params) -> DataFrame:
    """S7 + R5: a whole prompt file as one prompt, answered once."""
    cells = files.read_prompt(spark, path).withColumn("doc_id", F.lit(0).cast("long"))
    out = reports.answer_table(cells, make_generator, 0.0, **params)
    return out.select("prompt", "answer", "generation_time")


def perplexity(train: DataFrame, held_out: DataFrame, chunk_words: int = 1500,
               make_scorer=None) -> DataFrame:
    """Job E: ``(n_chunks, perplexity)``; the default scorer is the unigram model."""
    chunks = ppl.eval_chunks(held_out, chunk_words)
    losses = (ppl.unigram_losses(train, chunks) if make_scorer is None
              else ppl.plugin_losses(chunks, make_scorer))
    return ppl.macro_perplexity(ppl.chunk_perplexity(losses))


__all__ = ["build_corpus", "token_windows", "build_store", "search", "answer", "benchmark",
           "compare", "extract", "run_prompt_file", "perplexity", "retrieval"]
