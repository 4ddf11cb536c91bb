"""Command-line front end: ``python -m tessera <command> [options]``.

Commands mirror the original tools; models are plug-ins named
``module:factory`` (a zero-argument callable).  Without one, the built-in
defaults run (vocabulary encoder, hash embedder, echo stub, unigram scorer).
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import functions as F

from tessera.plans import jobs
from tessera.session import get_session
from tessera.sources import sinks


def _factory(spec: str | None):
    if not spec:
        return None
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def _with_doc_ids(docs):
    """Document ids from the path alone (43 bits of its hash, which the row-id
    layout holds), so a new file changes no other id and stores can grow; two
    paths with one id are an error."""
    ids = docs.withColumn("doc_id", F.pmod(F.xxhash64("path"), F.lit(1 << 43)))
    twice = ids.groupBy("doc_id").agg(F.count_distinct("path").alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ValueError("two paths share a document id; rename one of the files")
    return ids


def _questions(spark, path: str):
    """A parquet table with (q_id, question) or one question per line of text."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path).select(F.col("q_id").cast("long"), "question")
    lines = spark.read.text(path).filter(F.col("value") != "")
    return lines.select(F.monotonically_increasing_id().alias("q_id"),
                        F.col("value").alias("question")).checkpoint(eager=True)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("build-corpus", help="text files -> skip done -> train/eval split")
    c.add_argument("--input-dir", required=True)
    c.add_argument("--output-dir", required=True)
    c.add_argument("--ratio", type=float, default=0.9)
    c.add_argument("--seed", default="42")
    c.add_argument("--pdf-extractor", help="module:factory returning bytes -> [page text]")
    c.add_argument("--done", help="text file or folder: one finished stem per line (what the "
                                  "output folder holds counts as finished anyway)")

    w = sub.add_parser("token-windows", help="documents -> padded overlapping windows (JSONL)")
    w.add_argument("--input-dir", required=True)
    w.add_argument("--output-dir", required=True)
    w.add_argument("--max-length", type=int, default=2048)
    w.add_argument("--stride", type=int, default=512)
    w.add_argument("--tokenizer", help="module:factory returning an object with encode()")

    b = sub.add_parser("build-store", help="documents -> chunks -> vectors -> index")
    b.add_argument("--data-dir", required=True)
    b.add_argument("--output-dir", required=True)
    b.add_argument("--index-type", default="Flat", choices=["Flat", "IVF", "PQ", "HNSW"])
    b.add_argument("--chunk-size", type=int, default=400)
    b.add_argument("--chunk-overlap", type=int, default=50)
    b.add_argument("--embedder", help="module:factory returning f(texts) -> matrix")

    for name in ("search", "answer", "benchmark", "compare"):
        s = sub.add_parser(name)
        s.add_argument("--store", required=True)
        s.add_argument("--questions", required=True)
        if name != "benchmark":  # the grid has its own k values and both rerank forms
            s.add_argument("--k", type=int, default=5)
            s.add_argument("--rerank", action="store_true")
        s.add_argument("--embedder", help="module:factory, the store's own embedder")
        if name != "search":
            s.add_argument("--generator", help="module:factory returning g(prompt, **params)")
            s.add_argument("--temperature", type=float, default=0.1)
        if name == "compare":
            s.add_argument("--second-generator", help="module:factory of the second model")
        s.add_argument("--output", help="folder for the CSV report")

    x = sub.add_parser("extract", help="one generation per document, or for one prompt file")
    x.add_argument("--input-dir", help="folder of text files")
    x.add_argument("--prompt-file", help="a file that is one prompt")
    x.add_argument("--generator", help="module:factory returning g(prompt, **params)")
    x.add_argument("--output", help="folder for the CSV report")

    e = sub.add_parser("perplexity", help="held-out text -> macro-average perplexity")
    e.add_argument("--train-dir", required=True)
    e.add_argument("--eval-dir", required=True)
    e.add_argument("--chunk-words", type=int, default=1500)
    e.add_argument("--scorer", help="module:factory returning f([text]) -> [mean loss]")

    a = p.parse_args(argv)
    spark = get_session(a.master, app=f"tessera-{a.cmd}")
    from tessera.operators.generate import EchoExtract
    from tessera.sources import files

    if a.cmd == "build-corpus":
        done = spark.read.text(a.done).select(F.col("value").alias("stem")) if a.done else None
        out = jobs.run_corpus(spark, a.input_dir, a.output_dir, done, ratio=a.ratio, seed=a.seed,
                              binary_extractor=_factory(a.pdf_extractor))
    elif a.cmd == "token-windows":
        docs = _with_doc_ids(files.read_texts(spark, a.input_dir))
        jobs.token_windows(docs, a.output_dir, a.max_length, a.stride,
                           make_tokenizer=_factory(a.tokenizer))
        out = files.read_samples(spark, a.output_dir).groupBy().count()
    elif a.cmd == "build-store":
        docs = _with_doc_ids(files.read_texts(spark, a.data_dir, recursive=True)).select(
            "doc_id", F.col("path").alias("source"), "text")
        out = jobs.build_store(docs, a.output_dir, a.index_type, chunk_size=a.chunk_size,
                               overlap=a.chunk_overlap, make_embedder=_factory(a.embedder),
                               model=a.embedder or "hash")
    elif a.cmd == "search":
        out = jobs.search(spark, a.store, _questions(spark, a.questions), a.k, a.rerank,
                          make_embedder=_factory(a.embedder))
        out = out.select("q_id", "question", "rank", "similarity", "metadata.source", "text")
    elif a.cmd in ("answer", "benchmark", "compare"):
        gen, qs = _factory(a.generator) or EchoExtract, _questions(spark, a.questions)
        options = {"make_embedder": _factory(a.embedder), "temperature": a.temperature}
        if a.cmd == "answer":
            out = jobs.answer(spark, a.store, qs, gen, a.k, a.rerank, **options)
            out = out.select("q_id", "question", "answer", "performance.*")
        elif a.cmd == "benchmark":
            out = jobs.benchmark(spark, a.store, qs, gen, **options)
        else:
            second = _factory(a.second_generator) or EchoExtract
            out = jobs.compare(spark, a.store, qs, gen, second, a.k, a.rerank, **options)
    elif a.cmd == "extract":
        gen = _factory(a.generator) or EchoExtract
        if bool(a.input_dir) == bool(a.prompt_file):
            p.error("extract takes either --input-dir or --prompt-file")
        if a.prompt_file:
            out = jobs.run_prompt_file(spark, a.prompt_file, gen)
        else:
            docs = _with_doc_ids(files.read_texts(spark, a.input_dir))
            out = jobs.extract(docs, gen).select("doc_id", "answer", "generation_time")
    else:
        train = _with_doc_ids(files.read_texts(spark, a.train_dir))
        held = _with_doc_ids(files.read_texts(spark, a.eval_dir))
        out = jobs.perplexity(train, held, a.chunk_words, _factory(a.scorer))

    if getattr(a, "output", None):
        target = a.output
        if a.cmd in sinks.REPORT_PREFIXES:  # named after index and embedder, like the scripts do
            target = f"{target.rstrip('/')}/" + sinks.report_name(
                f"{a.store.rstrip('/')}/index", a.embedder or "hash", sinks.REPORT_PREFIXES[a.cmd])
        sinks.write_report_csv(out, target)
    else:
        out.show(truncate=80)


if __name__ == "__main__":
    main()
