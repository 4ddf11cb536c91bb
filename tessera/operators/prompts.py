"""Context, prompt templates and echo stripping as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import strip_prefix

# Prompt layouts a user of the original scripts gets.
RAG_TEMPLATE_HEAD = (
    "You are a helpful assistant. Answer the question based on the provided context.\n"
    "If the context doesn't contain relevant information, say \"I don't have enough "
    "information to answer this question.\"\n\nContext:\n"
)
RAG_TEMPLATE_QUESTION = "\n\nQuestion: "
RAG_TEMPLATE_TAIL = "\n\nAnswer:"
PLAIN_TEMPLATE_HEAD = "Question: "
PLAIN_TEMPLATE_TAIL = "\n\nAnswer:"
EXTRACT_INSTRUCTION = (
    "Extract knowledge triples (subject, relation, object) from the text below. "
    "Return ONLY a list of Python tuples like [(subject, relation, object), ...]."
)
EXTRACT_TEXT_HEAD = "\n\nText: "
CONTEXT_ITEM = "[Document {rank}]: {text}"
CONTEXT_SEPARATOR = "\n\n"


def contexts(hits: DataFrame, key: str = "q_id", rank_col: str = "rank",
             text_col: str = "text") -> DataFrame:
    """``(key, context)`` — ``[Document i]: text`` in rank order joined by a
    blank line.  One group per query, at most k rows each."""
    item = F.concat(F.lit("[Document "), F.col(rank_col).cast("string"), F.lit("]: "),
                    F.col(text_col))
    return (hits.groupBy(key)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(rank_col), item.alias("t"))))
                 .alias("_c"))
            .select(key, F.array_join(F.transform("_c", lambda s: s["t"]),
                                      CONTEXT_SEPARATOR).alias("context")))


def rag_prompt(question, context) -> Column:
    """R2 (an empty context when a question has no hits)."""
    q = F.col(question) if isinstance(question, str) else question
    c = F.col(context) if isinstance(context, str) else context
    return F.concat(F.lit(RAG_TEMPLATE_HEAD), F.coalesce(c, F.lit("")),
                    F.lit(RAG_TEMPLATE_QUESTION), q, F.lit(RAG_TEMPLATE_TAIL))


def plain_prompt(question) -> Column:
    """The prompt of the model without retrieval."""
    q = F.col(question) if isinstance(question, str) else question
    return F.concat(F.lit(PLAIN_TEMPLATE_HEAD), q, F.lit(PLAIN_TEMPLATE_TAIL))


def extract_prompt(text, instruction: str = EXTRACT_INSTRUCTION) -> Column:
    """Triple-extraction instruction over a whole document."""
    t = F.col(text) if isinstance(text, str) else text
    return F.concat(F.lit(instruction), F.lit(EXTRACT_TEXT_HEAD), t)


def strip_echo(output, prompt) -> Column:
    """Drop an echoed prompt from a generation and strip the rest."""
    return strip_prefix(output, prompt)
