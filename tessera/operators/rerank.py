"""Lexical rerank of the k hits of each query.

``adjusted = similarity * (1 + 0.1 * overlap)`` where overlap is the number
of distinct lower-cased words shared by query and chunk; hits are reordered
by adjusted score, the previous rank breaking ties (a stable sort).  Works on
the k hits only, never on a larger candidate pool.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import lower_words

# Fixed value: weight of one shared word in the adjusted score.
OVERLAP_WEIGHT = 0.1


def term_overlap(a_text, b_text) -> Column:
    """Size of the intersection of the two word *sets*."""
    return F.size(F.array_intersect(lower_words(a_text), lower_words(b_text)))


def rerank(hits: DataFrame, query_col: str = "question", text_col: str = "text",
           sim_col: str = "similarity", rank_col: str = "rank") -> DataFrame:
    """Adds ``overlap`` and ``score``; ``rank`` becomes the new 1-based rank and
    the old one is kept as ``prev_rank``."""
    scored = (hits.withColumn("overlap", term_overlap(F.col(query_col), F.col(text_col)))
              .withColumn("score", F.col(sim_col) * (F.lit(1.0) + F.lit(OVERLAP_WEIGHT)
                                                      * F.col("overlap"))))
    w = Window.partitionBy("q_id").orderBy(F.round("score", 9).desc(), F.col("prev_rank"))
    return (scored.withColumnRenamed(rank_col, "prev_rank")
            .withColumn(rank_col, F.row_number().over(w)))
