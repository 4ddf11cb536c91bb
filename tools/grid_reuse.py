"""R8 design check: the benchmark grid from one search at max(k) against the
original recipe (a separate search for every (k, rerank) cell).  Both give
the same answers; prints the seconds of each.

usage: python tools/grid_reuse.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import prompts, reports, retrieval  # noqa: E402
from tessera.plans import registry as R  # noqa: E402
from tessera.session import get_session  # noqa: E402


def six_searches(spark, sf_dir):
    vectors, chunks = R._store(spark, sf_dir)
    qs = R._questions(spark, sf_dir)
    parts = []
    for k in reports.K_VALUES:
        for rr in reports.RERANK_VALUES:
            h = retrieval.search(vectors, chunks, qs, k, dim=R.DIM, rerank=rr)
            ctx = prompts.contexts(h)
            cells = (qs.join(ctx, "q_id", "left")
                     .withColumn("prompt", prompts.rag_prompt("question", "context"))
                     .withColumn("k", F.lit(k)).withColumn("rerank", F.lit(rr)))
            parts.append(reports.answer_table(cells.select("q_id", "k", "rerank", "prompt"),
                                              R._stub))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("q_id", "k", "rerank", "answer")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    R.QUERIES["benchmark_grid"](spark, "/root/testdata/sf0.001").collect()   # warm-up
    t0 = time.perf_counter()
    once = sorted(tuple(r) for r in R.QUERIES["benchmark_grid"](spark, sf_dir)
                  .select("q_id", "k", "rerank", "answer").collect())
    t1 = time.perf_counter()
    six = sorted(tuple(r) for r in six_searches(spark, sf_dir).collect())
    t2 = time.perf_counter()
    print(f"rows {len(once)}  one search: {t1 - t0:.2f} s  six searches: {t2 - t1:.2f} s  "
          f"same answers: {once == six}")


if __name__ == "__main__":
    main()
