"""Partition invariance: registered queries give the same rows whatever the
input partitioning and shuffle width (SURVEY section 5, item 4)."""

import pytest

from sf_paths import SF_SMALL
from tessera.plans.registry import QUERIES

NAMES = ["word_chunks", "token_windows", "search_rerank", "split_exact", "shard_assign",
         "collate_batches", "perplexity_unigram", "knn_cells"]


@pytest.fixture
def dealt(spark, monkeypatch):
    """Deal every input table over as many partitions as the test asks for."""
    from tessera.plans import registry
    plain = registry.load_table
    parts = {"n": 1}
    monkeypatch.setattr(registry, "load_table",
                        lambda s, base, name: plain(s, base, name).repartition(parts["n"]))
    monkeypatch.setattr(registry, "spread", lambda df: df)
    return parts


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_for_1_4_17_partitions(spark, dealt, name):
    results = []
    keys = {"spark.sql.shuffle.partitions": None, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for n in (1, 4, 17):
            dealt["n"] = n
            for k, v in keys.items():
                spark.conf.set(k, v or str(n))
            results.append(sorted(tuple(r) for r in QUERIES[name](spark, SF_SMALL).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert results[0] == results[1] == results[2]
