"""Driver contract: every registered query runs; SQL twins exist by name."""

import __spark_entry__ as entry

from sf_paths import SF_SMALL


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "score" in df.columns


def test_oracle_keys_are_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_all_queries_run_small(spark):
    for name, q in entry.queries().items():
        df = q(spark, SF_SMALL)
        assert df.columns, name
        df.write.format("noop").mode("overwrite").save()
