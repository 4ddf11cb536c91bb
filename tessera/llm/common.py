"""Shared plumbing of the training-data operators.

* ``session(spark)`` readies a session: package shipped by value, bounded
  Arrow batches, the shared checkpoint folder.
* ``worker_cache`` keeps read-only tables and bounded caches alive for the
  life of a Python worker, so a tokenizer is loaded once per worker and not
  once per task or batch.
* ``add_arrow_columns`` appends columns computed by an Arrow batch function
  without letting user columns clash with the operator's own names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ARROW_BYTES, ARROW_ROWS, prepare, scratch_path  # noqa: F401


def session(spark: SparkSession) -> SparkSession:
    return prepare(spark)


def worker_cache(key, make: Callable):
    """``make()`` once per Python worker and key.  The store lives in a
    synthetic module, because this package travels by value and its own
    globals are rebuilt for every task.  It holds one operator's tables: a
    worker that Spark reuses for another operator first gives back the memory
    of the one before."""
    import ctypes
    import gc
    import sys
    import types

    store = sys.modules.get("_tessera_worker_cache")
    if store is None:
        store = sys.modules["_tessera_worker_cache"] = types.ModuleType("_tessera_worker_cache")
        store.items = {}
    if key not in store.items:
        if store.items:
            store.items.clear()
            gc.collect()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass
        store.items[key] = make()
    return store.items[key]


def add_arrow_columns(df: DataFrame, inputs: dict[str, Column], outputs: T.StructType,
                      fn: Callable[[Iterator], Iterator]) -> DataFrame:
    """``df`` plus ``outputs``, computed by ``fn`` from the columns ``inputs``.

    ``fn`` maps an iterator of Arrow struct arrays with the fields of
    ``inputs`` to an iterator of Arrow struct arrays of ``outputs``, row for
    row.  A column of ``df`` that has the name of an output is replaced; every
    other column passes through untouched and is never sent to Python.
    """
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf

    def run(batches):
        yield from fn(batches)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = arrow_udf(run, outputs)
    arg = F.struct(*[c.alias(n) for n, c in inputs.items()])
    own = {f.name.lower() for f in outputs}
    tmp = f"_out_{uuid.uuid4().hex[:8]}"
    wide = df.withColumn(tmp, udf(arg))
    kept = [wide[_quoted(c)] for c in df.columns if c.lower() not in own]
    return wide.select(*kept, *[F.col(tmp)[f.name].alias(f.name) for f in outputs])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(df: DataFrame, name: str) -> Column:
    return df[_quoted(name)]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage with a replicated table, so a lost executor costs one task."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` as a URI that Spark's
    readers and writers resolve on every node."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    return scratch_path(spark, name)


def tokenizer_file(name: str) -> str:
    """Where the installed public vocabulary ``name`` lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
