"""Repeatable orders and global ordinals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def md5_order_key(seed, key) -> Column:
    """``md5(seed || ':' || key)`` — a permutation key that is the same on any
    partitioning (``rand(seed)`` is not)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")
                          if isinstance(key, str) else key.cast("string")))


def md5_fraction(seed, key) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of ``md5_order_key``."""
    return F.conv(F.substring(md5_order_key(seed, key), 1, 8), 16, 10).cast("double") \
        / F.lit(4294967296.0)


def global_index(df: DataFrame, order: list, name: str = "idx") -> DataFrame:
    """Attach a 0-based ordinal in the total order ``order`` (which must be a
    strict order for a repeatable result).

    Scale path: range-partitioned sort, then every row's ordinal is its
    partition's offset (a tiny per-partition count table, broadcast) plus its
    position inside the partition.  No single task ever sees all rows.  The
    sorted table is checkpointed so counts and rows come from one sort.
    """
    spark = df.sparkSession
    from tessera.session import checkpoint_dir
    checkpoint_dir(spark)
    sorted_df = (df.orderBy(*order)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id())
                 .checkpoint(eager=True))
    # monotonically_increasing_id = (partition id << 33) + position in partition
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1))).fillna(0, ["_off"]).select("_pid", "_off")
    return (sorted_df.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.expr("_mid & 8589934591"))
            .drop("_pid", "_mid", "_off"))


# hexadecimal digits that one histogram of ``order_boundary`` resolves, and the
# keys that are sorted once so few are left
_DIGITS_PER_ROUND = 3
_LAST_KEYS = 16 ** _DIGITS_PER_ROUND


def order_boundary(keys: DataFrame, hash_col: str, key: str, rank_of) -> Row | None:
    """The row of 0-based rank ``rank_of(n)`` in the order ``(hash_col, key)``
    of the ``n`` rows of ``keys``; null hashes come last, and a rank among or
    behind them gives None.

    ``hash_col`` holds hexadecimal digests.  A histogram of their first digits
    tells the bin in which the rank lies, the next one splits that bin, until
    at most 4,096 keys are left.  Each round reads the key column and moves
    4,096 counts a task; nothing is sorted or copied, and a table of 10^11 rows
    takes three rounds."""
    prefix, skipped, rank, last = "", 0, None, False
    while not last:
        width = len(prefix) + _DIGITS_PER_ROUND
        inside = keys.filter(F.col(hash_col).startswith(prefix)) if prefix else keys
        bins = sorted(((r["b"], r["n"]) for r in inside.groupBy(
            F.substring(hash_col, 1, width).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()),
            key=lambda bin_: (bin_[0] is None, bin_[0]))
        if rank is None:
            rank = rank_of(sum(n for _, n in bins))
        for prefix, n in bins:
            if rank < skipped + n:
                break
            skipped += n
        else:
            return None
        if prefix is None:
            return None
        # equal digests end the search as well: their keys are equal as texts
        last = n <= _LAST_KEYS or len(prefix) < width
    left = keys.filter(F.col(hash_col).startswith(prefix)).select(hash_col, key)
    if n > _LAST_KEYS:
        return left.agg(F.min(hash_col).alias(hash_col), F.min(key).alias(key)).first()
    return left.orderBy(hash_col, key).limit(rank - skipped + 1).collect()[-1]


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy per-row work (chunking, embedding, splitting) at least
    one task per core.  A small table stored as one row group reads as a
    single partition; a large input already has many splits and is returned
    untouched (no shuffle of the data at scale)."""
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
