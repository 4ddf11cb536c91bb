"""The data side of training, as table operators.

* ``assign_batches`` (D2): consecutive batches of ``size`` rows in a given
  order; the incomplete last batch can be dropped (train) or kept (eval).
* ``collate`` (D1): pad every row to the longest in its batch — ids with the
  pad id, labels with -100, attention mask with 0.
* ``shard`` (D3): a seeded per-epoch permutation padded by wrap-around to a
  multiple of ``world``; position p goes to worker p mod world.
* ``step_plan`` (D4): which batches close an optimizer update under gradient
  accumulation.

Global ordinals come from ``global_index`` (distributed sort + per-partition
offsets); groups are batches, bounded by ``size``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.ordering import global_index, md5_order_key

LABEL_PAD = -100


def _batch_columns(df: DataFrame, n: int, size: int, drop_last: bool) -> DataFrame:
    out = (df.withColumn("batch_id", F.floor(F.col("_i") / size).cast("long"))
           .withColumn("slot", F.pmod(F.col("_i"), F.lit(size)).cast("int")))
    if drop_last:
        out = out.filter(F.col("batch_id") < F.lit(n // size))
    return out.drop("_i")


def assign_batches(df: DataFrame, order: list, size: int = 2, drop_last: bool = True) -> DataFrame:
    """Batches of ``size`` rows in any order; sorts the rows themselves.  For
    numbered items of a document (windows) use ``assign_item_batches``."""
    if size < 1:
        raise ValueError("batch size must be >= 1")
    idx = global_index(df, order, "_i")
    return _batch_columns(idx, idx.count(), size, drop_last)


def number_documents(df: DataFrame, order: list, name: str = "doc_row") -> DataFrame:
    """``df`` plus a row number in ``order``: a key for documents whose ids are
    null or repeated.  The numbered table is checkpointed once, so everything
    derived from it (counts, windows) agrees on the numbers."""
    return global_index(df, order, name).checkpoint(eager=True)


def item_offsets(counts: DataFrame, key: str = "doc_id", count_col: str = "n") -> DataFrame:
    """``(key, offset)``: how many items stand before each document when
    documents are in key order.  Only ``(key, count)`` rows are sorted."""
    ranked = global_index(counts.select(key, F.col(count_col).cast("long").alias("_n")),
                          [F.col(key)], "_r")
    # prefix sums in blocks: sums of blocks of keys, then inside each block
    block = ranked.withColumn("_b", F.floor(F.col("_r") / 100_000))
    sums = block.groupBy("_b").agg(F.sum("_n").alias("_s"))
    before = sums.select("_b", (F.sum("_s").over(Window.orderBy("_b")) - F.col("_s")).alias("_o"))
    inside = F.sum("_n").over(Window.partitionBy("_b").orderBy("_r")) - F.col("_n")
    return (block.withColumn("_in", inside).join(before, "_b")
            .select(key, (F.col("_o") + F.col("_in")).cast("long").alias("offset")))


def assign_item_batches(docs: DataFrame, items: DataFrame, size: int = 2, drop_last: bool = True,
                        key: str = "doc_id", ordinal: str = "chunk_id",
                        count_col: str = "n") -> DataFrame:
    """Batches over the numbered items of documents in ``(key, ordinal)`` order.

    ``docs (key, n)`` says how many items a document has; the wide ``items``
    are only joined with their document's offset, never sorted.  ``key`` tells
    rows apart; ids that may be null or repeated are numbered first
    (``number_documents``), and counts and items carry the number."""
    if size < 1:
        raise ValueError("batch size must be >= 1")
    shared = docs.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull())
    if shared.limit(1).collect():
        raise ValueError(f"{key} is null or repeated: number the rows first (number_documents) "
                         "and pass that number as key")
    n = docs.agg(F.sum(count_col)).first()[0] or 0
    idx = items.join(item_offsets(docs, key, count_col), key).withColumn(
        "_i", F.col("offset") + F.col(ordinal)).drop("offset")
    return _batch_columns(idx, n, size, drop_last)


def batch_table(spark, n_rows: int, size: int, drop_last: bool = True) -> DataFrame:
    """``(batch_id, n_rows)`` of ``n_rows`` rows cut into batches: arithmetic on
    the count alone."""
    whole, rest = divmod(n_rows, size)
    n = whole + (1 if rest and not drop_last else 0)
    return spark.range(n).select(F.col("id").alias("batch_id"), F.when(
        F.col("id") < whole, F.lit(size)).otherwise(F.lit(rest)).cast("long").alias("n_rows"))


def collate(df: DataFrame, batch_col: str = "batch_id", ids_col: str = "input_ids",
            labels_col: str = "labels", pad_id: int = 0,
            mask_col: str = "attention_mask") -> DataFrame:
    """Pads ids, labels and the row's own mask (ones where it has none)."""
    longest = F.max(F.size(ids_col)).over(Window.partitionBy(batch_col))
    short = longest - F.size(ids_col)
    labels = F.col(labels_col) if labels_col in df.columns else F.col(ids_col)
    ones = F.array_repeat(F.lit(1), F.size(ids_col))
    mask = F.coalesce(F.col(mask_col), ones) if mask_col in df.columns else ones
    return (df.withColumn("_short", short)
            .withColumn(mask_col, F.concat(mask, F.array_repeat(F.lit(0), F.col("_short"))))
            .withColumn("labels", F.concat(labels, F.array_repeat(F.lit(LABEL_PAD), F.col("_short"))))
            .withColumn(ids_col, F.concat(F.col(ids_col),
                                          F.array_repeat(F.lit(pad_id), F.col("_short"))))
            .drop("_short"))


def shard(df: DataFrame, key: str, world: int, seed=0, epoch: int = 0) -> DataFrame:
    """``(df..., shard, position)``: rows are repeated from the start, as often
    as it takes, until every worker has as many."""
    if world < 1:
        raise ValueError("world size must be >= 1")
    idx = global_index(df.withColumn("_k", md5_order_key(f"{seed}:{epoch}", key)),
                       [F.col("_k"), F.col(key)], "_i").drop("_k")
    n = idx.count()
    total = -(-n // world) * world
    if n:
        idx = idx.withColumn("_i", F.explode(F.sequence(F.col("_i"), F.lit(total - 1), F.lit(n))))
    return (idx.withColumn("shard", F.pmod(F.col("_i"), F.lit(world)).cast("int"))
            .withColumn("position", F.floor(F.col("_i") / world).cast("long"))
            .drop("_i"))


def step_plan(batches: DataFrame, batch_col: str = "batch_id", accumulation: int = 8,
              first_step_updates: bool = True) -> DataFrame:
    """Adds ``update_after`` and ``step``.  ``first_step_updates`` follows the
    loop that tests ``b % accum == 0`` (an update right after batch 0, the
    rest carry on); otherwise the update closes every ``accum`` batches."""
    b = F.col(batch_col)
    if first_step_updates:
        upd = F.pmod(b, F.lit(accumulation)) == 0
        step = F.floor((b + F.lit(accumulation - 1)) / accumulation)
    else:
        upd = F.pmod(b + 1, F.lit(accumulation)) == 0
        step = F.floor(b / accumulation)
    return batches.withColumn("update_after", upd).withColumn("step", step.cast("long"))
