"""Exact k-nearest-neighbour search (squared L2): the "Flat" index, and the
block join that every index shares.

Few queries (at most ``FEW_QUERY_BYTES`` of them, measured) go to the vectors:
every task runs over its vectors once, keeps the best k rows per query, and
only these rows move.  Beyond that bound
vectors and queries are dealt into blocks of bounded size and co-grouped block
by block, so neither side is ever collected or broadcast.  Inside a group one
matrix product gives the candidates and each query keeps at most k rows; the
final ``row_number`` sees ``queries x k x vector blocks`` rows.  No (query,
vector) pair materialises as a row.

Ordering is ``(round(d2, 9), id)``.  The product form only proposes: every
row within its rounding error of the k-th distance (and within the rounding of
the order key) is measured again by difference, however many rows that are, so
copies and near ties come out alike on any partitioning.

Rows with a null vector take no part, as queries or as vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.functions.vectors import similarity_from_d2

#: Bytes of one query block (float64 matrix), and vectors of one vector block.
MAX_QUERY_BLOCK_BYTES = 2 << 20
VECTORS_PER_BLOCK = 20_000
#: Query vectors up to this many bytes travel to the vectors, not both to a shuffle.
FEW_QUERY_BYTES = 8 << 20
# rows of the distance matrix computed at once inside a task, and its entries
_QUERY_SUB_BLOCK = 256
_SUB_BLOCK_ENTRIES = 4 << 20
# entries up to which more rows are taken at once: for less than 1,000 columns
_FEW_ENTRIES = 1000 * _QUERY_SUB_BLOCK
#: Bytes (as doubles) of the vectors or queries of one pack of cells, and the
#: tasks per core that a search by cells is dealt into while packs are smaller.
PACK_BYTES = 32 << 20
PACK_TASKS_PER_CORE = 4
# queries of a pack that look through its cells together: many, since each
# cell costs a call, but few where they ask for many hits, which are held
_PACK_FEWEST_QUERIES, _PACK_MOST_QUERIES, _PACK_HITS = 64, 16_384, 500_000
#: Hits that a group of packs and queries returns, and ids that a group scores
#: again; a group's queries are fewer where each has many.
GROUP_HITS, GROUP_IDS = 1_000_000, 4_000_000
_SCORED_QUERIES = 256
# digits of the order key
_DIGITS = 9


def _flat_vectors(col, dim: int | None) -> tuple[np.ndarray, int]:
    """list<float> Arrow column -> (n, dim) float64 matrix without Python loops."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    values = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if n == 0:
        return values.reshape(0, dim or 0), dim or 0
    d = len(values) // n
    offsets = col.offsets.to_numpy()
    if not np.all(np.diff(offsets) == d):
        raise ValueError("vectors must all have the same dimension")
    if dim is not None and d != dim:
        raise ValueError(f"vector dimension {d} != query dimension {dim}")
    return values.reshape(n, d), d


def first_k(row: np.ndarray, ids: np.ndarray, d2: np.ndarray, k: int):
    """Of ``(row, id, d2)`` triples the best ``k`` of every row, in order."""
    order = np.lexsort((ids, np.round(d2, _DIGITS), row))
    row, ids, d2 = row[order], ids[order], d2[order]
    heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else row
    nth = np.arange(len(row)) - np.repeat(heads, np.diff(np.concatenate((heads, [len(row)]))))
    best = nth < k
    return row[best], ids[best], d2[best]


def sub_block(n: int) -> int:
    """Queries whose distances to ``n`` rows are held at once."""
    n = max(1, n)
    return max(1, min(max(_QUERY_SUB_BLOCK, _FEW_ENTRIES // n), _SUB_BLOCK_ENTRIES // n))


def nearest_rows(q: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int,
                 limit: np.ndarray | None = None):
    """``(query row, id, d2)`` of the ``k`` rows of ``v`` nearest to each row
    of ``q``, ordered by ``(round(d2, 9), id)``.  Where ``limit`` has a query's
    k-th distance so far, rows beyond it are left out unmeasured."""
    out = []
    v_sq = (v * v).sum(axis=1)
    # half of (distance - square of the query) as one product
    sides = np.concatenate([v, v_sq[:, None] / 2], axis=1).T
    step = sub_block(len(ids))
    for lo in range(0, len(q), step):
        part = q[lo:lo + step]
        q_sq = (part * part).sum(axis=1)
        approx = np.concatenate([-part, np.ones((len(part), 1))], axis=1) @ sides
        known = np.full(len(part), np.inf) if limit is None else limit[lo:lo + step]
        if len(ids) > k or np.isfinite(known).any():
            cut = (known - q_sq) / 2
            open_ = np.flatnonzero(~np.isfinite(known))
            if len(open_) and len(ids) > k:
                cut[open_] = np.partition(approx[open_], k - 1, axis=1)[:, k - 1]
            # twice the rounding error of the product form, and one step of the key
            slack = 4e-16 * (v.shape[1] + 8) * (q_sq + v_sq.max()) * 2 + 10.0 ** -_DIGITS
            row, at = np.divmod(np.flatnonzero(approx <= (cut + slack / 2)[:, None]), len(ids))
        else:
            row, at = np.divmod(np.arange(approx.size), max(1, len(ids)))
        d2 = np.zeros(len(row))
        for j in range(q.shape[1]):  # a fixed order of summation
            diff = part[row, j] - v[at, j]
            d2 += diff * diff
        row, found, d2 = first_k(row, ids[at], d2, k)
        out.append((row + lo, found, d2))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def rank_hits(candidates: DataFrame, k: int, id_col: str = "row_id") -> DataFrame:
    """Final top-k per query from per-block candidates (Catalyst plans a partial
    ``WindowGroupLimit`` before the shuffle on ``q_id``)."""
    w = Window.partitionBy("q_id").orderBy(F.round("d2", _DIGITS), F.col(id_col))
    return (candidates.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .withColumn("similarity", similarity_from_d2(F.col("d2")))
            .select("q_id", id_col, "rank", "d2", "similarity"))


def block_search(vectors: DataFrame, queries: DataFrame, kernel, k: int, id_col: str,
                 vectors_per_group: int, queries_per_group: int) -> DataFrame:
    """The block join.  ``vectors (cell, id, payload)`` and ``queries (cell,
    q_id, vector)``: a cell's vectors are cut into blocks of about
    ``vectors_per_group`` and its queries into blocks of ``queries_per_group``;
    each side is repeated over the other side's blocks, so a hot cell only adds
    groups.  ``kernel(cell, query matrix, payload column, ids, k)`` returns
    ``(query row, id, d2)`` arrays.  Only per-cell counts (one row per cell)
    reach the driver."""
    spark = vectors.sparkSession
    v_counts = {r[0]: r[1] for r in vectors.groupBy("cell").count().collect()}
    q_counts = {r[0]: r[1] for r in queries.groupBy("cell").count().collect()}
    rows = [(int(c), max(1, -(-v_counts[c] // vectors_per_group)),
             max(1, -(-n // queries_per_group))) for c, n in q_counts.items() if c in v_counts]
    salts = F.broadcast(spark.createDataFrame(rows, "cell int, _vs int, _qs int"))
    # a cell-partitioned store reads the probed cells only
    v = (vectors.filter(F.col("cell").isin([c for c, *_ in rows])).join(salts, "cell")
         .withColumn("_v", F.pmod(F.xxhash64("id"), F.col("_vs")).cast("int"))
         .withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_qs") - 1)))
         .select("cell", "_v", "_q", "id", "payload"))
    q = (queries.join(salts, "cell")
         .withColumn("_q", F.pmod(F.xxhash64("q_id"), F.col("_qs")).cast("int"))
         .withColumn("_v", F.explode(F.sequence(F.lit(0), F.col("_vs") - 1)))
         .select("cell", "_v", "_q", "q_id", "vector"))

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["q_id", id_col, "d2"]
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()),
                             pa.array([], pa.float64())], names)
        q_mat, _ = _flat_vectors(left.column("vector"), None)
        row, ids, d2 = kernel(left.column("cell")[0].as_py(), q_mat, right.column("payload"),
                              right.column("id").to_numpy(), k)
        return pa.table([pa.array(left.column("q_id").to_numpy()[row], pa.int64()),
                         pa.array(ids, pa.int64()), pa.array(d2, pa.float64())], names)

    schema = T.StructType([T.StructField("q_id", T.LongType()), T.StructField(id_col, T.LongType()),
                           T.StructField("d2", T.DoubleType())])
    by = ("cell", "_v", "_q")
    found = q.groupBy(*by).cogroup(v.groupBy(*by)).applyInArrow(block, schema)
    return rank_hits(found, k, id_col)


class Packs:
    """Cells ``0..n-1`` dealt into packs: runs of neighbouring cells with about
    ``rows`` vectors together; a cell with more has packs of its own, among
    which its vectors are spread by id.  ``pieces`` is 0 for an empty cell."""

    def __init__(self, counts: dict[int, int], n_cells: int, rows: int):
        self.first, self.pieces = np.zeros(n_cells, np.int64), np.zeros(n_cells, np.int64)
        low, held = [], rows
        for cell in range(n_cells):
            n = counts.get(cell, 0)
            if not n:
                continue
            self.pieces[cell] = max(1, -(-n // rows))
            if held + n > rows:
                self.first[cell], held = len(low), n
                low += [cell] * int(self.pieces[cell])
            else:
                self.first[cell], held = len(low) - 1, held + n
        self.low = np.array(low, np.int64)
        last = {int(f + p - 1): c for c, (f, p) in enumerate(zip(self.first, self.pieces)) if p}
        self.high = np.array([last.get(i, low[i]) + 1 for i in range(len(low))], np.int64)

    def deal(self, vectors: DataFrame, per_pack: dict[int, int], cells) -> DataFrame:
        """``vectors (cell, id, payload)`` of the probed ``cells``, once for each
        block of queries (``per_pack``) that their pack meets."""
        spark = vectors.sparkSession
        cells = [int(c) for c in cells]
        where = spark.createDataFrame([(c, int(self.first[c]), int(self.pieces[c])) for c in cells],
                                      "cell int, _first int, _pieces int")
        blocks = spark.createDataFrame(list(per_pack.items()), "pack int, _qs int")
        # a cell-partitioned store reads the probed cells only
        return (vectors.filter(F.col("cell").isin(cells)).join(F.broadcast(where), "cell")
                .withColumn("pack", (F.col("_first") + F.pmod(F.xxhash64("id"), F.col("_pieces")))
                            .cast("int")).join(F.broadcast(blocks), "pack")
                .withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_qs") - 1)))
                .select("pack", "_q", "cell", "id", "payload"))


def _dealt_queries(sent: DataFrame, per_pack: dict[int, int]) -> DataFrame:
    blocks = sent.sparkSession.createDataFrame(list(per_pack.items()), "pack int, _qs int")
    return (sent.join(F.broadcast(blocks), "pack")
            .withColumn("_q", F.pmod(F.xxhash64("q_id"), F.col("_qs")).cast("int")).drop("_qs"))


def block_rows(spark, n: int, dim: int, most: int | None = None) -> int:
    """Rows of one block of ``n``: few blocks, so that little is repeated, but
    enough for the cores, and none over ``PACK_BYTES``."""
    sides = max(1, int(np.ceil(np.sqrt(PACK_TASKS_PER_CORE * spark.sparkContext.defaultParallelism))))
    rows = max(1, min(PACK_BYTES // (8 * max(1, dim)), -(-n // sides)))
    return min(rows, most) if most else rows


def queries_together(k: int) -> int:
    """Queries of a pack that look for ``k`` hits together."""
    return max(_PACK_FEWEST_QUERIES, min(_PACK_MOST_QUERIES, _PACK_HITS // k))


def sent_to_packs(queries: DataFrame, packs: Packs, wanted) -> tuple[DataFrame, DataFrame]:
    """``(sent, counts)`` of ``queries (q_id, vector, limit)``.

    ``wanted(vectors, limits)`` marks the cells that each query looks through (a
    boolean matrix).  A query goes once to every pack that holds one of them:
    ``sent (pack, q_id, vector, cells, n)`` has a bit for each cell of the pack.
    ``counts (kind, key, n)`` are queries by cell (kind 0) and by pack (1)."""
    kind = queries.schema["vector"].dataType.simpleString()

    def looked(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, _QUERY_SUB_BLOCK):
                part = batch.slice(lo, _QUERY_SUB_BLOCK)
                vecs, _ = _flat_vectors(part.column("vector"), None)
                want = wanted(vecs, part.column("limit").to_numpy(zero_copy_only=False))
                yield part, want & (packs.pieces > 0)[None]

    def send(batches):
        for part, want in looked(batches):
            for pack, (a, b) in enumerate(zip(packs.low, packs.high)):
                mine = want[:, a:b]
                rows = np.flatnonzero(mine.any(axis=1))
                if not len(rows):
                    continue
                bits = [x.tobytes() for x in np.packbits(mine[rows], axis=1)]
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), pack, np.int32)), part.column("q_id").take(take),
                     part.column("vector").take(take), pa.array(bits, pa.binary()),
                     pa.array(mine[rows].sum(axis=1), pa.int64())],
                    ["pack", "q_id", "vector", "cells", "n"])

    def count(batches):
        by_cell = np.zeros(len(packs.pieces), np.int64)
        by_pack = np.zeros(len(packs.low), np.int64)
        for _, want in looked(batches):
            by_cell += want.sum(axis=0)
            for pack, (a, b) in enumerate(zip(packs.low, packs.high)):
                by_pack[pack] += want[:, a:b].any(axis=1).sum()
        for k, n in enumerate((by_cell, by_pack)):
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)),
                                              pa.array(at, pa.int64()), pa.array(n[at])],
                                             ["kind", "key", "n"])

    sent = queries.mapInArrow(send, f"pack int, q_id long, vector {kind}, cells binary, n long")
    counts = queries.mapInArrow(count, "kind int, key long, n long").groupBy("kind", "key").agg(
        F.sum("n").alias("n"))
    return sent, counts


def pack_search(vectors: DataFrame, queries: DataFrame, packs: Packs, wanted, kernel, k: int,
                id_col: str, queries_per_group: int) -> tuple[DataFrame, DataFrame]:
    """The block join by cells: ``(candidates, sent)``.  ``vectors (cell, id,
    payload)`` meet ``queries (q_id, vector, limit)`` pack by pack, a pack's
    queries in blocks of ``queries_per_group``, or fewer where ``k`` hits of each
    would be over ``GROUP_HITS``.  What is exchanged follows the
    packs and blocks, not the cells that a query looks through.
    ``kernel(cell, query matrix, payload column, ids, k, limit)`` returns ``(query
    row, id, d2)`` arrays and may leave out what lies beyond a query's k-th
    distance so far; ``candidates (q_id, id, d2, pack)`` are the best ``k`` of
    every query and pack.  Counts by cell and by pack reach the driver."""
    sent, counts = sent_to_packs(queries, packs, wanted)
    found = {0: {}, 1: {}}
    for r in counts.collect():
        found[r["kind"]][r["key"]] = r["n"]
    step = queries_together(k)
    if queries_per_group * k > GROUP_HITS:
        queries_per_group = min(queries_per_group, max(1, GROUP_HITS // k // step) * step)
    per_pack = {p: max(1, -(-n // queries_per_group)) for p, n in found[1].items()}
    schema = T.StructType([T.StructField("q_id", T.LongType()), T.StructField(id_col, T.LongType()),
                           T.StructField("d2", T.DoubleType()), T.StructField("pack", T.IntegerType())])

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["q_id", id_col, "d2", "pack"]
        if not len(left) or not len(right):
            return schema_table(names)
        pack = left.column("pack")[0].as_py()
        low = int(packs.low[pack])
        right = right.sort_by("cell")
        cell = right.column("cell").to_numpy()
        heads = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        ends = np.append(heads[1:], len(cell))
        payload, ids = right.column("payload").combine_chunks(), right.column("id").to_numpy()
        q_mat, _ = _flat_vectors(left.column("vector"), None)
        bits = left.column("cells").to_pylist()
        out = []
        for lo in range(0, len(q_mat), step):
            part = q_mat[lo:lo + step]
            want = np.unpackbits(np.frombuffer(b"".join(bits[lo:lo + step]), np.uint8)
                                 .reshape(len(part), -1), axis=1)
            hits = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            limit, held = np.full(len(part), np.inf), 0
            for a, b in zip(heads, ends):
                rows = np.flatnonzero(want[:, cell[a] - low])
                if not len(rows):
                    continue
                row, found_ids, d2 = kernel(int(cell[a]), part[rows], payload.slice(a, b - a),
                                            ids[a:b], k, limit[rows])
                row = rows[row]
                near = d2 <= limit[row]  # a query's k-th hit so far, and ties of its key
                hits.append((row[near], found_ids[near], d2[near]))
                held += int(near.sum())
                if held >= k * len(part):
                    hits, held = [first_k(*map(np.concatenate, zip(*hits)), k)], 0
                    row, _, d2 = hits[0]
                    full = np.bincount(row, minlength=len(part)) == k
                    worst = np.zeros(len(part))
                    np.maximum.at(worst, row, d2)
                    limit = np.where(full, worst + 10.0 ** (1 - _DIGITS), np.inf)
            row, found_ids, d2 = first_k(*map(np.concatenate, zip(*hits)), k)
            out.append((row + lo, found_ids, d2))
        row, found_ids, d2 = map(np.concatenate, zip(*out))
        return pa.table([left.column("q_id").combine_chunks().take(pa.array(row)),
                         pa.array(found_ids, pa.int64()), pa.array(d2, pa.float64()),
                         pa.array(np.full(len(row), pack, np.int32))], names)

    def schema_table(names):
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()),
                         pa.array([], pa.float64()), pa.array([], pa.int32())], names)

    by = ("pack", "_q")
    q = _dealt_queries(sent.drop("n"), per_pack)
    v = packs.deal(vectors, per_pack, sorted(found[0]))
    return q.groupBy(*by).cogroup(v.groupBy(*by)).applyInArrow(block, schema), sent


def rescore(vectors: DataFrame, asked: DataFrame, packs: Packs, k: int, id_col: str,
            queries_per_group: int) -> DataFrame:
    """``(q_id, id, d2)``: of the ids that each row of ``asked (pack, q_id,
    vector, ids)`` names among its pack's ``vectors (cell, id, payload)``, the
    ``k`` nearest, measured as in the exact search.  A group has at most about
    ``queries_per_group`` queries and ``GROUP_IDS`` ids."""
    per_pack = {r["pack"]: max(1, -(-r["n"] // queries_per_group), -(-r["ids"] // GROUP_IDS))
                for r in asked.groupBy("pack").agg(F.count(F.lit(1)).alias("n"), F.sum(
                    F.size("ids")).alias("ids")).collect()}

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(left) and len(right):
            ids = right.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            mat, dim = _flat_vectors(right.column("payload"), None)
            ids, mat = ids[order], mat[order]
            q_mat, _ = _flat_vectors(left.column("vector"), dim)
            lists = left.column("ids").combine_chunks()
            for lo in range(0, len(q_mat), _SCORED_QUERIES):
                part = lists.slice(lo, _SCORED_QUERIES)
                wanted = part.flatten().to_numpy()
                row = np.repeat(np.arange(lo, lo + len(part)), np.diff(part.offsets.to_numpy()))
                a, n = np.searchsorted(ids, wanted), 0
                n = np.searchsorted(ids, wanted, "right") - a
                row, at = np.repeat(row, n), np.repeat(a, n) + np.arange(n.sum()) - np.repeat(
                    np.cumsum(n) - n, n)
                d2 = np.zeros(len(row))
                for j in range(dim):  # the fixed order of the exact search
                    d2 += (q_mat[row, j] - mat[at, j]) ** 2
                out.append(first_k(row, ids[at], d2, k))
        row, best, d2 = map(np.concatenate, zip(*out))
        return pa.table([left.column("q_id").combine_chunks().take(pa.array(row)) if len(row)
                         else pa.array([], pa.int64()), pa.array(best, pa.int64()),
                         pa.array(d2, pa.float64())], ["q_id", id_col, "d2"])

    by = ("pack", "_q")
    cells = np.flatnonzero([p and any(int(f) + i in per_pack for i in range(int(p)))
                            for f, p in zip(packs.first, packs.pieces)])
    return _dealt_queries(asked, per_pack).groupBy(*by).cogroup(
        packs.deal(vectors, per_pack, cells).groupBy(*by)).applyInArrow(
        block, f"q_id long, `{id_col}` long, d2 double")


def flat_kernel(cell, q_mat, payload, ids, k, limit=None):
    vecs, _ = _flat_vectors(payload, q_mat.shape[1])
    return nearest_rows(q_mat, vecs, ids, k, limit)


def running_search(vectors: DataFrame, q_ids: np.ndarray, q_mat: np.ndarray, k: int,
                   id_col: str) -> DataFrame:
    """Top-k of a few queries by one pass over ``vectors (id, payload)``: a task
    keeps a running top-k over its whole partition, partial results merge in
    ``rank_hits``.  No vector is exchanged.  Partial lists are mergeable because
    ``nearest_rows`` measures in a fixed order and ``first_k`` orders totally."""
    packed = vectors.sparkSession.sparkContext.broadcast((q_ids, q_mat))

    def run(batches):
        ids, mat = packed.value
        row, best, d2 = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            vecs, _ = _flat_vectors(batch.column("payload"), mat.shape[1])
            new = nearest_rows(mat, vecs, batch.column("id").to_numpy(), k)
            row, best, d2 = first_k(*(np.concatenate(x) for x in zip((row, best, d2), new)), k)
        yield pa.RecordBatch.from_arrays([pa.array(ids[row], pa.int64()), pa.array(best, pa.int64()),
                                          pa.array(d2, pa.float64())], ["q_id", id_col, "d2"])

    return rank_hits(vectors.mapInArrow(run, f"q_id long, `{id_col}` long, d2 double"), k, id_col)


def few_queries(queries: DataFrame, max_bytes: int):
    """``(ids, matrix)`` of ``queries (q_id, vector)`` if they take at most
    ``max_bytes``, else None."""
    n, dim = queries.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if 8 * n * max(1, dim or 1) > max_bytes:
        return None
    t = queries.toArrow()
    mat, _ = _flat_vectors(t.column("vector"), None)
    return t.column("q_id").to_numpy(), mat


def queries_per_block(queries: DataFrame, vec_col: str, max_block_bytes: int) -> int:
    """Queries that fit a block of ``max_block_bytes``."""
    dim = queries.select(F.max(F.size(vec_col))).first()[0] or 1
    return max(1, max_block_bytes // (8 * max(1, dim)))


def knn_search(vectors: DataFrame, queries: DataFrame, k: int = 5, *,
               id_col: str = "row_id", vec_col: str = "embedding",
               q_id_col: str = "q_id", q_vec_col: str = "embedding",
               max_block_bytes: int = MAX_QUERY_BLOCK_BYTES,
               vectors_per_group: int = VECTORS_PER_BLOCK,
               few_query_bytes: int = FEW_QUERY_BYTES) -> DataFrame:
    """Top-k rows of ``vectors`` for every row of ``queries``:
    ``(q_id, <id_col>, rank, d2, similarity)``; rank is 1-based.  Query vectors
    of at most ``few_query_bytes`` go to the vectors; more meet them in blocks.
    Both ways give the same rows."""
    if k < 1:
        raise ValueError("k must be >= 1")
    one_cell = F.lit(0).alias("cell")
    v = vectors.filter(F.col(vec_col).isNotNull()).select(
        one_cell, F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("payload"))
    q = queries.filter(F.col(q_vec_col).isNotNull()).select(
        one_cell, F.col(q_id_col).cast("long").alias("q_id"), F.col(q_vec_col).alias("vector"))
    few = few_queries(q.select("q_id", "vector"), few_query_bytes)
    if few is not None:
        return running_search(v.select("id", "payload"), *few, k, id_col)
    return block_search(v, q, flat_kernel, k, id_col, vectors_per_group,
                        queries_per_block(q, "vector", max_block_bytes))
