"""Operator 12: Merkle manifest of a dataset by lag and lead windows.

Every row is a leaf, every group (``lang``) a tree of fan-out eight, and the
groups' roots form one more such tree.

* Leaves are written once, then numbered by a distributed sort on (group, id,
  digest); a node's place in its group gives its run (place div 8) and slot.
* Per level one window orders the nodes of a block of whole runs.  Seven lag and
  seven lead columns hold the neighbours at fixed offsets; slot and run length
  mask those of other runs.  What remains are the siblings on the left and on
  the right, and the row in slot 0 hashes own digest and siblings to the parent.
* Levels above the leaves have an eighth of the rows each.  Going down again,
  each node's list of sibling pairs up to the root is one join per level.
* A row's proof hashes these siblings; ``fold`` recomputes the root from any leaf
  along the same pairs.

Windows are cut at ``BLOCK`` places, so no task holds a whole group; the number
of groups is taken as is (their roots go through the same levels).

Defined cases: null columns count as ``-``; a null group is a group of its own
and comes first; null ids come first in a group; equal ids are ordered by
digest, so repeated rows are leaves side by side; extra columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ordering import global_index
from tessera.llm.common import col, written

FAN = 8
#: Places of one window partition: whole runs only.
BLOCK = FAN ** 4
#: Groups up to this many rows (number, size, digest) are broadcast.
BROADCAST_GROUPS = 50_000

# The letters that tampering lowers.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(x: Column) -> Column:
    return F.sha2(x, 256)


def field(x: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    x = x.cast("string")
    return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))


def leaf_digest(df: DataFrame, columns: list[str], text: str | None = None,
                changed: Column | None = None) -> Column:
    return sha(F.concat(*[field(changed if c == text else col(df, c)) for c in columns]))


def siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``grp, place, size, digest``) plus ``slot``, ``left`` and
    ``right`` (the siblings' digests joined) and ``up`` (the parent, slot 0)."""
    w = Window.partitionBy("grp", F.floor(F.col("place") / BLOCK)).orderBy("place")
    slot = F.col("place") % FAN
    length = F.least(F.lit(FAN), F.col("size") - (F.col("place") - slot))
    before = [F.when(slot >= k, F.lag("digest", k).over(w)) for k in range(FAN - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("digest", k).over(w)) for k in range(1, FAN)]
    out = nodes.withColumns({"slot": slot, "left": F.concat_ws("", *before),
                             "right": F.concat_ws("", *after)})
    return out.withColumn("up", F.when(F.col("slot") == 0, sha(F.concat("digest", "right"))))


def parents(level: DataFrame) -> DataFrame:
    """The next level's nodes."""
    return level.filter("slot = 0").select(
        "grp", F.floor(F.col("place") / FAN).alias("place"),
        F.ceil(F.col("size") / FAN).alias("size"), F.col("up").alias("digest"))


def climb(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """``(levels, roots)``: the written levels from the leaves upward, each
    with the groups that have several nodes there, and one root per group."""
    levels, roots = [], nodes.filter("size = 1").select("grp", "digest")
    while True:
        rest = nodes.filter("size > 1")
        height = nodes.agg(F.max("size")).first()[0] or 0
        if height <= 1:
            return levels, roots.withColumnRenamed("digest", "subroot")
        level = written(siblings(rest), f"{name}-{len(levels)}")
        levels.append(level)
        nodes = parents(level)
        roots = roots.unionByName(nodes.filter("size = 1").select("grp", "digest"))


def pair() -> Column:
    return F.struct("left", "right")


def paths(levels: list[DataFrame]) -> DataFrame | None:
    """``grp, place, path`` of the level-1 nodes: sibling pairs up to the
    group's root, lowest first; None if no level lies above the leaves."""
    above = None
    for level in reversed(levels[1:]):
        own = level.select("grp", "place", F.array(pair()).alias("path"))
        if above is not None:
            own = own.withColumn("up_place", F.floor(F.col("place") / FAN)).join(
                above.select("grp", F.col("place").alias("up_place"),
                             F.col("path").alias("more")), ["grp", "up_place"], "left")
            own = own.select("grp", "place", F.concat(
                "path", F.coalesce("more", F.slice("path", 1, 0))).alias("path"))
        above = own
    return above


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along the sibling pairs."""
    return F.aggregate(path, start, lambda d, p: sha(F.concat(p["left"], d, p["right"])))


def proof(path: Column) -> Column:
    return sha(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_GROUPS else df


def manifest(df: DataFrame, columns: list[str], group: str, key: str,
             changed: dict[str, Column] | None = None,
             tampered_where: Column | None = None) -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified`` of
    every row.  ``changed`` (one column) with ``tampered_where`` simulates rows
    altered after the manifest was made."""
    leaf = leaf_digest(df, columns)
    given = leaf
    if changed:
        (name, value), = changed.items()
        given = F.when(tampered_where, leaf_digest(df, columns, name, value)).otherwise(leaf)
    leaves = written(df.select(col(df, group).alias("grp_key"), col(df, key).alias("key"),
                               leaf.alias("digest"), given.alias("given"))
                     .withColumn("row", F.monotonically_increasing_id()), "leaves")
    order = [F.col("grp_key").asc_nulls_first(), F.col("key").asc_nulls_first(), "digest", "row"]
    spread = global_index(leaves, order, "idx")
    groups = spread.groupBy("grp_key").agg(F.min("idx").alias("first"),
                                           F.count(F.lit(1)).alias("size"))
    groups = written(global_index(groups, [F.col("grp_key").asc_nulls_first()], "grp"), "groups")
    n_groups = groups.count()
    known = groups.withColumnRenamed("grp_key", "grp_name")
    nodes = spread.join(small(known, n_groups), F.col("grp_key").eqNullSafe(F.col("grp_name")))
    nodes = written(nodes.select("grp", (F.col("idx") - F.col("first")).alias("place"), "size",
                                 "digest", "given", "key"), "nodes")
    levels, roots = climb(nodes, "level")

    # the groups' roots are the leaves of the last tree
    roots = written(roots, "subroots")
    tops, top = climb(roots.select(F.lit(0).alias("grp"), F.col("grp").cast("long").alias("place"),
                                   F.lit(n_groups).cast("long").alias("size"),
                                   F.col("subroot").alias("digest")), "top")
    root = top.first()
    last = roots.withColumn("root_path", F.array().cast("array<struct<left:string,right:string>>"))
    if tops:
        ways = tops[0].select(F.col("place").alias("grp"), F.array(pair()).alias("here"),
                              F.floor(F.col("place") / FAN).alias("up_place"))
        higher = paths(tops)
        if higher is not None:
            ways = ways.join(higher.select(F.col("place").alias("up_place"), "path"), "up_place",
                             "left")
            ways = ways.withColumn("here", F.concat("here", F.coalesce(
                "path", F.slice("here", 1, 0))))
        last = roots.join(ways.select("grp", F.col("here").alias("root_path")), "grp", "left")
    last = written(last.withColumn("root", F.lit(root["subroot"] if root else None)
                                   .cast("string")), "group-paths")

    # leaves of groups with several rows have siblings; lone leaves have none
    none = F.array().cast("array<struct<left:string,right:string>>")
    if levels:
        low = levels[0].select("grp", "key", F.col("digest").alias("leaf"), "given",
                               F.array(pair()).alias("here"),
                               F.floor(F.col("place") / FAN).alias("run"))
        lone = nodes.filter("size = 1").select("grp", "key", F.col("digest").alias("leaf"),
                                               "given", none.alias("path"))
        above = paths(levels)
        if above is None:
            low = low.withColumnRenamed("here", "path").drop("run")
        else:
            low = low.join(above.withColumnRenamed("place", "run"), ["grp", "run"], "left")
            low = low.select("grp", "key", "leaf", "given", F.concat(
                "here", F.coalesce("path", none)).alias("path"))
        rows = low.unionByName(lone)
    else:
        rows = nodes.select("grp", "key", F.col("digest").alias("leaf"), "given",
                            none.alias("path"))
    rows = rows.join(small(last, n_groups), "grp")
    way = F.concat("path", "root_path")
    folded = fold(F.col("given"), way)
    return rows.select(F.col("key").alias(key), "leaf", "subroot", "root",
                       proof(way).alias("proof_sha256"), folded.alias("folded_root")
                       ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``; a third of the rows, by checksum of the
    id, come back tampered with (text in lower case)."""
    where = F.crc32(col(docs, "doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
                    {"text": F.translate(col(docs, "text"), UPPER, LOWER)},
                    F.coalesce(where, F.lit(False)))


def oracle_sql(levels: int = 8) -> str:
    """DuckDB twin for trees of up to ``8 ^ levels`` leaves."""
    def part(c):
        return (f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, "
                f"'-')")

    def leaf(text):
        return "sha256(" + " || ".join(
            [part("doc_id"), part("source"), part("lang"), part("n_chars"), part(text)]) + ")"

    # CRC-32 bit by bit: every byte takes its bits, lowest first
    crc = ("list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform("
           "range(length(doc_id::VARCHAR)), lambda i: list_transform(range(8), lambda b: "
           "((ascii(substr(doc_id::VARCHAR, i::INTEGER + 1, 1)) >> b::INTEGER) & 1)::BIGINT)))), "
           "lambda c, b: CASE WHEN (xor(c, b) & 1) = 1 THEN xor(c >> 1, 3988292384) "
           "ELSE c >> 1 END)")
    sql = [f"""t AS (SELECT doc_id, lang, {leaf('text')} AS leaf,
  CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")}
    ELSE {leaf('text')} END AS given FROM documents),
n0 AS (SELECT dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
  count(*) OVER (PARTITION BY lang) AS size, leaf AS digest, doc_id, given FROM t)"""]

    def tree(first, tag):
        for k in range(levels):
            src = first if k == 0 else f"{tag}{k}"
            near = "OVER (PARTITION BY grp, place // 8 ORDER BY place ROWS BETWEEN"
            sql.append(f"""{tag}s{k} AS (SELECT grp, place,
  coalesce(string_agg(digest, '') {near} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(digest, '') {near} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {src} WHERE size > 1)""")
            sql.append(f"""{tag}{k + 1} AS (SELECT grp, place // 8 AS place,
  (max(size) + 7) // 8 AS size, sha256(string_agg(digest, '' ORDER BY place)) AS digest
  FROM {src} WHERE size > 1 GROUP BY grp, place // 8)""")
        every = " UNION ALL ".join(
            f"SELECT grp, digest FROM {first if k == 0 else f'{tag}{k}'} WHERE size = 1"
            for k in range(levels + 1))
        sql.append(f"{tag}root AS ({every})")

    tree("n0", "a")
    sql.append("m0 AS (SELECT 0 AS grp, grp AS place, count(*) OVER () AS size, digest FROM aroot)")
    tree("m0", "b")
    path = " || ".join([*(f"coalesce(as{k}.l || as{k}.r, '')" for k in range(levels)),
                        *(f"coalesce(bs{k}.l || bs{k}.r, '')" for k in range(levels))])
    joins = "\n".join(
        [f"LEFT JOIN as{k} ON as{k}.grp = n0.grp AND as{k}.place = n0.place // {8 ** k}"
         for k in range(levels)]
        + [f"LEFT JOIN bs{k} ON bs{k}.place = n0.grp // {8 ** k}" for k in range(levels)])
    folds, cur = [], "given"
    for k, tag in [*((k, "a") for k in range(levels)), *((k, "b") for k in range(levels))]:
        nxt = f"f{tag}{k}"
        folds.append(f"CASE WHEN l{tag}{k} IS NULL THEN {cur} ELSE "
                     f"sha256(l{tag}{k} || {cur} || r{tag}{k}) END AS {nxt}")
        cur = nxt
    cols = ", ".join(f"{t}s{k}.l AS l{t}{k}, {t}s{k}.r AS r{t}{k}"
                     for t in "ab" for k in range(levels))
    sql.append(f"""j AS (SELECT n0.doc_id, n0.digest AS leaf, n0.given, n0.grp,
  sha256({path}) AS proof_sha256, {cols}
  FROM n0 {joins})""")
    prev = "j"
    for i, f in enumerate(folds):
        sql.append(f"k{i} AS (SELECT *, {f} FROM {prev})")
        prev = f"k{i}"
    return ("WITH " + ",\n".join(sql) + f"""
SELECT doc_id, leaf, aroot.digest AS subroot, broot.digest AS root, proof_sha256,
  {cur} AS folded_root, {cur} = broot.digest AS verified
FROM {prev} JOIN aroot ON aroot.grp = {prev}.grp, broot""")
