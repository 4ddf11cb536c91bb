"""Operator 8: quality rules compiled into one Spark projection.

Every measure is a built-in expression over the words and lines of the whole
text; a threshold table (``RULES``) is compiled into one Boolean per rule.
There is no user function, Arrow or Python on the executors, and no shuffle.

Words are runs of characters other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``); lines are cut at ``\\n``.

Defined cases: a null text has no words and no lines (all counts 0, base
failed); an empty or blank text likewise; repeated rows and null ids pass
through one for one; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import let
from tessera.llm.common import col

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``numerator * scale > limit * denominator`` (or ``<`` for ``at_least``)
    rejects a text; an empty ``denominator`` stands for 1.  Integers only, so
    every engine decides alike."""

    name: str
    numerator: str
    denominator: str
    scale: int
    limit: int
    at_least: bool = False


#: Threshold table: length, symbol, stop-word and line ratios.
RULES = (
    Rule("word_length_low", "word_chars", "n_words", 1, 2, at_least=True),
    Rule("word_length_high", "word_chars", "n_words", 1, 40),
    Rule("symbols", "n_symbols", "n_words", 100, 10),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 100, 70),
    Rule("shouted_words", "n_marks", "n_words", 100, 70),
    Rule("stop_words", "n_stop", "n_words", 100, 2, at_least=True),
)

#: Frequent function words of the four languages, lower case.
STOP_WORDS = (
    "the and of to in is that it for with was on as are by this be or an not "
    "le la les de des et un une en est que qui dans pour sur au du il elle pas "
    "der die das und ist von zu den mit auf ein eine im nicht als für dem sie "
    "el los las y es por con para una del se no al su lo como más"
).split()


def _ratio_fails(rule: Rule, count) -> Column:
    """``count(name)`` gives a measure's column."""
    below = count(rule.denominator) if rule.denominator else F.lit(1)
    left, right = count(rule.numerator) * F.lit(rule.scale), below * F.lit(rule.limit)
    bad = left < right if rule.at_least else left > right
    return F.coalesce(bad & (below > 0), F.lit(False))


def _base_fails(count) -> Column:
    return (count("n_words") < 20) | (count("n_repeat_words") * 100 > count("n_words") * 30)


def repeated_window_words(words: Column, width: int = WINDOW) -> Column:
    """Words that stand in a ``width``-word window occurring at least twice in
    the same array, the first occurrence included.

    Windows are 64-bit hashes.  Only arrays that do hold a repeated window are
    sorted; then the union length of the repeated windows is summed."""

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeats(s: Column) -> Column:
            same = F.transform(s, lambda x, i: F.when(
                (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["i"]))
            return F.array_sort(F.filter(same, lambda p: p.isNotNull()))

        zero = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            let(ordered, repeats), zero,
            lambda acc, p: F.struct(p.alias("last"),
                                    (acc["n"] + F.least(F.lit(width), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)),
                             lambda i: F.xxhash64(F.slice(w, i, width)))
        return let(hashes, lambda h: F.when(
            F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))

    return F.when(F.size(words) > width, let(words, count)).otherwise(F.lit(0))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
          "n_marks", "n_stop")


def split_words(body: Column) -> Column:
    return F.array_remove(F.split(body, SPACE), "")


def split_lines(body: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")


def counts(words: Column, lines: Column, body: Column) -> list[Column]:
    """The measures, in the order of ``COUNTS``."""
    values = (
        F.size(words), F.length(F.array_join(words, "")),
        F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")), F.size(lines),
        F.size(lines) - F.size(F.array_distinct(lines)), repeated_window_words(words),
        F.length(F.regexp_replace(body, "[^!]+", "")),
        F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))))
    return [v.cast("long").alias(n) for n, v in zip(COUNTS, values)]


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus the counts the rules read.  Columns of ``df`` that carry a
    count's name are replaced."""
    keep = [c for c in df.columns if c.lower() not in COUNTS or c == text]
    whole = F.coalesce(col(df, text), F.lit(""))
    base = df.select(*[col(df, c) for c in keep], split_words(whole).alias("_words"),
                     split_lines(whole).alias("_lines"))
    body = F.coalesce(F.col(_q(text)), F.lit(""))
    return base.select(*[F.col(_q(c)) for c in keep if c.lower() not in COUNTS],
                       *counts(F.col("_words"), F.col("_lines"), body))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def apply_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` plus counts, ``base_failed``, ``failed_rules`` and ``kept``."""
    own = ("base_failed", "failed_rules", "kept")
    m = measure(df.select(*[col(df, c) for c in df.columns
                            if c.lower() not in own or c == text]), text)
    failed = F.array_compact(F.array(*[F.when(_ratio_fails(r, F.col), F.lit(r.name)) for r in rules]))
    return (m.withColumn("base_failed", _base_fails(F.col)).withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kept`` as one expression that computes each measure once, wherever the
    optimizer moves it (a filter on columns of ``apply_rules`` would be pushed
    below them and repeat their expressions)."""
    body = F.coalesce(text, F.lit(""))

    def decide(c: Column) -> Column:
        bad = _base_fails(lambda n: c[n])
        for r in rules:
            bad = bad | _ratio_fails(r, lambda n: c[n])
        return ~bad

    parts = F.struct(split_words(body).alias("w"), split_lines(body).alias("l"))
    return let(parts, lambda p: let(F.struct(*counts(p["w"], p["l"], body)), decide))


def op8(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document."""
    out = apply_rules(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


def filter_documents(docs: DataFrame) -> DataFrame:
    """Documents the rules keep, with exactly their own columns."""
    return docs.filter(verdict(col(docs, "text")))


_WORD = r"[ \t\n\x0b\f\r]+"


def oracle_sql() -> str:
    """The DuckDB twin, compiled from the same threshold table."""
    stops = ", ".join("'" + w + "'" for w in STOP_WORDS)
    bad = []
    for r in RULES:
        sign = "<" if r.at_least else ">"
        below = r.denominator or "1"
        bad.append(f"({below} > 0 AND {r.numerator} * {r.scale} {sign} {below} * {r.limit})")
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, doc_id, text,
            list_filter(regexp_split_to_array(text, '{_WORD}'), lambda x: x <> '') AS ws,
            list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0b\\f\\r]')) AS ls
          FROM d),
    win AS (SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g
            FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
    dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
    rep AS (SELECT r, CAST(sum(least({WINDOW}, i - p)) AS BIGINT) AS n
            FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), i - {WINDOW}) AS p FROM dup)
            GROUP BY r),
    m AS (SELECT w.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
            CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(len(ls) AS BIGINT) AS n_lines,
            CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
            coalesce(n, 0) AS n_repeat_words,
            CAST(length(regexp_replace(text, '[^!]+', '', 'g')) AS BIGINT) AS n_marks,
            CAST(len(list_filter(ws, lambda x: lower(x) IN ({stops}))) AS BIGINT) AS n_stop
          FROM w LEFT JOIN rep ON w.r = rep.r),
    b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT ({' OR '.join(bad)}) AS kept
    FROM b"""
