"""String helpers that reproduce Python's ``str`` semantics with Spark SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the 29 code points Python's str.split() / str.strip() treat as
# whitespace, as a Java regex class.  Spark's "\s" misses 23 of them.  Java keeps
# the single characters of Latin-1 as one bit set; the class behind them asks
# its first range before the others, so a letter costs two questions, not ten.
PY_WHITESPACE = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """``text.split()`` as ``array<string>``: no empty pieces, ``[]`` for ``''``."""
    return F.filter(F.split(_col(c), PY_WHITESPACE + "+"), lambda w: w != F.lit(""))


def lower_words(c) -> Column:
    return words(F.lower(_col(c)))


def py_strip(c) -> Column:
    """``text.strip()`` with Python's whitespace (``trim`` only removes spaces)."""
    return F.regexp_replace(_col(c), f"^{PY_WHITESPACE}+|{PY_WHITESPACE}+$", "")


def strip_prefix(text, prefix) -> Column:
    """Cut an echoed ``prefix`` from the start of ``text`` and strip; unchanged
    when ``text`` does not start with it."""
    text, prefix = _col(text), _col(prefix)
    return F.when(text.startswith(prefix),
                  py_strip(F.substring(text, F.length(prefix) + 1, 2147483647))
                  ).otherwise(text)


def file_stem(path) -> Column:
    """``os.path.splitext(os.path.basename(path))[0]`` (last extension only;
    leading dots belong to the stem)."""
    base = F.regexp_extract(_col(path), r"([^/]*)$", 1)
    return F.regexp_extract(base, r"^(\.*[^.].*?|\.*)(\.[^.]*)?$", 1)


def window_file_name(name, i) -> Column:
    """``name.replace('.txt', f'_{i}.jsonl')`` — every occurrence is replaced."""
    return F.replace(_col(name), F.lit(".txt"),
                     F.concat(F.lit("_"), _col(i).cast("string"), F.lit(".jsonl")))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Spark does not share sub-expressions inside higher-order functions, so an
    array used in a per-element lambda would be rebuilt for every element;
    binding it as the start value of a one-step ``aggregate`` computes it once
    per row."""
    return F.aggregate(F.array(F.lit(0)), value, lambda acc, _x: acc, body)
