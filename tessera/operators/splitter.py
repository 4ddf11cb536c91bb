"""Recursive character splitter (chunk_size / overlap in characters).

Rules: try the separators in order and use the first one present in the text
("" always matches and cuts between characters).  Cut the text so that every
piece after the first starts with the separator.  Pieces strictly shorter
than ``chunk_size`` are packed greedily into chunks; a longer piece is split
again with the separators after the one in use (or kept whole when none is
left).  While packing, when the next piece would overflow, the current chunk
is emitted (stripped, empty dropped) and pieces are released from its front
until at most ``overlap`` characters remain and the next piece fits.

The splitting itself is a small per-row Python function run through an Arrow
batch UDF; Spark distributes the rows and ``posexplode`` numbers the chunks.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default separators, tried in this order.
DEFAULT_SEPARATORS = ("\n\n", "\n", " ", "")


def _cut(text: str, sep: str) -> list[str]:
    if sep == "":
        return list(text)
    head, *tail = text.split(sep)
    return [p for p in [head] + [sep + t for t in tail] if p]


def _pack(pieces: list[str], size: int, overlap: int, length=len) -> list[str]:
    out: list[str] = []
    window: list[str] = []
    used = 0
    for piece in pieces:
        n = length(piece)
        if window and used + n > size:
            chunk = "".join(window).strip()
            if chunk:
                out.append(chunk)
            while window and (used > overlap or used + n > size):
                used -= length(window.pop(0))
        window.append(piece)
        used += n
    chunk = "".join(window).strip()
    if chunk:
        out.append(chunk)
    return out


def split_text(text: str | None, size: int = 400, overlap: int = 50,
               separators=DEFAULT_SEPARATORS, length=len) -> list[str]:
    """Chunks of ``text``; ``length`` measures pieces (characters by default,
    a token counter for token-sized chunks)."""
    if not text:
        return []
    if overlap >= size:
        raise ValueError("overlap must be smaller than chunk size")
    seps = list(separators)
    sep, rest = seps[-1], []
    for i, s in enumerate(seps):
        if s == "":
            sep, rest = s, []
            break
        if s in text:
            sep, rest = s, seps[i + 1:]
            break
    out: list[str] = []
    small: list[str] = []
    for piece in _cut(text, sep):
        if length(piece) < size:
            small.append(piece)
            continue
        if small:
            out.extend(_pack(small, size, overlap, length))
            small = []
        if rest:
            out.extend(split_text(piece, size, overlap, rest, length))
        else:
            out.append(piece)
    if small:
        out.extend(_pack(small, size, overlap, length))
    return out


def line_ends(text) -> Column:
    """``\\r\\n`` and lone ``\\r`` as ``\\n``: the text that is split."""
    return F.regexp_replace(text, "\r\n?", "\n")


def split_column(text, size: int = 400, overlap: int = 50,
                 separators=DEFAULT_SEPARATORS, length=len) -> Column:
    """``array<string>`` of chunks.  ``\\r\\n`` and lone ``\\r`` become ``\\n``
    first, as Python's text mode does when the files are read."""
    seps = tuple(separators)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_text(t, size, overlap, seps, length))

    text = F.col(text) if isinstance(text, str) else text
    return _split(line_ends(text))


def recursive_chunks(df: DataFrame, size: int = 400, overlap: int = 50,
                     text_col: str = "text", keep: tuple = ("doc_id",),
                     separators=DEFAULT_SEPARATORS, length=len) -> DataFrame:
    """``(keep..., chunk_id, text)`` — chunk_id is 0-based per document."""
    return df.select(*keep, F.posexplode(split_column(text_col, size, overlap, separators,
                                                      length)).alias("chunk_id", "text"))
