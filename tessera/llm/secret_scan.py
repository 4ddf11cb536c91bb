"""Operator 7: secret scan with a token-efficiency test.

Three fixed patterns find assigned credentials, access keys and long
hexadecimal strings.  On top of them the method looks at every long unbroken
run of credential characters: a run that a tiktoken vocabulary can only spell
with very few characters per token is a random string.  Known digests
(hexadecimal of a digest's length), UUIDs and numbers are excluded before the
test, words of one letter case have to pass a stricter one, and a run with many
separators is a path or web address where its segments are spelled efficiently.
What a base span covers is not reported again.

A batch is screened with compiled set scans (Arrow, on the whole batch); only
texts that can hold a finding are looked at one by one.

Defined cases: a null or empty text has no findings; spans are code points of
the whole text; repeated rows and null ids pass through one for one; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_arrow_columns, col, tokenizer_file, worker_cache

VOCABULARY = "byte_bpe_50k.tiktoken"
KINDS = ("assign", "access", "hex", "random")

# The three base patterns and their least lengths.
ASSIGN = (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32

#: Runs that the token-efficiency test looks at, and its threshold.
RUN_MIN = 20
RUN = r"[A-Za-z0-9+/_=-]{%d,}" % RUN_MIN
MAX_CHARS_PER_TOKEN = 2.0
#: Stricter thresholds of runs without digits that are of one letter case (or
#: have at most two letters of the other), since words may be spelled so, and
#: the least ratio of the segments of a path.
LOWER_CHARS_PER_TOKEN, UPPER_CHARS_PER_TOKEN, PATH_CHARS_PER_TOKEN = 1.85, 1.8, 1.8
#: Hexadecimal lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)

_COMPILED = {
    "assign": re.compile(ASSIGN, re.IGNORECASE | re.ASCII),
    "access": re.compile(ACCESS),
    # a maximal run of fewer characters is dropped anyway
    "hex": re.compile(r"[0-9a-f]{%d,}" % HEX_MIN),
    "run": re.compile(RUN),
    "hex_any": re.compile(r"[0-9a-fA-F]+\Z"),
    "uuid": re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z"),
    "uuid_in": re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])"),
    "letter": re.compile(r"[A-Za-z]"),
    "separator": re.compile(r"[/+=_-]+"),
}
#: Screens for Arrow's linear-time matcher: supersets of what can match.
SCREEN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
          r"|AKIA[A-Z0-9]{12}|[0-9a-f]{32}|[A-Za-z0-9+/_=-]{20}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Base findings as ``(start, end, kind)``; failing matches are dropped."""
    out = [(m.start(), m.end(), "assign") for m in _COMPILED["assign"].finditer(text)
           if m.end(2) - m.start(2) >= ASSIGN_MIN]
    out += [(m.start(), m.end(), "access") for m in _COMPILED["access"].finditer(text)
            if m.end() - m.start() >= ACCESS_MIN]
    out += [(m.start(), m.end(), "hex") for m in _COMPILED["hex"].finditer(text)]
    return out


def known_identifier(run: str) -> bool:
    """Digests, UUIDs, numbers and rules of dashes are no secrets."""
    if _COMPILED["hex_any"].match(run) and len(run) in DIGEST_LENGTHS:
        return True
    return bool(_COMPILED["uuid"].match(run)) or not _COMPILED["letter"].search(run)


def ratio_limit(run: str, max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> float:
    """Characters per token up to which ``run`` counts as random."""
    upper, lower = sum("A" <= c <= "Z" for c in run), sum("a" <= c <= "z" for c in run)
    if any("0" <= c <= "9" for c in run) or upper >= 3 and lower >= 3:
        return max_chars_per_token
    return min(max_chars_per_token, UPPER_CHARS_PER_TOKEN if upper > lower else LOWER_CHARS_PER_TOKEN)


def path_like(run: str, tokens, max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> bool:
    """Whether ``run`` is a path, address or chain of words: many separators,
    and efficient segments between them.  Known identifiers among the segments
    and single tokens of one or two characters say nothing; a segment that is
    itself random makes the run no path."""
    if not (run.count("/") > 2 or "//" in run or run.count("-") > 3 or run.count("_") > 3):
        return False
    parts = [p for p in _COMPILED["separator"].split(_COMPILED["uuid_in"].sub("", run))
             if p and not known_identifier(p)]
    sizes = [(p, tokens(p)) for p in parts]
    if any(len(p) >= RUN_MIN and len(p) <= ratio_limit(p, max_chars_per_token) * n for p, n in sizes):
        return False
    told = [(len(p), n) for p, n in sizes if n > 1 or len(p) > 2]
    return sum(n for n, _ in told) >= PATH_CHARS_PER_TOKEN * sum(n for _, n in told)


def merged_spans(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The spans' union as ascending, disjoint stretches."""
    out: list[tuple[int, int]] = []
    for a, b, _ in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def random_spans(text: str, encoder, taken: list[tuple[int, int, str]],
                 max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int, str]]:
    """Long runs outside ``taken`` that the vocabulary spells inefficiently."""

    def tokens(part: str) -> int:
        return len(encoder.encode_ordinary(part))

    out = []
    covered, at = merged_spans(taken), 0
    for m in _COMPILED["run"].finditer(text):
        run = m.group()
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        if at < len(covered) and covered[at][0] < m.end() or known_identifier(run):
            continue
        if (len(run) <= ratio_limit(run, max_chars_per_token) * tokens(run)
                and not path_like(run, tokens, max_chars_per_token)):
            out.append((m.start(), m.end(), "random"))
    return out


def span_text(spans) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], order[s[2]], s[1])))


def _encoder(path: str):
    def load():
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=ranks, special_tokens={})

    return worker_cache(("tiktoken", path), load)


def scan(df: DataFrame, text: str = "text", vocabulary: str | None = None,
         max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """``df`` plus ``findings array<struct<start, end, kind>>`` in order, base
    findings and those of the token-efficiency test (kind ``random``)."""
    finding = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                            T.StructField("kind", T.StringType())])
    schema = T.StructType([T.StructField("findings", T.ArrayType(finding))])
    order = {k: i for i, k in enumerate(KINDS)}

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                   ("kind", pa.string())]))
        encoder = None
        for batch in batches:
            texts = batch.field("text")
            maybe = pc.fill_null(pc.match_substring_regex(texts, SCREEN), False)
            rows = [[]] * len(texts)
            for i in pc.indices_nonzero(maybe).to_pylist():
                encoder = encoder or _encoder(vocabulary or tokenizer_file(VOCABULARY))
                body = texts[i].as_py()
                spans = base_spans(body)
                spans += random_spans(body, encoder, spans, max_chars_per_token)
                spans.sort(key=lambda s: (s[0], order[s[2]], s[1]))
                rows[i] = [{"start": a, "end": b, "kind": k} for a, b, k in spans]
            yield pa.StructArray.from_arrays([pa.array(rows, kind)], ["findings"])

    return add_arrow_columns(df, {"text": col(df, text)}, schema, run)


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every finding in ``text`` replaced by ``mark`` (overlapping
    findings by one); texts without findings stay as they are."""
    body = F.col("_t")
    marked = scan(df.select(F.struct(*[col(df, c).alias(c) for c in df.columns]).alias("_row"),
                            col(df, text).alias("_t")), "_t")
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    joined = F.aggregate(
        "findings", zero,
        lambda acc, f: F.when(f["start"] >= acc["at"], F.struct(
            F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"),
                                             (f["start"] - acc["at"]).cast("int")),
                     F.lit(mark)).alias("out"), f["end"].alias("at"))
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], f["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"),
                                                     F.lit(2147483647))))
    clean = F.when(F.size("findings") > 0, joined).otherwise(body)
    out = marked.withColumn("_clean", clean)
    return out.select(*[F.col("_clean").alias(c) if c == text else F.col("_row")[c].alias(c)
                        for c in df.columns])


def op7(docs: DataFrame) -> DataFrame:
    out = scan(docs.select("doc_id", "text")).select("doc_id", "findings")

    def joined(keep):
        spans = F.filter("findings", keep)
        return F.array_join(F.transform(spans, lambda f: F.concat_ws(
            ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")

    return out.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(lambda f: f["kind"] != "random"), 256).alias("base_sha256"),
        joined(lambda f: F.lit(True)).alias("spans"))
