"""Operator 1: quality classifier by hierarchical empirical Bayes.

* Document evidence: a logistic classifier on byte and word statistics of the
  whole text, fitted on at most ``max_labelled`` labelled documents.  Its log
  odds, less the prior of its training rows, are the document's evidence.
* Site evidence: documents are grouped by host and by path below it.  A
  labelled document counts as its label, any other as its classifier
  probability.  Host rates are shrunk towards the global rate and path rates
  towards their host's posterior, by Beta priors whose strengths are estimated
  from the spread of the rates (method of moments), so sparse sites say little.
* Posterior: path posterior without the document itself, plus its evidence.

The text is read once; everything after it moves a few numbers per document.
Groups are partial sums, so a hot host costs one row per task.

Defined cases: null text counts as empty; a null host or path is a site of its
own; a document with several labels has their mean; labels without document
are ignored; without both kinds of label the classifier is silent (evidence
0); repeated rows are scored alike; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import bytescan
from tessera.llm.common import add_arrow_columns, col, written

#: Bound of the fitting sample (documented parameter).
MAX_LABELLED = 20_000
KEEP_AT = 0.5
SITE_WEIGHT_LIMIT = 10_000.0
#: A site row takes about 150 bytes in a broadcast table.
BROADCAST_ROWS = 100_000
FEATURES = ("symbols", "marks", "bars", "upper", "digits", "non_ascii", "word_length",
            "distinct_words", "adjacent_equal", "duplicate_lines", "length", "short")


def features(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    n = len(offsets) - 1
    starts, ends, rows = bytescan.word_spans(buf, offsets)
    words = np.bincount(rows, minlength=n).astype(float)
    per_word = np.maximum(words, 1)

    def count(mask):
        total = np.concatenate(([0], np.cumsum(mask)))
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in "#*$%&<>^~=_{}[]\\"]] = True
    upper = count((buf >= 65) & (buf <= 90))
    lower = count((buf >= 97) & (buf <= 122))
    lead = count((buf & 0xC0) != 0x80)
    h = bytescan.word_hashes(buf, starts, ends)
    key = np.sort((rows.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[new] >> np.uint64(44)).astype(np.int64), minlength=n)
    same = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
    adjacent = np.bincount(rows[1:][same], minlength=n)
    lines, repeated = line_repeats(buf, offsets)
    return np.stack([
        np.log1p(count(symbol[buf]) / per_word), np.log1p(count(buf == 33) / per_word),
        np.log1p(count(buf == 124) / per_word), upper / np.maximum(upper + lower, 1),
        np.log1p(count((buf >= 48) & (buf <= 57)) / per_word),
        count(buf >= 0xC0) / np.maximum(lead, 1), np.log1p(lead / per_word),
        1 - distinct / per_word, adjacent / per_word, repeated / np.maximum(lines, 1),
        np.log1p(words), 1.0 / (1 + words)], axis=1)


def line_repeats(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines of each text and how many of them equal an earlier one."""
    n = len(offsets) - 1
    stop = np.flatnonzero(buf == 10)
    starts = np.unique(np.concatenate((offsets[:-1][np.diff(offsets) > 0], stop + 1)))
    starts = starts[starts < len(buf)]
    if not len(starts):
        return np.zeros(n), np.zeros(n)
    rows = np.searchsorted(offsets, starts, "right") - 1
    nexts = np.concatenate((starts[1:], [len(buf)]))
    ends = np.minimum(nexts, offsets[rows + 1])
    ends = ends - ((ends > starts) & (buf[ends - 1] == 10))
    full = ends > starts
    starts, ends, rows = starts[full], ends[full], rows[full]
    h = bytescan.word_hashes(buf, starts, ends)
    key = np.sort((rows.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    total = np.bincount(rows, minlength=n).astype(float)
    return total, total - np.bincount((key[new] >> np.uint64(44)).astype(np.int64), minlength=n)


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> "Classifier":
        """Ridge logistic regression by Newton steps; both classes together
        weigh the same.  Without both classes the classifier is silent."""
        k = x.shape[1]
        if len(y) == 0 or y.min() >= 0.5 or y.max() < 0.5:
            return Classifier(np.zeros(k), np.ones(k), np.zeros(k), 0.0,
                              float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)))
        mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = np.concatenate(((x - mean) / scale, np.ones((len(x), 1))), 1)
        prior = float(np.clip(y.mean(), 0.01, 0.99))
        weight = np.where(y >= 0.5, 0.5 / prior, 0.5 / (1 - prior))
        w = np.zeros(k + 1)
        keep = np.full(k + 1, ridge)
        keep[-1] = 1e-6
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            grad = z.T @ (weight * (y - p)) - keep * w
            hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(keep + 1e-9)
            step = np.linalg.solve(hess, grad)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        return Classifier(mean, scale, w[:-1], float(w[-1]), prior)

    def evidence(self, x: Column) -> Column:
        """Log likelihood ratio of a feature array, as a native expression:
        classes weigh the same in the fit, so its log odds hold no prior."""
        out = F.lit(self.bias)
        for j, (m, s, w) in enumerate(zip(self.mean, self.scale, self.weights)):
            out = out + (F.get(x, F.lit(j)) - F.lit(float(m))) * F.lit(float(w / s))
        return F.least(F.greatest(out, F.lit(-15.0)), F.lit(15.0))


def logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(groups: DataFrame, rate: Column) -> float:
    """Beta prior weight from the spread of group rates about ``rate``: rates
    that differ no more than chance explains give a strong prior."""
    r = groups.select("n", (F.col("s") / F.col("n") - rate).alias("d"), (rate * (1 - rate)).alias("v"))
    got = r.agg(F.count("n").alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"),
                F.sum(F.col("n") * F.col("d") * F.col("d")).alias("ss"),
                F.sum(F.col("n") * F.col("v")).alias("v")).collect()[0]
    if not got["n"] or got["g"] < 2:
        return SITE_WEIGHT_LIMIT
    within = got["v"] / got["n"]
    between = (got["ss"] - (got["g"] - 1) * within) / max(got["n"] - got["n2"] / got["n"], 1e-9)
    if between <= 0 or within <= 0:
        return SITE_WEIGHT_LIMIT
    return float(min(max(within / between - 1, 1.0), SITE_WEIGHT_LIMIT))


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None,
             path: Column | None = None, key: str = "doc_id", text: str = "text",
             label: str = "quality", max_labelled: int = MAX_LABELLED,
             keep_at: float = KEEP_AT) -> DataFrame:
    """``doc_id, evidence, host_posterior, path_posterior, score, kept`` per row
    of ``docs``.  ``host`` and ``path`` default to the ``source`` column (up to
    and after its first ``/``); see ``sites``."""
    d_host, d_path = sites(docs)
    host, path = (d_host if host is None else host), (d_path if path is None else path)
    schema = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType(), False))])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            buf, off = bytescan.text_buffer(batch.field("text"))
            parts = [features(buf[off[a]:off[b]], off[a:b + 1] - off[a])
                     for a, b in bytescan.row_slices(off, 4 << 20)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            ends = np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, x.ravel())], ["features"])

    base = docs.select(col(docs, key).alias("doc_id"), host.alias("host"), path.alias("path"),
                       col(docs, text).alias("text"))
    known = labels.select(col(labels, key).alias("doc_id"), col(labels, label).cast("double").alias("y")
                          ).filter("y IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.avg("y").alias("y"))
    narrow = add_arrow_columns(base, {"text": F.col("text")}, schema, run).drop("text")
    rows = written(narrow.join(known, "doc_id", "left"), "features")
    labelled = rows.filter("y IS NOT NULL").select("features", "y", F.xxhash64("doc_id").alias("h"))
    # thinned before the sort, so that the tasks together send little more than is kept
    share = min(1 << 30, -(-(max_labelled * 5 << 28) // max(1, labelled.count())))
    sample = (labelled.filter(F.pmod("h", F.lit(1 << 30)) < share)
              .orderBy("h").limit(max_labelled).collect())
    model = Classifier.fit(np.array([r["features"] for r in sample], float).reshape(-1, len(FEATURES)),
                           np.array([r["y"] for r in sample], float))
    scored = rows.select("doc_id", "host", "path", model.evidence(F.col("features")).alias("evidence"),
                         "y")
    scored = scored.withColumn("y", F.coalesce(
        "y", sigmoid(F.col("evidence") + F.lit(float(np.log(model.prior / (1 - model.prior)))))))
    paths = written(scored.groupBy("host", "path").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()[0]
    rate = float(np.clip(total["s"] / total["n"], 1e-4, 1 - 1e-4)) if total["n"] else 0.5
    host_weight = _strength(hosts, F.lit(rate))
    hosts = hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    host_rate = (F.col("host_s") + rate * host_weight) / (F.col("host_n") + host_weight)
    path_weight = _strength(both, host_rate)
    if both.count() <= BROADCAST_ROWS:
        both = F.broadcast(both)
    b = both.withColumnsRenamed({"host": "h2", "path": "p2"})
    joined = scored.join(b, scored["host"].eqNullSafe(b["h2"]) & scored["path"].eqNullSafe(b["p2"]))
    y = F.col("y")  # the site's opinion does not hold the document itself
    host_post = (F.col("host_s") - y + rate * host_weight) / (F.col("host_n") - 1 + host_weight)
    path_post = (F.col("s") - y + host_post * path_weight) / (F.col("n") - 1 + path_weight)
    out = joined.select("doc_id", "evidence", host_post.alias("host_posterior"),
                        path_post.alias("path_posterior"))
    out = out.withColumn("score", sigmoid(logit(F.col("path_posterior")) + F.col("evidence")))
    return out.withColumn("kept", F.col("score") >= keep_at)


def sites(docs: DataFrame) -> tuple[Column, Column]:
    """Host and path of the ``documents`` schema.  ``source`` is read like an
    address: what stands before the first ``/`` is the host, the first segment
    behind it the path.  A source without segments is divided by language, as
    sites keep their language sections."""
    source = col(docs, "source")
    bare = F.regexp_replace(source, r"^[a-z]+://", "")
    host = F.split_part(bare, F.lit("/"), F.lit(1))
    segment = F.split_part(bare, F.lit("/"), F.lit(2))
    lang = col(docs, "lang") if "lang" in docs.columns else F.lit("")
    return host, F.when(segment != "", segment).otherwise(lang)


def op1(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs, labels)
