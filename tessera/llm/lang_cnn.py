"""Operator 10: language identification by a byte convolutional network.

Bytes are embedded, filters of several widths run over fixed-length windows,
each filter keeps its maximum (ReLU and max pooling) and a softmax names the
language.  The network is trained here, in numpy, on labelled text: a bounded
sample of ``per_language`` documents a language and ``windows_per_doc`` windows
of each, drawn at hashed places of the whole text.  Prediction reads every
window of every text; the mean log probability over a text's windows, weighted
by their bytes, decides.

Defined cases: null text or text without a letter is ``und`` with score 0;
documents without language teach nothing; without any labelled document every
prediction is ``und``; ties go to the language first in order; repeated rows
and null ids pass through one for one; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import bytescan
from tessera.llm.common import add_arrow_columns, col, worker_cache

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
#: Bounds of the training sample (documented parameters).
PER_LANGUAGE = 1000
WINDOWS_PER_DOC = 4
UNKNOWN = "und"
MIN_SCORE = 0.35


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray        # 256 x EMBED
    filters: list            # per width: width x EMBED x FILTERS
    bias: np.ndarray         # FILTERS * len(WIDTHS)
    out: np.ndarray          # FILTERS * len(WIDTHS) x languages
    out_bias: np.ndarray

    def digest(self) -> int:
        return hash((*self.languages, self.out.tobytes(), self.embed.tobytes()))

    def tables(self) -> np.ndarray:
        """Embedding and filters folded into one table per position offset:
        ``tables[o][byte]`` is the byte's share of every filter."""
        wide = np.zeros((max(WIDTHS), 256, len(self.bias)), np.float32)
        for k, f in enumerate(self.filters):
            for o in range(f.shape[0]):
                wide[o, :, k * FILTERS:(k + 1) * FILTERS] = self.embed @ f[o]
        return wide


def windows_of(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every text cut into windows of ``WINDOW`` bytes, the last one padded
    with zeros: bytes, row and true length of each window."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    rows = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[rows] + nth * WINDOW
    length = np.minimum(WINDOW, offsets[rows + 1] - begin) if len(rows) else np.zeros(0, np.int64)
    padded = np.concatenate((buf, np.zeros(WINDOW, np.uint8)))
    out = padded[begin[:, None] + np.arange(WINDOW)] if len(rows) else np.zeros((0, WINDOW), np.uint8)
    short = np.flatnonzero(length < WINDOW)
    out[short] = np.where(np.arange(WINDOW) < length[short, None], out[short], 0)
    return out, rows, length


def log_probabilities(net: Network, tables: np.ndarray, win: np.ndarray, step: int = 48) -> np.ndarray:
    """Log softmax of each window."""
    span = WINDOW - max(WIDTHS) + 1
    n_out = len(net.bias)
    hidden = np.empty((len(win), n_out), np.float32)
    part, total = (np.empty((step * span, n_out), np.float32) for _ in range(2))
    for a in range(0, len(win), step):
        w = win[a:a + step].astype(np.intp)
        m = len(w) * span
        np.take(tables[0], w[:, :span].ravel(), axis=0, out=total[:m], mode="clip")
        for o in range(1, max(WIDTHS)):
            np.take(tables[o], w[:, o:o + span].ravel(), axis=0, out=part[:m], mode="clip")
            total[:m] += part[:m]
        hidden[a:a + step] = total[:m].reshape(len(w), span, n_out).max(axis=1)
    hidden = np.maximum(hidden + net.bias, 0)
    z = hidden @ net.out + net.out_bias
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train(win: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 10,
          batch: int = 64, rate: float = 4e-3, seed: int = 11) -> Network:
    """Adam on the windows' cross entropy; every language weighs the same."""
    rng = np.random.default_rng(seed)
    n_out, span = FILTERS * len(WIDTHS), WINDOW - max(WIDTHS) + 1
    par = {"embed": rng.normal(0, 0.3, (256, EMBED)), "bias": np.zeros(n_out),
           "out": rng.normal(0, 0.2, (n_out, len(languages))), "out_bias": np.zeros(len(languages))}
    for k, w in enumerate(WIDTHS):
        par[f"f{k}"] = rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS))
    par = {k: v.astype(np.float32) for k, v in par.items()}
    m1 = {k: np.zeros_like(v) for k, v in par.items()}
    m2 = {k: np.zeros_like(v) for k, v in par.items()}
    share = np.bincount(labels, minlength=len(languages)).astype(np.float32)
    weight = (len(labels) / (len(languages) * np.maximum(share, 1)))[labels]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(win))
        for a in range(0, len(order), batch):
            pick = order[a:a + batch]
            b = win[pick].astype(np.intp)
            x = par["embed"][b]
            peak, where = [], []
            for k, w in enumerate(WIDTHS):
                conv = sum(x[:, o:o + span] @ par[f"f{k}"][o] for o in range(w))
                at = conv.argmax(axis=1)
                where.append(at)
                peak.append(np.take_along_axis(conv, at[:, None, :], 1)[:, 0])
            pre = np.concatenate(peak, 1) + par["bias"]
            hid = np.maximum(pre, 0)
            z = hid @ par["out"] + par["out_bias"]
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1
            dz = (p * weight[pick, None] / len(pick)).astype(np.float32)
            grad = {"out": hid.T @ dz, "out_bias": dz.sum(0)}
            dh = (dz @ par["out"].T) * (pre > 0)
            grad["bias"], grad["embed"] = dh.sum(0), np.zeros_like(par["embed"])
            row = np.arange(len(pick))[:, None]
            for k, w in enumerate(WIDTHS):
                d = dh[:, k * FILTERS:(k + 1) * FILTERS]
                g = np.zeros_like(par[f"f{k}"])
                for o in range(w):
                    seen = b[row, where[k] + o]               # the byte under each maximum
                    g[o] = np.einsum("nfe,nf->ef", par["embed"][seen], d)
                    np.add.at(grad["embed"], seen, d[:, :, None] * par[f"f{k}"][o].T[None])
                grad[f"f{k}"] = g
            step += 1
            lr = rate * (1 - 0.9 * epoch / max(1, epochs))
            for name, g in grad.items():
                m1[name] = 0.9 * m1[name] + 0.1 * g
                m2[name] = 0.999 * m2[name] + 0.001 * g * g
                par[name] -= (lr * (m1[name] / (1 - 0.9 ** step))
                              / (np.sqrt(m2[name] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Network(languages, par["embed"], [par[f"f{k}"] for k in range(len(WIDTHS))],
                   par["bias"], par["out"], par["out_bias"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        per_language: int = PER_LANGUAGE, windows_per_doc: int = WINDOWS_PER_DOC
        ) -> Network | None:
    """Train on ``labelled``: at most ``per_language`` documents of each language
    that occurs.  The driver receives that many windows of ``WINDOW`` bytes,
    whatever the size of the table."""
    rows = labelled.select(col(labelled, text).alias("text"), col(labelled, lang).alias("lang"),
                           F.xxhash64(col(labelled, key)).alias("h")).filter(
        F.col("lang").isNotNull() & (F.coalesce(F.octet_length("text"), F.lit(0)) > 0))
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return None
    languages = sorted(r["lang"] for r in counts)
    share = {r["lang"]: min(1 << 20, -(-(per_language * 2 << 20) // r["count"])) for r in counts}
    part = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])
    # thinned to about twice the number, then the first by hash
    drawn = rows.filter(F.pmod(F.col("h"), F.lit(1 << 20)) < part[F.col("lang")]).withColumn(
        "nth", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text")))
    drawn = drawn.filter(F.col("nth") <= per_language).select("text", "lang", "h")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for body, name, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                     batch.column(2).to_pylist()):
                raw = body.encode()
                rng = np.random.default_rng(h & 0xFFFFFFFF)
                last = max(0, len(raw) - WINDOW)
                for at in rng.integers(0, last + 1, windows_per_doc if last else 1):
                    out.append({"window": raw[at:at + WINDOW], "lang": name})
            yield pa.RecordBatch.from_pylist(out, pa.schema(
                [("window", pa.binary()), ("lang", pa.string())]))

    sample = drawn.mapInArrow(cut, "window binary, lang string").collect()
    sample.sort(key=lambda r: (r["lang"], bytes(r["window"])))
    index = {k: i for i, k in enumerate(languages)}
    win = np.zeros((len(sample), WINDOW), np.uint8)
    for i, r in enumerate(sample):
        win[i, :len(r["window"])] = np.frombuffer(bytes(r["window"]), np.uint8)
    return train(win, np.array([index[r["lang"]] for r in sample]), languages)


def predict(df: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``df`` plus ``lang_pred`` and ``score``."""
    schema = T.StructType([T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    body = col(df, text)
    readable = F.coalesce(body.rlike(r"\p{L}"), F.lit(False))
    if net is None:
        own = {"lang_pred", "score"}
        return df.select(*[col(df, c) for c in df.columns if c.lower() not in own],
                         F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches):
        import pyarrow as pa

        tables = worker_cache(("language", net.digest()), net.tables)
        names = np.array(net.languages, object)
        for batch in batches:
            buf, off = bytescan.text_buffer(batch.field("text"))
            total = np.zeros((len(off) - 1, len(names)))
            weight = np.zeros(len(off) - 1)
            for a, b in bytescan.row_slices(off, 1 << 21):
                win, rows, size = windows_of(buf[off[a]:off[b]], off[a:b + 1] - off[a])
                logp = log_probabilities(net, tables, win)
                np.add.at(total, rows + a, logp * size[:, None])
                np.add.at(weight, rows + a, size)
            empty = weight == 0
            mean = total / np.maximum(weight, 1)[:, None]
            p = np.exp(mean - mean.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            pred = np.where(empty, UNKNOWN, names[best])
            score = np.where(empty, 0.0, p[np.arange(len(p)), best])
            yield pa.StructArray.from_arrays([pa.array(pred.tolist(), pa.string()),
                                              pa.array(score)], ["lang_pred", "score"])

    return add_arrow_columns(df, {"text": F.when(readable, body)}, schema, run)


def keep_languages(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents of a recognised language, with exactly their own columns; what
    is ``und`` or hardly better than a guess goes."""
    net = fit(docs.filter(col(docs, "doc_id").isNotNull() & ~held_out(col(docs, "doc_id"))))
    marked = docs.select(F.struct(*[col(docs, c).alias(c) for c in docs.columns]).alias("_row"),
                         col(docs, "text").alias("text"))
    out = predict(marked, net)
    return out.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select(
        *[F.col("_row")[c].alias(c) for c in docs.columns])


def op10(docs: DataFrame) -> DataFrame:
    seen = docs.select("doc_id", "text", "lang").filter(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    out = predict(docs.select("doc_id", "text"), fit(seen))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
