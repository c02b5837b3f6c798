"""Quality classifier: a byte-level convolutional network in numpy.

A document is its UTF-8 bytes.  Overlapping chunks of ``WIDTH`` bytes, one
every ``STRIDE`` bytes, cover it from the first byte to the last; each byte is
embedded, learned filters respond to every chunk, responses are max-pooled
over the whole document, and a logistic layer combines the pooled maxima into
one probability.

Training runs on the driver over a bounded sample of labelled rows: at most
``max_rows`` rows of at most ``max_bytes`` bytes each, by smallest row hash.
Both bounds are parameters; scoring covers every document and all its bytes,
in blocks of ``BLOCK`` chunks, so memory does not follow a text's length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import bounded_batches

WIDTH, STRIDE, BLOCK = 16, 8, 1 << 15


@dataclass
class Net:
    embed: np.ndarray  # 257 x e; row 256 stands past the end of a text
    filters: np.ndarray  # WIDTH * e x f
    bias: np.ndarray  # f
    weights: np.ndarray  # f
    offset: float

    @classmethod
    def fresh(cls, rng: np.random.Generator, e: int = 6, f: int = 32) -> Net:
        return cls(rng.normal(0, 0.5, (257, e)).astype(np.float32),
                   rng.normal(0, (2 / (WIDTH * e)) ** 0.5, (WIDTH * e, f)).astype(np.float32),
                   np.zeros(f, np.float32), rng.normal(0, 0.1, f).astype(np.float32), 0.0)


def chunks(raw: bytes) -> np.ndarray:
    """``n x WIDTH`` byte values: chunks every STRIDE bytes until the last byte is covered, padded with 256."""
    n = max(1, -(-max(0, len(raw) - WIDTH) // STRIDE) + 1)
    flat = np.full((n - 1) * STRIDE + WIDTH, 256, np.int16)
    flat[:len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, WIDTH)[::STRIDE]


def pooled(net: Net, pieces: list[np.ndarray]) -> np.ndarray:
    """Maxima of the filters' responses for documents given as chunks."""
    top = np.zeros((len(pieces), len(net.bias)), np.float32)
    sizes = np.array([len(p) for p in pieces])

    def run(rows: np.ndarray) -> np.ndarray:
        return np.maximum(net.embed[rows].reshape(len(rows), -1) @ net.filters + net.bias, 0)

    start = 0
    while start < len(pieces):
        if sizes[start] > BLOCK:  # one long document, block by block
            for at in range(0, sizes[start], BLOCK):
                top[start] = np.maximum(top[start], run(pieces[start][at:at + BLOCK]).max(0))
            start += 1
            continue
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), BLOCK, "right")))
        r = run(np.concatenate(pieces[start:end]))
        cut = np.concatenate([[0], np.cumsum(sizes[start:end])[:-1]])
        top[start:end] = np.maximum.reduceat(r, cut)
        start = end
    return top


def scores(net: Net, texts: list[str | None]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    z = pooled(net, [chunks((t or "").encode()) for t in texts]).astype(np.float64) @ net.weights + net.offset
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(texts: list[str], labels: list[int], epochs: int = 12, batch: int = 32, rate: float = 4e-3,
        seed: int = 7) -> Net:
    """Adam on the logistic loss; the gradient goes through each pooled maximum."""
    rng = np.random.default_rng(seed)
    net = Net.fresh(rng)
    if not texts:
        return net
    docs = [chunks(t.encode()) for t in texts]
    y = np.array(labels, np.float32)
    net.offset = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    names = ("embed", "filters", "bias", "weights")
    m = {k: np.zeros_like(getattr(net, k)) for k in names} | {"offset": 0.0}
    v = {k: np.zeros_like(getattr(net, k)) for k in names} | {"offset": 0.0}
    f, step = len(net.bias), 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch):
            ids, step = order[at:at + batch], step + 1
            rows = np.concatenate([docs[i] for i in ids])
            sizes = np.array([len(docs[i]) for i in ids])
            cut = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            x = net.embed[rows].reshape(len(rows), -1)
            r = np.maximum(x @ net.filters + net.bias, 0)
            best = np.stack([c + r[c:c + s].argmax(0) for c, s in zip(cut, sizes)])
            h = r[best, np.arange(f)]
            p = 1 / (1 + np.exp(-np.clip(h @ net.weights + net.offset, -50, 50)))
            dz = (p - y[ids]) / len(ids)
            dh = dz[:, None] * net.weights
            dr = np.zeros_like(r)
            np.add.at(dr, (best.ravel(), np.tile(np.arange(f), len(ids))), dh.ravel())
            dr *= r > 0
            dx = (dr @ net.filters.T).reshape(-1, net.embed.shape[1])
            flat = rows.ravel()
            g = {"embed": np.stack([np.bincount(flat, dx[:, j], 257) for j in range(dx.shape[1])], 1).astype(np.float32),
                 "filters": x.T @ dr, "bias": dr.sum(0), "weights": h.T @ dz + 1e-4 * net.weights, "offset": float(dz.sum())}
            for k in g:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                move = rate * (m[k] / (1 - 0.9 ** step)) / ((v[k] / (1 - 0.999 ** step)) ** 0.5 + 1e-8)
                setattr(net, k, getattr(net, k) - (move if k == "offset" else move.astype(np.float32)))
    return net


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", max_rows: int = 2000, max_bytes: int = 1 << 16) -> DataFrame:
    """``text, y``: a bounded sample of the labelled rows that are not held out, by smallest row hash."""
    lab = (labels.select(F.col(id_col).alias("doc"), F.col(label_col).cast("int").alias("y"))
           .where(F.col("y").isin(0, 1) & (F.crc32(F.col("doc").cast("string")) % 3 != 1)))
    # the ids are chosen first, so only their texts are read into the sample
    chosen = lab.orderBy(F.xxhash64("doc"), "doc", "y").limit(max_rows)
    text = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (text.join(F.broadcast(chosen), "doc").where(F.octet_length("text") <= max_bytes)
            .orderBy(F.xxhash64("doc"), "doc", "y", F.xxhash64("text")).limit(max_rows).select("text", "y"))


def trained(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
            max_rows: int, max_bytes: int) -> Net:
    bounded_batches(docs.sparkSession)
    sample = training_rows(docs, labels, id_col, text_col, label_col, max_rows, max_bytes).collect()
    return fit([r.text for r in sample], [r.y for r in sample])


def score_of(net: Net):
    """A column function: the net's probability for each text."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        parts = [scores(net, text.iloc[at:at + 256].tolist()) for at in range(0, len(text), 256)]
        return pd.Series(np.concatenate([np.zeros(0), *parts]))
    return score


def quality_net(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", max_rows: int = 2000, max_bytes: int = 1 << 16) -> DataFrame:
    """``id_col, held_out, score, predicted``: one row per row of ``docs``.

    Labels are learned from rows with ``crc32(id as text) mod 3 <> 1`` only;
    the score reads nothing but the text's bytes.  A null text is empty, and an
    empty one is a chunk of padding, so it has a score; a null id is not held
    out and never a training row.  Repeated rows and equal texts get equal
    scores.  Without labelled rows the net is untrained and scores are near
    1/2; no documents give no rows.  Other columns are ignored.
    """
    net = trained(docs, labels, id_col, text_col, label_col, max_rows, max_bytes)
    return (docs.select(F.col(id_col), score_of(net)(F.col(text_col)).alias("score"))
            .select(id_col, F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", max_rows: int = 2000, max_bytes: int = 1 << 16) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts good, all columns kept; no shuffle."""
    net = trained(docs, labels, id_col, text_col, label_col, max_rows, max_bytes)
    return docs.where(score_of(net)(F.col(text_col)) >= 0.5)
