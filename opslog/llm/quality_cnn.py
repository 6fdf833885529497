"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover the whole
document; every filter window lies whole in some chunk.  ``FILTERS`` learned
filters of ``WIDTH`` bytes slide over a chunk (one table of weights per byte
position, that is a convolution over one-hot bytes), the response is
max-pooled over the chunk and rectified, and the document's mean and maximum of
the pooled chunk features go through a logistic layer to one probability.

Training uses a sample of labelled rows of documented size (``TRAIN_PER_CLASS``
rows of each class, texts of at most ``TRAIN_MAX_BYTES``, chosen by a hash of
the id among rows that are not held out); scoring covers every byte of every
document, block by block, so memory does not grow with the text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import held_out

FILTERS, WIDTH, STRIDE = 16, 8, 2
CHUNK, STEP = 512, 504  # neighbours share WIDTH bytes, so that no filter window is cut
POS = (CHUNK - WIDTH) // STRIDE + 1
PAD = 256  # the byte after the end of a text
TRAIN_PER_CLASS, TRAIN_MAX_BYTES = 1500, 200_000
EPOCHS, BATCH, RATE = 8, 32, 0.02
BLOCK = 96  # chunks that are convolved at once


class ByteCNN:
    """Weights: ``table`` (WIDTH, 257, FILTERS), ``bias`` (FILTERS,), ``out`` (2 * FILTERS + 1,)."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.15, (WIDTH, 257, FILTERS)).astype(np.float32)
        self.table[:, PAD] = 0
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = np.concatenate([rng.normal(0, 0.1, 2 * FILTERS), [0.0]]).astype(np.float32)

    @staticmethod
    def chunks(text: bytes) -> np.ndarray:
        """(n, CHUNK) byte values; the last chunk is padded. An empty text has no chunk."""
        n = len(text)
        if n == 0:
            return np.empty((0, CHUNK), np.int16)
        k = max(1, -(-(n - WIDTH) // STEP))
        buf = np.full((k - 1) * STEP + CHUNK, PAD, np.int16)
        buf[: min(n, len(buf))] = np.frombuffer(text, np.uint8)[: len(buf)]
        return np.lib.stride_tricks.as_strided(buf, (k, CHUNK), (buf.strides[0] * STEP, buf.strides[0]), writeable=False)

    def pooled(self, x: np.ndarray, where: bool = False):
        """Filter maxima of each chunk before the bias, and on request their positions."""
        best = np.empty((len(x), FILTERS), np.float32)
        at = np.empty((len(x), FILTERS), np.int32) if where else None
        for a in range(0, len(x), BLOCK):
            part = x[a:a + BLOCK]
            z = self.table[0][part[:, 0:2 * POS:STRIDE]]
            for k in range(1, WIDTH):
                z += self.table[k][part[:, k:k + STRIDE * (POS - 1) + 1:STRIDE]]
            best[a:a + BLOCK] = z.max(axis=1)
            if where:
                at[a:a + BLOCK] = z.argmax(axis=1)
        return best, at

    def score(self, text: bytes) -> float:
        n = len(text)
        if n == 0:
            return float(1 / (1 + np.exp(-self.out[-1])))
        total, top, rows = np.zeros(FILTERS), np.zeros(FILTERS, np.float32), 0
        span = 4096 * STEP
        for a in range(0, max(1, n - WIDTH), span):  # blocks of chunks; the next one starts where the last chunk's successor would
            best, _ = self.pooled(self.chunks(text[a:a + span + WIDTH]))
            f = np.maximum(best + self.bias, 0)
            total, top, rows = total + f.sum(axis=0), np.maximum(top, f.max(axis=0)), rows + len(f)
        v = np.concatenate([total / rows, top])
        return float(1 / (1 + np.exp(-np.clip(v @ self.out[:-1] + self.out[-1], -30, 30))))

    def fit(self, texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> "ByteCNN":
        """Adam on the logistic loss; classes are weighted alike. The gradient reaches only the windows that won a maximum."""
        if not texts:
            return self
        rng, n = np.random.default_rng(seed), len(texts)
        share = np.bincount(y, minlength=2) / n
        if share.min() == 0:  # one class only: its smoothed share
            self.out[:] = 0
            self.out[-1] = np.log((y.sum() + 1) / (n - y.sum() + 1))
            return self
        weight = (0.5 / share)[y]
        params = [self.table, self.bias, self.out]
        m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for epoch in range(epochs):
            order, rate = rng.permutation(n), RATE * (1 - epoch / epochs) + RATE / 20
            for b in range(0, n, BATCH):
                ids = order[b:b + BATCH]
                parts = [self.chunks(texts[i]) for i in ids]
                size = np.array([len(p) for p in parts])
                ids, size = ids[size > 0], size[size > 0]
                if not len(ids):
                    continue
                x = np.concatenate([p for p in parts if len(p)])
                best, at = self.pooled(x, where=True)
                f = np.maximum(best + self.bias, 0)
                first = np.concatenate([[0], np.cumsum(size)[:-1]])
                mean, top = np.add.reduceat(f, first) / size[:, None], np.maximum.reduceat(f, first)
                feats = np.concatenate([mean, top, np.ones((len(ids), 1), np.float32)], axis=1)
                p = 1 / (1 + np.exp(-np.clip(feats @ self.out, -30, 30)))
                err = ((p - y[ids]) * weight[ids] / len(ids)).astype(np.float32)
                doc = np.repeat(np.arange(len(ids)), size)
                gf = err[doc, None] * (self.out[:FILTERS] / size[doc, None]
                                       + self.out[FILTERS:-1] * (f == top[doc])) * (f > 0)
                gt = np.zeros_like(self.table)
                rows, lanes = np.arange(len(x))[:, None], np.arange(FILTERS)
                for k in range(WIDTH):
                    cell = x[rows, at * STRIDE + k].astype(np.int64) * FILTERS + lanes
                    gt[k] = np.bincount(cell.ravel(), gf.ravel(), 257 * FILTERS).reshape(257, FILTERS)
                gt[:, PAD] = 0
                t += 1
                for j, g in enumerate((gt, gf.sum(axis=0), feats.T @ err + 1e-4 * self.out)):
                    m[j] = 0.9 * m[j] + 0.1 * g
                    v[j] = 0.999 * v[j] + 0.001 * g * g
                    params[j] -= (rate * (m[j] / (1 - 0.9 ** t)) / (np.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-7)).astype(np.float32)
        return self


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> DataFrame:
    """(text, quality) of at most ``per_class`` labelled documents of each class that are not held out.

    A document that is labelled twice counts once, with its lower label; null
    labels, other values and documents without text are left out.
    """
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    order = F.xxhash64(F.col("doc_id"), F.lit("quality sample"))
    picked = known.where("quality = 0").orderBy(order, "doc_id").limit(per_class) \
        .unionByName(known.where("quality = 1").orderBy(order, "doc_id").limit(per_class))
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= TRAIN_MAX_BYTES)
    return texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "quality")  # 2 * per_class rows at most


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> ByteCNN:
    rows = sorted(((r.doc_id, r.text, r.quality) for r in training_sample(docs, labels, per_class).collect()))
    return ByteCNN().fit([r[1].encode() for r in rows], np.array([r[2] for r in rows], dtype=np.int64))


def quality_score(text: Column | str, model: ByteCNN) -> Column:
    """Probability of label 1 for each whole text; null and empty texts get the network's bias."""
    @F.pandas_udf("double")
    def score(s):
        import pandas as pd
        return pd.Series([model.score(t.encode() if isinstance(t, str) else b"") for t in s], dtype="float64")
    return score(text)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (1 if the score reaches ``threshold``).

    One row per input row, repeated and null ids included; other columns are not carried.
    """
    model = fit_quality(docs, labels)
    return (docs.select("doc_id", held_out("doc_id").alias("held_out"), quality_score("text", model).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
