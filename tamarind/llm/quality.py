"""Quality classifier (operator 2): hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Tokens are words and runs of other marks. Single tokens and pairs of neighbours are
hashed; a token that repeats the one before it becomes one common token, and a word in
capitals adds a token for that, so that such habits weigh the same whatever the words.
A text's features are their shares of all its n-grams.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField

from tamarind.llm.common import Codes, Shared, add_columns, hold, labelled_sample, list_array, mix64

BITS = 18
#: Labelled documents that the model is fitted on, at most.
MAX_TRAIN = 6000
EPOCHS = 10
BATCH = 16
#: A score from which a document is predicted to have the label.
CUT = 0.3
CACHED_TOKENS = 120_000

_TOKENS = regex.compile(r"\w+|[^\w\s]+")
_AGAIN = np.uint64(0x5851F42D4C957F2D)
_CAPITALS = np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0x2545F4914F6CDD1D)


def text_hash(words: list[str]) -> np.ndarray:
    """64-bit hashes of strings, the same on every machine."""
    data = [w.encode() for w in words]
    size = np.fromiter(map(len, data), np.int64, len(data))
    flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(data)), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    mixed = mix64(flat + np.uint64(257) * (place.astype(np.uint64) + np.uint64(1)))
    total = np.zeros(len(data), np.uint64)
    np.add.at(total, owner, mixed)
    return mix64(total + size.astype(np.uint64))


class NGrams:
    """Hashed features of texts; one for each Python worker."""

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.codes, self.hash, self.capitals = Codes(), np.zeros(0, np.uint64), np.zeros(0, bool)

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature number) of every n-gram and the n-grams of each text."""
        kept = self.codes.shrink(CACHED_TOKENS)
        if kept is not None:
            self.hash, self.capitals = self.hash[kept], self.capitals[kept]
        code, count = self.codes.of([_TOKENS.findall(t or "") for t in texts])
        if new := self.codes.take_new():
            self.hash = np.concatenate([self.hash, text_hash([w.lower() for w in new])])
            self.capitals = np.concatenate([self.capitals, [len(w) > 1 and w.isupper() for w in new]]).astype(bool)
        doc = np.repeat(np.arange(len(texts)), count)
        h = self.hash[code]
        pair = np.flatnonzero(doc[1:] == doc[:-1])
        again = np.zeros(len(h), bool)
        again[pair + 1] = h[pair] == h[pair + 1]
        h = np.where(again, _AGAIN, h)
        capital = doc[self.capitals[code]]
        grams = np.concatenate([h, mix64(h[pair] * _PAIR + h[pair + 1]), np.full(len(capital), _CAPITALS)])
        owner = np.concatenate([doc, doc[pair], capital])
        return owner, (mix64(grams) >> self.shift).astype(np.int64), np.bincount(owner, minlength=len(texts))


def ftrl(start: np.ndarray, index: np.ndarray, value: np.ndarray, label: np.ndarray, size: int, epochs: int,
         batch: int, alpha: float, l1: float, l2: float, beta: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias by per-coordinate follow-the-regularised-leader over small batches.

    ``start`` (n + 1) bounds each row's ``index``/``value`` pairs. Rows come in the order
    given in each epoch.
    """
    z, g2, w = np.zeros(size), np.zeros(size), np.zeros(size)
    zb = gb = bias = 0.0
    for _ in range(epochs):
        for a in range(0, len(label), batch):
            b = min(a + batch, len(label))
            idx, val = index[start[a]:start[b]], value[start[a]:start[b]]
            owner = np.repeat(np.arange(b - a), np.diff(start[a:b + 1]))
            logit = bias + np.bincount(owner, w[idx] * val, minlength=b - a)
            error = 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35))) - label[a:b]
            touched, back = np.unique(idx, return_inverse=True)
            g = np.bincount(back, error[owner] * val, minlength=len(touched))
            rate = (np.sqrt(g2[touched] + g * g) - np.sqrt(g2[touched])) / alpha
            z[touched] += g - rate * w[touched]
            g2[touched] += g * g
            zt = z[touched]
            w[touched] = np.where(np.abs(zt) <= l1, 0.0, (np.sign(zt) * l1 - zt) / ((beta + np.sqrt(g2[touched])) / alpha + l2))
            e = float(error.sum())
            rate = (math.sqrt(gb + e * e) - math.sqrt(gb)) / alpha
            zb, gb = zb + e - rate * bias, gb + e * e
            bias = -zb / ((beta + math.sqrt(gb)) / alpha + 1e-6)
    return w, bias


def collect_rows(rows: DataFrame):
    """(row bounds, feature numbers, values, labels) of a bounded sample, in a fixed order
    that mixes the labels."""
    table = rows.orderBy(F.xxhash64(F.lit("order"), "_id"), "_id").toArrow()
    lists = table["features"].combine_chunks()
    size = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    start = np.concatenate([[0], np.cumsum(size)])
    value = np.asarray(table["value"].combine_chunks().flatten(), np.float64)
    return start, np.asarray(lists.flatten(), np.int64), value, np.asarray(table["_label"], np.float64)


def _sample_features(rows: DataFrame, bits: int) -> DataFrame:
    fields = [StructField("features", ArrayType(IntegerType())), StructField("value", ArrayType(FloatType()))]

    def make():
        grams = NGrams(bits)

        def fn(batch):
            owner, index, total = grams.features(batch.column("text").to_pylist())
            key, n = np.unique(owner << bits | index, return_counts=True)
            owner, index = key >> bits, key & ((1 << bits) - 1)
            size = np.bincount(owner, minlength=batch.num_rows)
            return [list_array(index.astype(np.int32), size, pa.int32()),
                    list_array((n / total[owner]).astype(np.float32), size, pa.float32())]

        return fn

    return add_columns(rows, ["text"], fields, make, keep=["_id", "_label"])


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, label: str = "quality",
          max_train: int = MAX_TRAIN, bits: int = BITS) -> tuple[np.ndarray, float]:
    """Weights and bias fitted on at most ``max_train`` labelled documents where
    ``learn_from`` (a condition on ``doc_id``) holds. Without any, all weights are 0."""
    sample = labelled_sample(docs, labels, label, learn_from, max_train)
    start, index, value, y = collect_rows(_sample_features(sample, bits))
    return ftrl(start, index, value, y, 1 << bits, EPOCHS, BATCH, alpha=100.0, l1=0.01, l2=0.00001)


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", keep: list[str] | None = None,
          cut: float = CUT, bits: int = BITS) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: the label likelier) and ``predicted``
    (1 if score >= ``cut``). A null or empty text has no features and gets the score of the
    bias. Existing columns with the names of added ones are replaced."""
    shared = Shared(docs.sparkSession, model)  # 2 ** bits weights

    def make():
        grams, (weight, bias) = hold(shared.id, lambda: NGrams(bits)), shared.value

        def fn(batch):
            owner, index, total = grams.features(batch.column(text_col).to_pylist())
            logit = bias + np.bincount(owner, weight[index], minlength=batch.num_rows) / np.maximum(total, 1)
            p = 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35)))
            return [pa.array(p), pa.array((p >= cut).astype(np.int32))]

        return fn

    return add_columns(docs, [text_col], [StructField("score", DoubleType()), StructField("predicted", IntegerType())], make, keep)
