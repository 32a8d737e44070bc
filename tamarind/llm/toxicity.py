"""Toxicity (operator 10): a factorization machine over hashed terms.

Terms are the distinct lower-cased words of a text and the beginnings of longer words.
Besides a weight, a term has a short vector; the inner products of the vectors of the
terms that occur together add what a sum of weights misses (an insult next to the mention
of a group). Every term of the sample is trained, also one whose weight alone is zero:
half of a combination may say nothing by itself. Weights and vectors both move by
follow-the-regularised-leader, so the thousands of terms that the sample says little about
stay out of the machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField

from tamarind.llm.common import Codes, Shared, add_columns, hold, labelled_sample, list_array, mix64
from tamarind.llm.quality import collect_rows, text_hash

BITS = 18
FACTORS = 6
MAX_TRAIN = 12000
EPOCHS = 6
BATCH = 32
CUT = 0.3
CACHED_WORDS = 120_000
#: Beginnings of words that are terms of their own.
PREFIXES = (4, 6)

_WORDS = regex.compile(r"\w+")


class Terms:
    """Hashed terms of words; one for each Python worker."""

    def __init__(self, bits: int, active: np.ndarray | None = None):
        self.shift, self.active = np.uint64(64 - bits), active
        self.codes, self.number = Codes(), np.zeros((0, 1 + len(PREFIXES)), np.int64)

    def _numbers(self, words: list[str]) -> np.ndarray:
        cols = [text_hash(words)]
        for k in PREFIXES:
            cols.append(np.where([len(w) > k for w in words], mix64(text_hash([w[:k] for w in words]) + np.uint64(k)), cols[0]))
        number = (np.stack(cols, axis=1) >> self.shift).astype(np.int64)
        return number if self.active is None else np.where(self.active[number], number, -1)

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text, term number) of each distinct term, ordered by text; dropped terms left out."""
        kept = self.codes.shrink(CACHED_WORDS)
        if kept is not None:
            self.number = self.number[kept]
        code, count = self.codes.of([_WORDS.findall((t or "").lower()) for t in texts])
        if new := self.codes.take_new():
            self.number = np.concatenate([self.number, self._numbers(new)])
        doc = np.repeat(np.arange(len(texts)), count)
        number = self.number[code]
        key = np.unique(((doc[:, None] << 32) | number)[number >= 0])
        return key >> 32, key & 0xFFFFFFFF


class Machine:
    """Bias, weights and vectors of a factorization machine over 2 ** bits terms."""

    def __init__(self, bias: float, weight: np.ndarray, vectors: np.ndarray):
        self.bias, self.weight, self.vectors = bias, weight, vectors

    def logits(self, owner: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
        """w0 + sum of w + half of (square of the sum of v, less the sum of squares)."""
        out = self.bias + np.bincount(owner, self.weight[index], minlength=n)
        v = self.vectors[index]
        for f in range(v.shape[1]):
            out += 0.5 * (np.bincount(owner, v[:, f], minlength=n) ** 2 - np.bincount(owner, v[:, f] ** 2, minlength=n))
        return out


class _Leader:
    """Coordinates moved by follow-the-regularised-leader: one leaves 0 only when the gradients
    that pull on it add up to more than ``l1``, whatever fits the sample beyond that."""

    def __init__(self, shape, alpha: float, l1: float, beta: float, l2: float = 0.001):
        self.value, self.z, self.g2 = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        self.alpha, self.l1, self.beta, self.l2 = alpha, l1, beta, l2

    def move(self, at, g) -> None:
        before, after = np.sqrt(self.g2[at]), np.sqrt(self.g2[at] + g * g)
        self.z[at] += g - (after - before) / self.alpha * self.value[at]
        self.g2[at] += g * g
        z = self.z[at]
        self.value[at] = np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + after) / self.alpha + self.l2))


def fit(start: np.ndarray, index: np.ndarray, label: np.ndarray, bits: int = BITS, factors: int = FACTORS,
        epochs: int = EPOCHS, l1: float = 8.0, pair_l1: float = 4.0) -> Machine:
    """Weights, then weights and vectors together, over small batches; all by the same rule.

    Vectors start at small random values, and a term's vector leaves its start only when the
    errors of more than about ``pair_l1`` rows pull it one way; a vector that never does is no
    part of the machine. So terms that only happen to occur in a few toxic rows of the sample
    get neither weight nor vector, while a pair of terms that says something does, even if
    neither of the two does alone."""
    size = 1 << bits
    used = np.bincount(index, minlength=size) > 0
    terms_of_a_row = max(1.0, len(index) / max(1, len(label)))
    # so small that the untrained interactions of a text of usual length add up to about 0.1
    spread = np.sqrt(0.1 * np.sqrt(2 / factors) / terms_of_a_row)
    begin = np.where(used[:, None], np.random.default_rng(7).normal(0, spread, (size, factors)), 0.0)
    weight, bias = _Leader(size, 1.0, l1, 1.0), _Leader(1, 1.0, 0.0, 1.0, 1e-6)
    # one row pulls a vector by its other terms' vectors, about this far
    change = _Leader((size, factors), 0.1, pair_l1 * spread * np.sqrt(terms_of_a_row), 0.01)
    none = np.zeros((size, 0))
    m = Machine(0.0, weight.value, none)
    for epoch in range(2 * epochs):
        if epoch == epochs:
            m.vectors = begin.copy()
        for a in range(0, len(label), BATCH):
            b = min(a + BATCH, len(label))
            owner = np.repeat(np.arange(b - a), np.diff(start[a:b + 1]))
            idx = index[start[a]:start[b]]
            error = 1.0 / (1.0 + np.exp(-np.clip(m.logits(owner, idx, b - a), -35, 35))) - label[a:b]
            bias.move([0], error.sum(keepdims=True))
            m.bias = float(bias.value[0])
            if not len(idx):
                continue
            terms, back = np.unique(idx, return_inverse=True)
            weight.move(terms, np.bincount(back, error[owner], minlength=len(terms)))
            if epoch >= epochs:
                v = m.vectors[idx]
                total = np.stack([np.bincount(owner, v[:, f], minlength=b - a) for f in range(factors)], axis=1)
                each = error[owner][:, None] * (total[owner] - v)
                change.move(terms, np.stack([np.bincount(back, each[:, f], minlength=len(terms)) for f in range(factors)], axis=1))
                m.vectors[terms] = begin[terms] + change.value[terms]
    if len(label):
        m.vectors[~change.value.any(axis=1)] = 0.0
    return m


def _sample_terms(rows: DataFrame, bits: int) -> DataFrame:
    fields = [StructField("features", ArrayType(IntegerType())), StructField("value", ArrayType(FloatType()))]

    def make():
        terms = Terms(bits)

        def fn(batch):
            owner, index = terms.features(batch.column("text").to_pylist())
            size = np.bincount(owner, minlength=batch.num_rows)
            return [list_array(index.astype(np.int32), size, pa.int32()),
                    list_array(np.zeros(0, np.float32), np.zeros(batch.num_rows, np.int64), pa.float32())]

        return fn

    return add_columns(rows, ["text"], fields, make, keep=["_id", "_label"])


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, label: str = "toxic",
          max_train: int = MAX_TRAIN, bits: int = BITS) -> Machine:
    """A machine fitted on at most ``max_train`` labelled documents where ``learn_from`` (a
    condition on ``doc_id``) holds. Without any, all weights are 0."""
    sample = labelled_sample(docs, labels, label, learn_from, max_train)
    start, index, _, y = collect_rows(_sample_terms(sample, bits))
    return fit(start, index, y, bits)


def score(docs: DataFrame, machine: Machine, text_col: str = "text", keep: list[str] | None = None,
          cut: float = CUT, bits: int = BITS) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` (1 if score
    >= ``cut``). A null or empty text gets the score of the bias. Existing columns with the
    names of added ones are replaced."""
    shared = Shared(docs.sparkSession, machine)  # 2 ** bits rows of 1 + FACTORS numbers

    def make():
        machine = shared.value
        terms = hold(shared.id, lambda: Terms(bits, (machine.weight != 0) | machine.vectors.any(axis=1)))

        def fn(batch):
            owner, index = terms.features(batch.column(text_col).to_pylist())
            p = 1.0 / (1.0 + np.exp(-np.clip(machine.logits(owner, index, batch.num_rows), -35, 35)))
            return [pa.array(p), pa.array((p >= cut).astype(np.int32))]

        return fn

    return add_columns(docs, [text_col], [StructField("score", DoubleType()), StructField("predicted", IntegerType())], make, keep)
