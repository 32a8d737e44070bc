"""Shared helpers of the training-data operators.

* ``add_columns``: run a vectorised function over Arrow batches, adding columns.
* ``Norm``: byte-level word normaliser for a batch of texts (numpy, no per-word Python).
* ``Workspace``: tables written to the shared scratch folder to cut lineage.
* ``labelled_sample``: a bounded training sample of labelled documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tamarind.session import remove_path, scratch_root

#: Text bytes handled at once inside a task; one longer text is handled alone, whole.
CHUNK_BYTES = 1 << 20
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null: empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    if data is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, inputs: list[str], limit: int):
    """Slices of a batch with about ``limit`` bytes of input text each (one row at least)."""
    if not batch.num_rows:
        return
    size = np.zeros(batch.num_rows, np.int64)
    for name in inputs:
        col = batch.column(name)
        if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
            size += np.asarray(pc.fill_null(pc.binary_length(col), 0).cast(pa.int64()))
    part = np.cumsum(size) // limit
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows]):
        yield batch.slice(int(a), int(b - a))


def kept_columns(df: DataFrame, fields: list[StructField], keep: list[str] | None) -> list[str]:
    """Columns to carry along: a column whose name equals an added one is replaced."""
    taken = {f.name.lower() for f in fields}
    return [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]


def small_batches(spark: SparkSession) -> None:
    """Lets Spark hand texts to Python in batches of 1,000 rows where the session has Spark's
    default of 10,000: its buffers outside the heap grow with a batch's bytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def add_columns(df: DataFrame, inputs: list[str], fields: list[StructField],
                make: Callable[[], Callable[[pa.RecordBatch], list]], keep: list[str] | None = None,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``df`` with ``fields`` added by a function over Arrow batches; a narrow step.

    ``make()`` runs once per task and returns the batch function, which gets at most
    ``chunk_bytes`` of text (a longer single text whole) and returns one Arrow array per
    field. ``keep`` names the columns carried along (all by default); an existing column
    with the name of an added one is replaced.
    """
    small_batches(df.sparkSession)
    keep = kept_columns(df, fields, keep)
    src = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, *inputs])])
    schema = StructType([src.schema[c] for c in keep] + fields)
    names = schema.names

    def run(batches):
        fn = make()
        for batch in batches:
            for part in chunks(batch, inputs, chunk_bytes):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *fn(part)], names)

    return src.mapInArrow(run, schema)


def list_array(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of values in each row."""
    off = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, kind))


def _word_table() -> np.ndarray:
    t = np.full(256, 32, np.uint8)
    for b in range(256):
        if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80:
            t[b] = b
        elif 0x41 <= b <= 0x5A:
            t[b] = b + 32
    return t


_WORD = _word_table()


class Norm:
    """Words of a batch of texts: A-Z lower-cased, words are runs of ``WORD_PATTERN``.

    ``text`` is `` w1 w2 w3 \\n w4 ...``: every word between single spaces, and a line
    feed between texts, so that no word sequence crosses from one text to the next.
    ``first``/``last``: place of each word's first and last byte in ``text``;
    ``doc``: its text; ``words_before``: words before each text (n + 1 values).
    """

    def __init__(self, data: np.ndarray, off: np.ndarray):
        low = _WORD[data]
        is_word = low != 32
        begins = is_word.copy()
        begins[1:] &= ~is_word[:-1]
        cut = off[1:-1][off[1:-1] < len(low)]
        begins[cut] = is_word[cut]
        ends = is_word.copy()
        ends[:-1] &= ~is_word[1:]
        before = cut[cut > 0] - 1
        ends[before] = is_word[before]
        self.src_first, self.src_last = np.flatnonzero(begins), np.flatnonzero(ends)
        n_docs = len(off) - 1
        self.words_before = np.searchsorted(self.src_first, off)
        self.n_words = np.diff(self.words_before)
        self.doc = np.repeat(np.arange(n_docs), self.n_words)
        size = self.src_last - self.src_first + 1
        done = np.cumsum(size) - size
        n = len(size)
        self.first = done + np.arange(n) + 1 + 2 * self.doc
        self.last = self.first + size - 1
        text = np.full(int(size.sum()) + n + 1 + 2 * n_docs, 32, np.uint8)
        place = np.repeat(self.first - done, size) + np.arange(int(size.sum()))
        text[place] = low[is_word]
        if n_docs > 1:
            total = np.concatenate([done, [int(size.sum())]])[self.words_before[1:-1]]
            text[total + self.words_before[1:-1] + 1 + 2 * np.arange(1, n_docs) - 2] = 10
        self.text = text

    def string(self) -> str:
        """``text`` with one character per byte, as the matcher reads it."""
        return self.text.tobytes().decode("latin-1")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (uint64, wraps)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class SpanHash:
    """64-bit hashes of spans of ``Norm.text`` from one prefix sum, modulo 2 ** 64."""

    BASE = 0x9E3779B97F4A7C15 | 1
    _byte = mix64(np.arange(256, dtype=np.uint64) + np.uint64(0x1234567))
    _power = _inverse = np.ones(1, np.uint64)

    @classmethod
    def powers(cls, n: int):
        if len(cls._power) < n:
            size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 1))
            base = np.full(size, cls.BASE, np.uint64)
            base[0] = 1
            back = np.full(size, pow(cls.BASE, -1, 1 << 64), np.uint64)
            back[0] = 1
            cls._power, cls._inverse = np.cumprod(base, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        return cls._power, cls._inverse

    def __init__(self, text: np.ndarray):
        power, self.inverse = self.powers(len(text) + 1)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self._byte[text] * power[:len(text)], dtype=np.uint64, out=self.sums[1:])

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix64((self.sums[last + 1] - self.sums[first]) * self.inverse[first])


def shingles(norm: Norm, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``k`` words; a text of 1 to k - 1 words has one."""
    if not len(norm.doc):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n = norm.n_words
    place = np.arange(len(norm.doc)) - norm.words_before[:-1][norm.doc]
    start = np.flatnonzero((place + k <= n[norm.doc]) | ((place == 0) & (n[norm.doc] < k)))
    d = norm.doc[start]
    end = np.minimum(start + k, norm.words_before[1:][d]) - 1
    return d, SpanHash(norm.text)(norm.first[start], norm.last[end])


class Shared:
    """A broadcast value of proven size with an id, under which a worker keeps what it builds."""

    def __init__(self, spark: SparkSession, value):
        self.id, self.cast = uuid.uuid4().hex, spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self.cast.value


class Codes(dict):
    """Numbers words in the order of their first look-up and notes the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.uses = np.zeros(0, np.int64)

    def __missing__(self, word):
        self[word] = i = len(self)
        self.new.append(word)
        return i

    def of(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(codes of all words, words per list)."""
        count = np.fromiter(map(len, words), np.int64, len(words))
        code = np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.int64, int(count.sum()))
        uses = np.bincount(code, minlength=len(self))
        uses[:len(self.uses)] += self.uses
        self.uses = uses
        return code, count

    def take_new(self) -> list[str]:
        new, self.new = self.new, []
        return new

    def shrink(self, limit: int, letters: int | None = None) -> np.ndarray | None:
        """Beyond ``limit`` words, or ``letters`` in all, keeps the most used ones up to half of
        that; the codes that those had, in the order of their new ones. Otherwise None."""
        if len(self) <= limit and (letters is None or sum(map(len, self)) <= letters):
            return None
        words = list(self)
        most = np.argsort(-self.uses, kind="stable")[:limit // 2]
        if letters is not None:
            most = most[np.cumsum([len(words[i]) for i in most.tolist()]) <= letters // 2]
        kept = np.sort(most)
        self.clear()
        self.update((words[i], k) for k, i in enumerate(kept.tolist()))
        self.uses = self.uses[kept]
        return kept


def row_sums(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows; 0 for an empty run."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    edge = np.concatenate([[0], np.cumsum(count)])
    return total[edge[1:]] - total[edge[:-1]]


_held: dict = {}


def hold(key, make):
    """What a Python worker keeps between tasks: the one value made last. A worker serves many
    operators in turn, so what another one kept is dropped first."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


class Workspace:
    """Tables in the shared scratch folder: they cut lineage and survive lost executors.

    What ``drop`` does not remove earlier goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        remove_path(spark, self.root, on_exit=True)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove_path(self.spark, f"{self.root}/{name}")


def unit_hash(c: Column, salt: str) -> Column:
    """A number in [0, 1) from a hash of a column."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), c), 11).cast("double") / F.lit(float(1 << 53))


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, learn: Column,
                    max_rows: int, id_col: str = "doc_id") -> DataFrame:
    """(id, text, label 0/1) of at most ``max_rows`` labelled documents, chosen by a hash of
    the id among those where ``learn`` holds. A document labelled twice counts as 1 when one
    of its labels is 1; of repeated ids the smallest text counts. Only the bounded id list
    is broadcast, never a text."""
    picked = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & learn)
              .groupBy(id_col).agg(F.max(F.col(label)).cast("int").alias("_label"))
              .orderBy(unit_hash(F.col(id_col), "sample"), id_col).limit(max_rows))
    picked = picked.withColumnRenamed(id_col, "_id")
    text = documents.select(F.col(id_col).alias("_doc"), F.coalesce("text", F.lit("")).alias("text"))
    return (text.join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
            .groupBy("_id", "_label").agg(F.min("text").alias("text")).select("_id", "text", "_label"))
