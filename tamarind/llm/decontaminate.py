"""Benchmark decontamination (operator 5).

One Aho-Corasick automaton holds every window of 10 consecutive words of the normalised
test questions and answers. Each document text is normalised once, scanned once, and the
matches are mapped back to word numbers and to character offsets of the original text.

The automaton runs over word numbers, not letters: a window is ten nodes at most, which it
shares with its neighbours' beginnings. Each Python worker builds it from a broadcast list of
items. A benchmark of more than ``BLOCK_NODES`` nodes is dealt by a hash of its text into
blocks of that size; then each block is a pass of its own that writes the hits only (so one
automaton is alive in a worker), and all hits meet their documents in a last pass. With one
block documents are never shuffled; with several they are only where the hits are too many to
be broadcast.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from tamarind.llm.common import WORD_PATTERN, Norm, Shared, SpanHash, Workspace, add_columns, hold, kept_columns, text_buffers
from tamarind.operators.joins import maybe_broadcast

WINDOW = 10
#: Nodes that one automaton takes, counted as ten for each word of its items; some 70 bytes each.
BLOCK_NODES = 2_000_000

HIT = StructType([StructField("first", LongType()), StructField("last", LongType()), StructField("item", StringType())])
SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
_HITS = "_benchmark_hits"
_HIT_TYPE = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("item", pa.string())])


class Windows:
    """The automaton of some items (id, text): their words are numbered from 1, every other word
    and the end of a text is 0. Words are numbered by their hashes, a whole batch at once; a
    match is held against the window's bytes, so that equal hashes of different words do not count."""

    def __init__(self, items: list[tuple[str, str]], size: int = WINDOW):
        norm = Norm(*text_buffers(pa.array([t for _, t in items], pa.large_string())))
        hashes = SpanHash(norm.text)(norm.first, norm.last) if len(norm.first) else np.zeros(0, np.uint64)
        self.keys, code = np.unique(hashes, return_inverse=True)
        code, self.text = (code + 1).tolist(), norm.text.tobytes()
        held: dict[tuple, tuple] = {}
        for i, (name, _) in enumerate(items):
            a, b = int(norm.words_before[i]), int(norm.words_before[i + 1])
            for j in range(a, max(a + 1, b - size + 1) if b > a else a):
                end = min(j + size, b)
                window = held.get(key := tuple(code[j:end]))
                if window is None:
                    held[key] = (end - j, [name], int(norm.first[j]), int(norm.last[end - 1]) + 1)
                elif window[1][-1] != name:
                    window[1].append(name)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE) if held else None
        while held:
            window, value = held.popitem()
            self.automaton.add_word(window, value)
        if self.automaton is not None:
            self.automaton.make_automaton()

    def hits(self, norm: Norm):
        """(text, first word, last word, item) of each match, words counted within the text,
        ordered by text."""
        doc, first, last, item = [], [], [], []
        if self.automaton is not None and len(norm.first):
            found = SpanHash(norm.text)(norm.first, norm.last)
            at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            # a text's end takes a place of its own, so that no window crosses to the next
            code = np.zeros(len(found) + len(norm.n_words), np.int64)
            code[np.arange(len(found)) + norm.doc] = np.where(self.keys[at] == found, at + 1, 0)
            begins = norm.words_before[:-1] + np.arange(len(norm.n_words))
            text = None
            for end, (k, names, a, b) in self.automaton.iter(tuple(code.tolist())):
                text = norm.text.tobytes() if text is None else text
                r = int(np.searchsorted(begins, end, side="right")) - 1
                word = int(norm.words_before[r]) + end - int(begins[r])
                if text[norm.first[word - k + 1]:norm.last[word] + 1] == self.text[a:b]:
                    for name in names:
                        doc.append(r)
                        last.append(end - int(begins[r]))
                        first.append(end - int(begins[r]) - k + 1)
                        item.append(name)
        return np.asarray(doc, np.int64), np.asarray(first, np.int64), np.asarray(last, np.int64), np.array(item, object)


def _spans(norm: Norm, data: np.ndarray, off: np.ndarray, r: int, first, last) -> tuple[int, list[dict]]:
    """Words of text ``r`` inside a match, and where they stand in the original, merged."""
    edge = np.zeros(int(norm.n_words[r]) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, np.asarray(last) + 1, -1)
    inside = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
    base = int(norm.words_before[r])
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]) + base, np.flatnonzero(inside[:-1] & ~inside[1:]) - 1 + base
    char = np.cumsum((data[off[r]:off[r + 1]] & 0xC0) != 0x80) - 1  # character number of each byte
    return int(inside.sum()), [{"start": int(char[norm.src_first[s] - off[r]]), "end": int(char[norm.src_last[e] - off[r]]) + 1}
                               for s, e in zip(starts.tolist(), ends.tolist())]


def _findings(norm: Norm, data, off, doc, first, last, item) -> list[pa.Array]:
    """The columns that follow from all hits of a batch, which are ordered by text."""
    n = len(off) - 1
    edge = np.searchsorted(doc, np.arange(n + 1))
    n_hit, items, spans = np.zeros(n, np.int64), [[] for _ in range(n)], [[] for _ in range(n)]
    for r in np.flatnonzero(np.diff(edge)).tolist():
        here = slice(edge[r], edge[r + 1])
        n_hit[r], spans[r] = _spans(norm, data, off, r, first[here], last[here])
        items[r] = sorted(set(item[here]))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return [pa.array(norm.n_words, pa.int64()), pa.array(n_hit), pa.array(items, pa.list_(pa.string())), pa.array(spans, kind), pa.array(n_hit > 0)]


_FIELDS = [StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("items", ArrayType(StringType())),
           StructField("hit_spans", ArrayType(SPAN)), StructField("contaminated", BooleanType())]


def _scan(docs: DataFrame, shared, text_col: str, window: int) -> DataFrame:
    """One pass with the automaton of the one block there is."""
    def make():
        windows = hold(shared.id, lambda: Windows(shared.value, window))

        def fn(batch):
            data, off = text_buffers(batch.column(text_col))
            norm = Norm(data, off)
            return _findings(norm, data, off, *windows.hits(norm))

        return fn

    return add_columns(docs, [text_col], _FIELDS, make)


def _hits_of_block(texts: DataFrame, shared, window: int) -> DataFrame:
    """(key, hits) of the texts that hold a window of a block; ``texts`` has key and text."""
    def make():
        windows = hold(shared.id, lambda: Windows(shared.value, window))

        def fn(batch):
            norm = Norm(*text_buffers(batch.column("text")))
            doc, first, last, item = windows.hits(norm)
            edge = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            hits = pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(item, pa.string())], fields=list(_HIT_TYPE))
            return [pa.ListArray.from_arrays(pa.array(edge), hits)]

        return fn

    return add_columns(texts, ["text"], [StructField("hits", ArrayType(HIT))], make, keep=["key"]).where("size(hits) > 0")


def _finish(docs: DataFrame, text_col: str) -> DataFrame:
    """The last pass of several: the hits of all blocks, as columns."""
    def make():
        def fn(batch):
            data, off = text_buffers(batch.column(text_col))
            norm = Norm(data, off)
            col = batch.column(_HITS)
            count = np.asarray(col.value_lengths().fill_null(0), np.int64)
            flat = col.flatten()
            return _findings(norm, data, off, np.repeat(np.arange(batch.num_rows), count), np.asarray(flat.field("first"), np.int64),
                             np.asarray(flat.field("last"), np.int64), np.array(flat.field("item").to_pylist(), object))

        return fn

    return add_columns(docs, [text_col, _HITS], _FIELDS, make, keep=[c for c in docs.columns if c != _HITS])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """``docs`` with what it shares with the benchmark.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``items`` (sorted
    distinct ids, as strings, of the items with an occurring window), ``hit_spans``
    (character offsets in the original text, merged) and ``contaminated`` (n_hit > 0).
    A window is ``window`` consecutive words of an item; an item of fewer words, but not
    none, is one window. Null and empty texts have no words, an item without words or
    without id is skipped, an empty benchmark contaminates nothing, repeated items count
    once. An item longer than a block has a block of its own. Columns of ``docs`` with the
    names of added ones are replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).alias("text"))
    items = items.where("id IS NOT NULL AND text IS NOT NULL")
    words = items.agg(F.sum(F.regexp_count("text", F.lit(WORD_PATTERN)))).first()[0] or 0
    blocks = max(1, -(-words * window // block_nodes))
    if blocks == 1:
        rows = [tuple(r) for r in items.collect()]  # at most block_nodes / window words
        return _scan(docs, Shared(spark, rows), text_col, window)
    ws = Workspace(spark, "decontaminate")
    own = docs.select(*kept_columns(docs, _FIELDS, None))
    key = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    texts, found = own.select(key.alias("key"), F.col(text_col).alias("text")), None
    items = ws.write(items.distinct().withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks))).hint("rebalance", "block"), "items")
    for k in range(blocks):
        rows = [tuple(r) for r in items.where(F.col("block") == k).select("id", "text").collect()]  # about block_nodes / window words
        hits = ws.write(_hits_of_block(texts, Shared(spark, rows), window), f"hits{k}").withColumn("block", F.lit(k))
        found = hits if found is None else found.unionByName(hits)
    # equal texts have equal hits
    found = found.groupBy("key", "block").agg(F.any_value("hits").alias("hits")).groupBy("key").agg(F.flatten(F.collect_list("hits")).alias(_HITS))
    found = maybe_broadcast(ws.write(found, "hits"))
    joined = own.join(found, key == found["key"], "left").select(*[own[f"`{c}`"] for c in own.columns], _HITS)
    return _finish(joined, text_col)
