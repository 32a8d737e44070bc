"""BPE encoding and decoding (operator 3): speculate and verify.

A word's tokens are first proposed by greedy longest match. A sequence of tokens is the
BPE result exactly when every token is the result for its own bytes and every adjacent
pair of tokens is the result for its joined bytes, so the proposals of many words are
verified together: one vectorised test over all their tokens and adjacent pairs. Only
words with a failing token or pair are merged exactly, merge by merge.

Texts are split by the pattern of the tokenizer; each worker keeps the tokens of the words
it has seen, up to a bound, so a word is encoded once and then looked up.
"""

from __future__ import annotations

import heapq
import json
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField

from tamarind.llm.common import Codes, Shared, add_columns, hold, list_array

# fixed value: the split pattern of byte-level BPE files
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words a worker keeps the tokens of; beyond it the less used go.
CACHED_WORDS = 250_000
_NEVER = np.int64(1 << 40)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes
    stand for themselves, the others for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE file of the tokenizers library: tokens, merges, special tokens."""

    def __init__(self, source: str):
        data = json.loads(source)
        letters = byte_letters()
        model = data["model"]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        names = set(self.special.values())
        self.size = max([*model["vocab"].values(), *names]) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for text, i in model["vocab"].items():
            if i not in names:
                self.bytes[i] = bytes(letters[c] for c in text)
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        ids = {b: i for i, b in enumerate(self.bytes) if b and i not in names}
        self.ids = ids
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        left, right, made = [], [], []
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            a, b = bytes(letters[c] for c in a), bytes(letters[c] for c in b)
            left.append(ids[a])
            right.append(ids[b])
            made.append(ids[a + b])
        self.rank = {(a, b): (r, c) for r, (a, b, c) in reversed(list(enumerate(zip(left, right, made))))}
        # the merge that first makes each token; tokens without one are bytes (or never made)
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.made_at = np.full(self.size, -1, np.int64)
        for r in reversed(range(len(made))):
            self.left[made[r]], self.right[made[r]], self.made_at[made[r]] = left[r], right[r], r
        key = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        first = np.unique(key, return_index=True)
        self.pair_key, self.pair_rank = np.append(first[0], np.iinfo(np.int64).max), np.append(first[1], 0)
        self.reach: dict[bytes, int] = {}  # longest token by its first two bytes
        for token in ids:
            self.reach[token[:2]] = max(self.reach.get(token[:2], 1), len(token))
        self.sound = self._sound_tokens()
        self.is_special = np.zeros(self.size, bool)
        self.is_special[list(names)] = True

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; ``_NEVER`` where there is none."""
        key = a * self.size + b
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the border of each pair of sound tokens before rank ``until``.

        Merging is undone on both sides of the border, the later merge first. The pieces
        that touch the border at one time would have merged if their merge came before the
        next merge on the left side, and no later than the one on the right side (of equal
        merges the left one comes first).
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        next_a, next_b = until.astype(np.int64), until.astype(np.int64)  # when a piece is merged away
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            rank = self._merge_rank(x, y)
            crossed = (rank < next_a[live]) & (rank <= next_b[live])
            good[live[crossed]] = False
            at_x, at_y = self.made_at[x], self.made_at[y]
            go_on = ~crossed & ((at_x >= 0) | (at_y >= 0))
            live, x, y, at_x, at_y = live[go_on], x[go_on], y[go_on], at_x[go_on], at_y[go_on]
            undo_left = at_x > at_y
            left, right = live[undo_left], live[~undo_left]
            next_a[left], a[left] = at_x[undo_left], self.right[x[undo_left]]
            next_b[right], b[right] = at_y[~undo_left], self.left[y[~undo_left]]
        return good

    def _sound_tokens(self) -> np.ndarray:
        """Which tokens are the BPE result of their own bytes: both parts are, and nothing
        crosses their border before they merge."""
        sound = np.zeros(self.size, bool)
        sound[self.byte_id] = True
        made = np.flatnonzero(self.made_at >= 0)
        quiet = np.zeros(self.size, bool)
        quiet[made] = self.compatible(self.left[made], self.right[made], self.made_at[made])
        for i in made[np.argsort(self.made_at[made])].tolist():
            sound[i] = quiet[i] and sound[self.left[i]] and sound[self.right[i]]
        return sound

    def propose(self, word: bytes) -> list[int]:
        """Tokens by greedy longest match."""
        out, i, n = [], 0, len(word)
        ids, reach = self.ids, self.reach
        while i < n:
            end = min(n, i + reach.get(word[i:i + 2], 1))
            while (t := ids.get(word[i:end])) is None:
                end -= 1
            out.append(t)
            i = end
        return out

    def merge(self, word: bytes) -> list[int]:
        """Tokens by exact merging: the lowest rank first, then the leftmost."""
        tokens = [self.byte_id[c] for c in word]
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(self.rank[p][0], i, p) for i, p in enumerate(zip(tokens, tokens[1:])) if p in self.rank]
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i]
            if tokens[i] != pair[0] or j >= n or tokens[j] != pair[1]:
                continue
            tokens[i], tokens[j] = self.rank[pair][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                pair = (tokens[i], tokens[after[i]])
                if pair in self.rank:
                    heapq.heappush(queue, (self.rank[pair][0], i, pair))
            if before[i] >= 0:
                pair = (tokens[before[i]], tokens[i])
                if pair in self.rank:
                    heapq.heappush(queue, (self.rank[pair][0], before[i], pair))
        return [t for t in tokens if t >= 0]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        """(tokens of all words, tokens per word, words merged exactly)."""
        data = [w.encode() for w in words]
        found = [[self.special[w]] if w in self.special else self.propose(b) for w, b in zip(words, data)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(size.sum()))
        owner = np.repeat(np.arange(len(words)), size)
        pairs = np.flatnonzero(owner[1:] == owner[:-1])
        codes, back = np.unique(flat[pairs] * self.size + flat[pairs + 1], return_inverse=True)
        ok = self.compatible(codes // self.size, codes % self.size, np.full(len(codes), _NEVER))
        failed = np.unique(np.concatenate([owner[pairs[~ok[back]]], owner[~(self.sound | self.is_special)[flat]]]))
        if len(failed):
            for i in failed.tolist():
                found[i] = self.merge(data[i])
            size = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.int64, int(size.sum()))
        return flat.astype(np.int32), size, len(failed)

    def decode(self, ids) -> str:
        """Text of token ids; bytes that are not UTF-8 become U+FFFD, unknown ids nothing."""
        return b"".join([self.bytes[i] for i in ids if 0 <= i < self.size]).decode("utf-8", "replace")


class Encoder:
    """Encodes texts with the tokens of seen words at hand; one for each Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(PATTERN)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.seen, self.flat, self.size = Codes(), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def shrink(self):
        """Keeps the most used words when there are too many."""
        kept = self.seen.shrink(CACHED_WORDS)
        if kept is not None:
            begin, size = (np.cumsum(self.size) - self.size)[kept], self.size[kept]
            self.flat = self.flat[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
            self.size = size

    def words(self, text: str, special: bool) -> list[str]:
        if special and self.special is not None and self.special.search(text):
            out = []
            for part in self.special.split(text):
                out += [part] if part in self.vocabulary.special else self.split.findall(part)
            return out
        return self.split.findall(text)

    def encode(self, texts: list[str], special: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all texts, tokens per text). ``special``: strings of special tokens in
        a text are those tokens; otherwise they are ordinary text."""
        self.shrink()
        code, count = self.seen.of([self.words(t, special) for t in texts])
        if new := self.seen.take_new():
            flat, size, _ = self.vocabulary.encode_words(new)
            self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])
        begin = np.cumsum(self.size) - self.size
        size = self.size[code]
        total = int(size.sum())
        tokens = self.flat[np.repeat(begin[code] - (np.cumsum(size) - size), size) + np.arange(total)]
        edge = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
        return tokens, np.diff(edge)


def encoder(shared) -> Encoder:
    """The encoder of a broadcast vocabulary file; one is kept in each Python worker."""
    return hold(shared.id, lambda: Encoder(Vocabulary(shared.value)))


def load(spark: SparkSession, path: str) -> Shared:
    """A vocabulary file (a few MB) read by the driver and broadcast."""
    with open(path, encoding="utf-8") as f:
        return Shared(spark, f.read())


def bpe_encode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None,
               decode: bool = False, special: bool = True) -> DataFrame:
    """``docs`` with ``token_ids`` and, if asked for, ``decoded`` (the text of those ids).

    Null and empty texts have no tokens; their decoded text is empty. ``special``: strings
    of special tokens in a text are encoded as those tokens. Existing columns with the
    names of added ones are replaced.
    """
    shared = load(docs.sparkSession, path)
    fields = [StructField("token_ids", ArrayType(IntegerType()))]
    fields += [StructField("decoded", StringType())] if decode else []

    def make():
        coder = encoder(shared)

        def fn(batch):
            tokens, size = coder.encode([t or "" for t in batch.column(text_col).to_pylist()], special)
            out = [list_array(tokens, size, pa.int32())]
            if decode:
                ids, end = tokens.tolist(), np.cumsum(size).tolist()
                out.append(pa.array([coder.vocabulary.decode(ids[a:b]) for a, b in zip([0, *end], end)], pa.string()))
            return out

        return fn

    return add_columns(docs, [text_col], fields, make, keep)


def bpe_decode(docs: DataFrame, path: str, ids_col: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``decoded``, the text of a column of token ids; a null list gives an empty text."""
    shared = load(docs.sparkSession, path)

    def make():
        vocabulary = encoder(shared).vocabulary
        return lambda batch: [pa.array([vocabulary.decode(ids or []) for ids in batch.column(ids_col).to_pylist()], pa.string())]

    return add_columns(docs, [ids_col], [StructField("decoded", StringType())], make, keep)
