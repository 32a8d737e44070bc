"""Language identification (operator 4): segmentation-marginalised unigrams.

Every language has a probability for each piece of one fixed public vocabulary. The
probability of a word is the sum, over all ways of cutting it into pieces, of the product
of their probabilities; a forward algorithm computes it for many words at once. A text's
score is the sum of its words' logarithms, and the languages' scores are compared.

Piece probabilities are learned by expectation maximisation (forward and backward over
the word counts of a bounded sample of documents per language, counted by Spark).
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tamarind.llm.common import Codes, Shared, add_columns, hold, mix64, row_sums, unit_hash

#: Documents per language that the probabilities are learned from (expected number).
TRAIN_DOCS = 500
ROUNDS = 3
#: Characters of words that a lattice holds at once (one longer word is held alone, whole).
CELLS = 400_000
#: Steps after which the probabilities of a word's beginnings are brought back to 1.
RESCALE = 8
#: Probability of a character that is no piece of the vocabulary, in every language.
UNKNOWN = 1e-7
CACHED_WORDS = 110_000
CACHED_LETTERS = 4_000_000
UNDETERMINED = "und"

_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_START = "▁"


def pieces(path: str) -> list[str]:
    """Pieces of a byte-level vocabulary of ranks that are lower-case letters, with a mark for a
    leading space."""
    out = {_START}
    with open(path, "rb") as f:
        for line in f:
            try:
                text = base64.b64decode(line.split()[0]).decode()
            except (UnicodeDecodeError, IndexError):
                continue
            body = text[1:] if text.startswith(" ") else text
            if body and _LETTERS.fullmatch(body) and body == body.lower():
                out.add(_START + body if text != body else body)
    return sorted(out)


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def parts(words: list[str], cells: int = CELLS) -> list[np.ndarray]:
    """The places of words, those of like length together, in parts of about ``cells`` characters."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    order = np.argsort(-size, kind="stable")
    out, a = [], 0
    while a < len(order):
        b = a + max(1, cells // int(size[order[a]]))
        out.append(order[a:b])
        a = b
    return out


class Lattice:
    """All pieces in a list of words. ``single[k]``: for every word that goes beyond place k, the
    piece that is its character there (or -1); ``longer[k]``: (length, words, pieces) of the
    longer pieces that start there. Words are ordered by length, longest first, one column of
    characters after the other; a beginning is followed while it begins some piece, so the
    longest piece of the vocabulary sets the reach and no length is left out."""

    _char = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, words: list[str], table: tuple[np.ndarray, np.ndarray, int]):
        marked = [_START + w for w in words]
        size = np.fromiter(map(len, marked), np.int64, len(marked))
        self.order = np.argsort(-size, kind="stable")
        self.size = size[self.order]
        self.length = int(self.size[0]) if len(words) else 0
        self.active = np.searchsorted(-self.size, -np.arange(1, self.length + 1), side="right")
        chars = np.zeros((self.length, len(words)), np.uint64)
        flat = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
        begin = (np.cumsum(size) - size)[self.order]
        for k in range(self.length):
            n = self.active[k]
            chars[k, :n] = mix64(flat[begin[:n] + k].astype(np.uint64))
        keys, numbers, self.reach = table
        self.single, self.longer = [], []
        for k in range(self.length):
            row, idx, h = [], np.arange(self.active[k]), np.zeros(self.active[k], np.uint64)
            for l in range(self.length - k):
                m = int(np.searchsorted(idx, self.active[k + l]))
                idx, h = idx[:m], h[:m] * self._char + chars[k + l, idx[:m]]
                at = np.searchsorted(keys, h)
                known = keys[at] == h
                idx, h, number = idx[known], h[known], numbers[at[known]]
                if l == 0:
                    single = np.full(self.active[k], -1)
                    single[idx] = number
                else:
                    whole = number >= 0
                    if whole.any():
                        row.append((l + 1, idx[whole], number[whole]))
                if not len(idx):
                    break
            self.single.append(single)
            self.longer.append(row)

    @classmethod
    def table(cls, names: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        """Sorted hashes of the beginnings of pieces, the number of the piece that each is (or
        -1), and the length of the longest piece."""
        number = {np.iinfo(np.uint64).max: -1}
        for i, name in enumerate(names):
            x = 0
            for c in mix64(np.frombuffer(name.encode("utf-32-le"), np.uint32).astype(np.uint64)).tolist():
                x = (x * int(cls._char) + c) % (1 << 64)
                number.setdefault(x, -1)
            number[x] = i
        keys = np.array(sorted(number), np.uint64)
        return keys, np.array([number[k] for k in keys.tolist()], np.int64), max(map(len, names), default=1)

    def forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length + 1, words, languages): probability of each beginning, and what it was
        multiplied by: after ``RESCALE`` places each, the beginning there is made 1, so that a
        word of any length stays within a double. Logarithms of the factors, summed up; row j
        holds those up to place j * RESCALE. ``p`` has a row for each piece and a last one, of
        zeros, for no piece."""
        alpha = np.zeros((self.length + 1, len(self.size), p.shape[1]))
        alpha[0] = 1.0
        factor = np.zeros((self.length // RESCALE + 1, *alpha.shape[1:]))
        for k in range(self.length):
            n = self.active[k]
            if k % RESCALE == 0 and k:
                at = alpha[k, :n].copy()
                alpha[k:k + self.reach + 1, :n] /= at
                factor[k // RESCALE] = factor[k // RESCALE - 1]
                factor[k // RESCALE, :n] -= np.log(at)
            alpha[k + 1, :n] += alpha[k, :n] * np.where((self.single[k] < 0)[:, None], UNKNOWN, p[self.single[k]])
            for l, idx, number in self.longer[k]:
                alpha[k + l, idx] += alpha[k, idx] * p[number]
        if self.length and self.length % RESCALE == 0:
            factor[-1] = factor[-2]
        return alpha, factor

    def log_probability(self, p: np.ndarray) -> np.ndarray:
        """(words, languages) in the order the words came."""
        alpha, factor = self.forward(p)
        out, words = np.zeros((len(self.size), p.shape[1])), np.arange(len(self.size))
        if len(self.size):
            out[self.order] = np.log(alpha[self.size, words]) - factor[(self.size - 1) // RESCALE, words]
        return out

    def expected(self, p: np.ndarray, count: np.ndarray) -> np.ndarray:
        """(pieces + 1, languages): expected uses of each piece in the counted words."""
        alpha, factor = self.forward(p)
        words = np.arange(len(self.size))
        count = count[self.order]
        # beta is kept multiplied by what makes its product with alpha that of the whole word
        beta = np.zeros_like(alpha)
        beta[self.size, words] = 1.0
        total = alpha[self.size, words]
        uses = np.zeros_like(p)

        def rest(k, l, idx):
            """beta after a piece, with the factors between its two ends."""
            end = np.minimum((k + l) // RESCALE, (self.size[idx] - 1) // RESCALE)
            return beta[k + l, idx] * np.exp(factor[end, idx] - factor[k // RESCALE, idx])

        for k in reversed(range(self.length)):
            n = self.active[k]
            for l, idx, number in [(1, words[:n], self.single[k]), *self.longer[k]]:
                step = np.where((number < 0)[:, None], UNKNOWN, p[number]) * rest(k, l, idx)
                beta[k, idx] += step
                hit = number >= 0
                weight = (alpha[k, idx] * step / total[idx] * count[idx])[hit]
                for j in range(p.shape[1]):
                    uses[:, j] += np.bincount(number[hit], weight[:, j], minlength=len(p))
        return uses


def train(counts, languages: list[str], names: list[str], rounds: int = ROUNDS) -> np.ndarray:
    """(pieces + 1, languages) probabilities from a list of (word, language number, count)."""
    table = Lattice.table(names)
    known: dict[str, int] = {}
    at, lang, n = [], [], []
    for word, j, k in counts:
        at.append(known.setdefault(word, len(known)))
        lang.append(j)
        n.append(k)
    c = np.zeros((len(known), len(languages)))
    np.add.at(c, (at, lang), n)
    words = list(known)
    lattices = [(Lattice([words[i] for i in part.tolist()], table), c[part]) for part in parts(words)]
    length = np.array([len(x) for x in names] + [0])
    p = np.repeat(np.exp(-2.0 * length)[:, None], len(languages), axis=1)  # shorter pieces likelier at first
    p[-1] = 0.0
    for _ in range(rounds):
        p /= p.sum(axis=0)
        uses = sum((lattice.expected(p, k) for lattice, k in lattices), np.zeros_like(p))
        p = uses + 0.05
        p[-1] = 0.0
    return p / p.sum(axis=0)


class Model:
    """Languages, pieces and their probabilities; a few MB, whatever the corpus."""

    def __init__(self, languages: list[str], names: list[str], p: np.ndarray):
        self.languages, self.table, self.p = languages, Lattice.table(names), p


def learn(docs: DataFrame, path: str, learn_from: Column, text_col: str = "text", lang_col: str = "lang",
          id_col: str = "doc_id", train_docs: int = TRAIN_DOCS) -> Model:
    """A model from about ``train_docs`` documents of each language, taken by a hash of the
    id among those where ``learn_from`` holds and language and text are not null."""
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & learn_from)
    sizes = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}  # a row per language
    languages = sorted(sizes)
    if not languages:
        return Model([], [_START], np.zeros((2, 0)))
    share = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, train_docs / sizes[k])]), F.col(lang_col))
    sample = usable.where(unit_hash(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "language") < share)
    schema = StructType([StructField("lang", StringType()), StructField("word", StringType()), StructField("n", LongType())])

    def count(batches):
        for b in batches:
            seen: dict = {}
            for lang, text in zip(b.column(lang_col).to_pylist(), b.column(text_col).to_pylist()):
                for w in words_of(text):
                    seen[lang, w] = seen.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_pydict({"lang": [k[0] for k in seen], "word": [k[1] for k in seen],
                                              "n": list(seen.values())}, pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))

    counts = sample.select(lang_col, text_col).mapInArrow(count, schema).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    rows = counts.orderBy("word", "lang").toArrow()  # bounded by the sample
    number = {k: i for i, k in enumerate(languages)}
    names = pieces(path)
    p = train(zip(rows["word"].to_pylist(), map(number.get, rows["lang"].to_pylist()), rows["n"].to_pylist()), languages, names)
    return Model(languages, names, p)


class _Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.codes, self.scores = Codes(), np.zeros((0, len(self.model.languages)))

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) log probabilities and the number of words of each text."""
        kept = self.codes.shrink(CACHED_WORDS, CACHED_LETTERS)
        if kept is not None:
            self.scores = self.scores[kept]
        code, count = self.codes.of([words_of(t) for t in texts])
        new = self.codes.take_new()
        found = np.zeros((len(new), len(self.model.languages)))
        for part in parts(new):
            found[part] = Lattice([new[i] for i in part.tolist()], self.model.table).log_probability(self.model.p)
        self.scores = np.concatenate([self.scores, found])
        return row_sums(self.scores[code], count), count


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language among the
    learned ones (all equally likely before the text is seen). A null text, one without
    letters, or a model without languages gives ``und`` and 0. Existing columns with the
    names of added ones are replaced."""
    shared = Shared(docs.sparkSession, model)

    def make():
        scorer = hold(shared.id, lambda: _Scorer(shared.value))

        def fn(batch):
            n = batch.num_rows
            if not scorer.model.languages:
                return [pa.array([UNDETERMINED] * n, pa.string()), pa.array(np.zeros(n))]
            total, count = scorer.score(batch.column(text_col).to_pylist())
            best = total.argmax(axis=1)
            sure = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            names = [scorer.model.languages[i] if k else UNDETERMINED for i, k in zip(best.tolist(), count.tolist())]
            return [pa.array(names, pa.string()), pa.array(np.where(count > 0, sure, 0.0))]

        return fn

    return add_columns(docs, [text_col], [StructField("lang_pred", StringType()), StructField("score", DoubleType())], make, keep)
