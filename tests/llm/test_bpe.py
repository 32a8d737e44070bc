"""BPE against the tokenizers library: ids and decoded text."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tamarind.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def coder():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Encoder(bpe.Vocabulary(f.read()))


def texts():
    rng = random.Random(3)
    parts = ["a", "ab", "the", " the", "ing", " ", "  ", "\n", "\t", "'s", "'re", "1", "23", "é", "日本", "😀", "<|endoftext|>", "--", "...", "ß", "x" * 9]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1500)] + [
        "", "a" * 700, "ab" * 300, " " * 300, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "\x00\x01\x7f", "é" * 200]


def test_ids_equal_the_library(coder, library):
    sample = texts()
    tokens, size = coder.encode(sample)
    at = 0
    for text, n, ref in zip(sample, size.tolist(), library.encode_batch(sample, add_special_tokens=False)):
        ids = tokens[at:at + n].tolist()
        at += n
        assert ids == ref.ids, text
        assert coder.vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_speculation_agrees_with_exact_merging(coder):
    words = sorted({w for t in texts() for w in coder.words(t, False)})
    flat, size, merged = coder.vocabulary.encode_words(words)
    assert 0 < merged < len(words)
    at = 0
    for w, n in zip(words, size.tolist()):
        assert flat[at:at + n].tolist() == coder.vocabulary.merge(w.encode())
        at += n


def test_decode_of_any_ids(coder, library):
    rng = random.Random(5)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(6)]
        assert coder.vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_special_strings_as_ordinary_text(coder, library):
    library.encode_special_tokens = True
    text = "x <|endoftext|> y"
    assert coder.encode([text], special=False)[0].tolist() == library.encode(text, add_special_tokens=False).ids
    library.encode_special_tokens = False


def test_only_used_words_stay_beyond_the_bound(coder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 5)
    for t in ("one two three four five six one", "one seven eight", "six six nine ten eleven twelve", "one two <|endoftext|> three", "<|endoftext|>"):
        alone, size = coder.encode([t, t])
        fresh = bpe.Encoder(coder.vocabulary).encode([t, t])
        assert alone.tolist() == fresh[0].tolist() and size.tolist() == fresh[1].tolist()
    assert len(coder.seen) < 12


def test_odd_rows(odd_docs):
    rows = bpe.bpe_encode(odd_docs, PATH, decode=True).select("doc_id", "text", "token_ids", "decoded").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.decoded == (r.text or "") and (len(r.token_ids) > 0) == bool(r.text)
    again = bpe.bpe_decode(bpe.bpe_encode(odd_docs, PATH), PATH).select("text", "decoded").collect()
    assert all(r.decoded == (r.text or "") for r in again)
    assert bpe.bpe_encode(odd_docs.limit(0), PATH).collect() == []
