"""Learned operators: exact sums against brute force, held-out accuracy, odd rows."""

import math
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tamarind.llm import language_id as I
from tamarind.llm import quality as Q
from tamarind.llm import toxicity as T
from tamarind.llm.common import crc_mod
from tests.llm.conftest import prose

PIECES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_forward_sums_all_segmentations():
    names = sorted(["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "bab", "aba"])
    rng = np.random.default_rng(2)
    p = np.vstack([rng.random((len(names), 2)), np.zeros((1, 2))])
    words = ["a", "ab", "abab", "babba", "bx", "x", "aabbab"]
    got = np.exp(I.Lattice(words, I.Lattice.table(names)).log_probability(p))

    def total(text, j):
        if not text:
            return 1.0
        out = 0.0
        for k in range(1, len(text) + 1):
            if text[:k] in names:
                out += p[names.index(text[:k]), j] * total(text[k:], j)
            elif k == 1:
                out += I.UNKNOWN * total(text[1:], j)
        return out

    assert np.allclose(got, [[total("▁" + w, j) for j in range(2)] for w in words], rtol=1e-9)


def test_expected_uses_sum_to_the_segmentations():
    names = sorted(["▁", "a", "b", "ab"])
    p = np.array([[0.2], [0.3], [0.1], [0.4], [0.0]])
    uses = I.Lattice(["ab"], I.Lattice.table(names)).expected(p, np.array([[2.0]]))
    at = {n: i for i, n in enumerate(names)}
    one, two = p[at["ab"], 0], p[at["a"], 0] * p[at["b"], 0]
    assert uses[at["▁"], 0] == pytest.approx(2.0)
    assert uses[at["ab"], 0] == pytest.approx(2 * one / (one + two)) and uses[at["a"], 0] == pytest.approx(2 * two / (one + two))


def test_long_words_and_long_pieces():
    """A piece of twenty letters, and a word of a hundred against exact fractions."""
    from fractions import Fraction
    names = sorted(["▁", "a", "b", "ab", "abababababababababab", "ba", "▁a"])
    p = np.array([[0.1, 0.3], [0.2, 0.05], [0.1, 0.2], [0.15, 0.1], [0.3, 0.05], [0.05, 0.2], [0.1, 0.1], [0.0, 0.0]])
    words = ["ab" * 50, "ab" * 9 + "x" * 60 + "ab" * 20, "x" * 300, "ab" * 10, "", "a", "ba" * 24, "x" * 7, "x" * 8]
    lattice = I.Lattice(words, I.Lattice.table(names))
    got = lattice.log_probability(p)

    def exact(word, j):
        at = [Fraction(0)] * (len(word) + 1)
        at[0] = Fraction(1)
        for k in range(len(word)):
            for l in range(1, min(20, len(word) - k) + 1):
                piece = word[k:k + l]
                if piece in names:
                    at[k + l] += at[k] * Fraction(p[names.index(piece), j])
                elif l == 1:
                    at[k + 1] += at[k] * Fraction(I.UNKNOWN)
        return math.log(at[-1].numerator) - math.log(at[-1].denominator)

    assert np.allclose(got, [[exact("▁" + w, j) for j in range(2)] for w in words], rtol=1e-9)
    count = np.ones((len(words), 2))
    uses = lattice.expected(p, count)
    for j in range(2):  # the pieces used cover the characters that are in the vocabulary
        covered = sum(len(n) * uses[i, j] for i, n in enumerate(names))
        assert covered == pytest.approx(sum(len(w) + 1 - w.count("x") for w in words), rel=1e-6)


def test_language_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = crc_mod(F.col("doc_id"), 4) == 2
    out = I.identify(docs, I.learn(docs, PIECES, ~held)).where(held).select("lang", "lang_pred").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.95


def test_language_of_odd_rows(spark, odd_docs):
    model = I.learn(odd_docs, PIECES, F.lit(True))
    rows = {r.doc_id: (r.lang_pred, r.score) for r in I.identify(odd_docs, model).collect()}
    assert rows[3] == rows[4] == rows[5] == rows[9] == ("und", 0.0) and rows[8] == ("en", 1.0) and rows[12][0] == "en"
    empty = I.learn(odd_docs.limit(0), PIECES, F.lit(True))
    assert {r.lang_pred for r in I.identify(odd_docs, empty).collect()} == {"und"}
    assert I.identify(odd_docs.limit(0), model).collect() == []


def test_null_languages_are_not_learned(spark):
    docs = spark.createDataFrame([(1, "der die das und", "de"), (2, "the of and to", "en"), (3, "zzz", None)], "doc_id long, text string, lang string")
    assert I.learn(docs, PIECES, F.lit(True)).languages == ["de", "en"]


def labelled(spark, seed, n):
    docs, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = prose(seed + i, 30)
        docs.append((i, (text.upper() + " !!!" if i % 2 else "buy *** " * 20 + text) if bad else text))
        labels.append((i, 0 if bad else 1))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_on_held_out_documents(spark):
    docs, labels = labelled(spark, 50, 240)
    held = crc_mod(F.col("doc_id"), 5) == 0
    model = Q.learn(docs, labels, ~held)
    rows = Q.score(docs, model).join(labels, "doc_id").where(held).collect()
    assert len(rows) > 20 and np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_quality_score_is_the_dot_product():
    grams = Q.NGrams(10)
    texts = ["One one TWO!! two", "", None, "x y x y"]
    owner, index, total = grams.features(texts)
    w = np.random.default_rng(0).normal(size=1 << 10)
    assert total.tolist() == [len(owner[owner == i]) for i in range(4)] and total[1] == total[2] == 0
    again = np.array([Q.NGrams(10).features([t])[1].sum() for t in texts])
    assert again.tolist() == [index[owner == i].sum() for i in range(4)]
    assert np.isfinite(w[index]).all()


def test_factorization_machine_equals_pairwise_sum():
    rng = np.random.default_rng(3)
    m = T.Machine(0.3, rng.normal(size=16), rng.normal(size=(16, 4)))
    terms = [1, 4, 7, 9]
    expected = 0.3 + sum(m.weight[i] for i in terms) + sum(m.vectors[i] @ m.vectors[j] for i, j in combinations(terms, 2))
    got = m.logits(np.array([0] * 4 + [1]), np.array([*terms, 2]), 3)
    assert got[0] == pytest.approx(expected) and got[1] == pytest.approx(0.3 + m.weight[2]) and got[2] == 0.3


def test_interactions_that_weights_alone_miss():
    """(1 and 2) or (3 and 4): no sum of four weights separates it."""
    rng = np.random.default_rng(5)
    rows, label = [], []
    for _ in range(4000):
        on = [k for k in (1, 2, 3, 4) if rng.random() < 0.5]
        rows.append(on + sorted((5 + rng.choice(20, 3, replace=False)).tolist()))
        label.append(float({1, 2} <= set(on) or {3, 4} <= set(on)))
    size = np.array([len(r) for r in rows])
    start, index, y = np.concatenate([[0], np.cumsum(size)]), np.array([x for r in rows for x in r]), np.array(label)
    owner = np.repeat(np.arange(len(y)), size)
    w, bias = Q.ftrl(start, index, np.ones(len(index)), y, 1 << 8, 6, 32, alpha=3.0, l1=4.0, l2=0.001)
    linear = bias + np.bincount(owner, w[index]) > 0
    m = T.fit(start, index, y, bits=8)
    assert (linear == y).mean() < 0.95 < 0.99 < ((m.logits(owner, index, len(y)) > 0) == y).mean()
    inner = {p: float(m.vectors[p[0]] @ m.vectors[p[1]]) for p in combinations((1, 2, 3, 4), 2)}
    assert sorted(inner, key=inner.get)[-2:] in ([(1, 2), (3, 4)], [(3, 4), (1, 2)])


@pytest.mark.parametrize("toxic", [(1, 2), (0, 3)])
def test_pair_of_terms_without_marginal_effect(toxic):
    """Rows with one of two terms are toxic, or those with both or none: each term is as common
    in clean as in toxic rows. As many rows as the operator learns from."""
    rng = np.random.default_rng(8)
    n = T.MAX_TRAIN
    kind = rng.permutation(np.arange(n) % 4)
    rows = [[k for k in (1, 2) if i & k] + sorted((5 + rng.choice(20, 3, replace=False)).tolist()) for i in kind]
    y = np.isin(kind, toxic).astype(float)
    size = np.array([len(r) for r in rows])
    start, index = np.concatenate([[0], np.cumsum(size)]), np.array([x for r in rows for x in r])
    m = T.fit(start, index, y, bits=8)
    assert ((m.logits(np.repeat(np.arange(n), size), index, n) > 0) == y).mean() > 0.99
    assert abs(m.vectors[1] @ m.vectors[2]) > 1


def test_toxicity_on_held_out_documents(spark):
    docs = [(i, prose(i, 40) + (" you idiot " if i % 4 == 0 else " you friend ") + prose(i + 1, 20)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    held = crc_mod(F.col("doc_id"), 4) == 2
    rows = T.score(docs, T.learn(docs, labels, ~held)).join(labels, "doc_id").where(held).collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.97


def test_quality_score_is_the_dot_product_of_its_grams(spark):
    """Scores against a plain dictionary of n-grams and their weights."""
    texts = [prose(i, 30) + (" SHOUT again again" if i % 3 else " calm") for i in range(40)] + ["", None, "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    weight, bias = Q.learn(docs, labels, F.lit(True))
    weight = np.random.default_rng(3).normal(size=len(weight))
    got = {r.doc_id: r.score for r in Q.score(docs, (weight, 0.25)).collect()}
    grams = Q.NGrams(Q.BITS)
    for i, text in enumerate(texts):
        _, number, total = grams.features([text])
        seen = {}
        for n in number.tolist():
            seen[n] = seen.get(n, 0) + 1
        logit = 0.25 + sum(weight[n] * k for n, k in seen.items()) / max(int(total[0]), 1)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-logit)), rel=1e-9)
        # one gram per word, one per pair of neighbours, one per capital word
        words = Q._TOKENS.findall(text or "")
        assert sum(seen.values()) == len(words) + max(0, len(words) - 1) + sum(len(w) > 1 and w.isupper() for w in words)


def test_ftrl_equals_the_rule_for_each_coordinate():
    """Batches of one against the rule in plain Python."""
    rng = np.random.default_rng(5)
    rows = [sorted(rng.choice(6, 3, replace=False).tolist()) for _ in range(50)]
    value, label = rng.random((50, 3)), (rng.random(50) < 0.4).astype(float)
    start, index = np.arange(0, 151, 3), np.array(rows).reshape(-1)
    got, bias = Q.ftrl(start, index, value.reshape(-1), label, 6, 2, 1, alpha=2.0, l1=0.1, l2=0.01)
    z, n, zb, nb = [0.0] * 6, [0.0] * 6, 0.0, 0.0

    def weight(i):
        return 0.0 if abs(z[i]) <= 0.1 else (math.copysign(0.1, z[i]) - z[i]) / ((1 + math.sqrt(n[i])) / 2.0 + 0.01)

    b = 0.0
    for _ in range(2):
        for row, x, y in zip(rows, value, label):
            e = 1 / (1 + math.exp(-(b + sum(weight(i) * v for i, v in zip(row, x))))) - y
            for i, v in zip(row, x):
                g = e * v
                w, rate = weight(i), (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 2.0
                z[i] += g - rate * w
                n[i] += g * g
            rate = (math.sqrt(nb + e * e) - math.sqrt(nb)) / 2.0
            zb, nb = zb + e - rate * b, nb + e * e
            b = -zb / ((1 + math.sqrt(nb)) / 2.0 + 1e-6)
    assert np.allclose(got, [weight(i) for i in range(6)], rtol=1e-9) and bias == pytest.approx(b, rel=1e-9)


def test_toxicity_of_an_insult_next_to_a_group(spark):
    """Toxic are texts with both words; each alone is as common in clean ones."""
    kinds = [(" dolt ", " romans "), (" dolt ", " "), (" ", " romans "), (" ", " ")]
    docs = [(i, prose(i, 25) + kinds[i % 4][0] + prose(i + 1, 10) + kinds[i % 4][1] + prose(i + 2, 10)) for i in range(6000)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(6000)], "doc_id long, toxic int")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    held = crc_mod(F.col("doc_id"), 4) == 2
    machine = T.learn(docs, labels, ~held)
    rows = T.score(docs, machine).join(labels, "doc_id").where(held).collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.99
    assert machine.vectors.any()


def test_toxicity_of_the_given_documents_by_language(spark):
    """Held-out recall at the cut in every language, and clean documents left alone."""
    table = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    docs, labels = table("documents"), table("labels").where("toxic IS NOT NULL")
    held = crc_mod(F.col("doc_id"), 4) == 2
    rows = T.score(docs.join(labels, "doc_id", "left_semi"), T.learn(docs, labels, ~held)).where(held).join(labels, "doc_id").collect()
    share = lambda want, keep: np.mean([r.predicted == want for r in rows if r.toxic == want and keep(r)])
    assert share(0, lambda r: True) >= 0.99 and share(1, lambda r: True) >= 0.92
    for lang in sorted({r.lang for r in rows if r.lang}):
        assert share(1, lambda r: r.lang == lang) >= 0.8, lang


@pytest.mark.parametrize("module", [Q, T])
def test_odd_rows(spark, odd_docs, module):
    label = "quality" if module is Q else "toxic"
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (8, 0), (None, 1), (99, 1), (10, None)], f"doc_id long, {label} int")
    model = module.learn(odd_docs, labels, F.lit(True))
    rows = module.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert math.isclose(*[next(r.score for r in rows if r.doc_id == i) for i in (3, 4)])
    none = module.learn(odd_docs, labels.limit(0), F.lit(True))
    assert {r.score for r in module.score(odd_docs, none).collect()} == {0.5}
    assert module.score(odd_docs.limit(0), model).collect() == []
