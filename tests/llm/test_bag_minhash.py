"""Near duplicates against all pairs, and the signatures against known similarities."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tamarind.llm import bag_minhash as B
from tamarind.llm.common import WORD_PATTERN
from tests.llm.conftest import prose


def bag(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    w = re.findall(WORD_PATTERN, low)
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows):
    """(id -> smallest id of its class) by comparing every pair of texts."""
    texts = defaultdict(list)
    for i, t in rows:
        texts[t].append(i)
    keys = list(texts)
    up = list(range(len(keys)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    bags = [bag(k) for k in keys]
    for i in range(len(keys)):
        for j in range(i):
            low = sum((bags[i] & bags[j]).values())
            high = sum((bags[i] | bags[j]).values())
            if high and low >= 0.8 * high - 1e-9:
                up[top(i)] = top(j)
    classes = defaultdict(list)
    for i, k in enumerate(keys):
        classes[top(i)] += texts[k]
    return {d: min(v) for v in classes.values() for d in v}


def edited(text, share, rng):
    w = text.split()
    for i in range(len(w)):
        if rng.random() < share:
            w[i] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_classes_equal_all_pairs(spark):
    rng = random.Random(4)
    rows = []
    for g in range(6):
        base = prose(100 + g, rng.choice([12, 80, 200]))
        rows += [edited(base, rng.choice([0, 0.005, 0.02, 0.05, 0.2]), rng) for _ in range(25)]
    rows += [prose(900, 7) * 30] * 3 + [(prose(901, 6) + " ") * k for k in (40, 41, 50, 90)] + ["one two"] * 2 + ["", "...", "...", "!"]
    rows = list(enumerate(rows))
    got = dict(B.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id").collect())
    assert got == brute(rows)


def test_group_of_near_copies_with_outliers(spark):
    rng = random.Random(9)
    base = prose(7, 150)
    rows = list(enumerate(edited(base, rng.choice([0.0, 0.01, 0.02, 0.04, 0.08]), rng) for _ in range(220)))
    got = dict(B.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id").collect())
    assert got == brute(rows)


def test_last_links_join_groups(spark, monkeypatch):
    """Links found last are handed on between groups, not with all links of their members again."""
    seen = {}

    def components(ws, links, name, run=B.connected_components):
        seen[name] = [(bytes(a), bytes(b)) for a, b in links.select("a", "b").collect()]
        out = run(ws, links, name)
        seen[name + "comps"] = {bytes(h): bytes(c) for h, c in out.select("h", "comp").collect()}
        return out

    monkeypatch.setattr(B, "connected_components", components)
    rng = random.Random(9)
    base = prose(7, 150)
    rows = list(enumerate(edited(base, rng.choice([0.01, 0.02, 0.04, 0.08]), rng) for _ in range(220)))
    got = dict(B.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id").collect())
    comps, last = seen["c2-comps"], seen["c3-"]
    assert last and len(set(last)) == len(last)
    assert all(comps.get(h, h) == h for link in last for h in link)
    assert got == brute(rows)


def test_signature_is_unbiased_for_weighted_jaccard():
    rng = np.random.default_rng(1)
    off = []
    for _ in range(60):
        base = rng.choice(2**60, 40).astype(np.uint64)
        a, b = rng.integers(1, 9, 40), rng.integers(0, 40, 40)
        b = np.where(rng.random(40) < 0.7, a, b)
        doc = np.repeat([0, 1], [a.sum(), b.sum()])
        sig = B.signatures(doc, np.concatenate([np.repeat(base, a), np.repeat(base, b)]), 2)
        off.append((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 0.02


def test_waiting_times_are_exponential():
    from tamarind.llm.common import mix64
    t = B.waiting_time(mix64(np.arange(1, 200_001, dtype=np.uint64)))
    assert abs(t.mean() - 1) < 0.01 and abs((t > 1).mean() - np.exp(-1)) < 0.005 and t.min() >= 0


def test_odd_rows(odd_docs):
    rows = B.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.class_id)
    assert by[1] == by[2] == by[11] == {1}  # copies, and a text with one changed word
    assert by[3] == {3} and by[4] == {4} and by[5] == {5} and by[None] == {None}
    assert all(r.class_key is None for r in rows if r.doc_id == 3)


def test_keep_one(odd_docs):
    kept = B.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and 2 not in ids and 11 not in ids and ids[3] == 2 and ids[None] == 1 and ids[8] == 1


@pytest.mark.parametrize("f", [B.near_duplicates, B.keep_one])
def test_empty_table(odd_docs, f):
    assert f(odd_docs.limit(0)).collect() == []
