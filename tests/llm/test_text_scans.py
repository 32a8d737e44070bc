"""Decontamination and licence scan against plain Python; odd rows and empty tables."""

import os
import random
import re
import subprocess
import sys
import time

import pytest

from tamarind.llm import decontaminate as D
from tamarind.llm import license_scan as L
from tamarind.llm.common import WORD_PATTERN
from tests.llm.conftest import prose


def words(text):
    return re.findall(WORD_PATTERN, re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = {}
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            q = words(t)
            k = min(10, len(q))
            for s in range(len(q) - k + 1) if k else ():
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == q[s:s + k]:
                        hit.update(range(p, p + k))
                        found.add(str(item))
        out[i] = (len(w), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("block_nodes", [D.BLOCK_NODES, 300])
def test_decontamination_equals_brute_force(spark, block_nodes):
    rng = random.Random(2)
    items = [(k, prose(k, rng.choice([3, 9, 10, 11, 25]))) for k in range(12)] + [(20, ""), (21, None), (22, "!!"), (None, prose(3, 20)), (5, prose(5, 12)), (23, "b b b")]
    docs = []
    for i in range(60):
        text = prose(1000 + i, rng.randrange(40))
        if i % 2:
            item = words(items[rng.randrange(12)][1])
            a = rng.randrange(len(item))
            text += " -- " + ", ".join(w.upper() for w in item[a:a + rng.choice([9, 10, 30])]) + ". " + prose(i, 5)
        docs.append((i, text))
    docs += [(100, "b b b b b"), (101, None), (102, ""), (103, "ééé " + prose(4, 25) + " ü")]
    got = D.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                          block_nodes=block_nodes).collect()
    expected = brute(docs, [x for x in items if x[0] is not None])
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == expected
    for r in got:
        assert r.contaminated == (r.n_hit > 0)
        assert sum(len(words((r.text or "")[s.start:s.end])) for s in r.hit_spans) == r.n_hit


def test_decontamination_of_odd_rows(spark, odd_docs):
    benchmark = spark.createDataFrame([(1, prose(1, 12))], "item_id long, text string")
    rows = D.decontaminate(odd_docs, benchmark).select("doc_id", "contaminated").collect()
    assert len(rows) == odd_docs.count() and {r.doc_id for r in rows if r.contaminated} == {1, 2, 11}
    assert not any(r.contaminated for r in D.decontaminate(odd_docs, benchmark.limit(0)).collect())
    assert D.decontaminate(odd_docs.limit(0), benchmark).collect() == []


def test_decontamination_of_odd_rows_in_several_blocks(spark, odd_docs):
    benchmark = spark.createDataFrame([(1, prose(1, 12)), (2, prose(8, 40)), (3, prose(9, 40))], "item_id long, text string")
    docs = odd_docs.selectExpr("*", "'mine' AS key", "'mine' AS hits")
    one, many = (D.decontaminate(docs, benchmark, block_nodes=n) for n in (D.BLOCK_NODES, 200))
    assert one.columns == many.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    assert D.decontaminate(odd_docs.limit(0), benchmark, block_nodes=200).collect() == []


def test_a_block_fits_a_worker():
    """As many words as a block takes (about 1.2 MB of text), all of them different windows, in a
    process of its own under 1 GB."""
    code = """
import random, resource
from tamarind.llm import decontaminate as D
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
rng = random.Random(1)
words = [f"w{i}" for i in range(30000)]
items = [(str(i), " ".join(rng.choice(words) for _ in range(200))) for i in range(D.BLOCK_NODES // D.WINDOW // 200)]
w = D.Windows(items)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024, len(w.automaton))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(__file__))))
    mb, n = map(int, out.stdout.split())
    assert n > 150_000 and mb < 1000, (mb, n)


def test_licences_in_linear_time():
    """A text of very many tags, one of a very long expression, and one of deep parentheses."""
    many = b"spdx-license-identifier: mit " * 40_000
    begin = time.perf_counter()
    for i in range(0, len(many), 29):
        assert L.evaluate(many, i + 25)[0] == "mit"
    form, names, level = L.evaluate("mit and " * 100_000 + "isc")
    assert names == {"mit", "isc"} and form.count("AND") == 100_000 and level == 1
    assert L.evaluate("(" * 100_000 + "mit" + ")" * 100_000)[0] == "mit"
    assert time.perf_counter() - begin < 10


def test_license_base_phrases_equal_brute_force(spark):
    rng = random.Random(6)
    bits = ["under the MIT license", "Apache License, Version 2", "CC BY-NC", "cc by", "the mit", "license", "under", "nc", "2.0", "x"]
    docs = [(i, rng.choice([" ", "\n", "--"]).join(rng.choice(bits) for _ in range(rng.randrange(12)))) for i in range(300)]
    for r in L.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        w = words(r.text)
        places = [(p, label) for phrase, label in L.BASE_PHRASES.items() for q in [phrase.split()] for p in range(len(w)) if w[p:p + len(q)] == q]
        assert r.n_words == len(w) and r.n_base == len(places)
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == sorted({x[1] for x in places}) and set(r.base_labels) <= set(r.labels)


@pytest.mark.parametrize("text, form, level", [
    ("MIT", "mit", 1), ("(MIT OR GPL-3.0) AND BSD-3-Clause", "(mit OR gpl-3.0) AND bsd-3-clause", 1),
    ("GPL-2.0-only WITH Classpath-exception-2.0 OR AGPL-3.0", "gpl-2.0-only WITH classpath-exception-2.0 OR agpl-3.0", 2),
    ("MIT and GPL-3.0 or Apache-2.0", "(mit AND gpl-3.0) OR apache-2.0", 1), ("MIT AND CC-BY-NC-4.0", "mit AND cc-by-nc-4.0", 4),
    ("MIT) and so on", "mit", 1)])
def test_expressions(text, form, level):
    assert L.evaluate(text)[::2] == (form, level)


@pytest.mark.parametrize("text", ["", "OR MIT", "MIT OR", "(MIT", "()", "(MIT OR ISC) WITH x", "AND"])
def test_invalid_expressions(text):
    assert L.evaluate(text) is None


def test_license_tags_and_odd_rows(spark, odd_docs):
    docs = spark.createDataFrame([(1, "// SPDX-License-Identifier: (MIT OR Apache-2.0)\nint x;"), (2, "SPDX-License-Identifier: OR"),
                                  (3, "Released under the MIT License."), (4, "Permission is hereby granted")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.expressions, r.score) for r in L.scan_licenses(docs).collect()}
    assert got == {1: (["apache-2.0", "mit"], ["mit OR apache-2.0"], 1.0), 2: ([], [], 0.4), 3: (["mit"], [], 1.0), 4: ([], [], 0.0)}
    rows = L.scan_licenses(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.score == 0.0 and r.restriction is None for r in rows)
    assert L.scan_licenses(odd_docs.limit(0)).collect() == []
