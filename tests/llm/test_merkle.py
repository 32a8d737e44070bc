"""Merkle manifest against a plain tree in Python, at every number of levels."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tamarind.llm import merkle as M

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """The top, and for each node its siblings (left, right) level by level."""
    path, at, cur = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(cur) > 1:
        for k, i in enumerate(at):
            b = i // 16 * 16
            path[k].append(("".join(cur[b:i]), "".join(cur[i + 1:b + 16])))
            at[k] = i // 16
        cur = [h(*cur[b:b + 16]) for b in range(0, len(cur), 16)]
    return cur[0], path


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    by = {}
    for r in rows:
        leaf = h(*map(field, r))
        changed = h(*map(field, r[:4]), field(None if r[4] is None else r[4].translate(LOW)))
        tampered = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0
        by.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0, leaf), r[0], leaf, changed if tampered else leaf))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda x: x[0])
    subs = [tree([x[2] for x in by[s]]) for s in sources]
    if not subs:
        return []
    root, up = tree([x[0] for x in subs])
    out = []
    for s, (sub, path), u in zip(sources, subs, up):
        for (_, i, leaf, now), p in zip(by[s], path):
            for a, b in p + u:
                now = h(a, now, b)
            out.append((i, leaf, sub, root, "".join(a + b for a, b in p + u), now, now == root))
    return sorted(out, key=str)


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    df = df.select("*", *[F.lit("mine").alias(c) for c in ("id", "leaf", "start", "pos", "width", "hash", "node", "root", "proof")])
    return sorted(map(tuple, M.manifest(df, **kw).collect()), key=str)


def rows_of(source, ids):
    return [(i, source, "en", i, f"Text {i}") for i in ids]


@pytest.mark.parametrize("sizes", [[1], [17, 2], [300, 16, 1, 33], [257, 1, 2, 40] + [1] * 300])
def test_equals_the_plain_tree(spark, sizes):
    rows, at = [], 0
    for s, n in enumerate(sizes):
        rows += rows_of(f"s{s}", range(at, at + n))
        at += n
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("near", [1, 20])
def test_both_recursions_meet(spark, near):
    """Few nodes are joined by broadcast, the others by shuffle."""
    rows = rows_of("a", range(700)) + rows_of("b", range(700, 760)) + rows_of("c", [900])
    assert got(spark, rows, near_root=near) == brute(rows)


def test_many_rows_of_one_source_and_of_one_id(spark):
    rows = rows_of("hot", [5] * 200 + list(range(300))) + [(7, "x", "en", 1, f"t{i}") for i in range(40)]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, "A"), (1, None, "en", 3, "ABC"), (5, "", "", 0, ""), (6, "é" * 100, "x", -4, "ÄÖ日 ABC"),
            (7, "-", None, None, "Q" * 200_000), (-3, ":", "en", 1, "x"), (7, "-", None, None, "Q" * 200_000), (9, "a/b", "l", 2, "\x00\n")]
    assert got(spark, rows) == brute(rows) and got(spark, []) == []


def test_tampering_is_found_exactly(spark):
    rows = rows_of("a", range(100)) + [(i, "b", "en", 1, "lower") for i in range(100, 200)]
    out = got(spark, rows)
    assert {r[0] for r in out if not r[6]} == {i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert len(got(spark, rows, tampered=F.col("doc_id") == 3)) == 200
    assert [r[0] for r in got(spark, rows, tampered=F.col("doc_id") == 3) if not r[6]] == [3]
