"""License scan (operator 9).

One Aho-Corasick automaton over the normalised text finds notice phrases and the
identifier tag. What follows a tag on its line is parsed from the original text by a
shunting-yard parser, which evaluates ``AND``, ``OR``, ``WITH`` and parentheses.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField

from tamarind.llm.common import Norm, add_columns, hold, text_buffers

# fixed values: the phrases and labels that every result must hold
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notice phrases (normalised words) and the licence each of them names.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "cc by 4 0": "cc-by-4.0",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by nd 4 0": "cc-by-nd-4.0",
    "cc0 1 0": "cc0-1.0",
    "creative commons attribution": "cc-by",
    "isc license": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"

#: How much a licence asks of its user, by the beginning of its identifier: 0 next to
#: nothing, 1 notice, 2 share changes, 3 share the whole work, 4 no commercial or changed use.
RESTRICTION = {
    "cc0": 0, "unlicense": 0, "0bsd": 0, "mit": 1, "apache": 1, "bsd": 1, "isc": 1, "zlib": 1, "cc-by-nc": 4,
    "cc-by-nd": 4, "cc-by-sa": 3, "cc-by": 1, "lgpl": 2, "mpl": 2, "epl": 2, "gpl": 3, "agpl": 3,
}
UNKNOWN = 4

_TOKEN = re.compile(rb"[A-Za-z0-9][A-Za-z0-9.+:-]*|[()]")
_BIND = {"or": 1, "and": 2, "with": 3}
_LINE_END = re.compile(rb"[\r\n]|\*/|-->")


def restriction(name: str) -> int:
    """The level of the longest known beginning of an identifier."""
    known = [k for k in RESTRICTION if name.startswith(k)]
    return RESTRICTION[max(known, key=len)] if known else UNKNOWN


class _Part:
    """A licence, or two parts joined by an operator; ``only``: its licence, if it has just one."""

    __slots__ = ("name", "op", "left", "right", "level", "only")

    def __init__(self, name=None, op=None, left=None, right=None):
        self.name, self.op, self.left, self.right = name, op, left, right
        if op is None:
            self.level, self.only = restriction(name), name
        elif op == "with":  # an exception loosens what it is attached to by one level
            if left.op is not None or right.only is None:
                raise ValueError("WITH needs a licence and an exception")
            self.level, self.only = max(0, left.level - 1), left.only
        else:
            self.level = min(left.level, right.level) if op == "or" else max(left.level, right.level)
            self.only = left.only if left.only == right.only else None

    def read(self) -> tuple[str, frozenset]:
        """Canonical form and licences, from left to right without recursion."""
        form, names, rest = [], set(), [(self, True)]
        while rest:
            part, counts = rest.pop()
            if isinstance(part, str):
                form.append(part)
            elif part.op is None:
                form.append(part.name)
                if counts:
                    names.add(part.name)
            elif part.op == "with":
                rest += [(part.right, False), (" WITH ", False), (part.left, counts)]
            else:
                rest += [(")", False), (part.right, counts), (f" {part.op.upper()} ", False), (part.left, counts), ("(", False)]
        return "".join(form), frozenset(names)


def evaluate(text: str | bytes, start: int = 0, end: int | None = None) -> tuple[str, frozenset, int] | None:
    """(canonical form, licences, level) of a licence expression, or None where invalid.

    ``WITH`` binds closest, then ``AND``, then ``OR``; all from the left. ``OR`` leaves the
    choice to the user (the smaller level), ``AND`` asks for both (the larger one). Words
    after a complete expression that cannot continue it are not part of it, nor read.
    """
    values: list[_Part] = []
    ops: list[str] = []
    raw = text.encode() if isinstance(text, str) else text

    def reduce_top():
        op, right, left = ops.pop(), values.pop(), values.pop()
        values.append(_Part(op=op, left=left, right=right))

    nested, operand_next = 0, True
    try:
        for found in _TOKEN.finditer(raw, start, len(raw) if end is None else end):
            token = found[0].decode()
            low = token.lower().rstrip(".:")
            if operand_next:
                if token == "(":
                    ops.append("(")
                    nested += 1
                elif low in _BIND or token == ")":
                    return None
                else:
                    values.append(_Part(low))
                    operand_next = False
            elif low in _BIND:
                while ops and ops[-1] != "(" and _BIND[ops[-1]] >= _BIND[low]:
                    reduce_top()
                ops.append(low)
                operand_next = True
            elif token == ")" and nested:
                while ops[-1] != "(":
                    reduce_top()
                ops.pop()
                nested -= 1
            else:
                break
        if operand_next or nested:
            return None
        while ops:
            reduce_top()
    except ValueError:
        return None
    form, names = values[0].read()
    return (form[1:-1] if form.startswith("(") else form), names, values[0].level


def _automaton():
    a = ahocorasick.Automaton()
    for words in {*BASE_PHRASES, *NOTICES, TAG}:
        a.add_word(f" {words} ", words)
    a.make_automaton()
    return a


def scan_licenses(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the licence notices of each whole text.

    Adds ``n_words``; ``n_base`` (places of base phrases), ``first_word``/``last_word``
    (their smallest and largest first word, from 0; else null), ``base_labels``; ``labels``
    (sorted distinct licences of base phrases, notice phrases and valid expressions);
    ``expressions`` (canonical, sorted, distinct); ``restriction`` (0 to 4, the strictest of
    the expressions and notices; null: none); ``score``: 1.0 with a valid expression or a
    base phrase, 0.8 with another notice phrase, 0.4 with only an invalid tag, else 0.0.
    A null text counts as empty: no words, empty lists, score 0. Existing columns with the
    names of added ones are replaced.
    """
    words = ArrayType(StringType())
    fields = [StructField("n_words", LongType()), StructField("n_base", LongType()),
              StructField("first_word", LongType()), StructField("last_word", LongType()),
              StructField("base_labels", words), StructField("labels", words),
              StructField("expressions", words), StructField("restriction", IntegerType()),
              StructField("score", DoubleType())]

    def make():
        automaton = hold("licences", _automaton)

        def fn(batch):
            data, off = text_buffers(batch.column(text_col))
            norm = Norm(data, off)
            n = batch.num_rows
            found = [(end - len(words) , words) for end, words in automaton.iter(norm.string())] if len(norm.first) else []
            at = np.searchsorted(norm.first, np.asarray([x[0] for x in found], np.int64))
            raw = data.tobytes()
            tagged = any(words == TAG for _, words in found)
            line_ends = np.fromiter((m.start() for m in _LINE_END.finditer(raw)), np.int64) if tagged else np.zeros(0, np.int64)
            n_base, first, last = [0] * n, [None] * n, [None] * n
            base, labels = [set() for _ in range(n)], [set() for _ in range(n)]
            forms, level, score = [set() for _ in range(n)], [None] * n, [0.0] * n

            def note(d, names, strict, sure):
                labels[d].update(names)
                level[d] = strict if level[d] is None else max(level[d], strict)
                score[d] = max(score[d], sure)

            for (_, words), i in zip(found, at.tolist()):
                d = int(norm.doc[i])
                if words in BASE_PHRASES:
                    name, place = BASE_PHRASES[words], i - int(norm.words_before[d])
                    n_base[d] += 1
                    first[d] = place if first[d] is None else min(first[d], place)
                    last[d] = place if last[d] is None else max(last[d], place)
                    base[d].add(name)
                    note(d, [name], restriction(name), 1.0)
                if words in NOTICES:
                    note(d, [NOTICES[words]], restriction(NOTICES[words]), 0.8)
                if words == TAG:
                    begin = int(norm.src_last[i + 2]) + 1
                    stop = np.searchsorted(line_ends, begin)
                    got = evaluate(raw, begin, min(int(off[d + 1]), int(line_ends[stop]) if stop < len(line_ends) else len(raw)))
                    if got:
                        forms[d].add(got[0])
                        note(d, got[1], got[2], 1.0)
                    else:
                        score[d] = max(score[d], 0.4)
            lists = [pa.array([sorted(x) for x in col], pa.list_(pa.string())) for col in (base, labels, forms)]
            return [pa.array(norm.n_words, pa.int64()), pa.array(n_base, pa.int64()), pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()), *lists, pa.array(level, pa.int32()), pa.array(score, pa.float64())]

        return fn

    return add_columns(docs, [text_col], fields, make, keep)
