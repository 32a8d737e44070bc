"""Chat formatting at token level (operator 6).

Every segment (role or text) is escaped and encoded by itself, so no token spans a border.
Reserved ids, which the vocabulary does not use, are spliced between the segments; the loss
mask is the prefix sum of +1 and -1 at the borders of assistant texts. A control string in
a text is escaped by a mark after its first character, which is undone when reading back.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, IntegerType, StringType, StructField, StructType

from tamarind.llm.bpe import encoder, load
from tamarind.llm.common import add_columns, list_array

#: Strings of the reserved ids, in the order of their ids after the vocabulary's.
START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
RESERVED = (START, MESSAGE, END)
# fixed values: control strings of common templates, escaped wherever a text holds them
CONTROL = (*RESERVED, "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
MARK = "\\"
TRAINED_ROLE = "assistant"

_RAW = re.compile("|".join(f"({re.escape(c[0])}{re.escape(MARK)}*){re.escape(c[1:])}" for c in CONTROL))
_ESCAPED = re.compile("|".join(f"({re.escape(c[0])}{re.escape(MARK)}*){re.escape(MARK + c[1:])}" for c in CONTROL))


def escape(text: str) -> str:
    """One mark more after the first character of each control string (with marks or none)."""
    return _RAW.sub(lambda m: m[m.lastindex] + MARK + m[0][len(m[m.lastindex]):], text)


def unescape(text: str) -> str:
    """One mark less: the inverse of ``escape``."""
    return _ESCAPED.sub(lambda m: m[m.lastindex] + m[0][len(m[m.lastindex]) + len(MARK):], text)


def _decoded(vocabulary, ids: np.ndarray, edge: np.ndarray) -> list[str]:
    """Texts of consecutive runs of ids, from one join of all their bytes."""
    held = [vocabulary.bytes[i] for i in ids.tolist()]
    size = np.fromiter(map(len, held), np.int64, len(held))
    at = np.concatenate([[0], np.cumsum(size)])[edge].tolist()
    data = b"".join(held)
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]


def _values(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and lengths of a list column; null: empty."""
    return np.asarray(col.flatten()), np.asarray(col.value_lengths().fill_null(0), np.int64)


def _slots(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of runs of given sizes."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def format_chats(rows: DataFrame, path: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``token_ids`` and ``loss_mask``.

    A turn is START role MESSAGE text END; the mask is 1 on the tokens of assistant texts.
    Rows come by turn, ties by role and then text; null roles and texts count as empty, null
    turns come first, rows of a null ``conv_id`` are one conversation, repeated rows are
    repeated turns. Other columns are not read. A conversation becomes one row, so its
    turns meet in one task; only their tokens travel there, and turns of one number are put in
    order by decoding them.
    """
    shared = load(rows.sparkSession, path)
    ints = ArrayType(IntegerType())
    source = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                         F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))

    def make_segments():
        coder = encoder(shared)

        def fn(batch):
            out = []
            for name in ("role", "text"):
                tokens, size = coder.encode([escape(t) for t in batch.column(name).to_pylist()], special=False)
                out.append(list_array(tokens, size, pa.int32()))
            return out

        return fn

    segments = add_columns(source, ["role", "text"], [StructField("role_ids", ints), StructField("text_ids", ints)],
                           make_segments, keep=["conv_id", "turn", "role"])
    segments = segments.select("conv_id", F.struct("turn", "role_ids", "text_ids", (F.col("role") == TRAINED_ROLE).cast("byte").alias("trained")).alias("t"))
    turns = segments.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.sort_array(F.collect_list("t")).alias("turns"))
    turns = turns.select("conv_id", "n_turns", F.col("turns.role_ids").alias("roles"), F.col("turns.text_ids").alias("texts"),
                         F.col("turns.trained").alias("trained"), F.transform("turns", lambda t, i: (
                             (i > 0) & t.turn.eqNullSafe(F.get(F.col("turns.turn"), i - 1))).cast("byte")).alias("ties"))

    def make_rows():
        vocabulary = encoder(shared).vocabulary
        first = vocabulary.size

        def in_order(tie, role, role_size, text, text_size):
            """Places of all turns of a batch with ties by role and text."""
            order = np.arange(len(tie))
            tied = np.flatnonzero(tie)
            if not len(tied):
                return order
            roles = _decoded(vocabulary, role, np.concatenate([[0], np.cumsum(role_size)]))
            texts = _decoded(vocabulary, text, np.concatenate([[0], np.cumsum(text_size)]))
            begins = np.flatnonzero(tie == 0)
            for g in np.unique(np.searchsorted(begins, tied, side="right") - 1).tolist():
                a, b = int(begins[g]), int(begins[g + 1]) if g + 1 < len(begins) else len(tie)
                order[a:b] = sorted(range(a, b), key=lambda i: (unescape(roles[i]), unescape(texts[i])))
            return order

        def fn(batch):
            (roles, per_conv), (texts, _) = ((c.flatten(), np.asarray(c.value_lengths().fill_null(0), np.int64))
                                             for c in (batch.column("roles"), batch.column("texts")))
            (role, role_size), (text, text_size) = _values(roles), _values(texts)
            trained, tie = np.asarray(batch.column("trained").flatten()), np.asarray(batch.column("ties").flatten())
            order = in_order(tie, role, role_size, text, text_size)
            role_at, text_at = (np.cumsum(role_size) - role_size)[order], (np.cumsum(text_size) - text_size)[order]
            role_size, text_size, trained = role_size[order], text_size[order], trained[order]
            size = role_size + text_size + len(RESERVED)
            begin = np.cumsum(size) - size
            ids = np.empty(int(size.sum()), np.int32)
            ids[begin], ids[begin + 1 + role_size], ids[begin + size - 1] = first, first + 1, first + 2
            ids[_slots(begin + 1, role_size)] = role[_slots(role_at, role_size)]
            ids[_slots(begin + 2 + role_size, text_size)] = text[_slots(text_at, text_size)]
            # the mask is the prefix sum of +1 and -1 at the borders of trained texts
            step = np.zeros(len(ids) + 1, np.int32)
            np.add.at(step, (begin + 2 + role_size)[trained == 1], 1)
            np.add.at(step, (begin + size - 1)[trained == 1], -1)
            mask = np.cumsum(step[:-1]).astype(np.int8)
            edge = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(per_conv)])]
            return [list_array(ids, np.diff(edge), pa.int32()), list_array(mask, np.diff(edge), pa.int8())]

        return fn

    return add_columns(turns, ["roles", "texts", "trained", "ties"], [StructField("token_ids", ints), StructField("loss_mask", ArrayType(ByteType()))],
                       make_rows, keep=["conv_id", "n_turns"])


def read_back(chats: DataFrame, path: str) -> DataFrame:
    """``chats`` with what its tokens say: ``turns`` (role and text, unescaped), ``loss_text``
    (all text under the mask, unescaped) and ``formatted`` (the whole as text)."""
    shared = load(chats.sparkSession, path)
    turn = StructType([StructField("role", StringType()), StructField("text", StringType())])
    fields = [StructField("turns", ArrayType(turn)), StructField("loss_text", StringType()), StructField("formatted", StringType())]

    def make():
        vocabulary = encoder(shared).vocabulary
        first = vocabulary.size

        def fn(batch):
            (ids, size), (mask, _) = _values(batch.column("token_ids")), _values(batch.column("loss_mask"))
            # cut at the reserved ids: a turn is three of them, with its role and its text between
            cut = np.flatnonzero(ids >= first)
            start, message, end = cut[0::3], cut[1::3], cut[2::3]
            if len(cut) % len(RESERVED) or (ids[start] != first).any() or (ids[message] != first + 1).any() or (ids[end] != first + 2).any():
                raise ValueError("reserved ids that do not form turns")
            bounds = np.stack([start + 1, message, message + 1, end], axis=1)
            plain = np.where(ids < first, 1, 0)
            before = np.concatenate([[0], np.cumsum(plain)])
            parts = _decoded(vocabulary, ids[ids < first], np.concatenate([before[bounds[:, [0, 2]].reshape(-1)], before[-1:]]))
            roles, texts = parts[0::2], parts[1::2]
            under = np.flatnonzero((mask == 1) & (ids < first))
            spoken = _decoded(vocabulary, ids[under], np.searchsorted(under, np.concatenate([start, [len(ids)]])))
            per_conv = np.bincount(np.searchsorted(np.cumsum(size), start, side="right"), minlength=len(size))
            at = np.concatenate([[0], np.cumsum(per_conv)]).tolist()
            own_roles, own_texts = list(map(unescape, roles)), list(map(unescape, texts))
            turns = pa.StructArray.from_arrays([pa.array(own_roles, pa.string()), pa.array(own_texts, pa.string())], ["role", "text"])
            whole = [f"{START}{r}{MESSAGE}{t}{END}" for r, t in zip(roles, texts)]
            losses = list(map(unescape, spoken))
            pairs = list(zip(at, at[1:]))
            return [pa.ListArray.from_arrays(pa.array(at, pa.int32()), turns), pa.array(["".join(losses[a:b]) for a, b in pairs], pa.string()),
                    pa.array(["".join(whole[a:b]) for a, b in pairs], pa.string())]

        return fn

    return add_columns(chats, ["token_ids", "loss_mask"], fields, make)
