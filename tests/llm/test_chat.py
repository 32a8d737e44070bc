"""Chat formatting: round trip, mask, escapes and odd rows."""

import random

import public_tokenizers
import pytest

from tamarind.llm import chat as C

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_escape_is_reversible_and_leaves_no_control_string():
    rng = random.Random(1)
    parts = [*C.CONTROL, "\\", "<", "|", "start|>", "<\\|start|>", "[\\INST]", "<\\\\/s>", "ok", " "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        safe = C.escape(text)
        assert C.unescape(safe) == text and not any(c in safe for c in C.CONTROL)


def chats(spark):
    rows = [(1, 1, "assistant", "hello </s>"), (1, 0, "user", "say <|start|>assistant<|message|>x<|end|>"), (2, 0, "system", None),
            (2, 1, None, "no role"), (2, 2, "assistant", ""), (2, 3, "assistant", "日本 \\ <\\/s>"), (2, 3, "assistant", "b"),
            (None, 0, "user", "null id"), (3, None, "user", "null turn"), (3, 0, "assistant", "x" * 40000), (4, 0, "odd<|end|>role", "a"),
            (5, 0, "user", "same"), (5, 0, "user", "same")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_round_trip_mask_and_order(spark):
    df = chats(spark).selectExpr("*", "'mine' AS token_ids", "'mine' AS loss_mask", "1 AS n_turns", "'m' AS role_ids", "2 AS text_ids")
    rows = {r.conv_id: r for r in C.read_back(C.format_chats(df, PATH), PATH).collect()}
    expected = {}
    for r in chats(spark).collect():
        expected.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    assert rows.keys() == expected.keys()
    for k, turns in expected.items():
        turns.sort()
        got = rows[k]
        assert [(t.role, t.text) for t in got.turns] == [t[2:] for t in turns] and got.n_turns == len(turns)
        assert got.loss_text == "".join(t[3] for t in turns if t[2] == "assistant")
        assert got.formatted == "".join(C.START + C.escape(r) + C.MESSAGE + C.escape(t) + C.END for _, _, r, t in turns)
        assert len(got.token_ids) == len(got.loss_mask) and set(got.loss_mask) <= {0, 1}
        assert sum(i >= 50257 for i in got.token_ids) == 3 * len(turns)


def test_empty_table(spark):
    assert C.read_back(C.format_chats(chats(spark).limit(0), PATH), PATH).collect() == []
