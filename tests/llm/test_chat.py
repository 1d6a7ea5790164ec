from __future__ import annotations

import hashlib

from hypothesis import HealthCheck, given, settings, strategies as st

from userlake.llm import chat

TURNS = "conv_id bigint, turn bigint, role string, text string"
PIECES = ["<|im_end|>", "<|im_start|>", "<|im_turn|>", "\\", "<", "|", "\n", "n", "<\\|", "<\\n|", "é", "🦆", "assistant", ""]
text = st.lists(st.sampled_from(PIECES), max_size=6).map("".join)


def sha(value):
    return hashlib.sha256(value.encode()).hexdigest()


def expected(turns):
    lines = "".join(f"{role}\n{t}\n" for role, t in turns)
    loss = "".join(t for role, t in turns if role == "assistant")
    return len(turns), sha(lines), len(loss), sha(loss)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["user", "assistant", "a\nb", "<|im_end|>\n", "", "\\"]), text), min_size=1, max_size=60))
def test_everything_is_read_back(spark, turns):
    rows = [(conv, i, role, t) for i, (conv, role, t) in enumerate(turns)]
    out = chat.digests(chat.format_conversations(spark.createDataFrame(rows, TURNS)))
    got = {r.conv_id: tuple(r)[1:5] for r in out.collect()}
    want = {c: expected([(r, t) for conv, r, t in turns if conv == c]) for c, _, _ in turns}
    assert got == want


def test_adjacent_turns_of_a_role_share_a_block_and_nulls_are_empty(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 3, "assistant", None), (None, 0, None, "x"), (1, 2, "assistant", "b")]
    df = spark.createDataFrame(rows, TURNS)
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert got[1].formatted == (
        "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_turn|>b<|im_turn|><|im_end|>\n"
    )
    assert got[None].formatted == "<|im_start|>\nx<|im_end|>\n"
    assert [s.text for s in got[1].segments if s.loss] == ["b", "b", ""]
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_hostile_conversation_is_added(spark):
    df = spark.createDataFrame([(5, 0, "user", "q", "extra")], TURNS + ", formatted string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(chat.with_hostile_conversation(df))).collect()}
    assert got[-1].n_turns == 2 and got[-1].loss_chars == len(chat.HOSTILE_TEXT) and got[5].loss_chars == 0
