"""Chat formatting: round trips, masks, odd rows."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from logforge.llm import chat

PIECES = ["\\", "[INST]", "[/INST]", "</s>", "<s>", "[SYS] ", "[ROLE:", "] ", "<", "/s>", "é", "日本", "😀", " ", "\n", "a", "x y"]
texts = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)
roles = st.sampled_from(["user", "assistant", "system", "tool", "", "a]b [INST]", "é"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=5))
def test_parse_undoes_render(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=4))
def test_mask_covers_assistant_texts_exactly(turns):
    formatted, spans = chat.render(turns)
    code = chat._tokenizer(chat.VOCABULARY).encode_batch([formatted], add_special_tokens=False)[0]
    offsets = np.array(code.offsets, np.int64).reshape(-1, 2)
    mask, pieces = chat.masked(offsets, spans)
    assert pieces == [s for s in spans if s[1] > s[0]]
    for inside, (a, b) in zip(mask, offsets):
        assert inside == any(a < e and b > s for s, e in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_conversations_with_odd_rows(spark):
    rows = [
        (1, 2, "assistant", "two"), (1, 1, "user", "one</s>"), (1, None, "system", None), (2, 0, None, "x"),
        (2, 0, None, "x"), (None, 1, "user", "lost"), (None, 2, "assistant", "found"), (3, 1, "assistant", ""),
        (4, 1, "assistant", "long [INST] \\" * 20_000)]
    table = spark.createDataFrame(
        [(*r, "clash", "clash") for r in rows], "conv_id long, turn long, role string, text string, tokens string, mask string")
    formatted = chat.format_conversations(table)
    out = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    want = {
        1: [("system", ""), ("user", "one</s>"), ("assistant", "two")], 2: [("", "x"), ("", "x")],
        None: [("user", "lost"), ("assistant", "found")], 3: [("assistant", "")], 4: [("assistant", rows[-1][3])]}
    assert set(out) == set(want)
    for key, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        row = out[key]
        assert row["n_turns"] == len(turns) and row["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), sha(loss))
    assert chat.read_back(chat.format_conversations(table.limit(0))).count() == 0


def test_equal_turn_numbers_are_ordered(spark):
    table = spark.createDataFrame(
        [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "z")], "conv_id long, turn long, role string, text string")
    assert chat.parse(chat.format_conversations(table).first()["formatted"]) == [
        ("assistant", "z"), ("user", "a"), ("user", "b")]
