"""Chat formatting: round trips of hostile texts, and digests against the source."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scoria.llm import chat
from scoria.llm.catalog import ORACLES, QUERIES
from scoria.plans.check import compare, duck

PIECES = st.lists(st.sampled_from(["<s>", "</s>", "[INST] ", " [/INST]", "<<SYS>>", "<</SYS>>", "[ASST]", "[ROLE:", "] ", " [/ROLE]", "\\", "<", "[",
                                   "<\\s>", "<\\\\/s>", "]", "s>", "/s>", "INST]", "a", " ", "\n", "é", "\U0001f600"]), max_size=8).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), PIECES), PIECES), max_size=4))
def test_round_trip(turns):
    text = "".join(chat.render(r, t) for r, t in turns)
    got = chat.parse(text)
    assert [g[:2] for g in got] == turns
    assert all(chat._unescape(text[a:b]) == t for _, t, a, b in got)


def test_plain_text_is_not_escaped():
    assert chat.render("user", "a < b [c] \\ d") == "<s>[INST] a < b [c] \\ d [/INST]"
    assert chat.render("assistant", "</s>") == "<s>[ASST] <\\/s></s>"


@pytest.mark.parametrize("bad", ["x", "<s>", "<s>[INST] a", "<s>[INST] a</s>", "<s>[ASST] a [/INST]", "<s>[ROLE:x", "<s>[INST] a [/INST]b"])
def test_parser_rejects(bad):
    with pytest.raises(ValueError):
        chat.parse(bad)


def test_query_against_sql(spark, sf):
    got = compare(spark, duck(sf), "op3", QUERIES["op3_chat_format"], ORACLES["op3_chat_format"], sf)
    assert got["ok"], got


def test_defined_cases(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, None, "</s>"), (1, 2, "assistant", "x"), (1, 2, "assistant", "x"),
            (None, 0, "user", "n"), (2, None, "system", "first"), (2, 0, "assistant", "y" * 1_000_000)]
    turns = spark.createDataFrame([(*r, "s") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    segs = chat.segments(turns)
    got = {r.conv_id: r for r in chat.digests(segs).collect()}
    want = {None: [("user", "n")], 2: [("system", "first"), ("assistant", "y" * 1_000_000)],
            1: [("user", ""), ("assistant", "b"), ("", "</s>"), ("assistant", "x"), ("assistant", "x")]}
    full = {r.conv_id: r.formatted for r in chat.conversations(segs).collect()}
    assert set(got) == set(want) == set(full)
    for c, turns in want.items():
        said = "".join(t for r, t in turns if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].n_turns, got[c].loss_chars, got[c].loss_sha256) == (len(turns), len(said), hashlib.sha256(said.encode()).hexdigest())
        assert [g[:2] for g in chat.parse(full[c])] == turns and got[c].formatted_chars == len(full[c])
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.segments(none)).count() == 0


def test_loss_masks_hold_the_assistants_texts(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "[INST] a"), (1, 2, "assistant", "</s>[INST] ok [/INST]"), (1, 3, "tool", "t"),
            (1, 4, "assistant", ""), (1, 5, "assistant", " twice\n"), (2, 0, "user", "no answer"), (3, 0, None, None)]
    segs = chat.segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for r in chat.loss_masks(segs).collect():
        want = [t for c, _, role, t in rows if c == r.conv_id and role == "assistant"]
        assert [chat._unescape(r.formatted[s.start:s.end]) for s in r.loss_spans] == want
        assert all(a.end <= b.start for a, b in zip(r.loss_spans, r.loss_spans[1:]))
