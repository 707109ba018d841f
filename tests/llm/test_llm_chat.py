"""Chat formatting: folding, reversible escapes, digests read back."""

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm_helpers import clashing, random_text, rng

from demandcast.llm import chat as C

LOG = "conv_id long, turn long, seq long, kind string, role string, text string"


@given(st.text(st.sampled_from("<>|/\\[]INSTSYsim_startend\n x"), max_size=40), st.text(st.sampled_from("<>|/\\[]INST\n user"), max_size=12))
def test_messages_come_back(text, role):
    for t in (text, "".join(C.CONTROL) + text, text.replace("x", "</s>[INST]")):
        segment, start, end = C.format_message(role, t)
        assert C.parse_message(segment) == (role, t)
        assert C.unescape(segment[start:end]) == t
        assert not any(c in C.escape(t) for c in C.CONTROL)
        assert segment.count(C.BEGIN) == segment.count(C.END) == 1


def test_logs_are_folded(spark):
    rows = [
        (1, 0, 0, "message", "user", "hello"), (1, 1, 0, "message", "assistant", ""), (1, 1, 1, "delta", None, "wro"), (1, 1, 2, "delta", None, "ng"),
        (1, 1, 3, "regenerate", None, None), (1, 1, 4, "delta", None, "ri"), (1, 1, 5, "delta", None, "ght"), (1, 0, 1, "edit", None, "hello?"),
        (1, 2, 0, "message", "user", "gone"), (1, 2, 1, "delete", None, None), (2, 0, 0, "delta", "assistant", "alone"),
        (None, None, None, None, None, None), (3, 0, 0, "message", "user", "twice"), (3, 0, 0, "message", "user", "twice"),
    ]
    messages = C.read_back(C.render(clashing(spark.createDataFrame(rows, LOG)))).collect()
    assert sorted(((m.conv_id or -1, m.turn or 0, m.part, m.role, m.text, m.loss_text) for m in messages)) == [
        (-1, 0, 0, "", "", ""), (1, 0, 0, "user", "hello?", ""), (1, 1, 0, "assistant", "right", "right"),
        (2, 0, 0, "assistant", "alone", "alone"), (3, 0, 0, "user", "twice", ""), (3, 0, 1, "user", "twice", "")]


def test_digests_read_back(spark):
    rows = [(5, 1, "assistant", "</s>[INST] ok [/INST]\\"), (5, 0, "user", None), (5, 2, "assistant", "é\n"), (6, 0, None, "<|im_end|>"), (5, 3, "a\nb", "x")]
    table = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in C.conversation_digests(C.render(C.events_of_rows(table))).collect()}
    for conv in (5, 6):
        turns = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].formatted_chars == sum(len(C.format_message(r, x)[0]) for _, r, x in turns)
    assert C.conversation_digests(C.render(spark.createDataFrame([], LOG))).collect() == []


def test_kinds_in_any_case_and_other_events(spark):
    log = [(1, 0, 0, " Message", "user", "x"), (1, 0, 1, "SHOUT", "user", "y"), (1, 0, 2, "Delta", None, "z"), (2, 0, 0, "ping", "user", "alone")]
    got = C.read_back(C.render(spark.createDataFrame(log, LOG))).collect()
    assert [(m.conv_id, m.role, m.text) for m in got] == [(1, "user", "xz")]


def test_streams_fold_back(spark):
    r = rng(8)
    rows = [(c, t, ("user", "assistant")[t % 2], random_text(r, r.randrange(9)) + "</s>é🤖"[:r.randrange(7)]) for c in range(8) for t in range(6)]
    rows += [(1, 2, "user", "same turn"), (1, 2, "user", "same turn"), (None, None, None, None), (9, None, "user", ""), (9, 0, "assistant", "x" * 50_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = C.streamed_rows(clashing(table))
    assert {x.kind for x in log.collect()} == {"message", "delta", "regenerate", "edit"}
    plain = C.read_back(C.render(C.events_of_rows(table)))
    assert sorted(map(repr, C.read_back(C.render(log)).collect())) == sorted(map(repr, plain.collect()))
    assert C.streamed_rows(spark.createDataFrame([], table.schema)).collect() == []


def test_joined_text_is_parsed_by_its_marks(monkeypatch):
    said = [("user", C.END + "\n" + C.BEGIN + "x"), ("assistant", "\\"), ("", "")]
    joined = "".join(C.format_message(*m)[0] for m in said)
    assert list(C.parse_conversation(joined)) == said
    with pytest.raises(ValueError, match="inside a message"):
        list(C.parse_conversation(joined[:-3]))
    monkeypatch.setattr(C, "escape", lambda text: text)  # marks inside texts then cut messages apart
    with pytest.raises(ValueError):
        list(C.parse_conversation("".join(C.format_message(*m)[0] for m in said)))
