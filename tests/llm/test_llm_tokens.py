"""SentencePiece agenda: ids and texts of the library."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import clashing, documents

from demandcast.llm import sentencepiece_bpe as S

TEXTS = [None, "", " ", "  ", "a", "Hello  wörld\n\tab ▁ x\n", " a\n\n b  ", "<s></s>[INST] <0x0A>", "日本語 テスト\u0000 x", "\r\n\x0b", "x" * 3000,
         "\n", "a\n ", "é́ 🤖🤖", " \xa0 q", "e.g. a.b, (c) \"d\" x_.y ².z", "word." * 50, "▁▁▁", "ends with space "]


def test_digests_are_those_of_the_library(spark):
    library = S.agenda_for(S.default_model()).library
    df = clashing(documents(spark, list(enumerate(TEXTS * 2))))
    rows = {r.doc_id: r for r in S.encode_digests(df).collect()}
    assert len(rows) == len(TEXTS) * 2
    for i, text in enumerate(TEXTS * 2):
        ids = library.encode(text or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_ids_and_texts(spark):
    library = S.agenda_for(S.default_model()).library
    for r in S.encode_texts(documents(spark, list(enumerate(TEXTS)))).collect():
        assert r.ids == library.encode(TEXTS[r.doc_id] or "") and r.decoded == library.decode(r.ids)
    assert S.encode_digests(documents(spark, [])).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n.,_²▁()ab'\"-"))))
def test_agenda_alone_equals_library(text):
    agenda = S.agenda_for(S.default_model())
    assert [i for s in agenda.segments(text) for i in agenda.merge(s)] == agenda.library.encode(text)


def test_long_and_short_agendas_agree():
    agenda = S.agenda_for(S.default_model())
    for segment in [" international", "aaaaaaaa", " ...", "übergeschnappt", " 123123123"]:
        assert agenda.merge(segment) == agenda.merge_long(segment)


def test_a_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(S, "SEGMENTS_KEPT", 3)
    agenda = S.Agenda(S.default_model())
    for text in ["one two three four five", "two six", "one nine ten", "two"]:
        got = [i for e in next(iter(agenda.encode_batch([text]))) for i in e[0]]
        assert got == agenda.library.encode(text)


def test_a_broken_agenda_fails(monkeypatch):
    agenda = S.Agenda(S.default_model())
    monkeypatch.setattr(agenda, "merge", lambda segment: [0])
    with pytest.raises(ValueError, match="differ"):
        next(iter(agenda.encode_batch(["some words"])))
