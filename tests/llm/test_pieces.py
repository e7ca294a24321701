import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataloom.llm import pieces

MATCH, SAID, BYTE0 = pieces.read_model(pieces.default_model())
CODEC = pieces.Codec(MATCH, SAID, BYTE0)
SCORE = {p: (s, i) for p, s, i in MATCH}


def brute(text):
    """Best path over the whole text, position by position, without automaton or segments."""
    if not text:
        return []
    s = [pieces.SPACE if c == " " else ("", c) if c == pieces.SPACE else c for c in " " + text]
    best, last = [0.0] + [float("-inf")] * len(s), [None] * (len(s) + 1)
    for end in range(1, len(s) + 1):
        c = s[end - 1]
        if isinstance(c, tuple) or c not in SCORE:
            best[end], last[end] = best[end - 1] + CODEC.unknown, (end - 1, [BYTE0 + b for b in (c[1] if isinstance(c, tuple) else c).encode()])
        for length in range(min(16, end), 0, -1):
            part = s[end - length : end]
            if any(isinstance(x, tuple) for x in part):
                continue
            got = SCORE.get("".join(part))
            if got and best[end - length] + got[0] > best[end]:
                best[end], last[end] = best[end - length] + got[0], (end - length, [got[1]])
    out, at = [], len(s)
    while at:
        at, ids = last[at]
        out = ids + out
    return out


def ids(text):
    return np.frombuffer(CODEC.encode(text), np.int32)


TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁abcdeé日本語ß😀"), st.characters(exclude_categories=["Cs"])), max_size=40)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_best_path_and_round_trip(text):
    assert ids(text).tolist() == brute(text)
    assert CODEC.decode(ids(text)) == text


@pytest.mark.parametrize("text", ["Hello  world\n x", "internationalization of unbelievable things", "   ", "▁", "a▁ b", "x" * 5000])
def test_known_texts(text):
    assert ids(text).tolist() == brute(text)
    assert CODEC.decode(ids(text)) == text
    if pieces.SPACE not in text:
        assert sentencepiece.SentencePieceProcessor(model_file=pieces.default_model()).decode(ids(text).tolist()).strip() == text.strip()


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBER", 10)
    codec = pieces.Codec(MATCH, SAID, BYTE0)
    for i in range(100):
        codec.encode(f"word{i} other{i}")
    assert len(codec.known) <= 10


def test_documents_come_back_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    coded = pieces.encode_documents(docs)
    joined = coded.join(docs, "doc_id")
    assert joined.where(F.col("round_trip") & (F.sha2("text", 256) == F.col("decoded_sha256")) & (F.size("ids") == F.col("n_tokens"))).count() == docs.count()
    back = pieces.decode_documents(coded).join(docs.withColumnRenamed("text", "own"), "doc_id")
    assert back.where("text = own").count() == docs.count()


def test_edge_rows(spark):
    rows = [(1, None, 0), (2, "", 1), (None, "a b", 2), (4, "long " * 60_000, 3), (4, "x", 4), (4, "x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = pieces.encode_documents(df).collect()
    assert len(got) == 6 and all(r.round_trip for r in got)
    assert {r.doc_id: r.n_tokens for r in got if r.doc_id in (1, 2)} == {1: 0, 2: 0}
    assert next(r for r in got if r.doc_id == 1).decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert pieces.encode_documents(df.where("false")).count() == 0


def test_ids_that_are_no_text_read_as_the_replacement_character(spark):
    whole = pieces.encode_documents(spark.createDataFrame([(1, "a 😀 b 🜚")], "doc_id long, text string")).first().ids
    codec = pieces.Codec(*pieces.read_model(pieces.default_model()))
    rows = [(1, whole), (2, [*whole[:1], 10**9, -5, None]), (3, None), (4, [])]
    rows += [(10 + k, whole[:k]) for k in range(1, len(whole))] + [(50, [codec.byte0 + 0xF0, codec.byte0 + 0x9F])]
    got = {r.doc_id: r.text for r in pieces.decode_documents(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()}
    assert got[1] == "a 😀 b 🜚" and got[2].endswith("\ufffd" * 3) and got[3] == got[4] == "" and len(got) == len(rows)
    assert all(got[10 + k].rstrip("\ufffd") == "a 😀 b 🜚"[: len(got[10 + k].rstrip("\ufffd"))] for k in range(1, len(whole)))
