from __future__ import annotations

import hashlib
import random
import sys
from itertools import pairwise

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeops.llm.pieces import Pieces, encode_documents, op6_sentencepiece, public_model, read_model


@pytest.fixture(scope="module")
def model():
    return read_model(public_model())


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@pytest.fixture(scope="module")
def known(model):
    return Pieces(model)


def same(known, library, text):
    ids = np.frombuffer(known.encode(text), "<u4")
    assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert known.decode(ids) == library.decode(ids.tolist())


ODD = ["", " ", "a", "<s>", "</s> <unk> <0x0A>", "\n\n", "\t", "▁", "▁a ▁▁b", "é", "é", "\x00a", "a\x00", "😀😀 x", "　 x", "a" * 300, "-" * 100, "ÀÀÀ\r\n", "ﬁ", "​", "﻿a", " lead", "trail ", "日本語 text", "x" * 5000 + " y"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(known, library, text):
    same(known, library, text)


def test_runs_of_spaces(known, library):
    for n in range(200):
        for text in (" " * n, " " * n + "b", "a" + " " * n + "b", "a" + " " * n, " " * n + "日x", "é" + " " * n + "๛"):
            same(known, library, text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(known, library, text):
    same(known, library, text)


def test_texts_of_pieces(known, library):
    draw = random.Random(7)
    names = [n.replace("▁", " ") for n in known.ids]
    for _ in range(4000):
        same(known, library, "".join(draw.choice(names) for _ in range(draw.randrange(12))))


def test_pair_compatibility_against_its_definition(known):
    def merged(text):
        parts = list(text)
        while True:
            ranks = [known.rank.get(a + b) for a, b in pairwise(parts)]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                return parts
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    draw = random.Random(8)
    names = [n for n in known._time if "▁" not in n[1:]]
    for _ in range(20_000):
        a, b = draw.choice(names), draw.choice([n for n in (draw.choice(names), draw.choice(names)) if "▁" not in n] or ["e"])
        assert known.compatible(known.ids[a], known.ids[b]) == (merged(a + b) == [a, b])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 400), st.integers(0, 31999)), max_size=12))
def test_decoding_any_ids(known, library, ids):
    ids = [i for i in ids if i != known.unknown]
    assert known.decode(np.array(ids, np.uint32)) == library.decode(ids)


def test_small_caches_change_nothing(model, library, monkeypatch):
    monkeypatch.setattr("lakeops.llm.pieces.MOST_CACHED", 4)
    known = Pieces(model)
    for i in range(200):
        same(known, library, f"word{i} other{i % 7} and more,{i}")


def test_words_met_with_other_neighbours_are_not_looked_at_again(model, library):
    known, calls = Pieces(model), []
    words = [f"{a}{b}ing" for a in "bdfglmnprs" for b in "aeiou"]
    text = " ".join(f"{a}.\n({b})" for a in words for b in words)
    known.encode(" ".join(f"{a}.\n({a})" for a in words))
    sys.setprofile(lambda frame, event, _: calls.append(frame) if event == "call" else None)
    try:
        known.encode(text)
    finally:
        sys.setprofile(None)
    assert len(calls) < 100  # of 2,500 pairs of words
    same(known, library, text)


def test_texts_in_strips(model, library, monkeypatch):
    texts = [*ODD, "a,b  c\u0416\u65e5 (x)\n\U0001f600\U0001f600.  ", "one two, three" * 50]
    for strip in (1, 2, 3, 7):
        monkeypatch.setattr("lakeops.llm.pieces.STRIP", strip)
        known = Pieces(model)
        for text in texts:
            same(known, library, text)


def test_documents(spark, library, tmp_path):
    rows = [(1, None), (2, ""), (3, "A text, with spaces.\n"), (3, "A text, with spaces.\n"), (None, "é"), (4, "lang " * 30_000)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, ids string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = op6_sentencepiece(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert encode_documents(docs, public_model()).columns == ["doc_id", "text", "ids", "decoded", "n_tokens"]
    assert encode_documents(docs.limit(0), public_model()).collect() == []
