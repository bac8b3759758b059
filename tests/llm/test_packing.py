from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeops.llm import packing
from lakeops.llm.packing import Limits, Packer, Piece, WordIds, op12_pack_sequences, pack, public_tokenizer

ODD = ["", " ", "a", "A, b.", "don't, he's 'SO", "x...,,", "Était—une, fête.", "日本語 text 12", "J̌ ǰ K Å", "été, ÉTÉ fête; Ünï straße. ŉ ǰ, ẞ Ж жЯ ԱբԳ ªº µ İ ı ﬁ", "e\u0301t\u0301 ά ΆΣ, \u0345 \u02b0 ʰ", "<|endoftext|> <|EndOfText|> a", "\x85a\x1cb c\xa0d", "ΑΣ Σ. İI", "é é", "≠ ≠", "😀😀, x", "\x00a", "it's'll;" * 3, "x" * 5000, "A" * 70 + ", " * 3]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizer())


@pytest.fixture(scope="module")
def words():
    return WordIds(public_tokenizer())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(words, library, text):
    assert np.frombuffer(words.of(text), "<u4").tolist() == ids_of(library, text)


def test_texts_cut_into_parts(words, library, monkeypatch):
    text = "One two, three\nfour  é " * 9 + "x" * 50
    for size in (1, 3, 7, 40):
        monkeypatch.setattr(packing, "CHUNK", size)
        assert np.frombuffer(words.of(text), "<u4").tolist() == ids_of(library, text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aAbBzé'’sStTdD.,;:! \t\n0१̌̇İßΣ—<|>")), max_size=40))
def test_ids_of_any_text(words, library, text):
    assert np.frombuffer(words.of(text), "<u4").tolist() == ids_of(library, text)


sizes = st.lists(st.tuples(st.integers(1, 90), st.integers(0, 90)), max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(sizes, max_size=4), st.integers(1, 40), st.integers(1, 12), st.integers(1, 40))
def test_sequences_hold_every_token_once_within_all_limits(blocks, tokens, segments, loss):
    limits = Limits(tokens, segments, loss)
    packer, found, number = Packer(limits), [], 0
    whole = {}
    for block in blocks:
        pieces = []
        for length, prompt in block:
            whole[number] = length
            pieces.append(Piece(number, 0, length, min(prompt, length)))
            number += 1
        found += packer.pack(pieces)
    found += packer.pack([], last=True)
    covered = defaultdict(list)
    for sequence in found:
        total = sum(p.length for p in sequence)
        assert total == tokens or total & (total - 1) == 0
        assert len(sequence) <= segments and sum(p.loss for p in sequence) <= loss and total <= tokens
        for p in sequence:
            covered[p.example].append((p.start, p.start + p.length))
    assert covered.keys() == whole.keys()
    for number, spans in covered.items():
        spans.sort()
        assert [s for s, _ in spans] == [0, *(e for _, e in spans[:-1])] and spans[-1][1] == whole[number]


def test_pieces_that_fit_are_not_cut():
    found = list(Packer(Limits(10, 3, 10)).pack([Piece(i, 0, n, 0) for i, n in enumerate([6, 4, 7, 3, 5, 5])], last=True))
    assert sorted(sorted(p.length for p in s) for s in found) == [[3, 7], [4, 6], [5, 5]]


def test_many_small_examples_beside_large_ones_do_not_use_up_the_segments():
    lengths = [1] * 40 + [96] * 10
    found = list(Packer(Limits(100, 8, 100)).pack([Piece(i, 0, n, 0) for i, n in enumerate(lengths)], last=True))
    assert len(found) == 10 and all(sum(p.length for p in s) == 100 for s in found)


def test_limits_have_to_allow_a_token():
    with pytest.raises(ValueError):
        Limits(tokens=0)


def check(rows, library, texts, limits=Limits()):
    """``texts``: id to list of texts; rows of pieces."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        documents[r.doc_id].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        total = sum(p.length for p in pieces)
        assert total == limits.tokens or total & (total - 1) == 0
        assert total <= limits.tokens and len(pieces) <= limits.segments
    expected = {k: sorted(ids_of(library, t) + [2] for t in found) for k, found in texts.items()}
    assert documents.keys() == expected.keys()
    return documents, expected


def test_the_query(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = op12_pack_sequences(spark, sf).collect()
    texts = {r.doc_id: [r.text] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    documents, expected = check(rows, library, texts)
    for key, pieces in documents.items():
        ids = np.array(expected[key][0], "<u4")
        pieces.sort(key=lambda r: r.start)
        assert [p.start for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1]]
        assert {p.doc_tokens for p in pieces} == {len(ids)} and sum(p.length for p in pieces) == len(ids)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())


def test_nulls_repeats_and_clashing_names(spark, library):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "y"), (None, "", "z"), (3, "long words " * 3000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(1)
    got = pack(docs, public_tokenizer(), Limits(64, 4, 64)).collect()
    texts = defaultdict(list)
    for key, text, _ in rows:
        texts[key].append(text)
    documents, expected = check(got, library, texts, Limits(64, 4, 64))
    assert [(r.start, bytes(r.ids)) for r in documents[2]] == [(0, b"\2\0\0\0")]
    assert len(documents[1]) >= 2 and sum(r.length for r in documents[1]) == 2 * len(expected[1][0])
    long = b"".join(bytes(r.ids) for r in sorted(documents[3], key=lambda r: r.start))
    assert np.frombuffer(long, "<u4").tolist() == expected[3][0]


def test_prompts_bear_no_loss(spark):
    docs = spark.createDataFrame([("k", "ask this", "the answer is long")], "doc_id string, prompt string, text string")
    (row,) = pack(docs, public_tokenizer(), prompt_col="prompt", limits=Limits(16, 4, 16)).groupBy("doc_id").sum("length", "n_loss").collect()
    assert row["sum(length)"] == 7 and row["sum(n_loss)"] == 5


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack(docs, public_tokenizer()).count() == 0
