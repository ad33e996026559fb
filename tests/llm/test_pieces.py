"""Prefix-table encoding and decoding against the sentencepiece library."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from martlet.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    with open(PATH, "rb") as f:
        return pieces.PrefixEncoder(f.read()), sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(both, text):
    own, library = both
    want = library.encode(text, add_bos=True, add_eos=True)
    assert own.encode(text) == want
    ids, decoded = own.round_trip(text)
    assert ids == struct.pack(f"<{len(want)}I", *want) and decoded == library.decode(want)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    same(both, text)


def test_texts_made_of_pieces_blanks_and_marks(both):
    rnd, known = random.Random(3), list(both[0].pieces.values())
    for _ in range(3000):
        kind = rnd.random()
        if kind < 0.4:
            text = "".join(rnd.choices(known, k=rnd.randint(0, 12))).replace("▁", " ")
        elif kind < 0.7:
            text = "".join(rnd.choices("abeht  in\n\t▁é😀\x00<s>", k=rnd.randint(0, 40)))
        else:
            text = " " * rnd.randint(0, 60) + "a" * rnd.randint(0, 30) + " " * rnd.randint(0, 40)
        same(both, text)


def test_long_texts_in_parts(both, monkeypatch):
    rnd = random.Random(5)
    text = " ".join(rnd.choices(["the", "  of", "😀x", "Éternité", "\n", "x" * 300], k=3000))
    monkeypatch.setattr(pieces, "PART", 7)
    same(both, text)
    same(both, "é" * 20_000)
    same(both, " " * 20_000)


def test_bounded_memories_change_nothing(both, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_UNITS", 3)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 5)
    same(both, "one two three four one two three four five six")


def test_every_prefix_has_the_last_piece_of_its_own_encoding(both):
    own, _ = both
    unit = "▁internationalization"
    found, length = own.last_pieces(unit)
    for n in range(1, len(unit) + 1):
        last = own.merged(unit[:n])[-1]
        assert own.pieces[found[n]] == last and length[n] == len(last)


def test_rows_nulls_repeats_and_clashing_names(spark, both):
    _, library = both
    rows = [(1, None), (1, ""), (None, "a b"), (2, "héllo wörld"), (2, "héllo wörld"), (3, "word " * 30_000)]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id bigint, text string, key string, ids int, decoded int")
    got = pieces.encoding_report(docs, PATH).collect()
    want = []
    for k, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((k, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert pieces.encoding_report(docs.limit(0), PATH).collect() == []
    assert pieces.encode_documents(docs.withColumnRenamed("doc_id", "ID"), PATH, key="ID").columns == ["ID", "ids", "decoded"]
    clash = pieces.encode_documents(docs.select("ids", "text"), PATH, key="ids")
    assert clash.columns == ["ids", "ids_", "decoded"] and clash.count() == len(rows)
