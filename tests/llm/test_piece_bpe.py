"""Encoding and decoding, against the library that the vocabulary belongs to."""

import hashlib

import awkward
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import piece_bpe, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.model_path())


@pytest.fixture(scope="module")
def ours():
    return piece_bpe.pieces(queries.model_path())


def same(library, ours, texts):
    flat, counts = ours.encode(texts)
    decoded, offsets = ours.decode(flat, counts)
    ends = np.cumsum(np.r_[0, counts])
    for k, text in enumerate(texts):
        ids = library.encode(text)
        assert flat[ends[k] : ends[k + 1]].tolist() == ids
        assert decoded[offsets[k] : offsets[k + 1]].tobytes().decode() == library.decode(ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aabcdeth ,.\n\t▁éß梦🙂\0") | st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_any_text(library, ours, texts):
    same(library, ours, texts)


def test_long_units_and_runs_of_spaces(library, ours):
    same(library, ours, ["a" * 3000, "abcde" * 400, " " * 700 + "x" + " " * 40, "梦é" * 500, "", "▁" * 300])


def thue_morse(n, a, b):
    return "".join(b if k.bit_count() % 2 else a for k in range(n))


def test_units_whose_hashes_agree_are_told_apart(library, ours):
    """Sums of powers modulo 2^64 are equal for these words and their complements, for any base."""
    for n in (1024, 2048, 4096):
        same(library, ours, [thue_morse(n, "a", "b"), thue_morse(n, "b", "a"), thue_morse(n, "é", "t")])


def test_units_at_the_borders_of_cutting(library, ours, monkeypatch):
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzäñ梦想世界"), n)) for n in (63, 64, 65, 255, 256, 257, 1000)]
    texts += ["世界梦想" * 300, "x梦" * 40, "the" * 90, "=" * 200 + "梦" + "-" * 200]
    same(library, ours, texts)
    for limit in (4, 64, 300):
        monkeypatch.setattr(piece_bpe, "LONG_UNIT", limit)
        monkeypatch.setattr(piece_bpe, "_CUT_UNIT", limit // 2)
        same(library, ours, texts)


def test_awkward_documents(spark, library):
    out = piece_bpe.encode_decode(awkward.documents(spark), queries.model_path()).collect()
    got = sorted((repr(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in out)
    wanted = []
    for id_, text in awkward.ROWS:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        wanted.append((repr(id_), ids, library.decode(ids)))
    assert got == sorted(wanted)
    assert piece_bpe.encode_decode(awkward.documents(spark).where("false"), queries.model_path()).isEmpty()


def test_whole_table(spark, documents, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op10_sentencepiece(spark, SMALL).collect()}
    for r in documents.collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        raw = np.array(ids, "<u4").tobytes()
        assert got[r.doc_id] == (
            len(ids),
            hashlib.sha256(raw).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest(),
        )
