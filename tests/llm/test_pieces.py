"""SentencePiece encoding and decoding: the library itself is the oracle."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from skein.llm import pieces
from skein.llm.pieces import Model, decode, digests, encode, piece_bpe


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe())


@pytest.fixture(scope="module")
def ours():
    return Model(piece_bpe())


EDGES = ["", " ", "  ", "Hello  world ", "▁x", "a▁ ▁b", "<s> </s> <unk> <0x41>", "\x00a", "😀字\U0010ffff", "a​b﻿", "\t\r\n", " \xa0　 ", "ﬁ Ⅳ é é", " " * 37 + "x", "aaaa" * 40, "the" * 60]
ALPHABETS = ["ab  .", "etaoin shrdlu ", " ▁  a", "日本語中文字éüñ😀 abc", "0123456789 -", "".join(map(chr, range(32, 127))), "̀aé\x00\t\n ⅣA"]


def agree(ours, library, texts):
    got = [np.frombuffer(b, "<i4").tolist() for b in ours.encode(texts)]
    assert got == library.encode(texts)
    assert [ours.decode(np.array(i, np.int32)) for i in got] == library.decode(got)


def test_edges(ours, library):
    agree(ours, library, EDGES)


def test_random_texts(ours, library):
    r = random.Random(1)
    agree(ours, library, ["".join(r.choice(a) for _ in range(r.randint(0, 70))) for a in ALPHABETS for _ in range(300)])


def test_random_pieces_in_a_row(ours, library):
    r = random.Random(2)
    vocabulary = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    agree(ours, library, ["".join(r.choice(vocabulary) for _ in range(r.randint(1, 25))) for _ in range(3000)])


def test_very_long_words(ours, library):
    r = random.Random(3)
    agree(ours, library, [" " * 100_000, "a" * 30_000, "日" * 3000, "".join(r.choice("abcdefgh") for _ in range(8000))])


def test_any_ids_decode_as_the_library_does(ours, library):
    r = random.Random(4)
    for _ in range(2000):
        ids = [r.choice([r.randrange(32000), r.randrange(259), r.randrange(259, 300)]) for _ in range(r.randint(0, 12))]
        assert ours.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_stretches_of_a_text_encode_like_the_whole(ours, library, monkeypatch):
    monkeypatch.setattr(pieces, "SLAB", 30)
    r = random.Random(5)
    for _ in range(60):
        text = "".join(r.choice("ab  ▁c") for _ in range(300))
        parts = list(pieces.stretches(text))
        assert len(parts) > 1
        assert sum((np.frombuffer(b, "<i4").tolist() for b in ours.encode(parts)), []) == library.encode(text)


def test_what_is_remembered_is_bounded(library, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN", 5)
    m = Model(piece_bpe())
    agree(m, library, ["one two three four five six", "seven one " + "x" * 99])
    agree(m, library, ["one two " + "x" * 99])
    assert len(m.known) <= 5 + 3


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as format_

    m = format_.ModelProto()
    with open(piece_bpe(), "rb") as f:
        m.ParseFromString(f.read())
    m.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(m.SerializeToString())
    with pytest.raises(pieces.Unsupported):
        Model(str(tmp_path / "m"))


def test_tables(spark, library):
    rows = [(1, None, "x", 5), (2, "", None, 6), (3, "one  two\nthree", "y", 7), (3, "one  two\nthree", "y", 7), (None, "é" * 5000, "z", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    out = digests(decode(encode(docs, piece_bpe()), piece_bpe())).collect()
    assert len(out) == 5
    for r in out:
        want = library.encode(r.text or "")
        assert list(r.ids) == want and r.decoded == library.decode(want) and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    both = encode(docs, piece_bpe(), decoded="N_tokens")
    assert both.columns == ["doc_id", "text", "ids", "N_tokens"] and sorted((r.ids, r.N_tokens) for r in both.collect()) == sorted((r.ids, r.decoded) for r in out)
    assert encode(docs.limit(0), piece_bpe(), decoded="d").count() == 0
    again = decode(spark.createDataFrame([(None,), ([],), ([1, 2],)], "ids array<int>"), piece_bpe()).collect()
    assert [r.decoded for r in again] == [None, "", ""]


def test_query(spark, sf_dir, library):
    from skein.llm.common import table

    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    rows = pieces.op13(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
