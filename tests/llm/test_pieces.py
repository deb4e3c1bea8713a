"""SentencePiece ids and texts against the library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from phrasemill.llm import pieces
from phrasemill.llm.common import tokenizer_path

BITS = [" ", "  ", "▁", "\n", "\t", "a", "th", "e", "in", "é", "ß", "中", "文", "😀", "\0", "<s>", "</s>", "<0x0A>", "<unk>", "1", "23", ".", "...", "://", " the", "ing", "x" * 8, " " * 40, "́", "﻿", "​", "ﬁ", "==="]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))


@pytest.fixture(scope="module")
def model():
    return pieces.piece_model(tokenizer_path(pieces.MODEL))


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=14).map("".join) | st.text(max_size=30))
def test_encode_and_decode_equal_the_library(model, library, text):
    ids = library.encode(text)
    assert model.encode(text) == ids
    assert model.decode(ids) == library.decode(ids)


@settings(max_examples=800, deadline=None)
@given(st.lists(st.integers(0, 300) | st.integers(0, 31_999), max_size=9))
def test_decode_of_any_ids(model, library, ids):
    assert model.decode(ids) == library.decode(ids)


def test_columns_in_slices(model, library, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(20))) for _ in range(800)] + [None, "", "word " * 500 + "end", " lead", "trail "]
    monkeypatch.setattr(pieces, "SLICE_CHARS", 300)
    ids, at = model.encode_column(pa.array(texts, pa.string()))
    want = [library.encode(t or "", add_bos=True, add_eos=True) for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
    assert model.decode_column(ids, at) == [library.decode(w) for w in want]


def test_backtracking_takes_pieces_back(model):
    """Longest matches alone give other pieces for some words."""
    def greedy(part):
        out = []
        while part:
            n = next(n for n in range(len(part), 0, -1) if n == 1 or part[:n] in model.ids)
            out.append(part[:n])
            part = part[n:]
        return out

    rng = random.Random(9)
    parts = ["▁" + "".join(rng.choice("aeinrst") for _ in range(12)) for _ in range(400)]
    assert all(model.segmented(p) == model.remerged(p) for p in parts)
    assert any(model.segmented(p) != greedy(p) for p in parts)


def test_tables_start_anew(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "MAX_UNITS", 5)
    monkeypatch.setattr(pieces, "MAX_PAIRS", 5)
    for text in ("some words to fill the table", "other words again", "some words"):
        ids, at = model.encode_column(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_long_text_without_spaces(model, library):
    text = "".join(random.Random(1).choice("abcde") for _ in range(20_000))
    assert model.encode(text) == library.encode(text)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(tokenizer_path(pieces.MODEL), "rb") as f:
        m.ParseFromString(f.read())
    m.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m.model").write_bytes(m.SerializeToString())
    with pytest.raises(ValueError):
        pieces.PieceModel(str(tmp_path / "m.model"))


def test_tables(spark, library):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (3, ""), (None, "▁x\n"), (4, "long " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as ids", "'d' as decoded", "5 as n_tokens")
    got = pieces.encode(df, decoded=True)
    want = [(i, len(w := library.encode(t or "", add_bos=True, add_eos=True)), np.array(w, "<u4").tobytes(), library.decode(w)) for i, t in rows]
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got.collect()), key=str) == sorted(want, key=str)
    assert pieces.encode(df.where("false")).count() == 0
    back = pieces.decode(pieces.encode(df).selectExpr("*", "'old' as decoded"))
    assert sorted((r.decoded for r in back.collect())) == sorted(w[3] for w in want)
    assert pieces.decode(spark.createDataFrame([(None,)], "ids binary")).first().decoded is None


def test_query_digests(spark, library):
    from phrasemill.llm.queries import op13_sentencepiece

    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in op13_sentencepiece(spark, d).collect():
        ids = library.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
