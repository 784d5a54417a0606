"""Ids and texts against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from corpora import SCHEMA, frame, hard_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from sluiceway.llm import queries
from sluiceway.llm.sentencepieces import BLOCK, PieceModel, decode_texts, encode_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return PieceModel(file.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text("abcdehinorst  \n\t.,漢é▁0=-<s>", max_size=60)))
def test_any_text(model, library, text):
    ids = model.encode(text)
    assert ids == library.encode(text) and model.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("unit", ["x", "ab", "=", " ", "漢字", "😀", "thequick", "\n", "aé", "<s>"])
def test_long_texts_without_borders(model, library, unit):
    text = unit * (2 * BLOCK + 7)
    assert model.encode(text) == library.encode(text)


def test_segments_may_be_cut_at_any_unjoined_signs(model, library):
    with open(PATH, "rb") as file:
        plain = PieceModel(file.read())
    plain._cut = None
    for text in ("two words, 12.5 signs!?", "aé  b▁▁c\n\n\td", "x" * 99):
        assert plain.encode(text) == model.encode(text) == library.encode(text)


def test_rows_of_any_ids(model, library):
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randrange(8))]
        assert model.decode(ids) == library.decode(ids)


def test_neighbours_are_compatible_as_when_merged_again(model, library):
    rng = random.Random(5)
    for _ in range(3000):
        a, b = (model.pieces[rng.randrange(259, 32000)] for _ in range(2))
        if not a.startswith("▁") or "▁" in b:
            continue
        alone = [library.id_to_piece(i) for i in library.encode((a + b)[1:].replace("▁", " "))]
        assert model.fits(a, b) == (alone == [a, b])


def test_hard_rows_with_clashing_columns(spark, library):
    rows = hard_rows()
    encoded = encode_texts(frame(spark, rows, clashing=True), PATH)
    got = sorted((tuple(r) for r in decode_texts(encoded, PATH).collect()), key=repr)
    assert got == sorted(((r[0], library.encode(r[1] or ""), library.decode(library.encode(r[1] or ""))) for r in rows), key=repr)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert encode_texts(empty, PATH).collect() == [] and decode_texts(encode_texts(empty, PATH), PATH).collect() == []


def test_query_against_the_library(spark, library):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    got = {tuple(r) for r in queries.QUERIES["op11_sentencepiece"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert got == {(r.doc_id, len(i), digest(",".join(map(str, i))), digest(library.decode(i))) for r in docs for i in [library.encode(r.text or "")]}
