"""Packed sequences against the tokenizer, and first fit against a plain search."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from corpora import SCHEMA, frame, hard_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from sluiceway.llm.packing import Encoder, first_fit, pack
from tokenizers import Tokenizer

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def packed(spark, rows, **options):
    return pack(frame(spark, rows, clashing=True), PATH, PATTERN, **options).collect()


def test_hard_rows_come_back_whole(spark):
    rows, exact = hard_rows(), Tokenizer.from_file(PATH)
    got = packed(spark, rows)
    expected = defaultdict(int)
    for r in rows:
        ids = np.array(exact.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        for start in range(0, len(ids), 2048):
            piece = ids[start : start + 2048]
            expected[r[0], start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    found = defaultdict(int)
    for r in got:
        found[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    assert found == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_groups_have_their_own_sequences_and_little_padding(spark):
    rows = [(i, words(i, 40 + i * 7 % 900), None, None, None) for i in range(400)]
    got = packed(spark, rows, group_docs=100)
    used = defaultdict(int)
    for r in got:
        used[r.sequence_id] += r.length
    assert len({s >> 32 for s in used}) == 4
    assert sum(2048 - u for u in used.values()) < 0.05 * sum(used.values())


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA), PATH, PATTERN).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit(lengths):
    room, expected = [], []
    for n in lengths:
        at = next((k for k, r in enumerate(room) if r >= n), len(room))
        if at == len(room):
            room.append(50)
        expected.append((at, 50 - room[at]))
        room[at] -= n
    assert list(zip(*first_fit(lengths, 50))) == expected


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aZ é'sß  \n\t0912.,!<|endoftext|>"), st.characters(codec="utf-8")), max_size=60))
def test_encoder_gives_the_ids_of_tokenizers(text):
    encoder = _encoder()
    raw = text.encode()
    plain = not any(b > 0xC8 or b < 9 or 13 < b < 32 for b in raw)
    assert encoder.ids(text, plain) == encoder._exact.encode(text, add_special_tokens=False).ids


def _encoder(kept=[]):  # noqa: B006
    if not kept:
        with open(PATH, encoding="utf-8") as file:
            kept.append(Encoder(file.read(), PATTERN))
    return kept[0]
