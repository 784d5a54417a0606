"""Packing of tokenised documents into sequences: first-fit decreasing in randomised groups."""

from __future__ import annotations

import json
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import saved, slices
from .words import text_bytes

SEQUENCE = 2048
END = 1
#: Documents of a group, about; a group is packed by one task.
GROUP_DOCS = 4096


def _byte_of_sign() -> dict[str, int]:
    """How a byte-level vocabulary writes bytes: printable Latin-1 stands for itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of a byte-level BPE given as a tokenizers file, without special tokens being added.

    Plain Latin text goes through tiktoken with the same merges, which gives the same ids several times
    faster; any other text, and text with the name of a special token, goes through tokenizers itself.
    """

    def __init__(self, definition: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        parsed, byte = json.loads(definition), _byte_of_sign()
        self._special = [t["content"] for t in parsed["added_tokens"]]
        ranks = {bytes(byte[c] for c in token): i for token, i in parsed["model"]["vocab"].items() if token not in self._special}
        self._fast = tiktoken.Encoding("same-merges", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._exact = Tokenizer.from_str(definition)

    def ids(self, text: str, plain: bool) -> list[int]:
        if plain and not any(s in text for s in self._special):
            return self._fast.encode_ordinary(text)
        return self._exact.encode(text, add_special_tokens=False).ids


def _encoder(definition: str, pattern: str) -> Encoder:
    """One encoder for each Python worker: tasks are unpickled anew, so it is kept with a module that stays."""
    import tiktoken

    kept = vars(tiktoken).setdefault("_encoders_by_definition", {})
    key = hash((definition, pattern))
    if key not in kept:
        kept[key] = Encoder(definition, pattern)
    return kept[key]


def pieces_of(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE) -> DataFrame:
    """(``id_col``, salt, start, length, ids_crc32, doc_tokens): each document's ids, END added, cut every ``size``."""
    # About 2 MB, whatever the data; the executors need no file.
    with open(tokenizer_path, encoding="utf-8") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shipped.value, pattern)
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            odd = (data > 0xC8) | (data < 9) | ((data > 13) & (data < 32))
            odd = np.diff(np.concatenate(([0], np.cumsum(odd)))[offsets])
            rows, numbers = [], []
            for i, text in enumerate(batch.column("text")):
                ids = encoder.ids(text.as_py() or "", not odd[i])
                ids.append(END)
                raw, n = np.array(ids, "<u4"), len(ids)
                for start in range(0, n, size):
                    piece = raw[start : start + size]
                    rows.append(i)
                    numbers.append((start, len(piece), crc32(piece.tobytes()), n))
            columns = np.array(numbers, np.int64).reshape(-1, 4).T
            owner = batch.select(["packed_id", "salt"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*owner.columns, *map(pa.array, columns)], ["packed_id", "salt", "start", "length", "ids_crc32", "doc_tokens"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("packed_id"), F.xxhash64(F.col(id_col), text).alias("salt"), text.alias("text"))
    kind = dict(rows.dtypes)["packed_id"]
    return rows.mapInArrow(run, f"packed_id {kind}, salt long, start long, length long, ids_crc32 long, doc_tokens long")


def first_fit(lengths: list[int], size: int = SEQUENCE) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, in the order given: the first bin with room, by a tournament of capacities.

    Each inner node of the tree holds the larger capacity of the two below it, so the first bin with room is
    found by going down, to the left wherever that side has room.
    """
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    room = [size] * (2 * leaves)
    bins, offsets = [], []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(size - room[node])
        room[node] -= length
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Sequences of at most ``size`` tokens: one row per piece of a document.

    Returns ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id and offset. Whole sequences that a
    document fills stand alone; its rest is packed with others of its group, longest first. Groups are dealt
    by a hash of id and text, so they are random and alike, and a repeated id or text does not gather
    in one. Null and empty texts are their end token. Rows that repeat id and text are packed each.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    pieces = saved(pieces_of(docs, tokenizer_path, pattern, id_col, text_col, size), "pieces")
    groups = max(1, -(-pieces.where("start = 0").count() // group_docs))
    kind = dict(pieces.dtypes)["packed_id"]

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("salt", "ascending"), ("packed_id", "ascending"), ("start", "ascending")])
        bins, offsets = first_fit(group["length"].to_pylist(), size)
        number = np.array(bins, np.int64) + (key[0].as_py() << 32)
        kept = group.select(["packed_id", "start", "length", "ids_crc32", "doc_tokens"])
        return kept.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offsets, pa.int64()))

    packed = (
        pieces.withColumn("group", F.pmod(F.xxhash64("salt"), F.lit(groups)))
        .groupBy("group")
        .applyInArrow(run, f"packed_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    )
    return packed.withColumnRenamed("packed_id", id_col)
