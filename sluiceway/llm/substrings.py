"""Removal of passages that occur earlier in the corpus, by Rabin-Karp hashes of every window of words."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import gathered, packed, unpacked
from .shared import shuffle_partitions, slices
from .words import mixed, sliding_minimum, text_bytes, whole_windows, window_hashes, word_hashes, word_spans

WINDOW = 20
#: Words of an anchor: each window is represented by the least hash of its anchors.
ANCHOR = 8
_DOCS_PER_BUCKET = 2048
_RUN = {"id": "<i8", "key": "<i8", "start": "<i4", "length": "<i4"}
_PLACE = {**_RUN, "known": "|b1"}


def _hashed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the first word of each text."""
    starts, ends, first = word_spans(*(spans := text_bytes(batch.column("text"))))
    return word_hashes(spans[0], starts, ends), first


def _owner(batch: pa.RecordBatch, first: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Row and place in the row of the words ``at``."""
    text = np.searchsorted(first, at, side="right") - 1
    ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sub_id", "sub_key"))
    return {"id": ids[text], "key": keys[text], "start": (at - first[text]).astype(np.int32)}


def _runs(batch: pa.RecordBatch, window: int, anchor: int) -> dict[str, np.ndarray] | None:
    """The windows of all texts, in runs that have the same least anchor, at the same place."""
    hashes, first = _hashed(batch)
    if len(hashes) < window:
        return None
    anchors = window_hashes(hashes, anchor)
    least = sliding_minimum(anchors, window - anchor + 1)
    inside = whole_windows(first, window)
    # Of equal anchors the last counts, so an anchor that comes in as the least begins a run.
    begins = anchors[window - anchor :] == least
    begins[1:] |= (least[1:] != least[:-1]) | ~inside[:-1]
    begins[0] = True
    edges = np.flatnonzero(begins | ~inside)
    lengths = np.diff(np.append(edges, len(inside))).astype(np.int32)
    real = inside[edges]
    at = edges[real]
    return {"hash": least[at], **_owner(batch, first, at), "length": lengths[real]}


def _windows(batch: pa.RecordBatch, window: int) -> dict[str, np.ndarray] | None:
    """The windows of the texts that lie in the runs given with them."""
    hashes, first = _hashed(batch)
    if len(hashes) < window:
        return None
    wanted = np.zeros(len(hashes) - window + 2, np.int64)
    for begin, runs in zip(first.tolist(), batch.column("runs").to_pylist()):
        places = np.frombuffer(runs, "<i4").reshape(-1, 2)
        np.add.at(wanted, begin + places[:, 0], 1)
        np.add.at(wanted, begin + places[:, 0] + places[:, 1], -1)
    at = np.flatnonzero(np.cumsum(wanted[:-1]) > 0)
    return {"hash": window_hashes(hashes, window)[at], **_owner(batch, first, at), "length": np.ones(len(at), np.int32)}


def _groups(rows: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Rows in order of hash and place, without repeated places; where a hash begins; each row's first row."""
    fewer = ~rows["many"] if "many" in rows else np.zeros(len(rows["hash"]), bool)
    order = np.lexsort((fewer, rows["start"], rows["key"], rows["id"], rows["hash"]))
    rows = {k: v[order] for k, v in rows.items()}
    same = np.ones(len(order), bool)
    for k in ("hash", "id", "key", "start"):
        same[1:] &= rows[k][1:] == rows[k][:-1]
    same[:1] = False
    rows = {k: v[~same] for k, v in rows.items()}
    begins = np.ones(len(rows["hash"]), bool)
    begins[1:] = rows["hash"][1:] != rows["hash"][:-1]
    return rows, begins, np.maximum.accumulate(np.where(begins, np.arange(len(begins)), 0))


def _sent(rows: dict[str, np.ndarray], mark_first: bool, buckets: int) -> pa.RecordBatch:
    """Of each hash that a task has gathered one row goes to the hash's bucket; the others are known already.

    That is what keeps a passage of a third of all rows from filling a bucket: it gets one row of each task.
    Known rows take any bucket, that of their document, and only pass through it.
    """
    rows, begins, first = _groups(rows)
    several = np.bincount(first, minlength=len(first))[first] > 1
    rows["known"] = ~begins
    rows["many"] = several & mark_first
    bucket = np.where(begins, rows["hash"], mixed(rows["key"].view(np.uint64))) % np.uint64(buckets)
    return packed("bucket", bucket.astype(np.int64), {k: np.ascontiguousarray(v) for k, v in rows.items()})


def _per_text(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """(sub_id, sub_key, runs): start and length of the rows of each text, as bytes."""
    order = np.lexsort((rows["start"], rows["key"], rows["id"]))
    ids, keys = rows["id"][order], rows["key"][order]
    places = np.stack([rows["start"][order], rows["length"][order]], axis=1)
    begins = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])))) if len(ids) else []
    ends = np.append(begins[1:], len(ids)) if len(ids) else []
    runs = [places[i:j].tobytes() for i, j in zip(begins, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[begins] if len(ids) else [], pa.int64()), pa.array(keys[begins] if len(ids) else [], pa.int64()), pa.array(runs, pa.binary())],
        ["sub_id", "sub_key", "runs"],
    )


def _counted(sent: DataFrame, mark_first: bool, buckets: int) -> DataFrame:
    """Bucket by bucket, the rows whose hash has several (``mark_first``), or has one at an earlier place.

    They go back as blocks for each bucket of documents, and are dealt out to the documents there: rows for
    each document and bucket of hashes would be as many as there are windows.
    """

    def count(bucket: pa.Table) -> pa.Table:
        rows = unpacked(bucket, {"hash": "<u8", **_PLACE, "many": "|b1"})
        passed = {k: v[rows["known"]] for k, v in rows.items()}
        rows, begins, first = _groups({k: v[~rows["known"]] for k, v in rows.items()})
        if mark_first:
            found = np.bincount(first, weights=1 + rows["many"], minlength=len(first))[first] > 1
        else:
            found = ~begins
        found = {k: np.concatenate([passed[k], rows[k][found]]) for k in _RUN}
        owner = (mixed(found["id"].view(np.uint64)) ^ mixed(found["key"].view(np.uint64))) % np.uint64(buckets)
        return pa.Table.from_batches([packed("owner", owner.astype(np.int64), found)])

    def dealt(owner: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_per_text(unpacked(owner, _RUN))])

    found = sent.groupBy("bucket").applyInArrow(count, "owner long, id binary, key binary, start binary, length binary")
    return found.groupBy("owner").applyInArrow(dealt, "sub_id long, sub_key long, runs binary")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), window: int = WINDOW
) -> DataFrame:
    """Texts without the words of any window that starts earlier in the corpus too.

    Returns ``id_col``, n_words, n_removed, kept_text (kept words joined by a space) and the ``carry`` columns,
    one row per row of ``docs``. A window is ``window`` consecutive words; it is removed if the same words also
    start in a row with a smaller id, or earlier in the same row. Overlapping windows merge into maximal
    intervals. Windows are judged on the input. The hash of every window is computed, in two rounds: first
    each window stands for its least anchor of ANCHOR words, and only windows whose anchor occurs elsewhere
    are then counted by their own hash. A repeated window repeats its anchor, so none is lost.

    Null texts have no words; texts shorter than a window keep all. A null id counts as the smallest. Rows
    with one id and different texts are ordered by a hash of the text; rows that repeat both id and text are
    one document given twice and get the same result. Other columns are ignored, whatever their names.
    """
    anchor = min(ANCHOR, window)
    if clash := {id_col, "n_words", "n_removed", "kept_text"} & set(carry):
        raise ValueError(f"these columns cannot be carried: {sorted(clash)}")
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("sub_id"),
        F.xxhash64(text).alias("sub_key"),
        F.col(id_col).alias("sub_doc"),
        text.alias("text"),
        F.struct(F.lit(0).alias("none"), *[F.col(c) for c in carry]).alias("sub_carry"),
    )
    buckets = max(shuffle_partitions(docs.sparkSession), docs.count() // _DOCS_PER_BUCKET)
    places = "bucket long, hash binary, id binary, key binary, start binary, length binary, known binary, many binary"

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (r for b in slices(batches, "text") if (r := _runs(b, window, anchor)))
        for part in gathered(found):
            yield _sent(part, True, buckets)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (r for b in slices(batches, "text") if (r := _windows(b, window)))
        for part in gathered(found):
            yield _sent(part, False, buckets)

    kinds = dict(docs.select(F.col(id_col).alias("sub_doc"), F.struct(F.lit(0).alias("none"), *[F.col(c) for c in carry]).alias("sub_carry")).dtypes)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, removed, texts = [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs").to_pylist()):
                words = (text.as_py() or "").encode().split()
                counts.append(len(words))
                if runs:
                    starts = np.frombuffer(runs, "<i4").reshape(-1, 2)[:, 0]
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, starts, 1)
                    np.add.at(depth, starts + window, -1)
                    words = list(compress(words, (np.cumsum(depth[:-1]) == 0).tolist()))
                removed.append(counts[-1] - len(words))
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("sub_doc"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), batch.column("sub_carry")],
                ["sub_doc", "n_words", "n_removed", "kept_text", "sub_carry"],
            )

    keys = ["sub_id", "sub_key"]
    repeated = _counted(rows.select(*keys, "text").mapInArrow(anchors, places), True, buckets)
    # Both joins shuffle the same rows by the same keys, so Spark moves the texts once.
    windows = rows.join(repeated, keys, "left").where("runs is not null").mapInArrow(candidates, places)
    result = rows.join(_counted(windows, False, buckets), keys, "left").mapInArrow(
        kept, f"sub_doc {kinds['sub_doc']}, n_words long, n_removed long, kept_text string, sub_carry {kinds['sub_carry']}"
    )
    return result.select(F.col("sub_doc").alias(id_col), "n_words", "n_removed", "kept_text", *[F.col(f"sub_carry.`{c}`").alias(c) for c in carry])
