"""Language identification by the nearest of several centroids of each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import remainder, slices
from .words import text_bytes

#: Documents that the model is fitted on, of each language at most.
FIT_ROWS = 1000
FOLDS, HELD_OUT = 3, 1
#: Hashed byte n-grams of these lengths, in so many dimensions (a power of two).
GRAMS, DIMENSIONS = (1, 2, 3), 1 << 12
CENTROIDS = 4
UNKNOWN = "und"
_ROWS = 512


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes with ASCII and Latin-1 capitals made small and everything but letters and bytes beyond ASCII a space."""
    small = np.full(256, 32, np.uint8)
    small[97:123] = small[65:91] = np.arange(97, 123)
    small[128:] = np.arange(128, 256)
    out = small[data]
    out[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0x9F)] += 32
    return out


def _counts(texts: pa.Array, grams: tuple[int, ...] = GRAMS, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts of each text, and whether it has a letter."""
    data, offsets = text_bytes(texts)
    data = _letters(data)
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    out = np.zeros(n * dimensions)
    code = np.zeros(len(data), np.uint64)
    for k in range(max(grams)):
        if k:
            code = code[: len(data) - k]
        code = code * np.uint64(256) + data[k:]
        if k + 1 not in grams or not len(code):
            continue
        inside = text[: len(code)] == text[k:]
        inside &= code != np.uint64(int("20" * (k + 1), 16))
        slot = ((code + np.uint64((k + 1) << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - dimensions.bit_length() + 1)
        out += np.bincount(text[: len(code)][inside] * dimensions + slot[inside].astype(np.int64), minlength=len(out))
    plain = np.zeros(n, bool)
    plain[text[(data >= 97) & (data < 123)]] = True
    for i in np.flatnonzero(~plain):
        plain[i] = any(c.isalpha() for c in texts[i].as_py() or "")
    return out.reshape(n, dimensions), plain


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf)


def _clustered(x: np.ndarray, k: int = CENTROIDS, rounds: int = 10) -> np.ndarray:
    """Centroids of spherical k-means; the first is the mean, each further one the vector farthest from those before."""
    centroids = _unit(x.mean(0, keepdims=True))
    while len(centroids) < min(k, len(x)):
        centroids = np.vstack([centroids, x[(x @ centroids.T).max(1).argmin()]])
    for _ in range(rounds):
        nearest = (x @ centroids.T).argmax(1)
        centroids = np.vstack([_unit(x[nearest == c].mean(0, keepdims=True)) if (nearest == c).any() else centroids[c : c + 1] for c in range(len(centroids))])
    return centroids


def fit_rows(known: DataFrame, rows: int) -> DataFrame:
    """(lang, fit_id, text) of the ``rows`` texts of each language whose ids have the smallest hashes, in one plan.

    Rows equal in all three count once. The rows of a language are first cut within ranges of the hash's last bits, so that
    no task has to see a whole language.
    """
    keys = ["lang", "fit_id", "digest"]
    narrow = known.select("lang", "fit_id", F.xxhash64("text").alias("digest")).distinct().withColumn("place", F.xxhash64("fit_id"))
    for part in (["lang", F.pmod("place", F.lit(256))], ["lang"]):
        order = Window.partitionBy(*part).orderBy("place", "fit_id", "digest")
        narrow = narrow.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows).drop("rank")
    # At most ``rows`` keys of each language: that is the bound of the broadcast.
    return known.withColumn("digest", F.xxhash64("text")).join(F.broadcast(narrow.select(*keys)), keys).dropDuplicates(keys).select("lang", "fit_id", "text")


def document_frequencies(known: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts have a letter, and how many of these have an n-gram in each dimension, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in slices(batches, "text", rows=_ROWS):
            counts, letters = _counts(batch.column("text"))
            total[:-1] += (counts[letters] > 0).sum(0)
            total[-1] += letters.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["slot", "n"])

    total = np.zeros(DIMENSIONS + 1, np.int64)
    for slot, n in known.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():
        total[slot] = n
    return int(total[-1]), total[:-1]


def fit_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = FIT_ROWS) -> dict | None:
    """Centroids of at most ``rows`` documents of each language, with document frequencies of all rows learned from.

    Rows without id, language or text, and those of the held-out fold, are not learned from; without any row the
    result is None. The sample is that of :func:`fit_rows`.
    """
    known = docs.select(F.col(id_col).alias("fit_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = known.where("fit_id is not null and lang is not null and text is not null").where(remainder(F.col("fit_id"), FOLDS) != HELD_OUT)
    found = fit_rows(known, rows).toArrow().sort_by([("lang", "ascending"), ("fit_id", "ascending"), ("text", "ascending")])
    counts, langs = [], []
    for batch in slices(iter(found.combine_chunks().to_batches()), "text", rows=_ROWS):
        count, letters = _counts(batch.column("text"))
        counts.append(count[letters].astype(np.float32))
        langs += [x for x, y in zip(batch.column("lang").to_pylist(), letters) if y]
    if not langs:
        return None
    n, holding = document_frequencies(known)
    idf = (np.log((1 + n) / (1 + holding)) + 1).astype(np.float32)
    x, langs = _vectors(np.concatenate(counts), idf), np.array(langs)
    names = sorted(set(langs))
    clusters = [_clustered(x[langs == name]) for name in names]
    return {"names": [n for n, c in zip(names, clusters) for _ in range(len(c))], "centroids": np.concatenate(clusters), "idf": idf}


def predict_language(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", max_distance: float = 1.0) -> DataFrame:
    """(``id_col``, held_out, lang_pred, score) for every row: the language of the nearest centroid by cosine.

    score is the cosine. A text is rejected as ``und`` where the distance, 1 - cosine, exceeds ``max_distance``;
    a text without any letter has no direction, so its distance is infinite. By default nothing else is
    rejected. Null and empty texts are ``und`` with score 0, as is everything without a model. Only the text is
    looked at; other columns are ignored, whatever their names.
    """
    # Of a fixed size for each language.
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in slices(batches, "text", rows=_ROWS):
            langs, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if model is not None:
                counts, letters = _counts(batch.column("text"))
                cosines = _vectors(counts, model["idf"]) @ model["centroids"].T
                nearest = cosines.argmax(1)
                best = np.clip(cosines[np.arange(len(nearest)), nearest], 0, 1)
                kept = letters & (1 - best <= max_distance)
                langs = [model["names"][c] if ok else UNKNOWN for c, ok in zip(nearest, kept)]
                scores = np.where(kept, best, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("scored_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["scored_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("scored_id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(run, f"scored_id {dict(rows.dtypes)['scored_id']}, lang_pred string, score double")
    return scored.select(F.col("scored_id").alias(id_col), (remainder(F.col("scored_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
