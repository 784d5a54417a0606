"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import remainder, slices
from .words import mixed, text_bytes, word_hashes, word_spans

#: Labelled rows that the model is fitted on, of each class at most. All other figures do not depend on it.
FIT_ROWS = 2500
FOLDS = 5
THRESHOLD = 0.3
#: Slots of word vectors (words share them by hash), their length, and the non-zero entries of an index vector.
SLOTS, SIZE, NONZERO = 1 << 15, 48, 4
REACH = 2
HIDDEN = 32
#: Texts are worked on in slices of about so many bytes: a word takes up to 600 bytes while its vectors are summed.
SLICE = 1 << 18


@dataclass(frozen=True)
class QualityModel:
    """Word vectors, the network's weights, the scale of its inputs and the temperature of its output."""

    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot of each word, slot of each word's shape, and each text's first word.

    A shape tells whether the word has capitals, small letters, digits and how many other signs, how it ends,
    and whether it repeats the word before it. Shapes are words of the random index like any other.
    """
    data, offsets = text_bytes(texts)
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    kinds = np.zeros(256, np.int64)
    kinds[65:91], kinds[97:123], kinds[48:58], kinds[128:] = 1, 2, 3, 2
    kinds = kinds[data]
    # In Latin-1 letters, the second byte of a capital lies below 0x9F.
    kinds[1:][(data[:-1] == 0xC3) & (data[1:] < 0x9F)] = 1

    def count(kind: int, most: int) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(kinds == kind)))
        return np.minimum(sums[ends] - sums[starts], most)

    last = data[ends - 1].astype(np.int64)
    shape = count(1, 2) * 3 + count(2, 2)
    shape = (shape * 2 + count(3, 1)) * 4 + count(0, 3)
    shape = shape * 257 + np.where((kinds[ends - 1] == 0) & (last < 128), last, 256)
    again = np.zeros(len(hashes), np.int64)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[:-1][first[:-1] < len(hashes)]] = 0
    shape = mixed((shape * 2 + again + (1 << 40)).astype(np.uint64))
    slot = np.uint64(SLOTS)
    return (hashes % slot).astype(np.int64), (shape % slot).astype(np.int64), first


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """The index vector of each slot, from a hash of the slot: where it is not zero, and a one or minus one for each such place."""
    h = mixed(np.arange(SLOTS * NONZERO, dtype=np.uint64) + np.tile(np.arange(1, NONZERO + 1, dtype=np.uint64), SLOTS) * np.uint64(SLOTS * NONZERO))
    places = (h >> np.uint64(1)) % np.uint64(SIZE)
    return places.astype(np.int64).reshape(SLOTS, NONZERO), np.where(h & np.uint64(1), 1.0, -1.0).reshape(SLOTS, NONZERO)


def _add_context_sums(texts: pa.Array, index: tuple[np.ndarray, np.ndarray], sums: np.ndarray) -> None:
    """Add to each slot's row the index vectors of what stands within REACH of its words, themselves included; shapes see shapes."""
    places, signs = index
    flat = sums.reshape(-1)
    words, shapes, first = _tokens(texts)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for tokens in (words, shapes):
        near = [(tokens, tokens)]
        for step in range(1, REACH + 1):
            inside = text[:-step] == text[step:]
            a, b = tokens[:-step][inside], tokens[step:][inside]
            near += [(a, b), (b, a)]
        for a, b in near:
            for k in range(NONZERO):
                np.add.at(flat, a * SIZE + places[b, k], signs[b, k])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Random-indexing vectors of all slots over all whole texts, at unit length; a slot without a word has zeros.

    Each task sends one row of whole numbers for each slot that it met, which Spark sums by slot; so the result does not
    depend on how rows lie in tasks. It has SLOTS rows of SIZE numbers whatever the input.
    """
    names = [f"v{k}" for k in range(SIZE)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (places, signs), sums = _index_vectors(), np.zeros((SLOTS, SIZE), np.int64)
        for batch in slices(batches, "text", SLICE):
            _add_context_sums(batch.column("text"), (places, signs.astype(np.int64)), sums)
        met = np.flatnonzero(sums.any(axis=1))
        for at in range(0, len(met), 8192):
            part = met[at : at + 8192]
            yield pa.RecordBatch.from_arrays([pa.array(part), *map(pa.array, np.ascontiguousarray(sums[part].T))], ["slot", *names])

    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    sent = rows.mapInArrow(count, ", ".join(f"{name} long" for name in ["slot", *names]))
    found = sent.groupBy("slot").agg(*[F.sum(name).alias(name) for name in names]).toArrow()
    vectors = np.zeros((SLOTS, SIZE), np.float32)
    if found.num_rows:
        vectors[found["slot"].to_numpy()] = np.stack([found[name].to_numpy() for name in names], axis=1)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def _pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean vectors of each text's words and shapes, their lengths, and the number of words on a log scale."""
    words, shapes, first = _tokens(texts)
    counts = np.diff(first)
    out = np.zeros((len(counts), 2 * SIZE + 3))
    filled = np.flatnonzero(counts)
    for k, tokens in enumerate((words, shapes)):
        if len(filled):
            # Texts stand in a row, so an empty one has no words between its neighbours.
            sums = np.add.reduceat(vectors[tokens], first[:-1][filled], axis=0, dtype=np.float64)
            out[filled, k * SIZE : (k + 1) * SIZE] = sums / counts[filled, None]
        out[:, 2 * SIZE + k] = np.linalg.norm(out[:, k * SIZE : (k + 1) * SIZE], axis=1)
    out[:, -1] = np.log1p(counts)
    return out


def _logits(x: np.ndarray, model: QualityModel) -> np.ndarray:
    hidden = np.maximum((x - model.centre) / model.scale @ model.w1 + model.b1, 0)
    return hidden @ model.w2 + model.b2


def _probability(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def _train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, vectors: np.ndarray, epochs: int = 60, rate: float = 0.01) -> QualityModel:
    """Adam on the weighted log loss; the temperature is then fitted on a fifth of the rows that were kept out."""
    rng = np.random.default_rng(0)
    order = rng.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    centre, scale = x[used].mean(0), np.maximum(x[used].std(0), 1e-3)
    params = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    inputs = (x - centre) / scale
    for _ in range(epochs):
        rng.shuffle(used)
        for at in range(0, len(used), 64):
            rows = used[at : at + 64]
            hidden = np.maximum(inputs[rows] @ params[0] + params[1], 0)
            error = (_probability(hidden @ params[2] + params[3]) - y[rows]) * weight[rows] / weight[rows].sum()
            back = np.outer(error, params[2]) * (hidden > 0)
            step += 1
            for p, g, m, v in zip(params, (inputs[rows].T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ error, error.sum(keepdims=True)), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = QualityModel(vectors, centre, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    if len(held) == 0:
        return model
    logits, temperatures = _logits(x[held], model), np.geomspace(0.25, 16, 97)
    p = np.clip(_probability(logits[None] / temperatures[:, None]), 1e-9, 1 - 1e-9)
    loss = -(weight[held] * np.where(y[held] > 0, np.log(p), np.log(1 - p))).sum(1)
    return QualityModel(vectors, centre, scale, params[0], params[1], params[2], float(params[3][0]), float(temperatures[loss.argmin()]))


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = FIT_ROWS
) -> QualityModel | None:
    """Fit on at most ``rows`` labelled documents of each class, outside the held-out fold.

    Word vectors come from all texts of ``docs``, which takes no labels; the sample is for the network only. It is
    the rows with the smallest hashes of their ids; the classes are weighted as they occur among all labels of
    the training folds. Labels other than 0 and 1 are ignored; without any the result is None.
    """
    known = labels.select(F.col(id_col).alias("fit_id"), F.col(label_col).cast("int").alias("label")).where("fit_id is not null and label in (0, 1)")
    known = known.where(remainder(F.col("fit_id"), FOLDS) != 0)
    share = dict(known.groupBy("label").count().collect())
    if not share:
        return None
    sample = None
    for label in sorted(share):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("fit_id"), "fit_id").limit(rows)
        sample = part if sample is None else sample.unionByName(part)
    texts = docs.select(F.col(id_col).alias("fit_id"), F.col(text_col).cast("string").alias("text"))
    # At most 2 * FIT_ROWS ids: that is the bound of the broadcast.
    found = texts.join(F.broadcast(sample), "fit_id").select("fit_id", "text", "label").toArrow().sort_by([("fit_id", "ascending"), ("text", "ascending"), ("label", "ascending")])
    if found.num_rows == 0:
        return None
    pieces = [b.column("text") for b in slices(iter(found.combine_chunks().to_batches()), "text", SLICE)]
    y = found["label"].to_numpy().astype(float)
    vectors = word_vectors(docs, text_col)
    x = np.concatenate([_pooled(piece, vectors) for piece in pieces])
    weight = np.array([share[int(label)] / max(1, (y == label).sum()) for label in y])
    return _train(x, y, weight / weight.mean(), vectors)


def quality_score(spark: SparkSession, model: QualityModel | None) -> Callable[[Column], Column]:
    """A function of a text column: the probability of label 1, from Python tasks that get that column alone.

    Null texts score as empty ones, and without a model all score 0.5.
    """
    # The model has a fixed size, about 6 MB. It goes as a mapping of arrays: executors may lack this package.
    shipped = spark.sparkContext.broadcast(model and vars(model))

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shipped.value and SimpleNamespace(**shipped.value)
        for whole in texts:
            if model is None or len(whole) == 0:
                yield pa.array(np.full(len(whole), 0.5), pa.float64())
                continue
            pieces = slices(iter([pa.RecordBatch.from_arrays([whole], ["text"])]), "text", SLICE)
            scores = [_probability(_logits(_pooled(piece.column("text"), model.vectors), model) / model.temperature) for piece in pieces]
            yield pa.array(np.concatenate(scores), pa.float64())

    return score


def score_quality(docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(``id_col``, held_out, score, predicted) for every row: the probability of label 1, and whether it reaches ``threshold``.

    Only the text is scored. Null texts score as empty ones. Without a model every score is 0.5. A null id
    counts as the empty text in the fold. Other columns are ignored, whatever their names.
    """
    score = quality_score(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("scored_id"), score(F.col(text_col).cast("string")).alias("score"))
    return rows.select(
        F.col("scored_id").alias(id_col), (remainder(F.col("scored_id"), FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with the columns of ``docs``; no row is shuffled.

    Each row is judged by its own text, whatever others share its id; null texts as empty ones.
    """
    score = quality_score(docs.sparkSession, fit_quality(docs, labels))
    return docs.where(score(docs["text"].cast("string")) >= THRESHOLD)
