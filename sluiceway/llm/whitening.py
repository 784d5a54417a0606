"""PCA whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation, its products distributed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import saved

COMPONENTS, SCALE = 4, 256
#: Rows of a block.
BLOCK = 4096
#: Directions that carry less than this part of the largest deviation count as none.
TINY = 1e-9
#: Steps at most: whole up to so many dimensions, so that equal eigenvalues are all found.
MAX_STEPS = 256
_LONG = (1 << 63) - 1


def _whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, x): the usable rows, their entries as whole numbers; shorter vectors are filled up with zeros."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    usable = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & usable)
    return rows.select("id", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _fit_blocks(rows: DataFrame, d: int) -> DataFrame:
    """Each distinct vector once, many to a block, and the block's exact sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = _matrix(batch.column("x").slice(at, BLOCK), d)
                sums = list(map(str, x.astype(object).sum(axis=0))) if np.abs(x.astype(float)).max(initial=0) > 2**40 else list(map(str, x.sum(axis=0).tolist()))
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([len(x)], pa.int64()), pa.array([sums], pa.list_(pa.string()))], ["block", "n", "sums"])

    return saved(rows.select("x").distinct().mapInArrow(run, "block binary, n long, sums array<string>"), "blocks")


def _sums(blocks: DataFrame, part, size: int) -> np.ndarray:
    """The sum over all blocks of ``part(x)``, an array of at most ``size`` numbers; it is summed up within each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for block in batch.column("block"):
                values = part(np.frombuffer(block.as_py(), np.int64))
                total[: len(values)] += values
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["part"])

    parts = blocks.select("block").mapInArrow(run, "part array<double>")
    return np.array(parts.agg(*[F.sum(F.col("part")[k]).alias(f"s{k}") for k in range(size)]).first(), float)


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def _bidiagonal(product, d: int, steps: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Golub-Kahan-Lanczos: right vectors V and the upper bidiagonal B with X V = U B.

    The left vectors have a number for each row. They are never stored: each is X w for a short w, which is kept
    instead. ``product(ws)`` gives, for u = X w of the last w, its dot products with the X w of all w and X'u, in one
    pass. New left vectors are made orthogonal to all earlier ones twice, by the X'u of these and by the
    dot products of the pass; right vectors are short and made so directly.
    """
    rng = np.random.default_rng(seed)
    right, ws, backs = [], [], []
    b = np.zeros((steps, steps))
    v, beta, largest = rng.normal(size=d), 0.0, 0.0
    for k in range(steps):
        v = _orthogonal(v, right)
        right.append(v / np.linalg.norm(v))
        w = right[k] - (beta * ws[k - 1] if k else 0)
        for other, back in zip(ws, backs):
            w = w - (back @ w) * other
        dots, back = product([*ws, w])
        for c, other, other_back in zip(dots[:-1], ws, backs):
            w, back = w - c * other, back - c * other_back
        alpha = np.sqrt(max(0.0, dots[-1] - dots[:-1] @ dots[:-1]))
        if k:
            b[k - 1, k] = beta
        largest = max(largest, alpha, beta)
        if alpha <= TINY * largest or alpha == 0:
            # The rows do not reach this direction: nothing is left of it but what earlier ones explain.
            ws.append(np.zeros(d))
            backs.append(np.zeros(d))
            v, beta = rng.normal(size=d), 0.0
            continue
        b[k, k] = alpha
        ws.append(w / alpha)
        backs.append(back / alpha)
        v = _orthogonal(backs[k] - alpha * right[k], right)
        beta = np.linalg.norm(v)
        if beta <= TINY * largest:
            # All that the first vector leads to is found; equal eigenvalues need another one.
            v, beta = rng.normal(size=d), 0.0
    return np.array(right).T, b


def _exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S)^2 for each row; None where it does not fit a long."""
    reach = float(np.abs(x.astype(float)).max(initial=0)) * n + max(map(abs, sums), default=0)
    if reach * reach * x.shape[1] < 2**62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return [e if e <= _LONG else None for e in exact]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n, from whole numbers where they are exact."""
    s = np.array(sums, object)
    whole, rest = np.array(s // n, float), np.array(s % n, float) / n
    return (x - whole) - rest


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, max_steps: int = MAX_STEPS, seed: int = 13
) -> DataFrame:
    """The leading principal components of each vector, whitened: one row for each row of ``vectors`` and component.

    Returns ``id_col``, component (from 1), n, deviation, whitened, explained and identity_error. Entries are taken
    as whole numbers, floor(``scale`` * entry). n, their sums S and every covariance count each distinct vector once.
    deviation is the exact sum of (n x - S)^2, null where a long does not hold it; whitened is x - S/n on the component
    over its standard deviation; explained is the component's part of all variance; identity_error is how far the
    covariance of whitened is from the identity, at most.

    Null vectors and those with null or non-finite entries get no row. Shorter vectors are filled up with zeros.
    Directions without variance are no components, so one distinct vector, or none, gives no rows. A null or repeated id
    keeps its rows. Entries beyond a long are taken at its end. Other columns are ignored, whatever their names.

    Each step is one pass over the distinct vectors with one row of sums per task; the driver holds short vectors only.
    """
    rows = _whole_numbers(vectors, id_col, vector_col, scale)
    d = rows.agg(F.max(F.size("x"))).first()[0] or 0
    kind = dict(vectors.dtypes)[id_col]
    schema = f"`id` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = rows.select("id", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("x"))).alias("x"))
    blocks = _fit_blocks(rows, d)
    sums_of = blocks.select(F.posexplode("sums").alias("place", "part")).groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"))
    # One number for each dimension.
    sums = [int(s) for _, s in sorted(map(tuple, sums_of.collect()))]
    n = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    axes, values, explained, error = np.zeros((d, 0)), np.zeros(0), np.zeros(0), 0.0
    if n > 1 and d:
        steps = min(d, n, max_steps)
        width = steps + d

        def centred(block: np.ndarray) -> np.ndarray:
            return _centred(block.reshape(-1, d), n, sums)

        def product(ws: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            w = np.array(ws).T

            def part(block: np.ndarray) -> np.ndarray:
                x = centred(block)
                left = x @ w
                return np.concatenate([x.T @ left[:, -1], left.T @ left[:, -1]])

            total = _sums(blocks, part, width)
            return total[d : d + len(ws)], total[:d]

        right, b = _bidiagonal(product, d, steps, seed)
        _, deviations, turned = np.linalg.svd(b)
        k = min(components, int((deviations > TINY * deviations[0]).sum()) if deviations[0] > 0 else 0)
        axes, values = right @ turned[:k].T, deviations[:k] ** 2 / n
        scaled = axes / np.sqrt(values)

        def spread(block: np.ndarray) -> np.ndarray:
            x = centred(block)
            return np.concatenate([[np.einsum("ij,ij->", x, x)], (x @ scaled).sum(axis=0)])

        total = _sums(blocks, spread, width)
        explained, mean = values * n / total[0] if k else values, total[1 : k + 1] / n

        def covariance(block: np.ndarray) -> np.ndarray:
            y = centred(block) @ scaled - mean
            return (y.T @ y).ravel()

        if k:
            error = float(np.abs(_sums(blocks, covariance, k * k).reshape(k, k) / n - np.eye(k)).max())
    k = axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows if k else 0, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(part.column("x"), d)
                whitened = _centred(x, n, sums) @ (axes / np.sqrt(values))
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                        pa.array([e for e in _exact_deviation(x, n, sums) for _ in range(k)], pa.int64()), pa.array(whitened.ravel()),
                        pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
