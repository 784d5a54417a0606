"""Near-duplicate embeddings by cosine, in tiles ordered by the first principal component."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.workspace import new_work_path

from .components import connected_components
from .shared import saved, shuffle_partitions

THRESHOLD = 0.95
#: Distinct vectors of a tile, and of a block, about. Blocks are compared so many rows at a time.
TILE, BLOCK, ROWS = 4096, 4096, 512
#: Leading components that are multiplied first.
LEADING = 24
#: Numbers of a chunk of blocks, which is written and read as one folder, at most; and chunks, if there are enough blocks.
CHUNK_VALUES, CHUNKS = 1 << 22, 32
#: Chunks that a task compares with one at a time. Numbers that a task gathers before it sends them, and takes at once.
_SPAN, _FLUSH, _SLICE = 4, 1 << 22, 1 << 20
#: Rounding of the first coordinate, of products in single and in double precision; bounds give way by so much.
_MARGIN, _SINGLE, _DOUBLE = 1e-6, 1e-5, 1e-9
#: Pairs that are tested, and kept, at once.
_PAIRS, _HELD = 1 << 15, 1 << 20


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]]:
    """Ids of some rows, and the usable vectors of each length: the rows that have them, and their components as given."""
    for batch in batches:
        step = max(1, batch.num_rows * _SLICE // max(1, len(batch.column("v").flatten())))
        for at in range(0, batch.num_rows, step):
            ids, vectors = (batch.column(c).slice(at, step) for c in ("id", "v"))
            lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = vectors.flatten()
            x = pc.fill_null(flat, pa.scalar(float("nan"), flat.type)).to_numpy(zero_copy_only=False)
            row, usable = np.repeat(np.arange(len(ids)), lengths), np.zeros(len(ids), bool)
            usable[row[x != 0]] = True
            usable[row[~np.isfinite(x)]] = False
            usable &= ids.is_valid().to_numpy(zero_copy_only=False)
            begins, found = np.cumsum(lengths) - lengths, []
            for length in np.unique(lengths[usable]).tolist():
                rows = np.flatnonzero(usable & (lengths == length))
                found.append((rows, x[begins[rows][:, None] + np.arange(length)].astype(np.float64)))
            yield ids, found


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows by their largest component, so that squares neither vanish nor overflow."""
    return x / np.abs(x).max(axis=1, keepdims=True) + 0.0


def _unit(w: np.ndarray) -> np.ndarray:
    """Added up component by component, so that equal rows give equal bits wherever they stand."""
    squares = np.zeros(len(w))
    for column in w.T:
        squares += column * column
    return w / np.sqrt(squares)[:, None]


def _first(w: np.ndarray, turn: np.ndarray | None) -> np.ndarray:
    """The first coordinate of the unit vectors; equal rows give equal bits, as in :func:`_unit`."""
    unit = _unit(w)
    if turn is None:
        return unit[:, 0].copy()
    out = np.zeros(len(w))
    for column, x in zip(unit.T, turn[:, 0].tolist()):
        out += column * x
    return out


def _keys(w: np.ndarray) -> np.ndarray:
    """128 bits that know each row."""
    import xxhash

    digest, size, data = xxhash.xxh3_128_digest, w.shape[1] * 8, memoryview(np.ascontiguousarray(w)).cast("B")
    return np.frombuffer(b"".join([digest(data[at : at + size]) for at in range(0, len(data), size)]), np.int64).reshape(-1, 2)


def principal_axes(rows: DataFrame, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each of ``lengths`` the axes of the covariance of the unit vectors of ``v``, the largest variance first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for _, found in _matrices(batches):
            for _, x in found:
                if x.shape[1] in lengths:
                    x = np.hstack([np.ones((len(x), 1)), _unit(_scaled(x))])
                    totals[x.shape[1] - 1] = x.T @ x + totals.get(x.shape[1] - 1, 0)
        for length, total in totals.items():
            n = total.size
            columns = [pa.array(np.full(n, length)), pa.array(np.arange(n)), pa.array(total.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["length", "place", "value"])

    parts = rows.mapInArrow(moments, "length long, place long, value double")
    # One number for each pair of dimensions of a length.
    totals: dict[int, np.ndarray] = {}
    for length, place, value in parts.groupBy("length", "place").agg(F.sum("value")).collect():
        totals.setdefault(length, np.zeros((length + 1) ** 2))[place] = value
    axes = {}
    for length, flat in totals.items():
        total = flat.reshape(length + 1, length + 1)
        mean = total[0, 1:] / total[0, 0]
        values, found = np.linalg.eigh(total[1:, 1:] / total[0, 0] - np.outer(mean, mean))
        axes[length] = found[:, np.argsort(-values)]
    return axes


class _Block:
    """Vectors of a block, as they are compared."""

    def __init__(self, number: int, node: np.ndarray, keys: np.ndarray, copies: np.ndarray, w: np.ndarray, turn: np.ndarray | None) -> None:
        self.number, self.node, self.keys, self.copies, self.w = number, node, keys, copies, w
        self.norm = np.sqrt(np.einsum("ij,ij->i", w, w))
        lead = w[:, :LEADING] if turn is None else w @ turn[:, :LEADING]
        lead = lead / self.norm[:, None]
        rest = np.sqrt(np.maximum(1 - (lead**2).sum(1, keepdims=True), 0)) if w.shape[1] > LEADING else np.zeros((len(w), 1))
        #: What the components beyond the leading ones can add to a product is at most the product of their norms.
        self.lead = np.hstack([lead, rest]).astype(np.float32)


def _exact(a: _Block, b: _Block, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the cosine of rows i and j, as given, is >= threshold."""
    out = np.empty(len(i), bool)
    for at in range(0, len(i), _PAIRS):
        x, y = a.w[i[at : at + _PAIRS]], b.w[j[at : at + _PAIRS]]
        cosine = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
        out[at : at + _PAIRS] = cosine >= threshold
    return out


def _near(a: _Block, b: _Block, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with cosine >= threshold. Pairs whose leading components cannot reach it are dropped by one
    product in single precision, the others are tested on the vectors as given; where most are left, only those are
    that a product in double precision does not decide."""
    for at in range(0, len(a.w), ROWS):
        product = a.lead[at : at + ROWS] @ b.lead.T
        hits = np.flatnonzero(product.ravel() >= np.float32(threshold - _SINGLE))
        if len(hits) > product.size // 16:
            cosine = ((a.w[at : at + ROWS] / a.norm[at : at + ROWS, None]) @ (b.w / b.norm[:, None]).T).ravel()
            hits = np.flatnonzero(cosine >= threshold - _DOUBLE)
            sure = cosine[hits] >= threshold + _DOUBLE
        else:
            sure = np.zeros(len(hits), bool)
        i, j = hits // len(b.w) + at, hits % len(b.w)
        if a is b:
            once = i < j
            i, j, sure = i[once], j[once], sure[once]
        unsure = np.flatnonzero(~sure)
        sure[unsure] = _exact(a, b, i[unsure], j[unsure], threshold)
        if sure.any():
            yield i[sure], j[sure]


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least node reachable from each of ``n`` nodes over the edges (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linked(a: _Block, b: _Block, threshold: float) -> tuple[np.ndarray, ...] | None:
    """Nodes and keys of the vectors that have links between two blocks, how many, and the first node each is joined with."""
    offset = 0 if a is b else len(a.node)
    node, keys, copies = (getattr(a, c) if a is b else np.concatenate([getattr(a, c), getattr(b, c)]) for c in ("node", "keys", "copies"))
    links, label, held, size = np.zeros(len(node), np.int64), np.arange(len(node)), [], 0

    def joined() -> np.ndarray:
        i, j = (np.concatenate(x) for x in zip(*held))
        return _labels(len(node), np.concatenate([np.arange(len(node)), i]), np.concatenate([label, j]))

    for i, j in _near(a, b, threshold):
        j = j + offset
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        held.append((i, j))
        size += len(i)
        if size > _HELD:
            label, held, size = joined(), [], 0
    if held:
        label = joined()
    at = np.flatnonzero(links)
    return (node[at], keys[at, 0], keys[at, 1], links[at], node[label[at]]) if len(at) else None


def _merged(length: int, meta: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of (key, key, block, copies) and their vectors, equal ones once, in the order of block and keys."""
    order = np.lexsort((meta[:, 1], meta[:, 0], meta[:, 2]))
    meta, given = meta[order], given.reshape(-1, length)[order]
    begins = np.flatnonzero(np.append(True, (meta[1:, :3] != meta[:-1, :3]).any(axis=1)))
    copies = np.add.reduceat(meta[:, 3], begins)
    return np.column_stack([meta[begins, :3], copies]), given[begins]


def _read(folder: str, chunk: int, kind: str, axes: dict[int, np.ndarray]) -> list[_Block]:
    """The blocks of a chunk, from the files that hold it; nodes are numbered alike by all who read it."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    files, root = fs.FileSystem.from_uri(f"{folder}/chunk={chunk}")
    parts: dict[int, list[tuple[bytes, bytes]]] = {}
    for info in files.get_file_info(fs.FileSelector(root)):
        if info.type == fs.FileType.File and info.base_name.endswith(".parquet"):
            with files.open_input_file(info.path) as source:
                rows = pq.ParquetFile(source).read()
            for length, meta, given in zip(*(rows[c].to_pylist() for c in ("length", "meta", "given"))):
                parts.setdefault(length, []).append((meta, given))
    blocks, base = [], chunk << 32
    for length, held in sorted(parts.items()):
        meta = np.frombuffer(b"".join([m for m, _ in held]), np.int64).reshape(-1, 4)
        meta, given = _merged(length, meta, np.frombuffer(b"".join([g for _, g in held]), kind))
        w = _scaled(given.astype(np.float64))
        cuts = np.flatnonzero(np.append(True, meta[1:, 2] != meta[:-1, 2])).tolist()
        for i, j in zip(cuts, [*cuts[1:], len(meta)]):
            blocks.append(_Block(int(meta[i, 2]), base + np.arange(i, j), meta[i:j, :2], meta[i:j, 3], w[i:j], axes.get(length)))
        base += len(meta)
    return blocks


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row for each row of ``vectors``: ``id_col``, n_links, component_id and kept.

    n_links counts the other rows with cosine >= ``threshold``; component_id is the smallest id reachable over
    such links, the row's own included, and kept marks the row that has it. Equal vectors are compared once,
    with their number as weight. Null and zero vectors and those with null or non-finite components, or
    without an id, link with nothing and are their own component. Vectors of different lengths have no cosine and so
    link only with those of their own length. Of rows that repeat an id, each counts as a vector. Other columns are
    ignored, whatever their names.

    All others are turned to the principal axes of their length and ordered by the first coordinate, which differs by at
    most sqrt(2 - 2 * threshold) between linked unit vectors. Tiles are ranges of it within a length; a tile meets only
    the tiles within that distance. Tasks return counts and spanning links, not pairs. A length with no more vectors
    than dimensions keeps its own axes, so the driver never holds more numbers of axes than the table has components.

    Equal vectors are known by 128-bit hashes of their directions, so ids move without vectors. The vectors, as given, are
    shuffled once, to files of neighbouring blocks in the work folder, a URI that pyarrow can read; tasks read those that
    they compare. So the disk that is needed grows with the input, only the time with the pairs of tiles that meet.
    """
    spark = vectors.sparkSession
    of_id, of_vector = (vectors.select(F.col(c).alias("x")).schema["x"].dataType for c in (id_col, vector_col))
    small = of_vector.elementType.typeName() in ("float", "byte", "short")
    kind = "f4" if small else "f8"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>" if small else "array<double>").alias("v"))
    sizes = rows.where("v is not null").groupBy(F.size("v").alias("length")).count().collect()
    many = sorted(r.length for r in sizes if 0 < r.length < r["count"])
    axes = principal_axes(rows, many) if many else {}

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _matrices(batches):
            keys, length, first = np.zeros((len(ids), 2), np.int64), np.zeros(len(ids), np.int64), np.zeros(len(ids))
            for at, x in found:
                w = _scaled(x)
                keys[at], length[at], first[at] = _keys(w), x.shape[1], _first(w, axes.get(x.shape[1]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.array(length), pa.array(first)], ["id", "key", "key2", "length", "first"])

    names = ["key", "key2"]
    # A length of 0 marks the rows that link with nothing.
    known = saved(rows.mapInArrow(keyed, f"id {of_id.simpleString()}, key long, key2 long, length long, first double"), "known")
    single = known.where("length = 0").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    classes = known.where("length > 0").groupBy(*names).agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.min("length").alias("length"), F.min("first").alias("first"))
    classes = saved(classes, "classes")
    counts = {r.length: r["count"] for r in classes.groupBy("length").count().collect()}
    if not counts:
        return single.select(F.col("id").alias(id_col), "n_links", F.col("component_id"), F.lit(True).alias("kept"))
    # One border for each tile: what the driver holds is some numbers for every ``tile`` vectors. Each length has numbers
    # of its own for its tiles, so that tiles of two lengths never meet.
    borders, base = {}, 0
    for length, count in sorted(counts.items()):
        parts = count // tile
        own = classes.where(F.col("length") == length)
        inner = sorted(set(own.approxQuantile("first", [k / parts for k in range(1, parts)], 0.2 / parts))) if parts > 1 else []
        borders[length] = (base, inner)
        base += len(inner) + 1
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + _MARGIN

    def placed(length: int, first: np.ndarray) -> np.ndarray:
        base, inner = borders[length]
        return base + np.searchsorted(inner, first, side="right")

    def extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, first, copies = (batch.column(c).to_numpy() for c in ("length", "first", "copies"))
            for length in np.unique(lengths).tolist():
                at = lengths == length
                own, last = placed(length, first[at]), placed(length, first[at] + reach)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(last), pa.array(copies[at]), pa.array(lengths[at])], ["tile", "last", "copies", "length"])

    extent = classes.select("length", "first", "copies").mapInArrow(extents, "tile long, last long, copies long, length long")
    extent = extent.groupBy("tile").agg(F.max("last").alias("last"), F.count("*").alias("n"), F.sum("copies").alias("copies"), F.min("length").alias("length")).collect()
    last, blocks, values, copied = np.arange(base), np.zeros(base, np.int64), np.zeros(base, np.int64), np.zeros(base)
    for r in extent:
        # A tile with many vectors at one place is cut into blocks by their keys, so that none outgrows a task.
        last[r.tile], blocks[r.tile], values[r.tile], copied[r.tile] = r["last"], -(-r.n // BLOCK), r.n * r.length, r.copies * r.length
    begins, tiles = np.cumsum(blocks) - blocks, np.repeat(np.arange(base), blocks)
    before = np.cumsum(values[tiles] / blocks[tiles]) - values[tiles] / blocks[tiles]
    chunks = np.unique(before // max(1, min(CHUNK_VALUES, values.sum() / CHUNKS)), return_inverse=True)[1].astype(np.int64)
    # A chunk of vectors with many copies is brought together in several groups, again by their keys.
    groups = np.maximum(1, -(-np.bincount(chunks, copied[tiles] / blocks[tiles]) // (2 * CHUNK_VALUES))).astype(np.int64)

    def sent(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for length in sorted({x.shape[1] for _, x in held}):
            meta, given = _merged(length, np.concatenate([m for m, x in held if x.shape[1] == length]), np.concatenate([x for _, x in held if x.shape[1] == length]))
            chunk = chunks[meta[:, 2]]
            part = meta[:, 1] % groups[chunk]
            order = np.lexsort((part, chunk))
            chunk, part, meta, given = chunk[order], part[order], meta[order], given[order]
            cuts = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (part[1:] != part[:-1])))
            ends = [*cuts[1:].tolist(), len(chunk)]
            columns = [[x[i:j].tobytes() for i, j in zip(cuts.tolist(), ends)] for x in (meta, given)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk[cuts]), pa.array(part[cuts]), pa.array(np.full(len(cuts), length)), *(pa.array(c, pa.binary()) for c in columns)], ["chunk", "part", "length", "meta", "given"]
            )

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, found in _matrices(batches):
            for _, x in found:
                w = _scaled(x)
                own, keys = placed(x.shape[1], _first(w, axes.get(x.shape[1]))), _keys(w)
                block = begins[own] + keys[:, 0] % blocks[own]
                held.append((np.column_stack([keys, block, np.ones_like(block)]), x.astype(kind)))
                size += x.size
            if size >= _FLUSH:
                yield from sent(held)
                held, size = [], 0
        yield from sent(held)

    def gathered(group: pa.Table) -> pa.Table:
        out = []
        for length in sorted(set(group["length"].to_pylist())):
            own = group.filter(pc.equal(group["length"], length))
            meta = np.frombuffer(b"".join(own["meta"].to_pylist()), np.int64).reshape(-1, 4)
            meta, given = _merged(length, meta, np.frombuffer(b"".join(own["given"].to_pylist()), kind))
            step = max(1, BLOCK * 64 // length)
            out += [(length, meta[at : at + step].tobytes(), given[at : at + step].tobytes()) for at in range(0, len(meta), step)]
        chunk = pa.array([group["chunk"][0].as_py()] * len(out), pa.int64())
        return pa.Table.from_arrays([chunk, pa.array([o[0] for o in out], pa.int64()), *(pa.array([o[k] for o in out], pa.binary()) for k in (1, 2))], ["chunk", "length", "meta", "given"])

    folder = new_work_path(spark, "blocks")
    spread = rows.mapInArrow(dealt, "chunk long, part long, length long, meta binary, given binary")
    spread.groupBy("chunk", "part").applyInArrow(gathered, "chunk long, length long, meta binary, given binary").write.partitionBy("chunk").parquet(folder)

    # Each chunk meets those up to the last tile that any of its tiles meets.
    ends = begins + blocks
    farthest = np.zeros(chunks[-1] + 1, np.int64)
    np.maximum.at(farthest, chunks, chunks[ends[last[tiles]] - 1])
    meets = spark.createDataFrame([(int(a), int(b)) for a, b in enumerate(farthest)], "a long, upto long")
    meets = meets.select("a", "upto", F.explode(F.sequence("a", "upto", F.lit(_SPAN).cast("long"))).alias("b"))
    tasks = int((-(-(farthest - np.arange(len(farthest)) + 1) // _SPAN)).sum())
    meets = meets.repartition(max(min(tasks, 4 * shuffle_partitions(spark)), tasks // 4))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, upto, begin in zip(*(batch.column(c).to_pylist() for c in ("a", "upto", "b"))):
                ours = _read(folder, a, kind, axes)
                for b in range(begin, min(begin + _SPAN, upto + 1)):
                    theirs = ours if a == b else _read(folder, b, kind, axes)
                    met = ((x, y) for x in ours for y in theirs if x.number <= y.number and tiles[y.number] <= last[tiles[x.number]])
                    found = [links for x, y in met if (links := _linked(x, y, threshold)) is not None]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["node", "key", "key2", "links", "other"])

    found = saved(meets.mapInArrow(compared, "node long, key long, key2 long, links long, other long"), "links")
    links = found.groupBy("node", *names).agg(F.sum("links").alias("links"))
    linked = connected_components(found.select(F.col("node").alias("src"), F.col("other").alias("dst")))
    named = saved(links.join(linked, "node").join(classes.select(*names, "least"), names), "named")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = saved(named.join(smallest, "component").select(*names, "links", "component_id"), "named")
    named = classes.select(*names, "least", "copies").join(named, names, "left")
    named = named.select(*names, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    result = known.where("length > 0").join(named, names).select("id", "n_links", "component_id").unionByName(single)
    return result.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
