"""Embedding near-duplicates by a PCA-ordered tiled comparison (operator 13).

Vectors with the same label (and number of components) link when their cosine reaches the threshold.
The comparison is exact: bounds leave out only pairs that cannot reach it.

1. *Classes.*  Equal vectors of a label are one class with a count, so copies are never compared.
2. *PCA order.*  A rotation is fitted on a sample of at most about ``SAMPLE`` unit vectors, its axes by
   falling variance.  Sample, axes and cuts only decide how much work there is, never the result.
3. *Tiles.*  A tree of median cuts along the leading axes (fitted on the sample too) and, where a leaf
   holds more than ``TILE`` vectors, a hash deal each label's classes to tiles of bounded size; one tile is
   one row with its vectors packed.  A hot label is many tiles.
4. *Pairs of tiles* of one label whose boxes along the leading axes come nearer than linked vectors can be
   apart are joined.  A task compares two tiles: products of the leading axes first, in stretches of
   ``STEPS``; after each, a pair stays only if its sum plus the product of both suffix norms (the
   Cauchy-Schwarz bound of all later axes) can still reach the threshold.  Pairs that stay to the end
   are decided by the cosine of the original vectors in double precision.
5. *Links are counted, not listed.*  A pair of tiles gives one row per linked class: how many vectors it
   links to, and the smallest member of its component inside this pair of tiles.  Linear in the tiles, however
   dense the links, and enough for the counts and the components of the whole graph.

Scale: vectors are shuffled once into tiles; tiles travel to the tiles that their box meets.
Work within a label is quadratic only among tiles that the bounds cannot part.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing,
nor do rows with a null label; repeated rows are one vector; an id with several vectors has the links of
all of them, added up; rows with a null id take no part (``n_links`` 0, ``component_id`` null, ``kept``
false); an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Intermediates, materialize
from .components import component_labels

COSINE = 0.98
#: Vectors that the rotation and the cuts are fitted on, at most about.
SAMPLE = 8_192
#: Vectors of a tile, about; axes that boxes and cuts use; deepest cut.
TILE, AXES, DEEPEST = 4_096, 8, 10
#: Ends of the stretches of axes that are summed before a bound, as shares of all axes.
STEPS = (0.125, 0.25, 0.5, 1.0)
#: Rows of a tile compared at once; slack of the bounds for rounded sums.
ROWS_AT_ONCE, SLACK = 256, 1e-5
#: Most rows of the table of leaf sizes that is broadcast (counted first).
BROADCAST_ROWS = 100_000
#: Numbers of components, by frequency, that a rotation is fitted for; others keep their axes.
FRAMES = 16


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a column of equally long lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(-1, dim)


def to_bytes(x: np.ndarray) -> bytes:
    """Numbers in single precision where nothing is lost, else in double."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return (short if np.array_equal(short, x) else x).tobytes()


def from_bytes(data: bytes, n: int, dim: int) -> np.ndarray:
    kind = np.float32 if len(data) == 4 * n * dim else np.float64
    return np.frombuffer(data, kind).reshape(n, dim).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow or underflow of squares."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: Column | str) -> Column:
    """Whether a vector can link: not null or empty, all components finite, one of them not zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


class Frame:
    """Rotation and cuts for vectors of one dimension: ``leaf = cell(unit vectors rotated)``."""

    def __init__(self, sample: np.ndarray, depth: int):
        dim = sample.shape[1]
        x = unit(sample) if len(sample) else sample
        # Without a sample the axes stay as they are.
        self.axes = np.ascontiguousarray(np.linalg.eigh(x.T @ x)[1][:, ::-1]) if len(x) else np.eye(dim)
        depth = min(depth, max(0, int(np.log2(max(1, len(x) // 16)))))
        self.leading = min(AXES, dim)
        self.cuts: list[np.ndarray] = []
        self.along: list[np.ndarray] = []
        y = x @ self.axes[:, :self.leading]
        leaf = np.zeros(len(y), np.int64)
        for level in range(depth):
            cuts, along = np.zeros(1 << level), np.zeros(1 << level, np.int64)
            for k in range(1 << level):
                own = y[leaf == k]
                if len(own):
                    along[k] = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                    cuts[k] = np.median(own[:, along[k]])
            self.cuts.append(cuts)
            self.along.append(along)
            leaf = self._down(y, leaf, level)

    def _down(self, y: np.ndarray, leaf: np.ndarray, level: int) -> np.ndarray:
        right = y[np.arange(len(y)), self.along[level][leaf]] > self.cuts[level][leaf]
        return leaf * 2 + right

    def rotated(self, x: np.ndarray) -> np.ndarray:
        return unit(x) @ self.axes

    def cell(self, y: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(y), np.int64)
        for level in range(len(self.cuts)):
            leaf = self._down(y[:, :self.leading], leaf, level)
        return leaf


def fitted_frames(classes: DataFrame) -> dict[int, Frame]:
    """A frame per number of components, from a sample by hash."""
    frames = {}
    sizes = (classes.groupBy("dim", "label").count().groupBy("dim")
             .agg(F.sum("count").alias("n"), F.max("count").alias("largest")).orderBy(F.desc("n"), "dim").limit(FRAMES))
    for dim, n, largest in map(tuple, sizes.collect()):
        share = F.xxhash64("id").cast("double") / 2.0 ** 64 + 0.5
        own = classes.filter(F.col("dim") == dim)
        rows = own if n <= SAMPLE else own.filter(share < SAMPLE / n)
        sample = [matrix(batch.column(0), dim) for batch in rows.select("vector").toArrow().to_batches()]
        depth = min(DEEPEST, int(np.ceil(np.log2(max(1, largest / TILE)))))
        frames[dim] = Frame(np.concatenate([*sample, np.empty((0, dim))]), depth)
    return frames


def frame_of(frames: dict[int, Frame], dim: int) -> Frame:
    if dim not in frames:
        frames[dim] = Frame(np.empty((0, dim)), 0)
    return frames[dim]


TILE_ROW = ("dim int, label string, cell long, part long, n long, low array<double>, high array<double>, "
            "keys binary, ids binary, counts binary, vectors binary")


def tiles(classes: DataFrame, frames: dict[int, Frame], own: Intermediates) -> DataFrame:
    """Stored tiles, one row each."""
    held = classes.sparkSession.sparkContext.broadcast(frames)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            cell = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                frame = frame_of(held.value, dim)
                cell[at] = frame.cell(frame.rotated(matrix(batch.column(5).take(pa.array(at)), dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    rows = own.store(classes.select("label", "dim", "key", "id", "n", "vector").mapInArrow(
        celled, "label string, dim int, key long, id long, n long, vector array<double>, cell long"), "embedding-cells")
    sizes = rows.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / TILE).alias("parts"))
    if sizes.count() <= BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    rows = rows.join(sizes, ["label", "dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))

    def packed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        label, dim, cell, part = (k.as_py() for k in key)
        table = table.sort_by("key").combine_chunks()
        x = np.concatenate([matrix(c, dim) for c in table.column("vector").chunks])
        y = frame_of(held.value, dim).rotated(x)[:, :AXES]
        row = {"dim": dim, "label": label, "cell": cell, "part": part, "n": len(x), "low": y.min(axis=0).tolist(),
               "high": y.max(axis=0).tolist(), "vectors": to_bytes(x),
               **{f"{c}s": table.column(c).to_numpy().tobytes() for c in ("key", "id")},
               "counts": table.column("n").to_numpy().tobytes()}
        kinds = {"dim": pa.int32(), "label": pa.string(), "low": pa.list_(pa.float64()), "high": pa.list_(pa.float64()),
                 **dict.fromkeys(("keys", "ids", "counts", "vectors"), pa.binary())}
        names = [c.split()[0] for c in TILE_ROW.split(", ")]
        return pa.table([pa.array([row[c]], kinds.get(c, pa.int64())) for c in names], names=names)

    return own.store(rows.groupBy("label", "dim", "cell", "part").applyInArrow(packed, TILE_ROW), "embedding-tiles")


def near_tiles(table: DataFrame, cosine: float) -> DataFrame:
    """Pairs of tiles (each with itself too) whose boxes are no farther apart than linked vectors can be."""
    box = table.select("dim", "label", "cell", "part", "low", "high")
    other = box.select("dim", "label", *[F.col(c).alias(f"{c}_b") for c in ("cell", "part", "low", "high")])
    gaps = F.zip_with(F.zip_with("low", "high_b", lambda a, b: a - b), F.zip_with("low_b", "high", lambda a, b: a - b),
                      lambda a, b: F.greatest(a, b, F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    # Unit vectors of cosine c are sqrt(2 - 2c) apart.
    return (box.join(other, ["dim", "label"])
            .filter((F.struct("cell", "part") <= F.struct("cell_b", "part_b")) & (apart <= 2 - 2 * cosine + SLACK))
            .select("dim", "label", "cell", "part", "cell_b", "part_b"))


def linked_rows(x: np.ndarray, y: np.ndarray, axes: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stretches of the pairs ``(row of x, row of y)`` whose cosine reaches the threshold."""
    dim = x.shape[1]
    ux, uy = unit(x), unit(y)
    rx, ry = (ux @ axes).astype(np.float32), (uy @ axes).astype(np.float32)
    norms = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    plain = all(np.isfinite(n).all() and (n > 1e-150).all() for n in norms)
    ends = sorted({max(1, round(dim * s)) for s in STEPS})
    # Norms of the axes behind each stretch.
    rest = [(np.sqrt((rx[:, e:] ** 2).sum(axis=1)), np.sqrt((ry[:, e:] ** 2).sum(axis=1))) for e in ends]
    least = np.float32(cosine - SLACK)
    for s in range(0, len(x), ROWS_AT_ONCE):
        part = slice(s, s + ROWS_AT_ONCE)
        sums = rx[part, :ends[0]] @ ry[:, :ends[0]].T
        a, b = np.nonzero(sums + np.multiply.outer(rest[0][0][part], rest[0][1]) >= least)
        sums = sums[a, b]
        for k in range(1, len(ends)):
            axis = slice(ends[k - 1], ends[k])
            sums = sums + products(rx[part, axis], ry[:, axis], a, b)
            keep = sums + rest[k][0][part][a] * rest[k][1][b] >= least
            a, b, sums = a[keep], b[keep], sums[keep]
        if plain:
            exact = products(x[part], y, a, b) / (norms[0][part][a] * norms[1][b])
        else:
            exact = products(ux[part], uy, a, b)
        yield a[exact >= cosine] + s, b[exact >= cosine]


def products(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``a`` of x and ``b`` of y."""
    if 8 * len(a) > len(x) * len(y):  # many: all of them at once are faster than picking rows
        return (x @ y.T)[a, b]
    out = np.empty(len(a), x.dtype)
    for t in range(0, len(a), 1 << 16):
        now = slice(t, t + (1 << 16))
        out[now] = np.einsum("ij,ij->i", x[a[now]], y[b[now]])
    return out


def merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of the components after links ``a - b``; ``root[i] <= i`` are the labels before."""
    a, b = root[a], root[b]
    while True:
        high, low = np.maximum(a, b), np.minimum(a, b)
        if not (high != low).any():
            return root
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
        a, b = root[high], root[low]


def compared(pairs: DataFrame, table: DataFrame, frames: dict[int, Frame], cosine: float) -> DataFrame:
    """``key, id, n_links, least``: per pair of tiles and class with a link, the vectors it links to there and
    the smallest id of its component there."""
    held = table.sparkSession.sparkContext.broadcast(frames)
    content = table.select("dim", "label", "cell", "part", "keys", "ids", "counts", "vectors")
    other = content.select("dim", "label", *[F.col(c).alias(f"{c}_b") for c in content.columns[2:]])
    rows = pairs.join(content, ["dim", "label", "cell", "part"]).join(other, ["dim", "label", "cell_b", "part_b"])
    same = (F.col("cell") == F.col("cell_b")) & (F.col("part") == F.col("part_b"))
    rows = rows.select("dim", same.alias("same"), *content.columns[4:], *other.columns[4:])

    def of_pair(dim: int, same: bool, one: list[bytes], two: list[bytes]) -> pa.RecordBatch:
        if same:
            two = [b""] * 4
        key, ids, counts = (np.concatenate([np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)])
                            for a, b in zip(one[:3], two[:3]))
        n = len(one[0]) // 8
        x = from_bytes(one[3], n, dim)
        y = x if same else from_bytes(two[3], len(two[0]) // 8, dim)
        order = np.argsort(ids, kind="stable")  # components are labelled by places in the order of ids
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        root, links = np.arange(len(ids)), np.zeros(len(ids), np.int64)
        for a, b in linked_rows(x, y, frame_of(held.value, dim).axes, cosine):
            b = b if same else b + n
            a, b = a[a != b], b[a != b]
            links += np.bincount(a, counts[b], len(ids)).astype(np.int64)
            if not same:
                links += np.bincount(b, counts[a], len(ids)).astype(np.int64)
            root = merged(root, place[a], place[b])
        at = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (key[at], ids[at], links[at], ids[order[root[place[at]]]])],
                                          names=["key", "id", "n_links", "least"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim, same, *data = (c[r].as_py() for c in batch.columns)
                yield of_pair(dim, same, data[:4], data[4:])

    return rows.mapInArrow(compare, "key long, id long, n_links long, least long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE) -> DataFrame:
    """``id_col, n_links, component_id, kept`` per row of ``df``: the other vectors (distinct ids) that a vector
    links to, the smallest id that links reach, and whether that is its own."""
    with Intermediates(df.sparkSession) as own:
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                         F.col(vector_col).cast("array<double>").alias("vector"))
        able = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
        # A zero has two signs that are equal.
        plain = F.transform("vector", lambda v: v + F.lit(0.0))
        able = able.select("id", "label", F.size("vector").alias("dim"), plain.alias("vector"))
        able = own.store(able.distinct(), "embedding-rows")
        equal = ["label", "dim", "vector"]
        classes = able.groupBy(*equal).agg(F.min("id").alias("id"), F.count("*").alias("n"))
        classes = own.store(classes.withColumn("key", F.monotonically_increasing_id()), "embedding-classes")
        members = own.store(able.join(classes.withColumnRenamed("id", "rep"), equal).select("id", "key", "rep", "n"),
                            "embedding-members")
        frames = fitted_frames(classes)
        table = tiles(classes, frames, own)
        found = own.store(compared(near_tiles(table, cosine), table, frames, cosine), "embedding-links")
        labels = component_labels(found.select(F.col("id").alias("a"), F.col("least").alias("b")).unionByName(
            members.select(F.col("id").alias("a"), F.col("rep").alias("b"))))
        counts = found.groupBy("key").agg(F.sum("n_links").alias("n_links"))
        direct = members.join(counts, "key", "left").groupBy("id").agg(
            F.sum(F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
        facts = direct.join(labels, "id", "left").select("id", "n_links", F.coalesce("component", "id").alias("component"))
        least = F.coalesce("component", "id")
        return materialize(
            df.select(F.col(id_col).cast("long").alias("id")).join(facts, "id", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    least.alias("component_id"), F.coalesce(least == F.col("id"), F.lit(False)).alias("kept")),
            "embedding-result")
