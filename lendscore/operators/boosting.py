"""Boosted trees as Spark ML stages (M2): histogram boosting over all rows of a table.

Rows are binned once and stored in blocks.  A tree takes one scan of the blocks per level of best-first
growth (:mod:`.trees`): every task adds up gradients, hessians and rows per (node, feature, bin) of its blocks,
and only those sums, whose size does not depend on the rows, are added up and reach the driver.  Blocks persist
with their scores, to which the next tree's first scan adds the last tree, so a row walks through every tree once.
Every ``REFRESH`` trees the blocks are stored again, which ends the lineage.  Rows that fit one block
(``BLOCK_ROWS``) need no sums from elsewhere: the task that holds it grows the same trees in one job.

* L2 penalty, leaf count and row share as the reference's library has them; a tree's row share is drawn by block
  and tree, so it does not depend on partitioning or repeated tasks.
* Nominal features (codes, -1 unseen) split into two sets of categories; codes from ``MAX_BINS - 1`` on share a bin.
* Scoring is an Arrow UDF on the features vector.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..session import Intermediates, share_package
from . import trees as T

#: Rows that one task fits alone; rows of a block of more; blocks of a scan's task, where there are as many tasks as
#: cores; trees between two stores of the scores.
BLOCK_ROWS, SCAN_ROWS, TASK_BLOCKS, REFRESH = 262_144, 65_536, 32, 25
#: Accuracy of the quantiles that cut numbers into bins.
ACCURACY = 10_000
#: Bytes of partial sums that the driver adds up itself; beyond, tasks add them up by node first.
DRIVER_BYTES = 64 << 20

BLOCK = "block string, n int, bins binary, labels binary, raw binary"


def numeric_cuts(rows: DataFrame, column: str, places: Sequence[int], bins: int) -> dict[int, np.ndarray]:
    """Upper bounds of the bins of some numbers of an array column: their values, if few, else quantiles.
    Two aggregates; at most ``bins`` values of a feature reach the driver."""
    if not places:
        return {}
    item = {p: F.col(column)[p] for p in places}
    shares = [k / bins for k in range(1, bins)]
    found = rows.agg(*[F.approx_count_distinct(item[p]).alias(f"n{p}") for p in places],
                     *[F.percentile_approx(item[p], shares, ACCURACY).alias(f"q{p}") for p in places]).first()
    few = [p for p in places if found[f"n{p}"] <= 1.2 * bins]
    values = rows.agg(*[F.collect_set(item[p]).alias(f"v{p}") for p in few]).first() if few else {}
    out = {}
    for p in places:
        exact = np.unique(np.array(values[f"v{p}"], float)) if p in few else None
        out[p] = exact[:-1] if exact is not None and len(exact) <= bins else np.unique(np.array(found[f"q{p}"] or [], float))
    return out


class _Columns(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "features vector", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)


class BoostedTrees(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """``n_estimators`` trees of ``num_leaves`` leaves at ``learning_rate``, L2 penalty ``reg_lambda`` and row share
    ``subsample`` (``params``, JSON); ``nominal`` lists the places of code features in the vector."""
    params_json = Param(Params._dummy(), "params_json", "training parameters as JSON", TypeConverters.toString)
    nominal = Param(Params._dummy(), "nominal", "places of nominal features", TypeConverters.toListInt)
    seed = Param(Params._dummy(), "seed", "seed of the row shares", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature", TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", params_json="{}", nominal=None, seed=42, maxBins=T.MAX_BINS):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", params_json="{}", nominal=[], seed=42, maxBins=T.MAX_BINS)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        share_package(df.sparkSession)
        params = {"n_estimators": 100, "learning_rate": 0.1, **json.loads(self.getOrDefault(self.params_json))}
        rows = df.select(vector_to_array(F.col(self.getOrDefault(self.featuresCol))).alias("x"),
                         F.col(self.getOrDefault(self.labelCol)).cast("int").alias("y"))
        rows = rows.filter(F.col("y").isNotNull())
        nominal, most = sorted(self.getOrDefault(self.nominal)), self.getOrDefault(self.maxBins)
        with Intermediates(df.sparkSession) as own:
            first = rows.agg(F.max(F.size("x")).alias("features"), F.avg("y").alias("share"), F.count("*").alias("n"),
                             *[F.max(F.col("x")[p]).alias(f"c{p}") for p in nominal]).first()
            if first["features"] is None:
                raise ValueError("no labelled rows to fit on")
            width = [min(most, int(first[f"c{p}"]) + 2) if p in nominal else 0 for p in range(first["features"])]
            cuts = numeric_cuts(rows, "x", [p for p in range(len(width)) if p not in nominal], most)
            width = [w or len(cuts[p]) + 1 for p, w in enumerate(width)]
            layout = T.Layout(width, [p in nominal for p in range(len(width))])
            alone = first["n"] <= BLOCK_ROWS
            blocks = _blocks(rows.coalesce(1) if alone else rows, cuts, layout, BLOCK_ROWS if alone else min(BLOCK_ROWS, SCAN_ROWS))
            blocks = own.store(blocks, "tree-blocks")
            forest = _Forest(blocks, layout, params, self.getOrDefault(self.seed), T.log_odds(first["share"]), own)
            state = {"start": forest.start, "bins": layout.bins, "cuts": {str(p): c.tolist() for p, c in cuts.items()},
                     "widths": width, "trees": [t.to_json() for t in forest.fit()]}
        return BoostedTreesModel(featuresCol=self.getOrDefault(self.featuresCol), state=json.dumps(state))


def _binned(x: np.ndarray, cuts: Mapping[int, np.ndarray], widths: Sequence[int]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for p in range(x.shape[1]):
        out[:, p] = T.to_bins(x[:, p], cuts.get(p), widths[p])
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(rows: DataFrame, cuts: dict[int, np.ndarray], layout: T.Layout, least: int) -> DataFrame:
    """Rows as blocks of ``least`` rows or a few more, the last of a task of fewer: bins, feature by feature, and labels."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            bins, y = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{part}-{seq}"]), pa.array([len(y)], pa.int32()), pa.array([bins.tobytes("F")], pa.binary()),
                 pa.array([y.tobytes()], pa.binary()), pa.array([b""], pa.binary())], names=["block", "n", "bins", "labels", "raw"])

        for batch in batches:
            if batch.num_rows:
                held.append((_binned(_matrix(batch.column(0)), cuts, layout.width), batch.column(1).to_numpy().astype(np.uint8)))
                size += batch.num_rows
                if size >= least:
                    yield block()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield block()

    return rows.mapInArrow(pack, BLOCK)


#: A block in an RDD: name, rows, bins, labels, raw scores (all but the first two as bytes).
_Block = tuple[str, int, bytes, bytes, bytes]


def _arrays(block: _Block, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels and raw scores of a block."""
    _, n, bins, labels, raw = block
    return np.frombuffer(bins, np.uint8).reshape(features, n).T, np.frombuffer(labels, np.uint8), np.frombuffer(raw, float)


def _block_seed(block: str) -> list[int]:
    return [int(x) for x in block.split("-")]


class _Forest:
    """One fit: blocks with the scores of the trees so far, and the sums of a growing tree."""

    def __init__(self, blocks: DataFrame, layout: T.Layout, params: Mapping[str, Any], seed: int, start: float,
                 own: Intermediates):
        self.stored, self.layout, self.params, self.seed, self.start, self.own = blocks, layout, params, seed, start, own
        self.features = len(layout.width)
        self.tree = 0
        #: Persisted blocks, and those that the next scan replaces.
        self.blocks: RDD | None = None
        self.stale: list[RDD] = []

    def fit(self) -> list[T.Tree]:
        count = self.stored.count()
        if count == 1:
            return self._fit_block()
        cores = self.stored.sparkSession.sparkContext.defaultParallelism
        self.tasks = min(count, max(cores, -(-count // TASK_BLOCKS)))
        done: list[T.Tree] = []
        try:
            self._load()
            for self.tree in range(int(self.params["n_estimators"])):
                if done:
                    self._add_scores(done[-1])
                if done and len(done) % REFRESH == 0:
                    self._store_scores()
                model = T.Model(0, int(self.params.get("num_leaves", T.NUM_LEAVES)), float(self.params.get("reg_lambda", 0.0)),
                                float(self.params["learning_rate"]))
                done.append(T.one_tree(T.grow(self._sums, self.layout, [model]), 0))
        finally:
            self._forget([self.blocks] if self.blocks is not None else [])
        return done

    def _fit_block(self) -> list[T.Tree]:
        layout, params, seed, features = self.layout, dict(self.params), self.seed, self.features

        def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    bins, y, _ = _arrays(tuple(row.values()), features)
                    found = T.boost([(np.ascontiguousarray(bins), y)], layout, [params], seed, keys=[_block_seed(row["block"])])[0][0]
                    yield pa.RecordBatch.from_arrays([pa.array([json.dumps([t.to_json() for t in found])])], names=["trees"])

        return [T.Tree.from_json(t, layout.bins) for t in json.loads(self.stored.mapInArrow(fitted, "trees string").first()["trees"])]

    def _load(self) -> None:
        """The stored blocks, dealt evenly to tasks and persisted with their first scan; those without scores begin with the start."""
        start = self.start

        def scored(row: Any) -> _Block:
            block, n, bins, labels, raw = row
            return block, n, bytes(bins), bytes(labels), bytes(raw) or np.full(n, start).tobytes()

        self.blocks = self.stored.repartition(self.tasks).rdd.map(scored).persist(StorageLevel.MEMORY_AND_DISK)

    def _add_scores(self, tree: T.Tree) -> None:
        features, leaves = self.features, np.flatnonzero(tree.feature < 0).tolist()

        def added(block: _Block) -> _Block:
            bins, y, raw = _arrays(block, features)
            raw = raw.copy()
            for leaf, rows in tree.parts(bins, np.arange(len(y)), leaves):
                raw[rows] += tree.value[leaf]
            return *block[:4], raw.tobytes()

        self.stale.append(self.blocks)
        self.blocks = self.blocks.map(added).persist(StorageLevel.MEMORY_AND_DISK)

    def _store_scores(self) -> None:
        old, self.stored = self.stored, self.own.store(self.stored.sparkSession.createDataFrame(self.blocks, BLOCK), "tree-blocks")
        self._forget([self.blocks])
        self.own.drop(old)
        self._load()

    def _forget(self, more: Sequence[RDD] = ()) -> None:
        """Give up blocks that newer ones replace."""
        for blocks in [*self.stale, *more]:
            blocks.unpersist()
        self.stale = []

    def _sums(self, growth: T.Growth, nodes: list[int]) -> np.ndarray:
        """Sums of ``nodes``: one scan of the blocks."""
        layout, features = self.layout, self.features
        share, seed, tree = float(self.params.get("subsample", 1.0)), self.seed, self.tree
        child = np.array(growth.child, np.int32)
        now = T.Tree(np.array(growth.feature, np.int32), growth.goes_left[:len(child)], child, child + (child >= 0), np.zeros(len(child)))
        n, slot = len(nodes), {k: i for i, k in enumerate(nodes)}

        def add(blocks: Iterator[_Block]) -> Iterator[tuple[int, np.ndarray]]:
            out = np.zeros((n, 3, layout.size))
            for block in blocks:
                bins, y, raw = _arrays(block, features)
                used = T.share_of_rows(len(y), share, seed, tree, *_block_seed(block[0]))
                found = [(slot[k], rows) for k, rows in now.parts(bins, used, nodes)]
                own = np.repeat([k for k, _ in found], [len(rows) for _, rows in found])
                rows = np.concatenate([rows for _, rows in found])
                p = T.sigmoid(raw[rows])
                T.add_columns(out, layout, bins, rows, own, p - y[rows], p * (1 - p))
            return enumerate(out)

        partial = self.blocks.mapPartitions(add)
        if self.tasks * n * layout.size * 24 > DRIVER_BYTES:
            partial = partial.reduceByKey(np.add)
        total = np.zeros((n, 3, layout.size))
        for slot, sums in partial.collect():
            total[slot] += sums
        self._forget()
        return total


_MODELS: dict[int, tuple] = {}


def _loaded(state: str) -> tuple:
    """``(start, cuts, widths, trees)`` of a model, once per worker."""
    key = hash(state)
    if key not in _MODELS:
        d = json.loads(state)
        _MODELS.clear()
        _MODELS[key] = (d["start"], {int(p): np.array(c) for p, c in d["cuts"].items()}, T.Layout(d["widths"], [False] * len(d["widths"])).width,
                        [T.Tree.from_json(t, d["bins"]) for t in d["trees"]])
    return _MODELS[key]


class BoostedTreesModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (vector) and ``prediction`` (probability over one half)."""
    state = Param(Params._dummy(), "state", "trees and bins as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol="features", state="{}"):
        super().__init__()
        self._setDefault(featuresCol="features")
        self._set(**self._input_kwargs)

    @property
    def trees(self) -> list[T.Tree]:
        return _loaded(self.getOrDefault(self.state))[3]

    def _transform(self, df: DataFrame) -> DataFrame:
        share_package(df.sparkSession)
        held = df.sparkSession.sparkContext.broadcast(self.getOrDefault(self.state))

        @F.arrow_udf(DoubleType())
        def positive(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            start, cuts, widths, trees = _loaded(held.value)
            for x in batches:
                if not len(x):
                    yield pa.array([], pa.float64())
                    continue
                bins = _binned(_matrix(x), cuts, widths)
                raw = np.full(len(bins), start)
                for tree in trees:
                    raw += tree.value[tree.leaves(bins)]
                yield pa.array(T.sigmoid(raw))

        p = positive(vector_to_array(F.col(self.getOrDefault(self.featuresCol))))
        out = df.withColumn("probability", p)
        return out.withColumns({"prediction": (F.col("probability") > 0.5).cast("double"),
                                "probability": array_to_vector(F.array(1 - F.col("probability"), F.col("probability")))})
