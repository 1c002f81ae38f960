"""M3: a tuning study of boosted trees, trials x folds, that goes on after a lost driver.

The rows of a study are at most about ``max_rows`` (a hash of the key chooses; raise it for more), binned once per
fold by encoders fitted on that fold's training rows.  One task fits some trials on all folds in step: a scan
sums gradients per (trial, fold, node, feature, bin) (:mod:`.trees`).  Trials are dealt in waves of similar
cost; a wave's scores are published as one folder when it ends.

Work table under ``path``: ``folds`` (the binned rows), ``claims/<trial>.<attempt>`` (a marker per leased trial) and
``results/<wave>``.  Several drivers may share a study: each takes trials that nobody has leased, and takes over
a lease that is older than ``lease_seconds`` and has no result.  No finished trial is fitted again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..session import Intermediates, child_names, claim, marker_age, path_exists, publish, scratch_path, share_package
from . import trees as T

#: Rows of a study, about; bins of a feature in it.
MAX_ROWS, BINS = 1_500, 32
#: Trials that one task fits in step.
IN_STEP = 4
#: A lease without a result may be taken over after so long.
LEASE_SECONDS = 1_800.0

FOLD = "fold int, widths array<int>, bins binary, labels binary, held_bins binary, held_labels binary"
SCORES = "trial int, fold int, score double, seconds double"


def sampled(train: DataFrame, settings: Settings, fold_col: str, max_rows: int) -> DataFrame:
    """Features as numbers and texts, label and fold of the rows that a study sees."""
    n = train.count()
    if n > max_rows:
        place = F.xxhash64(*settings.primary_keys).cast("double") / 2.0 ** 64 + 0.5
        train = train.filter(place < max_rows / n)
    return train.select(
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(settings.numerical_features)],
        *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(settings.categorical_features)],
        F.col(settings.target).cast("int").alias("label"), F.col(fold_col).cast("int").alias("part"))


def binned_folds(rows: DataFrame, n_numbers: int, n_codes: int, n_folds: int) -> DataFrame:
    """Per fold: bins and labels of its training rows and of the rows held out."""
    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        fold, label = key[0].as_py(), table["label"].to_numpy().astype(np.uint8)
        held = table["part"].to_numpy() == fold
        columns, widths = [], []
        for i in range(n_numbers):
            x = table[f"x{i}"].to_numpy().astype(float)
            cuts = T.cut_points(x[~held], BINS)
            columns.append(T.to_bins(x, cuts))
            widths.append(len(cuts) + 1)
        for i in range(n_codes):
            texts = table[f"c{i}"].to_pylist()
            known = sorted({t for t, out in zip(texts, held) if not out and t is not None})
            code = {t: k for k, t in enumerate(known)}
            width = min(T.MAX_BINS, len(known) + 1)
            columns.append(T.to_bins(np.array([code.get(t, -1) for t in texts], float), None, width))
            widths.append(width)
        bins = np.stack(columns, axis=1)
        return pa.table({"fold": pa.array([fold], pa.int32()), "widths": pa.array([widths], pa.list_(pa.int32())),
                         **{name: pa.array([a.tobytes()], pa.binary()) for name, a in (
                             ("bins", bins[~held]), ("labels", label[~held]), ("held_bins", bins[held]), ("held_labels", label[held]))}})

    every = F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1)))
    return rows.select("*", every.alias("fold")).groupBy("fold").applyInArrow(pack, FOLD)


def fit_trials(trials: Sequence[Mapping[str, Any]], folds: Sequence[Mapping[str, Any]], n_numbers: int, seed: int) -> list[list[float]]:
    """Average precision of each trial on each fold, all fitted in step."""
    widths = np.max([f["widths"] for f in folds], axis=0)
    layout = T.Layout(widths, [i >= n_numbers for i in range(len(widths))])

    def unpack(f: Mapping[str, Any], prefix: str) -> tuple[np.ndarray, np.ndarray]:
        return (np.frombuffer(f[f"{prefix}bins"], np.uint8).reshape(-1, len(widths)), np.frombuffer(f[f"{prefix}labels"], np.uint8))

    fitted, held = [unpack(f, "") for f in folds], [unpack(f, "held_") for f in folds]
    _, raw = T.boost(fitted * len(trials), layout, [t for t in trials for _ in folds], seed,
                     [b for b, _ in held] * len(trials), [(f["fold"],) for f in folds] * len(trials))
    scores = [T.average_precision(y, r) for (_, y), r in zip(held * len(trials), raw)]
    return [scores[i:i + len(folds)] for i in range(0, len(scores), len(folds))]


def _fit_wave(spark: SparkSession, folds: DataFrame, wave: Sequence[tuple[int, str]], n_numbers: int, seed: int) -> DataFrame:
    """``trial, fold, score, seconds``: one task for every ``IN_STEP`` trials of the wave."""
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = sorted(row["folds"], key=lambda f: f["fold"])
                start = time.perf_counter()
                scores = fit_trials([json.loads(p) for p in row["params"]], data, n_numbers, seed)
                each = (time.perf_counter() - start) / (len(scores) * len(data))
                yield pa.RecordBatch.from_pylist(
                    [{"trial": t, "fold": f["fold"], "score": s, "seconds": each}
                     for t, own in zip(row["trials"], scores) for f, s in zip(data, own)],
                    schema=pa.schema([("trial", pa.int32()), ("fold", pa.int32()), ("score", pa.float64()), ("seconds", pa.float64())]))

    # All folds of a study are one row of bounded size that every task gets.
    one = folds.groupBy(F.lit(0).alias("study")).agg(F.collect_list(F.struct(*folds.columns)).alias("folds"))
    groups = [wave[i:i + IN_STEP] for i in range(0, len(wave), IN_STEP)]
    work = [(0, [t for t, _ in g], [p for _, p in g]) for g in groups]
    work = spark.createDataFrame(spark.sparkContext.parallelize(work, len(work)), "study int, trials array<int>, params array<string>")
    return work.join(F.broadcast(one), "study").select("trials", "params", "folds").mapInArrow(fit, SCORES)


def results(spark: SparkSession, path: str) -> DataFrame:
    """Scores published so far; a trial that two drivers fitted counts once."""
    waves = [f"{path}/results/{w}" for w in child_names(spark, f"{path}/results")]
    found = spark.read.schema(SCORES).parquet(*waves) if waves else spark.createDataFrame([], SCORES)
    return found.dropDuplicates(["trial", "fold"])


def lease(spark: SparkSession, path: str, trial: int, seconds: float) -> bool:
    """Take a trial, unless another driver has taken it less than ``seconds`` ago."""
    attempt = 0
    while True:
        marker = f"{path}/claims/{trial}.{attempt}"
        if claim(spark, marker):
            return True
        if marker_age(spark, marker) < seconds:
            return False
        attempt += 1


def run(train: DataFrame, settings: Settings, trials: Sequence[Mapping[str, Any]], n_folds: int, fold_col: str, seed: int,
        parallelism: int | None = None, max_rows: int = MAX_ROWS, path: str | None = None,
        lease_seconds: float = LEASE_SECONDS, on_wave: Callable[[dict[int, float]], None] | None = None) -> DataFrame:
    """All scores ``trial, fold, score, seconds`` of a study; ``on_wave`` gets each wave's mean scores by trial.

    ``parallelism``: trials of a wave (default: one task for every core)."""
    spark = train.sparkSession
    share_package(spark)
    size = parallelism or IN_STEP * spark.sparkContext.defaultParallelism
    own = path or scratch_path(spark, "study")
    numbers, codes = len(settings.numerical_features), len(settings.categorical_features)
    if not path_exists(spark, f"{own}/folds"):
        staged = f"{own}/_staging/{uuid.uuid4().hex}"
        binned_folds(sampled(train, settings, fold_col, max_rows), numbers, codes, n_folds).write.parquet(staged)
        try:
            publish(spark, staged, f"{own}/folds")
        except FileExistsError:  # another driver was first with the same rows
            pass
    folds = spark.read.schema(FOLD).parquet(f"{own}/folds")
    # Costly trials first, so that those of a wave end at about the same time.
    by_cost = sorted(range(len(trials)), key=lambda i: -trials[i]["n_estimators"] * (20 + trials[i].get("num_leaves", T.NUM_LEAVES)))
    while True:
        done = {r["trial"] for r in results(spark, own).select("trial").distinct().collect()}
        todo = [i for i in by_cost if i not in done]
        if not todo:
            break
        wave = []
        for i in todo:
            if len(wave) < size and lease(spark, own, i, lease_seconds):
                wave.append(i)
        if not wave:  # others are at work on all that is left
            time.sleep(1.0)
            continue
        name = uuid.uuid4().hex
        scores = _fit_wave(spark, folds, [(i, json.dumps(dict(trials[i]))) for i in wave], numbers, seed)
        scores.write.parquet(f"{own}/_staging/{name}")
        publish(spark, f"{own}/_staging/{name}", f"{own}/results/{name}")
        if on_wave is not None:
            found = spark.read.schema(SCORES).parquet(f"{own}/results/{name}").groupBy("trial").agg(F.avg("score").alias("score"))
            on_wave({r["trial"]: r["score"] for r in found.collect()})
    if path is not None:
        return results(spark, own)
    with Intermediates(spark) as scratch:  # a study without a path leaves its scores only
        scratch.paths.append(own)
        return _kept(results(spark, own))


def _kept(scores: DataFrame) -> DataFrame:
    """The (few) scores as a table of their own."""
    rows = [tuple(r) for r in scores.collect()]
    return scores.sparkSession.createDataFrame(rows, SCORES)
