"""Feature assembly (F5), pipelines (F6), classifiers (M1, M2), tuning (M3)
and batch scoring (M10) on Spark ML.

Training reads the assembled training rows once into the cache
(MEMORY_AND_DISK) and every fit is a distributed Spark ML job; only
coefficients/trees, dictionaries and metrics come back to the driver.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.columns import decode_label
from ..session import Intermediates
from . import metrics, study
from .boosting import BoostedTrees
from .features import (CategoryCodes, CategoryCodesModel, PopulationStandardScaler, UnknownLast,
                       category_state)

FEATURES = "features"
PROB = "probability"
P1 = "p_positive"

# --- F5 ------------------------------------------------------------------------
class FeatureAssembler(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Column blocks -> one vector, in block order.

    ``mode="baseline"``: scaled numerics, one-hot of categoricals with more
    than two values, 0/1 of two-valued ones; categoricals with fewer than two
    values are dropped (and listed in :attr:`dropped`).
    ``mode="codes"``: scaled numerics, then integer category codes (-1 unseen).
    The cardinality decision is made on the data the assembler is fitted on.
    """
    numerical = Param(Params._dummy(), "numerical", "numeric columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "categorical columns",
                        TypeConverters.toListString)
    mode = Param(Params._dummy(), "mode", "baseline | codes", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, numerical=None, categorical=None, mode="baseline", outputCol=FEATURES):
        super().__init__()
        self._setDefault(mode="baseline", outputCol=FEATURES)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        nums = self.getOrDefault(self.numerical)
        cats = self.getOrDefault(self.categorical)
        scaled = [f"{c}__scaled" for c in nums]
        stages: list[Transformer] = [PopulationStandardScaler(inputCols=nums, outputCols=scaled).fit(df)] if nums else []
        inputs = list(scaled)
        if self.getOrDefault(self.mode) == "codes":
            codes = [f"{c}__code" for c in cats]
            stages.append(CategoryCodes(inputCols=cats, outputCols=codes).fit(df))
            inputs += codes
        else:
            # One dictionary pass decides the blocks and fits both encoders.
            state = category_state(df, cats)
            n = {c: state[c]["size"] for c in cats}
            onehot = [c for c in cats if n[c] > 2]
            binary = [c for c in cats if n[c] == 2]
            self.dropped = [c for c in cats if n[c] < 2]
            if onehot:
                # Sparse blocks for any number of categories: code, then one-hot of the code.
                codes, slots, vectors = ([f"{c}__{kind}" for c in onehot] for kind in ("code", "slot", "onehot"))
                stages.append(CategoryCodesModel(inputCols=onehot, outputCols=codes, onUnknown="minus_one",
                                                 state=json.dumps({c: state[c] for c in onehot})))
                stages.append(UnknownLast(inputCols=codes, outputCols=slots,
                                          state=json.dumps({k: n[c] for c, k in zip(onehot, codes)})))
                encoder = OneHotEncoder(inputCols=slots, outputCols=vectors, dropLast=True)
                # The sizes come from the columns' metadata: no row is read.
                stages.append(encoder.fit(PipelineModel(stages[-2:]).transform(df)))
                inputs += vectors
            if binary:
                outs = [f"{c}__bin" for c in binary]
                stages.append(CategoryCodesModel(inputCols=binary, outputCols=outs, onUnknown="error",
                                                 state=json.dumps({c: state[c] for c in binary})))
                inputs += outs
        stages.append(VectorAssembler(inputCols=inputs, outputCol=self.getOrDefault(self.outputCol)))
        return PipelineModel(stages)


# --- M1 / M2 -------------------------------------------------------------------
def baseline_classifier(label: str, n_train: int, C: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """L2 logistic regression with the objective ``0.5||w||^2 + C sum(logloss)``:
    Spark's ``mean(logloss) + regParam/2 ||w||^2`` with ``regParam = 1/(n C)``,
    no internal standardisation, intercept unpenalised."""
    return LogisticRegression(featuresCol=FEATURES, labelCol=label, regParam=1.0 / (n_train * C),
                              elasticNetParam=0.0, standardization=False, maxIter=max_iter,
                              tol=1e-6, fitIntercept=True)


def optimality(model: PipelineModel, df: DataFrame, settings: Settings, C: float = 1.0) -> DataFrame:
    """Certificate of a fitted baseline on the rows it was fitted on (one row): ``n_rows``, ``max_gradient`` (largest
    component of the objective's gradient, per row) and ``relative_gap`` (duality gap over the objective).

    Both are aggregates per slot of the features vector, so any number of rows gives as many numbers as the model
    has.  The dual point takes ``C * |p - y|`` per row, scaled down in the class that has more of it so that
    both classes have the same sum, as the free intercept demands; the gap bounds how far the model is from optimal."""
    lr = model.stages[-1]
    weights, intercept = [float(w) for w in lr.coefficients], float(lr.intercept)
    rows = model.transform(df).select(vector_to_array(FEATURES).alias("x"), F.col(settings.target).cast("double").alias("y"))
    z = F.aggregate(F.arrays_zip("x", F.array(*map(F.lit, weights)).alias("w")), F.lit(0.0), lambda s, v: s + v["x"] * v["w"])
    rows = rows.withColumn("z", z + F.lit(intercept)).withColumn("miss", 1 / (1 + F.exp(F.when(F.col("y") == 1, F.col("z")).otherwise(-F.col("z")))))
    log1pexp = F.greatest(F.lit(0.0), F.col("m")) + F.log1p(F.exp(-F.abs(F.col("m"))))
    rows = rows.withColumn("m", F.when(F.col("y") == 1, -F.col("z")).otherwise(F.col("z"))).withColumn("loss", log1pexp)
    rows = rows.select("x", "y", "miss", "loss").withColumn("side", F.when(F.col("y") == 1, 1).otherwise(-1))
    with Intermediates(df.sparkSession) as own:
        rows = own.store(rows, "optimality")
        sums = {r["side"]: r for r in rows.groupBy("side").agg(
            F.count("*").alias("n"), F.sum("loss").alias("loss"), F.sum("miss").alias("miss")).collect()}
        part = rows.select("side", "miss", F.posexplode("x")).groupBy("side", "pos").agg(F.sum(F.col("miss") * F.col("col")).alias("s")).collect()
        least = min((r["miss"] for r in sums.values()), default=0.0) if len(sums) == 2 else 0.0
        scale = {side: least / r["miss"] if r["miss"] else 0.0 for side, r in sums.items()}
        a = F.col("miss") * F.create_map(*[x for side, k in scale.items() for x in (F.lit(side), F.lit(k))])[F.col("side")]
        entropy = -F.when(a > 0, a * F.ln(a)).otherwise(0.0) - F.when(a < 1, (1 - a) * F.log1p(-a)).otherwise(0.0)
        dual_sum = (rows.agg(F.sum(entropy)).first()[0] or 0.0) if scale else 0.0
    direction, pull = [0.0] * len(weights), [0.0] * len(weights)
    for r in part:
        direction[r["pos"]] += C * r["side"] * scale[r["side"]] * r["s"]
        pull[r["pos"]] += C * r["side"] * r["s"]
    n = sum(r["n"] for r in sums.values())
    gradient = [w - g for w, g in zip(weights, pull)] + [C * sum(-side * r["miss"] for side, r in sums.items())]
    primal = 0.5 * sum(w * w for w in weights) + C * sum(r["loss"] for r in sums.values())
    dual = -0.5 * sum(d * d for d in direction) + C * dual_sum
    row = (n, max(map(abs, gradient)) / max(n, 1), (primal - dual) / max(abs(primal), 1e-300))
    return df.sparkSession.createDataFrame([row], "n_rows long, max_gradient double, relative_gap double")


def boosted_classifier(label: str, params: Mapping[str, Any], seed: int = 42, nominal: Sequence[int] = ()) -> BoostedTrees:
    """Gradient-boosted trees: ``n_estimators`` best-first trees of ``num_leaves`` leaves, ``learning_rate`` step,
    L2 penalty ``reg_lambda``, ``subsample`` row share per tree; ``nominal`` places of the vector hold codes."""
    known = {k: params[k] for k in ("n_estimators", "learning_rate", "num_leaves", "reg_lambda", "subsample") if k in params}
    return BoostedTrees(featuresCol=FEATURES, labelCol=label, params_json=json.dumps(known), seed=seed, nominal=list(nominal))


# --- F6 --------------------------------------------------------------------------
def build_pipeline(settings: Settings, kind: str, n_train: int | None = None,
                   params: Mapping[str, Any] | None = None) -> Pipeline:
    """Preprocessing + classifier as one estimator, so encoders are fitted
    on the training data of each fit only (no leakage across CV folds)."""
    mode = "baseline" if kind == "baseline" else "codes"
    asm = FeatureAssembler(numerical=settings.numerical_features,
                           categorical=settings.categorical_features, mode=mode)
    if kind == "baseline":
        clf = baseline_classifier(settings.target, n_train or 1)
    else:
        first = len(settings.numerical_features)  # numbers come first, then codes
        clf = boosted_classifier(settings.target, {**settings.hyperparameters, **(params or {})}, settings.seed,
                                 range(first, first + len(settings.categorical_features)))
    return Pipeline(stages=[asm, clf])


def fit(train: DataFrame, settings: Settings, kind: str,
        params: Mapping[str, Any] | None = None) -> PipelineModel:
    cols = [*settings.model_features, settings.target]
    data = train.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = data.count()
        return build_pipeline(settings, kind, n, params).fit(data)
    finally:
        data.unpersist()


# --- M10 -------------------------------------------------------------------------
def positive_probability(col: str = PROB) -> Column:
    return vector_to_array(F.col(col))[1]


def score(model: Transformer, df: DataFrame, keys: Sequence[str], label_text: str | None = None,
          extra: Sequence[str] = ()) -> DataFrame:
    """Batch scoring: key, positive-class probability, class, and its text."""
    out = model.transform(df)
    cols = [*[F.col(k) for k in keys], *[F.col(c) for c in extra],
            positive_probability().alias(P1), F.col("prediction").cast("int").alias("prediction")]
    if label_text:
        cols.append(decode_label(F.col("prediction")).alias(label_text))
    return out.select(*cols)


class LinearScorer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fixed-coefficient logistic scorer (no fitting): ``p = sigmoid(b +
    sum w_i x_i)``, ``prediction = p > 0.5``.  Pure expressions; used where a
    model must be reproducible outside Spark (oracle checks, stream tests)."""
    weights = Param(Params._dummy(), "weights", "column -> weight as JSON", TypeConverters.toString)
    intercept = Param(Params._dummy(), "intercept", "bias", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, weights=None, intercept=0.0):
        super().__init__()
        self._setDefault(intercept=0.0)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        import json
        w = json.loads(self.getOrDefault(self.weights))
        z = F.lit(float(self.getOrDefault(self.intercept)))
        for c, v in w.items():
            z = z + F.col(f"`{c}`").cast("double") * F.lit(float(v))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return df.withColumns({P1: p, "prediction": (p > 0.5).cast("int")})


# --- M3 --------------------------------------------------------------------------
# The tuning search space.
SEARCH_SPACE = {
    "n_estimators": ("int", 100, 500),
    "learning_rate": ("log", 0.001, 0.05),
    "num_leaves": ("int", 8, 256),
    "subsample": ("float", 0.5, 1.0),
    "reg_lambda": ("float", 0.0, 1.0),
}


def sample_trials(n_trials: int, seed: int, space: Mapping[str, tuple] = SEARCH_SPACE) -> list[dict]:
    """Seeded random search over the space (the adaptive sampler is not copied).  Each draw is the first
    52 bits of ``md5("<trial>:<name>:<seed>")``, so any engine can draw the same."""
    trials = []
    for i in range(n_trials):
        t = {}
        for name, (kind, lo, hi) in space.items():
            u = int(hashlib.md5(f"{i}:{name}:{seed}".encode()).hexdigest()[:13], 16) / 16.0 ** 13
            if kind == "int":
                t[name] = lo + int(u * (hi - lo + 1))
            elif kind == "log":
                t[name] = math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo)))
            else:
                t[name] = lo + u * (hi - lo)
        trials.append(t)
    return trials


def tune(train: DataFrame, settings: Settings, n_trials: int = 100, n_folds: int = 5, fold_col: str = "fold",
         seed: int = 42, parallelism: int | None = None, space: Mapping[str, tuple] = SEARCH_SPACE,
         max_rows: int = study.MAX_ROWS, path: str | None = None) -> tuple[list[dict], list[float]]:
    """M3: trials x folds, scored by average precision (:mod:`.study`).

    Folds come from the stratified ranking (``fold_col``), so every fold is class-balanced and the assignment
    is reproducible.  Returns the trial parameter dicts and their mean CV scores.  With a ``path``
    finished trials are kept there, and a study that starts again goes on with the others."""
    trials = sample_trials(n_trials, seed, space)
    fits = study.run(train, settings, trials, n_folds, fold_col, seed, parallelism, max_rows, path)
    means = {r["trial"]: r["score"] for r in fits.groupBy("trial").agg(F.avg("score").alias("score")).collect()}
    return trials, [float(means[i]) for i in range(n_trials)]
