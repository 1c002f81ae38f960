"""Run and model-version tables.

A tracking service is replaced by two append-only parquet tables under the
shared storage root:

* ``runs(run_id, run_name, params MAP<STRING,STRING>, metrics MAP<STRING,DOUBLE>,
  tags MAP<STRING,STRING>, start_ts, experiment, kind)`` (``kind``: study, trial or train)
* ``versions(model_name, version, alias, path, run_id, created_ts, tags MAP<STRING,STRING>)``

Lookups are ordinary DataFrame queries (filter + top-1, ``max_by``), so
they work the same over ten runs or ten million.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import claim, path_exists

RUNS_SCHEMA = ("run_id string, run_name string, params map<string,string>, "
               "metrics map<string,double>, tags map<string,string>, start_ts timestamp, "
               "experiment string, kind string")
VERSIONS_SCHEMA = ("model_name string, version bigint, alias string, path string, "
                   "run_id string, created_ts timestamp, tags map<string,string>")

#: The name pattern of tuning runs, and the metric they are ranked by.
STUDY_NAME, TUNING_METRIC = "hyperparameter_tuning_", "precision_recall_score"


# --- A8 / K3 -------------------------------------------------------------------
def cv_mean(fold_scores: DataFrame, trial: str, score: str) -> DataFrame:
    """Mean of the fold scores per trial (and how many folds)."""
    return fold_scores.groupBy(trial).agg(F.avg(score).alias("mean_score"),
                                          F.count(F.lit(1)).alias("n_folds"))


def best_trial(trials: DataFrame, trial: str, score: str) -> DataFrame:
    """K3: the maximising trial (ties: smallest trial id); one row."""
    key = F.struct(F.col(score), -F.col(trial))
    return trials.agg(F.max_by(F.col(trial), key).alias(trial), F.max(score).alias(score))


# --- K1 ------------------------------------------------------------------------
def runs_from_trials(fold_scores: DataFrame, trial: str, fold: str, score: str,
                     study: str, metric: str = "precision_recall_score") -> DataFrame:
    """Run records of a tuning study: one ``<study><trial>`` run per trial
    holding the cross-validated mean, and one child run per fold."""
    parents = cv_mean(fold_scores, trial, score).select(
        F.concat(F.lit(study), F.col(trial).cast("string")).alias("run_name"),
        F.col(trial).cast("bigint").alias("trial"),
        F.col("mean_score").alias(metric))
    children = fold_scores.select(
        F.concat(F.lit("trial_"), F.col(trial).cast("string"), F.lit("_fold_"),
                 F.col(fold).cast("string")).alias("run_name"),
        F.col(trial).cast("bigint").alias("trial"), F.col(score).alias(metric))
    return parents.unionByName(children)


def best_run(runs: DataFrame, name_like: str, metric: str) -> DataFrame:
    """K1: best run among those whose name matches ``name_like`` (SQL LIKE),
    highest ``metric`` first, ties by name; planned as a top-1
    (TakeOrderedAndProject: per-partition top-1, no full sort)."""
    return (runs.filter(F.col("run_name").like(name_like))
                .orderBy(F.col(metric).desc(), F.col("run_name")).limit(1))


def study_name(label: str) -> str:
    """Name of a tuning study's run; its trials are told apart by their kind."""
    return f"{STUDY_NAME}{label}"


def best_run_params(runs_table: DataFrame, name_like: str, metric: str,
                    defaults: Mapping[str, Any], experiment: str | None = None) -> dict[str, Any]:
    """K1 over the runs table: parameters of the best tuning run (of one
    ``experiment``), parsed back to the types of ``defaults``; ``defaults`` when
    there is none.  Runs of kind ``trial`` belong to a study and do not count."""
    runs_table = runs_table.filter(~F.col("kind").eqNullSafe("trial"))
    if experiment is not None:
        runs_table = runs_table.filter(F.col("experiment") == experiment)
    top = (runs_table.filter(F.col("run_name").like(name_like))
           .filter(F.col("metrics")[metric].isNotNull())
           .orderBy(F.col("metrics")[metric].desc(), F.col("run_id")).limit(1).collect())
    if not top:
        return dict(defaults)
    return parse_params(top[0]["params"], defaults)


def parse_params(raw: Mapping[str, str], defaults: Mapping[str, Any]) -> dict[str, Any]:
    out = dict(defaults)
    for k, v in raw.items():
        ref = defaults.get(k)
        if isinstance(ref, bool):
            out[k] = v.lower() == "true"
        elif isinstance(ref, int):
            out[k] = int(float(v))
        elif isinstance(ref, float):
            out[k] = float(v)
        else:
            try:
                out[k] = json.loads(v)
            except (ValueError, TypeError):
                out[k] = v
    return out


# --- run / version tables (P3) -----------------------------------------------
def log_runs(spark: SparkSession, root: str, records: list[dict]) -> None:
    """Append run records (a handful of rows per job) to ``<root>/runs``."""
    rows = []
    for r in records:
        rows.append((r.get("run_id") or uuid.uuid4().hex, r["run_name"],
                     {k: str(v) for k, v in (r.get("params") or {}).items()},
                     {k: float(v) for k, v in (r.get("metrics") or {}).items()},
                     {k: str(v) for k, v in (r.get("tags") or {}).items()},
                     None, r.get("experiment"), r.get("kind") or "train"))
    df = spark.createDataFrame(rows, RUNS_SCHEMA).withColumn("start_ts", F.current_timestamp())
    df.coalesce(1).write.mode("append").parquet(f"{root}/runs")


def _read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, empty only if its path does not exist; any other failure is raised."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return _read_table(spark, f"{root}/runs", RUNS_SCHEMA)


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    return _read_table(spark, f"{root}/versions", VERSIONS_SCHEMA)


def claim_version(spark: SparkSession, root: str, model_name: str) -> int:
    """The next version number of a model, held by a marker file, so that two
    writers never get the same one."""
    last = read_versions(spark, root).filter(F.col("model_name") == model_name).agg(F.max("version")).head()[0]
    version = 1 if last is None else int(last) + 1
    while not claim(spark, f"{root}/version_claims/{model_name}/{version}"):
        version += 1
    return version


def register_version(spark: SparkSession, root: str, model_name: str, path: str, run_id: str,
                     alias: str = "latest-model", version: int | None = None,
                     tags: Mapping[str, str] | None = None) -> int:
    """Record ``version`` (claimed now, if not given); the alias moves to it
    (the newest row for an alias wins in :func:`latest_version`)."""
    if version is None:
        version = claim_version(spark, root, model_name)
    row = (model_name, version, alias, path, run_id, None, {k: str(v) for k, v in (tags or {}).items()})
    df = spark.createDataFrame([row], VERSIONS_SCHEMA).withColumn("created_ts", F.current_timestamp())
    df.coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return version


def latest_version(versions: DataFrame, model_name: str | None = None,
                   alias: str = "latest-model") -> DataFrame:
    """K2: per model, the version the alias points to (its newest assignment)."""
    v = versions.filter(F.col("alias") == alias)
    if model_name is not None:
        v = v.filter(F.col("model_name") == model_name)
    return v.groupBy("model_name").agg(
        F.max_by(F.struct("version", "path", "run_id"), F.struct("version", "created_ts")).alias("v")
    ).select("model_name", "v.version", "v.path", "v.run_id")


def promotion_sequence(results: DataFrame, order_col: str, score_col: str, model_name: str,
                       alias: str = "latest-model") -> DataFrame:
    """Versions produced by gating a sequence of candidates in ``order_col``
    order: each is promoted when its score is >= the current champion's (the
    best promoted so far; ties promote, the first always does).  Promoted
    candidates get versions 1, 2, ... and the alias.

    The window runs over the candidates table (one row per training run),
    whose size is the number of runs, not the data.
    """
    prior = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    promoted = (results.withColumn("_best_before", F.max(score_col).over(prior))
                .filter(F.col("_best_before").isNull() | (F.col(score_col) >= F.col("_best_before"))))
    return promoted.select(
        F.lit(model_name).alias("model_name"),
        F.row_number().over(Window.orderBy(order_col)).cast("bigint").alias("version"),
        F.lit(alias).alias("alias"),
        F.concat(F.lit(f"models/{model_name}/"), F.col(order_col).cast("string")).alias("path"),
        F.col(order_col).cast("string").alias("run_id"),
        F.lit(None).cast("timestamp").alias("created_ts"))


def timestamp_label() -> str:
    return time.strftime("%Y%m%d_%H%M%S", time.gmtime())
