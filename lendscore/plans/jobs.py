"""End-to-end jobs J1-J5 (plain ``spark-submit`` entry points).

Each job reads and writes tables under one project root on shared storage
(``<root>/features``, ``<root>/splits``, ``<root>/runs``, ``<root>/versions``,
``<root>/models/<name>/<version>``, ``<root>/scores``); the snapshot a job
reads is resolved *before* reading and recorded with the run.

Support steps: P1 schema capture/check (``schema.json`` beside each model),
P2 whole-pipeline save/load (``PipelineModel``), P3 version registration.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import CREDIT_RULES, FeatureRules, Settings, Tags, credit_settings, settings_from_file
from ..operators import clean, metrics, models, registry, split, study
from ..operators.features import CategoryCodesModel
from ..session import Intermediates, get_spark, path_exists, publish, storage_root
from ..sources import files, tables
from ..streaming import scoring


@dataclass
class Project:
    spark: SparkSession
    settings: Settings
    root: str

    @property
    def features_path(self) -> str:
        return f"{self.root}/features"

    def model_path(self, version: int) -> str:
        return f"{self.root}/models/{self.settings.model_name}/v{version}"


def project(spark: SparkSession, settings: Settings, root: str | None = None) -> Project:
    root = root or f"{storage_root(spark)}/{settings.catalog_name}/{settings.schema_name}"
    return Project(spark, settings, root.rstrip("/"))


# --- P1 ---------------------------------------------------------------------------
def capture_schema(df: DataFrame, columns: list[str]) -> str:
    return df.select(*columns).schema.json()


# (input, model) types between which every value keeps its meaning.
_SAFE_WIDENING = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("tinyint", "double"),
                  ("smallint", "int"), ("smallint", "bigint"), ("smallint", "double"),
                  ("int", "bigint"), ("int", "double"), ("bigint", "double"), ("float", "double")}


def check_schema(df: DataFrame, schema_json: str, keep: Sequence[str] = ()) -> DataFrame:
    """The model's input columns, and those to ``keep``; a missing column or
    a type that the model's cannot hold is an error, extra columns are
    left out, safe widenings are cast."""
    want = StructType.fromJson(json.loads(schema_json))
    have = {f.name: f.dataType for f in df.schema.fields}
    cols, problems = [], []
    for f in want.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
            continue
        a, b = have[f.name].simpleString(), f.dataType.simpleString()
        if a != b and (a, b) not in _SAFE_WIDENING:
            problems.append(f"column {f.name}: {a} does not match {b}")
        cols.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
    if problems:
        raise ValueError("input does not match the model signature: " + "; ".join(problems))
    return df.select(*[F.col(f"`{c}`") for c in keep if c not in {f.name for f in want.fields}], *cols)


# --- J1 extract -------------------------------------------------------------------
def extract(p: Project, raw: DataFrame, rules: FeatureRules = CREDIT_RULES) -> int:
    """Raw rows -> normalised headers -> cleaned/encoded feature table,
    written as a new snapshot; the key constraints are checked on the stored rows
    before they are published (raise on violation)."""
    return tables.write_snapshot(clean.feature_table(raw, rules), p.features_path,
                                 keys=p.settings.primary_keys)


def extract_csv(p: Project, path: str, schema: StructType | str | None = None) -> int:
    return extract(p, files.read_csv(p.spark, path, schema=schema))


# --- J2 / J3 / J4 shared -----------------------------------------------------------
def load_split(p: Project) -> tuple[DataFrame, DataFrame, int]:
    """Resolve the newest snapshot first, then read exactly that snapshot."""
    snap = tables.latest_snapshot_id(p.spark, p.features_path)
    if snap is None:
        raise FileNotFoundError(f"no feature snapshot under {p.features_path}")
    s = p.settings
    feats = tables.read_snapshot(p.spark, p.features_path, snap)
    spec = f"{s.target}-{s.test_fraction}-{s.n_folds}-{s.seed}"
    path = f"{p.root}/splits/snapshot={snap}/{spec}"
    if not path_exists(p.spark, path):  # the split is a function of snapshot and spec: write it once
        staged = f"{p.root}/splits/_staging/{uuid.uuid4().hex}"
        split.stratified_split(feats, s.primary_keys, s.target, s.test_fraction, s.n_folds, s.seed).write.parquet(staged)
        try:
            publish(p.spark, staged, path)
        except FileExistsError:  # another job has published the same rows meanwhile
            pass
    sp = p.spark.read.parquet(path)
    return sp.filter(~F.col("is_test")), sp.filter(F.col("is_test")), snap


def tune_job(p: Project, tags: Tags, n_trials: int = 100, parallelism: int | None = None, space=models.SEARCH_SPACE,
             lease_seconds: float = study.LEASE_SECONDS) -> dict:
    """Random-search CV; one run per trial, recorded when its wave ends, plus the study run (best params).

    The study is known by its snapshot, seed and space: a job that starts again after a failure fits only the
    trials that have no result yet."""
    train, _, snap = load_split(p)
    s = p.settings
    trials = models.sample_trials(n_trials, s.seed, space)
    spec = json.dumps([trials, s.n_folds, s.seed, s.model_features, s.target], sort_keys=True)
    path = f"{p.root}/studies/snapshot={snap}/{hashlib.md5(spec.encode()).hexdigest()}"
    name = registry.study_name(registry.timestamp_label())
    common = {"tags": tags.to_dict(), "experiment": s.experiment_name}

    def record(scores: dict[int, float]) -> None:
        registry.log_runs(p.spark, p.root, [
            {"run_name": f"{name}/trial_{i}", "params": trials[i], "kind": "trial", **common,
             "metrics": {registry.TUNING_METRIC: score}} for i, score in sorted(scores.items())])

    fits = study.run(train, s, trials, s.n_folds, "fold", s.seed, parallelism, path=path, lease_seconds=lease_seconds, on_wave=record)
    cv = registry.cv_mean(fits, "trial", "score")
    best = registry.best_trial(cv.withColumnRenamed("mean_score", "score"), "trial", "score").first()
    registry.log_runs(p.spark, p.root, [{"run_name": name, "params": trials[best["trial"]], "kind": "study", **common,
                                         "metrics": {registry.TUNING_METRIC: best["score"], "feature_snapshot": snap}}])
    return {"best_params": trials[best["trial"]], "best_score": best["score"]}


def _evaluate_and_log(p: Project, model: PipelineModel, kind: str, train: DataFrame, test: DataFrame,
                      snap: int, tags: Tags, params: dict) -> tuple[str, dict]:
    s = p.settings
    run_id = uuid.uuid4().hex
    with Intermediates(p.spark) as own:
        scored = own.store(models.score(model, test, s.primary_keys, extra=[s.target]), "scored")
        m = metrics.classifier_metrics(scored, s.target, models.P1).head().asDict()
    lineage = tables.dataset_lineage([("features", train.drop("is_test", "fold"), "training", snap),
                                      ("features", test.drop("is_test", "fold"), "testing", snap)], run_id)
    lineage.write.mode("append").parquet(f"{p.root}/lineage")
    registry.log_runs(p.spark, p.root, [{"run_id": run_id, "run_name": f"train_{kind}",
                                         "params": params, "metrics": m, "tags": tags.to_dict(),
                                         "experiment": s.experiment_name}])
    return run_id, m


def own_dictionaries(spark: SparkSession, model: PipelineModel, path: str) -> PipelineModel:
    """Copy the dictionary tables of ``model``'s encoders under ``path`` and point the
    stages there, so that the saved folder is the whole model."""
    for stage in model.stages:
        if isinstance(stage, PipelineModel):
            own_dictionaries(spark, stage, path)
        elif isinstance(stage, CategoryCodesModel):
            state = json.loads(stage.getOrDefault(stage.state))
            for column, known in state.items():
                if "path" in known:
                    copy = f"{path}/{stage.uid}/{column}"
                    spark.read.parquet(known["path"]).write.parquet(copy)
                    known["path"] = copy
            stage.set(stage.state, json.dumps(state))
    return model


def _save_model(p: Project, model: PipelineModel, train: DataFrame, run_id: str, tags: Tags) -> tuple[int, str]:
    """Claim a version, save the model under it, then record it: a version is never seen unsaved."""
    s = p.settings
    version = registry.claim_version(p.spark, p.root, s.model_name)
    path = p.model_path(version)
    own_dictionaries(p.spark, model, f"{path}/dictionaries").save(f"{path}/pipeline")
    p.spark.createDataFrame([(capture_schema(train, s.model_features),)], "schema string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/schema")
    scored = models.score(model, train.limit(0), s.primary_keys, label_text=PREDICTION)
    p.spark.createDataFrame([(scored.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(f"{path}/output")
    registry.register_version(p.spark, p.root, s.model_name, path, run_id, version=version, tags=tags.to_dict())
    return version, path


def train_baseline_job(p: Project, tags: Tags) -> dict:
    """Logistic baseline, always registered."""
    train, test, snap = load_split(p)
    model = models.fit(train, p.settings, "baseline")
    run_id, m = _evaluate_and_log(p, model, "baseline", train, test, snap, tags, {"C": 1.0})
    version, _ = _save_model(p, model, train, run_id, tags)
    return {"version": version, "metrics": m, "promoted": True}


def train_boosted_job(p: Project, tags: Tags, gate_metric: str = "pr_auc") -> dict:
    """Boosted trees with the best tuned parameters (config defaults when
    none), gated against the current champion on the same test rows."""
    s = p.settings
    train, test, snap = load_split(p)
    params = registry.best_run_params(registry.read_runs(p.spark, p.root), f"{registry.STUDY_NAME}%",
                                      registry.TUNING_METRIC, s.hyperparameters, s.experiment_name)
    # Only what the classifier uses is passed on and logged.
    params = {k: v for k, v in params.items() if k in models.SEARCH_SPACE or k in s.hyperparameters}
    model = models.fit(train, s, "boosted", params)
    run_id, m = _evaluate_and_log(p, model, "boosted", train, test, snap, tags, params)
    champion = registry.latest_version(registry.read_versions(p.spark, p.root), s.model_name).head()
    if champion is None:
        promote = True
    else:
        old = load_model(p, champion.path)
        # Both models score the same row, one after the other: no join.
        first = models.score(model, test, test.columns).withColumnRenamed(models.P1, "new").select(*test.columns, "new")
        both = models.score(old, first, s.primary_keys, extra=[s.target, "new"]).withColumnRenamed(models.P1, "old")
        gate = metrics.promotion_gate(both, s.target, "new", "old", gate_metric).head()
        promote = bool(gate.promote)
    out = {"metrics": m, "promoted": promote, "params": params}
    if promote:
        out["version"], _ = _save_model(p, model, train, run_id, tags)
    return out


# --- J5 / P2 -------------------------------------------------------------------------
def load_model(p: Project, path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/pipeline")


def model_schema(p: Project, path: str) -> str:
    return p.spark.read.text(f"{path}/schema").head()[0]


def model_output(p: Project, path: str) -> StructType:
    """Names and types of what the model's scoring returns, as captured when it was saved."""
    return StructType.fromJson(json.loads(p.spark.read.text(f"{path}/output").head()[0]))


def score_job(p: Project, source: DataFrame | None = None) -> DataFrame:
    """J5 (batch): score with the version the alias points to."""
    s = p.settings
    v = registry.latest_version(registry.read_versions(p.spark, p.root), s.model_name).head()
    if v is None:
        raise LookupError(f"no registered version of {s.model_name}")
    model = load_model(p, v.path)
    data = source if source is not None else tables.read_snapshot(p.spark, p.features_path)
    data = check_schema(data, model_schema(p, v.path), keep=s.primary_keys)
    out = models.score(model, data, s.primary_keys, label_text=PREDICTION)
    want, have = ([(f.name, f.dataType.simpleString()) for f in t.fields] for t in (model_output(p, v.path), out.schema))
    if want != have:
        raise ValueError(f"scores {have} do not match the model signature {want}")
    return out


def stream_score_job(p: Project, source: str, sink: str, checkpoint: str) -> DataFrame:
    """J5 (streaming): score files as they land, exactly once per input row."""
    s = p.settings
    v = registry.latest_version(registry.read_versions(p.spark, p.root), s.model_name).head()
    if v is None:
        raise LookupError(f"no registered version of {s.model_name}")
    model = load_model(p, v.path)
    schema = p.spark.read.parquet(source).schema
    check_schema(p.spark.createDataFrame([], schema), model_schema(p, v.path))
    return scoring.run_available_now(p.spark, source, schema, model, s.primary_keys, models.P1,
                                     sink, checkpoint)


def champion_resolver(p: Project, schema: StructType):
    """``() -> (version, model)`` of the version that the alias points to now; a version is loaded, and its
    signature checked against ``schema``, once."""
    known: dict[int, PipelineModel] = {}

    def resolve() -> tuple[int, PipelineModel]:
        v = registry.latest_version(registry.read_versions(p.spark, p.root), p.settings.model_name).head()
        if v is None:
            raise LookupError(f"no registered version of {p.settings.model_name}")
        if v.version not in known:
            check_schema(p.spark.createDataFrame([], schema), model_schema(p, v.path))
            known.clear()
            known[v.version] = load_model(p, v.path)
        return v.version, known[v.version]

    return resolve


def follow_champion_job(p: Project, source: str, sink: str, checkpoint: str, available_now: bool = True,
                        max_files_per_trigger: int | None = None):
    """J5 (streaming): as :func:`stream_score_job`, but a version promoted meanwhile scores the next micro-batch."""
    schema = p.spark.read.parquet(source).schema
    return scoring.follow_champion(p.spark, source, schema, champion_resolver(p, schema), p.settings.primary_keys, models.P1,
                                   sink, checkpoint, available_now=available_now, max_files_per_trigger=max_files_per_trigger)


#: Column of the decoded class.
PREDICTION = "Credit risk prediction"
#: Exit status of a training job whose model was not promoted.
NOT_PROMOTED = 3


def main(argv: list[str] | None = None) -> int:
    """One job; 0, or :data:`NOT_PROMOTED`.  ``train_and_score`` scores only
    what it has just promoted."""
    ap = argparse.ArgumentParser(description="lendscore jobs")
    ap.add_argument("job", choices=["extract", "tune", "train_baseline", "train_boosted", "score", "train_and_score"])
    ap.add_argument("--root", required=True, help="project folder on storage that all executors share")
    ap.add_argument("--config", default=None, help="TOML or JSON settings; the credit settings, if left out")
    ap.add_argument("--env", default="dev")
    ap.add_argument("--input", default=None, help="CSV path for extract")
    ap.add_argument("--output", default=None, help="scores output path")
    ap.add_argument("--git_sha", default="unknown")
    ap.add_argument("--branch", default="unknown")
    ap.add_argument("--run_id", default=None)
    ap.add_argument("--trials", type=int, default=100)
    a = ap.parse_args(argv)
    settings = settings_from_file(a.config, a.env) if a.config else credit_settings(a.env)
    p = project(get_spark(), settings, a.root)
    tags = Tags(a.git_sha, a.branch, a.run_id)
    if a.job == "extract":
        result = {"snapshot": extract_csv(p, a.input)}
    elif a.job == "tune":
        result = tune_job(p, tags, n_trials=a.trials)
    elif a.job == "train_baseline":
        result = train_baseline_job(p, tags)
    elif a.job == "score":
        result = {"promoted": True}
    else:
        result = train_boosted_job(p, tags)
    if a.job == "score" or a.job == "train_and_score" and result["promoted"]:
        score_job(p).write.mode("overwrite").parquet(a.output or f"{p.root}/scores")
    print(json.dumps(result, default=str))
    return 0 if result.get("promoted", True) else NOT_PROMOTED


if __name__ == "__main__":
    raise SystemExit(main())
