import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lendscore.config import Tags, credit_settings
from lendscore.operators import registry
from lendscore.plans import jobs
from lendscore.sources import tables
from lendscore.sources.applications import applications
from lendscore.sources.tables import key_violations
from tests.conftest import SF_SMALL


def test_best_run_and_defaults(spark):
    root = tempfile.mkdtemp(prefix="runs-")
    defaults = {"n_estimators": 100, "learning_rate": 0.01}
    assert registry.best_run_params(registry.read_runs(spark, root), "hyperparameter_tuning_%",
                                    "precision_recall_score", defaults) == defaults
    registry.log_runs(spark, root, [
        {"run_name": "hyperparameter_tuning_a", "params": {"n_estimators": 300, "learning_rate": 0.02},
         "metrics": {"precision_recall_score": 0.4}},
        {"run_name": "hyperparameter_tuning_b", "params": {"n_estimators": 200, "learning_rate": 0.03},
         "metrics": {"precision_recall_score": 0.5}},
        {"run_name": "child_trial", "params": {"n_estimators": 999}, "metrics": {"precision_recall_score": 0.9}},
    ])
    best = registry.best_run_params(registry.read_runs(spark, root), "hyperparameter_tuning_%",
                                    "precision_recall_score", defaults)
    assert best == {"n_estimators": 200, "learning_rate": 0.03}       # typed, child excluded


def test_versions_and_alias(spark):
    root = tempfile.mkdtemp(prefix="versions-")
    assert registry.register_version(spark, root, "m", "/p1", "r1") == 1
    assert registry.register_version(spark, root, "m", "/p2", "r2") == 2
    assert registry.register_version(spark, root, "other", "/q1", "r3") == 1
    v = {r.model_name: (r.version, r.path) for r in registry.latest_version(registry.read_versions(spark, root)).collect()}
    assert v == {"m": (2, "/p2"), "other": (1, "/q1")}


def test_best_trial_ties(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.7), (2, 0.7)], "trial int, s double")
    r = registry.best_trial(df, "trial", "s").head()
    assert (r.trial, r.s) == (1, 0.7)


def test_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    got = {r.rule: r.violations for r in key_violations(df, ["k"]).collect()}
    assert got == {"not_null:k": 1, "primary_key:k": 2}


def test_jobs_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="project-")
    s = credit_settings("test", hyperparameters={"n_estimators": 5, "learning_rate": 0.1})
    p = jobs.project(spark, s, root)
    csv = f"{root}/raw_csv"
    raw = applications(spark, SF_SMALL)
    raw.write.option("header", "true").csv(csv)
    assert jobs.extract_csv(p, csv, schema=raw.schema) == 0
    tags = Tags("abc123", "main")
    base = jobs.train_baseline_job(p, tags)
    assert base["version"] == 1 and base["promoted"]
    boost = jobs.train_boosted_job(p, tags)
    assert isinstance(boost["promoted"], bool)
    scores = jobs.score_job(p)
    n = tables.read_snapshot(spark, p.features_path).count()
    assert scores.count() == n
    assert {r[0] for r in scores.select("Credit risk prediction").distinct().collect()} <= {"bad", "good"}
    with pytest.raises(ValueError, match="missing column"):
        v = registry.latest_version(registry.read_versions(spark, root)).head()
        jobs.check_schema(scores, jobs.model_schema(p, v.path))
    # J5 streaming: files landing in a folder are scored by the registered model
    src = f"{root}/incoming"
    tables.read_snapshot(spark, p.features_path).write.parquet(src)
    streamed = jobs.stream_score_job(p, src, f"{root}/stream_out", f"{root}/stream_ck")
    assert sorted(map(tuple, streamed.select("CustomerId", "prediction").collect())) == \
        sorted(map(tuple, scores.select("CustomerId", "prediction").collect()))
    runs = registry.read_runs(spark, root)
    assert runs.filter(F.col("run_name").startswith("train_")).count() == 2
    lineage = spark.read.parquet(f"{root}/lineage")
    assert lineage.filter("context = 'training'").count() == 2


def test_schema_check_is_one_way(spark):
    want = jobs.capture_schema(spark.createDataFrame([], "a int, b double"), ["a", "b"])
    with pytest.raises(ValueError, match="column a"):
        jobs.check_schema(spark.createDataFrame([], "a double, b double"), want)
    got = jobs.check_schema(spark.createDataFrame([(7, 1, 2)], "k long, a smallint, b int"), want, keep=["k"])
    assert got.dtypes == [("k", "bigint"), ("a", "int"), ("b", "double")]


def test_unreadable_table_is_no_empty_table(spark):
    root = tempfile.mkdtemp(prefix="broken-")
    assert registry.read_versions(spark, root).count() == 0
    os.makedirs(f"{root}/versions")
    with open(f"{root}/versions/part-0.parquet", "w") as fh:
        fh.write("no parquet")
    with pytest.raises(Exception):
        registry.register_version(spark, root, "m", "/p", "r")


def test_two_writers_get_two_versions(spark):
    root = tempfile.mkdtemp(prefix="versions-")
    assert registry.claim_version(spark, root, "m") == 1
    assert registry.claim_version(spark, root, "m") == 2
    registry.register_version(spark, root, "m", "/p2", "r", version=2, tags={"git_sha": "x"})
    row = registry.latest_version(registry.read_versions(spark, root), "m").head()
    assert (row.version, row.path) == (2, "/p2")
    assert registry.claim_version(spark, root, "m") == 3


def test_trials_and_other_experiments_do_not_win(spark):
    root = tempfile.mkdtemp(prefix="runs-")
    name, metric = registry.study_name("x"), registry.TUNING_METRIC
    registry.log_runs(spark, root, [
        {"run_name": name, "kind": "study", "experiment": "e", "params": {"n_estimators": 7}, "metrics": {metric: 0.5}},
        {"run_name": f"{name}/trial_0", "kind": "trial", "experiment": "e", "params": {"n_estimators": 9}, "metrics": {metric: 0.9}},
        {"run_name": name, "kind": "study", "experiment": "f", "params": {"n_estimators": 8}, "metrics": {metric: 0.8}}])
    best = registry.best_run_params(registry.read_runs(spark, root), f"{registry.STUDY_NAME}%", metric, {"n_estimators": 1}, "e")
    assert best == {"n_estimators": 7}


def test_settings_env():
    with pytest.raises(ValueError):
        credit_settings("staging")
    assert credit_settings("prod").catalog_name == "lendscore_prod"


def test_saved_model_holds_its_dictionaries(spark):
    from pyspark.ml import PipelineModel

    from lendscore.operators import features
    root = tempfile.mkdtemp(prefix="model-")
    df = spark.range(40).select(F.concat(F.lit("k"), "id").alias("k"))
    model = PipelineModel([features.CategoryCodes(inputCols=["k"], outputCols=["c"], maxCategories=10).fit(df)])
    want = sorted(map(tuple, model.transform(df).collect()))
    jobs.own_dictionaries(spark, model, f"{root}/dictionaries").save(f"{root}/pipeline")
    loaded = PipelineModel.load(f"{root}/pipeline")
    assert root in loaded.stages[0].getOrDefault("state")
    assert sorted(map(tuple, loaded.transform(df).collect())) == want
