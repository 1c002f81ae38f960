"""Settings files and the command line of the jobs."""

import json
import tempfile

import pytest

from lendscore.config import settings_from_file
from lendscore.operators import registry
from lendscore.plans import jobs
from lendscore.session import path_exists
from lendscore.sources.applications import applications
from tests.conftest import SF_SMALL

CONFIG = """
numerical_features = ["Credit_amount", "Age"]
categorical_features = ["Sex", "Job"]
target = "Risk"
primary_keys = ["CustomerId"]
n_folds = 2
[hyperparameters]
n_estimators = 2
learning_rate = 0.1
[test]
model_name = "small-model"
"""


def write(text, suffix):
    path = tempfile.mkdtemp(prefix="config-") + f"/settings.{suffix}"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_environment_wins_and_unknown_names_fail():
    s = settings_from_file(write(CONFIG, "toml"), "test")
    assert (s.model_name, s.n_folds, s.catalog_name) == ("small-model", 2, "lendscore_test")
    assert settings_from_file(write(CONFIG, "toml"), "dev").model_name != "small-model"
    with pytest.raises(ValueError, match="no_such"):
        settings_from_file(write(json.dumps({"no_such": 1}), "json"))


def test_all_jobs_from_the_command_line(spark, capsys):
    root, config = tempfile.mkdtemp(prefix="project-"), write(CONFIG, "toml")
    applications(spark, SF_SMALL).write.option("header", "true").csv(f"{root}/raw")
    common = ["--root", root, "--config", config, "--env", "test"]
    assert jobs.main(["extract", *common, "--input", f"{root}/raw"]) == 0
    # CSV without a schema is text; numbers are needed from here on.
    from pyspark.sql import functions as F

    from lendscore.sources import tables
    text = tables.read_snapshot(spark, f"{root}/features")
    tables.write_snapshot(text.select(*[F.col(c).cast("int").alias(c) if c in ("CustomerId", "Age", "Job") else
                                        F.col(c).cast("double").alias(c) if c == "Credit_amount" else c
                                        for c in text.columns]), f"{root}/features")
    assert jobs.main(["train_baseline", *common]) == 0
    status = jobs.main(["train_and_score", *common])
    assert status in (0, jobs.NOT_PROMOTED)
    assert path_exists(spark, f"{root}/scores") == (status == 0)
    assert jobs.main(["score", *common]) == 0
    assert spark.read.parquet(f"{root}/scores").count() == text.count()
    assert registry.read_versions(spark, root).filter("model_name = 'small-model'").count() == 1 + (status == 0)
    with pytest.raises(SystemExit):
        jobs.main(["score"])


def test_tuned_parameters_reach_training(spark):
    from lendscore.config import Tags, credit_settings
    from lendscore.plans.catalog import feature_rows
    from lendscore.sources import tables
    root = tempfile.mkdtemp(prefix="project-")
    p = jobs.project(spark, credit_settings("test", n_folds=2), root)
    tables.write_snapshot(feature_rows(spark, SF_SMALL), p.features_path)
    space = {"n_estimators": ("int", 2, 3), "learning_rate": ("log", 0.1, 0.2), "num_leaves": ("int", 4, 4),
             "subsample": ("float", 0.9, 1.0)}
    best = jobs.tune_job(p, Tags("x", "y"), n_trials=2, parallelism=2, space=space)
    out = jobs.train_boosted_job(p, Tags("x", "y"))
    assert {k: out["params"][k] for k in best["best_params"]} == pytest.approx(best["best_params"])
    runs = registry.read_runs(spark, root)
    assert runs.filter("kind = 'trial'").count() == 2 and runs.filter("kind = 'study'").count() == 1
