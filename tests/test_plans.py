"""Physical-plan checks: the properties that matter at scale."""

import re

from pyspark.sql import functions as F

from lendscore.operators import metrics, split
from lendscore.plans import catalog
from tests.conftest import SF_SMALL

PY_EVAL = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


def executed(df) -> str:
    df.count()  # run once so the adaptive plan is final
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_table_jvm_only_and_pruned(spark):
    plan = executed(catalog.feature_rows(spark, SF_SMALL))
    assert not any(p in plan for p in PY_EVAL)
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", catalog.feature_rows(spark, SF_SMALL)
                       ._jdf.queryExecution().executedPlan().toString())
    assert scans and all("o_orderdate" not in s and "c_name" not in s for s in scans)


def test_select_prunes_scan(spark):
    df = catalog.feature_rows(spark, SF_SMALL).select("CustomerId", "Risk")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "o_totalprice" not in s and "c_acctbal" not in s


def test_split_windows_are_bucketed(spark):
    df = split.stratified_split(catalog.feature_rows(spark, SF_SMALL), "CustomerId", "Risk")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the row-level window is partitioned by (class, hash bucket), never by class alone
    row_windows = [l for l in plan.splitlines() if "Window [" in l and "_h" in l]
    assert row_windows and all("_bkt" in l for l in row_windows)
    assert "SinglePartition" not in plan


def test_metric_curve_is_range_bucketed(spark):
    f = catalog.feature_rows(spark, SF_SMALL).withColumn("s", F.col("Duration") / 100)
    c = metrics.score_curve(f, "Risk", "s")
    plan = c._jdf.queryExecution().executedPlan().toString()
    row_windows = [l for l in plan.splitlines() if "Window [" in l and "score" in l]
    # partitioned by the range bucket (copied into _bkt), not one global window
    assert row_windows and all(re.search(r"\], \[_bkt#\d+\], \[score", l) for l in row_windows)


def test_scoring_has_no_python(spark):
    df = catalog.linear_scorer().transform(catalog.feature_rows(spark, SF_SMALL))
    plan = executed(df)
    assert not any(p in plan for p in PY_EVAL)


def test_tune_trials_runs_the_whole_study(monkeypatch):
    """The registered study has the defaults of ``models.tune``: trials, folds and space."""
    import inspect

    from lendscore.plans import catalog

    seen = {}

    def tune(*args, **kwargs):
        bound = inspect.signature(whole).bind(*args, **kwargs)
        bound.apply_defaults()
        seen.update(bound.arguments)
        return [], []

    whole = catalog.models.tune
    monkeypatch.setattr(catalog.models, "tune", tune)
    monkeypatch.setattr(catalog, "train_rows", lambda spark, sf_dir: None)

    class Session:
        def createDataFrame(self, rows, schema):
            return rows

    catalog.tune_trials(Session(), "")
    assert seen["n_trials"] == 100 and seen["n_folds"] == 5 and seen["space"] == catalog.models.SEARCH_SPACE
