import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendscore.config import credit_settings
from lendscore.functions.columns import hash_unit
from lendscore.operators import metrics, models, split
from lendscore.plans import catalog
from tests.conftest import SF_SMALL


def learnable(spark):
    """Feature rows with a label drawn from a known logistic rule."""
    f = catalog.feature_rows(spark, SF_SMALL)
    z = (F.col("Duration") - 40) / 10 + (F.col("Saving_accounts_ordinal_enc") - 1.5)
    p = 1 / (1 + F.exp(-z))
    return f.withColumn("Risk", (hash_unit(F.col("CustomerId"), 5) < p).cast("int"))


def test_logistic_matches_l2_objective(spark):
    s = credit_settings()
    df = learnable(spark)
    sp = split.stratified_split(df, "CustomerId", "Risk")
    train = sp.filter(~F.col("is_test"))
    m = models.fit(train, s, "baseline")
    asm, lr = m.stages[0], m.stages[-1]
    X = np.array([r[0] for r in asm.transform(train).select(vector_to_array("features")).collect()])
    y = np.array([r.Risk for r in train.select("Risk").collect()], dtype=float)
    w, b = lr.coefficients.toArray(), lr.intercept
    p = 1 / (1 + np.exp(-(X @ w + b)))
    # gradient of 0.5||w||^2 + C * sum(logloss) (C = 1), intercept unpenalised
    gw = w + X.T @ (p - y)
    gb = np.sum(p - y)
    scale = len(y)
    assert np.max(np.abs(gw)) / scale < 1e-4 and abs(gb) / scale < 1e-4


def test_boosted_learns_signal(spark):
    s = credit_settings(hyperparameters={"n_estimators": 15, "learning_rate": 0.3, "num_leaves": 8})
    df = learnable(spark)
    sp = split.stratified_split(df, "CustomerId", "Risk")
    m = models.fit(sp.filter(~F.col("is_test")), s, "boosted")
    test = sp.filter("is_test")
    scored = models.score(m, test, ["CustomerId"], extra=["Risk"], label_text="txt")
    ap = metrics.average_precision(scored, "Risk", models.P1).head()[0]
    base = test.agg(F.avg("Risk")).head()[0]
    assert ap > base + 0.1
    assert {r.txt for r in scored.collect()} <= {"bad", "good"}


def test_tune_small_study(spark):
    s = credit_settings()
    sp = split.stratified_split(learnable(spark), "CustomerId", "Risk", n_folds=3)
    space = dict(models.SEARCH_SPACE, n_estimators=("int", 3, 5))
    trials, scores = models.tune(sp.filter(~F.col("is_test")), s, n_trials=2, n_folds=3, space=space)
    assert len(trials) == len(scores) == 2
    assert all(0 <= v <= 1 for v in scores)
    assert all(100 > t["n_estimators"] >= 3 and 0.001 <= t["learning_rate"] <= 0.05 for t in trials)
    assert models.sample_trials(2, 42) == models.sample_trials(2, 42)

