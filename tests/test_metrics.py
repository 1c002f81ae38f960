import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lendscore.operators import metrics


def brute(labels, scores):
    """Direct definitions over sorted distinct thresholds."""
    P = sum(labels)
    N = len(labels) - P
    thr = sorted(set(scores), reverse=True)
    ap, pr, prev_p, prev_r, tp, fp = 0.0, 0.0, 1.0, 0.0, 0, 0
    for t in thr:
        tp += sum(1 for y, s in zip(labels, scores) if s == t and y == 1)
        fp += sum(1 for y, s in zip(labels, scores) if s == t and y == 0)
        p, r = tp / (tp + fp), tp / P
        ap += (r - prev_r) * p
        pr += (r - prev_r) * (p + prev_p) / 2
        prev_p, prev_r = p, r
    auc = 0.0
    for yp, sp in zip(labels, scores):
        if yp != 1:
            continue
        for yn, sn in zip(labels, scores):
            if yn == 0:
                auc += 1.0 if sp > sn else 0.5 if sp == sn else 0.0
    return ap, auc / (P * N), pr


def _df(spark, labels, scores, group=None):
    rows = [(g if group else "x", y, s) for g, y, s in zip(group or [None] * len(labels), labels, scores)]
    return spark.createDataFrame(rows, "g string, y int, s double")


def test_ranking_metrics_with_ties(spark):
    rnd = random.Random(3)
    labels = [rnd.randint(0, 1) for _ in range(300)]
    scores = [round(rnd.random() * 0.6 + 0.3 * y, 1) for y in labels]   # many ties
    r = metrics.ranking_metrics(_df(spark, labels, scores), "y", "s").head()
    ap, auc, pr = brute(labels, scores)
    assert abs(r.average_precision - ap) < 1e-12
    assert abs(r.roc_auc - auc) < 1e-12
    assert abs(r.pr_auc - pr) < 1e-12


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 5)), min_size=2, max_size=40))
def test_ranking_metrics_property(spark, pairs):
    labels = [p[0] for p in pairs]
    if len(set(labels)) < 2:
        return
    scores = [p[1] / 5 for p in pairs]
    r = metrics.ranking_metrics(_df(spark, labels, scores), "y", "s").head()
    ap, auc, pr = brute(labels, scores)
    assert math.isclose(r.average_precision, ap, abs_tol=1e-12)
    assert math.isclose(r.roc_auc, auc, abs_tol=1e-12)


def test_grouped_metrics(spark):
    labels = [1, 0, 1, 0, 1, 1, 0, 0]
    scores = [0.9, 0.8, 0.7, 0.1, 0.2, 0.3, 0.4, 0.5]
    groups = ["a"] * 4 + ["b"] * 4
    got = {r.g: r.roc_auc for r in metrics.roc_auc(_df(spark, labels, scores, groups), "y", "s", ["g"]).collect()}
    assert got["a"] == brute(labels[:4], scores[:4])[1]
    assert got["b"] == brute(labels[4:], scores[4:])[1]


def test_confusion_and_logloss(spark):
    df = _df(spark, [1, 1, 0, 0, 1], [0.9, 0.4, 0.6, 0.1, 0.5])
    c = metrics.confusion_metrics(df, "y", score="s").head()
    assert (c.true_positives, c.false_positives, c.true_negatives, c.false_negatives) == (1, 1, 1, 2)
    assert c.precision_score == 0.5 and abs(c.recall_score - 1 / 3) < 1e-12
    assert abs(c.f1_score - 0.4) < 1e-12 and c.accuracy_score == 0.4
    ll = metrics.log_loss(df, "y", "s").head().log_loss
    want = -sum(math.log(p) if y else math.log(1 - p) for y, p in [(1, .9), (1, .4), (0, .6), (0, .1), (1, .5)]) / 5
    assert abs(ll - want) < 1e-12
    empty = metrics.confusion_metrics(_df(spark, [0, 0], [0.1, 0.2]), "y", score="s").head()
    assert empty.precision_score == 0.0 and empty.f1_score == 0.0


def test_promotion_gate(spark):
    df = spark.createDataFrame([(1, 0.9, 0.1), (0, 0.2, 0.8), (1, 0.7, 0.6), (0, 0.1, 0.3)],
                               "y int, new double, old double")
    g = metrics.promotion_gate(df, "y", "new", "old").head()
    assert g.promote and g.challenger_value > g.champion_value
    g2 = metrics.promotion_gate(df, "y", "old", "new").head()
    assert not g2.promote
    tie = metrics.promotion_gate(df, "y", "new", "new").head()
    assert tie.promote                                   # ties promote
    first = metrics.promotion_gate(df, "y", "new", None).head()
    assert first.promote and first.champion_value is None
