"""Classification metrics (M4-M8), exact and distributed.

Ranking metrics need cumulative true/false positive counts in descending
score order.  Rows are first grouped by ``(group, score)`` -- map-side
combined, so one score value shared by a third of all rows is a single row
per partition -- and the running sums over that table are computed with the
range-bucketed prefix sums of :mod:`.ranking` (no single-task window).

Definitions (positive class = 1):

* average precision  ``sum_k (R_k - R_{k-1}) * P_k`` over distinct thresholds;
* ROC AUC            ties count one half;
* PR AUC             trapezoid over the precision-recall curve that starts
                     at (recall 0, precision 1);
* confusion counts   ``score > threshold`` predicts positive; 0/0 -> 0;
* log loss           probabilities clipped to ``[eps, 1 - eps]``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import cumulative, range_buckets


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def long_scores(df: DataFrame, label: str, scores: Mapping[str, str],
                model_col: str = "model") -> DataFrame:
    """Unpivot several score columns to ``(model, label, score)``."""
    items = [F.struct(F.lit(m).alias(model_col), _q(s).cast("double").alias("score"))
             for m, s in scores.items()]
    return (df.select(_q(label).alias("_y"), F.explode(F.array(*items)).alias("_m"))
              .select(f"_m.{model_col}", F.col("_y").alias(label), "_m.score"))


def score_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per ``(by, distinct score)``: ``pos, neg`` and inclusive running
    ``tp, fp`` in descending score order, plus totals ``n_pos, n_neg``."""
    y = (_q(label) == 1)
    # A NaN score is a broken model, not a high rank; a null score ranks lowest.
    ranked = F.when(F.isnan(_q(score).cast("double")), F.raise_error(F.lit(f"NaN in score column {score}")).cast("double")
                    ).otherwise(_q(score))
    g = df.groupBy(*[_q(c) for c in by], ranked.alias("score")).agg(
        F.sum(y.cast("bigint")).alias("pos"), F.sum((~y).cast("bigint")).alias("neg"))
    b, nb = range_buckets(g, [*[F.col(c) for c in by], F.col("score").desc()], return_count=True)
    # ungrouped, the offsets table has at most nb rows; grouped, it is counted
    return cumulative(b, [F.col("score").desc()], F.col("_rb"),
                      {"tp": F.col("pos"), "fp": F.col("neg")}, by,
                      totals={"tp": "n_pos", "fp": "n_neg"},
                      expected_buckets=None if by else nb).drop("_rb")


def ranking_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """``average_precision``, ``roc_auc``, ``pr_auc`` per group (one row each)."""
    c = score_curve(df, label, score, by)
    tp, fp, pos, neg = F.col("tp"), F.col("fp"), F.col("pos"), F.col("neg")
    npos, nneg = F.col("n_pos"), F.col("n_neg")
    prec = _div(tp, tp + fp)
    prev_tp, prev_fp = tp - pos, fp - neg
    prev_prec = F.when(prev_tp + prev_fp == 0, F.lit(1.0)).otherwise(_div(prev_tp, prev_tp + prev_fp))
    recall_step = _div(pos, npos)
    return c.groupBy(*by).agg(
        F.sum(recall_step * prec).alias("average_precision"),
        _div(F.sum(neg.cast("double") * (prev_tp + pos.cast("double") / 2)),
             F.first(npos).cast("double") * F.first(nneg)).alias("roc_auc"),
        F.sum(recall_step * (prec + prev_prec) / 2).alias("pr_auc"))


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, label, score, by).select(*by, "average_precision")


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, label, score, by).select(*by, "roc_auc")


def pr_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, label, score, by).select(*by, "pr_auc")


def _confusion_aggs(label: str, score: str | None, prediction: str | None, threshold: float) -> list:
    y = _q(label) == 1
    p = (_q(prediction) == 1) if prediction else (_q(score) > F.lit(threshold))
    return [F.count_if(y & p).alias("true_positives"), F.count_if(~y & p).alias("false_positives"),
            F.count_if(~y & ~p).alias("true_negatives"), F.count_if(y & ~p).alias("false_negatives"),
            F.count(F.lit(1)).alias("example_count")]


def _confusion_rates() -> list:
    tp, fp, tn, fn = (F.col(c) for c in ("true_positives", "false_positives",
                                          "true_negatives", "false_negatives"))
    zero = F.lit(0.0)
    return ["true_positives", "false_positives", "true_negatives", "false_negatives", "example_count",
            F.coalesce(_div(tp + tn, F.col("example_count")), zero).alias("accuracy_score"),
            F.coalesce(_div(tp, tp + fp), zero).alias("precision_score"),
            F.coalesce(_div(tp, tp + fn), zero).alias("recall_score"),
            F.coalesce(_div(2 * tp, 2 * tp + fp + fn), zero).alias("f1_score")]


def confusion_metrics(df: DataFrame, label: str, score: str | None = None,
                      prediction: str | None = None, threshold: float = 0.5,
                      by: Sequence[str] = ()) -> DataFrame:
    """Counts and rates from one aggregate.  Predicted positive is
    ``prediction == 1`` or else ``score > threshold``."""
    agg = df.groupBy(*by).agg(*_confusion_aggs(label, score, prediction, threshold))
    return agg.select(*by, *_confusion_rates())


def _log_loss_agg(label: str, prob: str, eps: float) -> Column:
    p = F.least(F.greatest(_q(prob).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = (_q(label) == 1).cast("double")
    return (-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss")


def log_loss(df: DataFrame, label: str, prob: str, eps: float = 1e-15,
             by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(_log_loss_agg(label, prob, eps),
                               F.count(F.lit(1)).alias("example_count"))


def classifier_metrics(df: DataFrame, label: str, prob: str, by: Sequence[str] = (),
                       threshold: float = 0.5, eps: float = 1e-15) -> DataFrame:
    """The default evaluation set: ranking metrics, confusion metrics and
    log loss.  Confusion counts and log loss share one aggregate; the ranking
    metrics need the score curve.  Pass a stored (materialised) scored set:
    it is read twice."""
    keys = list(by)
    r = ranking_metrics(df, label, prob, keys)
    c = df.groupBy(*keys).agg(*_confusion_aggs(label, prob, None, threshold),
                              _log_loss_agg(label, prob, eps))
    c = c.select(*keys, *_confusion_rates(), "log_loss")
    if keys:
        return r.join(c, keys)
    # Two one-row results meet on a literal key; the curve itself stays ungrouped.
    return r.withColumn("_all", F.lit(0)).join(c.withColumn("_all", F.lit(0)), "_all").drop("_all")


def promotion_gate(df: DataFrame, label: str, challenger: str, champion: str | None,
                   metric: str = "pr_auc") -> DataFrame:
    """M8: score both models on the same rows; promote when the challenger's
    metric is >= the champion's (ties promote; no champion promotes)."""
    scores = {"challenger": challenger}
    if champion:
        scores["champion"] = champion
    m = ranking_metrics(long_scores(df, label, scores), label, "score", ["model"])
    wide = m.groupBy().pivot("model", list(scores)).agg(F.first(metric))
    champ = F.col("champion") if champion else F.lit(None).cast("double")
    return wide.select(F.lit(metric).alias("metric"), F.col("challenger").alias("challenger_value"),
                       champ.alias("champion_value"),
                       (champ.isNull() | (F.col("challenger") >= champ)).alias("promote"))
