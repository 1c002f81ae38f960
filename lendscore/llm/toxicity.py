"""Toxicity by a factorization machine over hashed terms (operator 1).

Every bucket has a weight and a short factor vector; a text's score is the logistic
of bias + sum of weights + sum over all pairs of buckets of their factors' inner
product, so that pairs of terms (an insult beside the mention of a group) count beyond
what each adds alone.  The pair sum is taken in linear time, from the square of the
sum and the sum of squares.

Terms are the distinct words of the whole text and their leading letters, as far as
``MIN_ROWS`` rows of the training sample have them.  In the sum of weights a term's value is
its log odds of the label in that sample, shrunk towards 0 and 0 where chance explains them, so
that the many neutral terms of a long text add nothing.  In the pair sum every term has the
value 1, as a term that is neutral alone may matter beside another; there
the values are scaled to length at most 1, so that it does not grow with the text.  Training
uses a bounded, documented sample of labelled rows (``MAX_TRAINING_ROWS``, by text hash),
``averaged_fit`` and adaptive gradient steps, with both classes weighted alike in sum.
Scoring is an Arrow UDF without a shuffle.

Defined results: null and empty texts have no terms and score by the bias; ties and
repeated rows score alike; without both labels to learn from, every text gets their
smoothed share; labels other than 0 and 1 fail; columns named like the output are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_text, slices
from .hashed_text import BITS, averaged_fit, presence, rows_of, training_table

MAX_TRAINING_ROWS = 12_000
FACTORS, ROUNDS = 4, 12
STEP, DECAY = 0.2, 1e-4
#: Rows of average label that a term's log odds start from; standard deviations from
#: chance below which they are 0; weight of each term at first; rows that a term needs.
PRIOR, DEVIATIONS, FIRST, MIN_ROWS = 10.0, 5.0, 0.3, 8


@dataclass
class FactorMachine:
    """``slot`` has a bucket's place among the terms, or -1; ``paired`` the terms' values in
    the pair sum (without it, their odds)."""

    slot: np.ndarray
    odds: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    paired: np.ndarray | None = None

    def logits(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        at, x, per_text = rows_of([told(self.slot, a, x) for a, x in found])
        value = self.odds[at] * x
        pair = value if self.paired is None else self.paired[at] * x
        scale = np.sqrt(1.0 + per_text(pair * pair))[:, None]
        v = self.factors[at] * pair[:, None]
        pairs = 0.5 * ((per_text(v) / scale) ** 2 - per_text(v * v) / scale ** 2).sum(axis=1)
        return float(self.bias[0]) + per_text(self.weights[at] * value) + pairs


def told(slot: np.ndarray, at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of the terms that have a slot."""
    own = slot[at]
    keep = own >= 0
    return own[keep], x[keep]


def _epoch(class_weight: dict[int, float], slot: np.ndarray, odds: np.ndarray, paired: np.ndarray | None = None):
    paired = odds if paired is None else paired

    def epoch(params: list[np.ndarray], rows: list) -> list[np.ndarray]:
        bias, w, v = params
        past_b, past_w, past_v = 1.0, np.ones_like(w), np.ones_like(v)
        for label, at, x in rows:
            at, x = told(slot, at, x)
            xp, x = paired[at] * x, odds[at] * x
            xp = xp / np.sqrt(1.0 + xp @ xp)
            vx = v[at] * xp[:, None]
            total = vx.sum(axis=0)
            z = bias[0] + float(w[at] @ x) + 0.5 * float((total ** 2).sum() - (vx * vx).sum())
            g = class_weight[int(label)] * (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - int(label))
            gw = g * x + DECAY * w[at]
            gv = g * xp[:, None] * (total - vx) + DECAY * v[at]
            past_b += g * g
            past_w[at] += gw * gw
            past_v[at] += gv * gv
            bias[0] -= STEP * g / np.sqrt(past_b)
            w[at] -= STEP * gw / np.sqrt(past_w[at])
            v[at] -= STEP * gv / np.sqrt(past_v[at])
        return [bias, w, v]
    return epoch


def log_odds(rows: np.ndarray, hits: np.ndarray, share: float) -> np.ndarray:
    """Shrunk log odds of the label per term, against the label's ``share`` of all rows."""
    p = np.clip((hits + PRIOR * share) / (rows + PRIOR), 1e-4, 1 - 1e-4)
    return (np.log(p / (1 - p)) - np.log(share / (1 - share))).astype(np.float32)


def first_params(terms: int, share: float) -> list[np.ndarray]:
    return [np.array([np.log(share / (1 - share))]), np.full(terms, FIRST),
            np.random.default_rng(7).normal(0, 0.01, (terms, FACTORS))]


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic",
        max_rows: int = MAX_TRAINING_ROWS) -> FactorMachine:
    """Learn from the rows of ``labelled`` whose label is 0 or 1."""
    table = training_table(labelled, presence, max_rows, text_col, label_col)
    counts = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    if not set(counts) <= {0, 1}:
        raise ValueError(f"toxicity labels are 0 and 1, found {sorted(counts)}")
    total = sum(counts.values())
    if len(counts) < 2:
        share = (counts.get(1, 0) + 0.5) / (total + 2)
        return FactorMachine(np.full(1 << BITS, -1, dtype=np.int32), log_odds(np.empty(0), np.empty(0), share),
                             *first_params(0, share))
    weight = {k: (total / (2.0 * n)) ** 0.5 for k, n in counts.items()}
    share = counts[1] / total
    terms = (table.select("label", F.explode("at").alias("at")).groupBy("at")
             .agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
             .filter(F.col("n") >= MIN_ROWS).orderBy("at").toPandas())  # a row per bucket at most
    n, hits = terms["n"].to_numpy(float), terms["hits"].to_numpy(float)
    slot = np.full(1 << BITS, -1, dtype=np.int32)
    slot[terms["at"].to_numpy(int)] = np.arange(len(terms))
    chance = np.abs(hits - n * share) < DEVIATIONS * np.sqrt(n * (share * (1 - share)))
    odds = np.where(chance, np.float32(0), log_odds(n, hits, share))
    paired = np.ones(len(terms), np.float32)
    params = averaged_fit(table, first_params(len(terms), share), _epoch(weight, slot, odds, paired), ROUNDS)
    return FactorMachine(slot, odds, *params, paired)


def predict(df: DataFrame, model: FactorMachine, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` with the probability that each whole text is toxic."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = held.value
        for batch in batches:
            out = [1.0 / (1.0 + np.exp(-np.clip(model.logits([presence(t) for t in part.to_pylist()]), -500, 500)))
                   for part in slices(batch)]
            yield pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return df.withColumn(score_col, score(as_text(F.col(text_col))))
