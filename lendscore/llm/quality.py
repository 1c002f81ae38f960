"""Quality by ordinal cumulative-link regression on graded ratings (operator 3).

One shared weight per hashed term gives a text's level; ordered thresholds cut the
level into grades: ``P(grade <= j) = logistic(threshold_j - level)``.  From these come
the expected grade and the tail probabilities ``P(grade >= j)`` that a selection uses.

Terms are words, marks and token shapes of the whole text with the square roots of their
shares, so the level does not depend on length.  Training uses a bounded, documented
sample of rated rows (``MAX_TRAINING_ROWS``, by text hash) and ``averaged_fit``; each grade
has the same weight in sum.  Scoring is an Arrow UDF without a shuffle.

Defined results: null and empty texts have no terms and level 0; ties and repeated rows
score alike; K is the largest grade + 1, 2 at least; without rated rows every text has
level 0 and one threshold at 0; negative grades fail; columns named like the output are replaced, all others pass through.
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
from .hashed_text import BITS, averaged_fit, frequencies, rows_of, training_table

MAX_TRAINING_ROWS = 12_000
ROUNDS, STEP, DECAY = 10, 2.0, 1e-5
#: Least distance of neighbouring thresholds.
GAP = 0.05


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """``P(grade >= j)`` for j = 1..K-1, one row per text."""
        at, value, per_text = rows_of(found)
        level = per_text(self.weights[at] * value)
        return _logistic(level[:, None] - self.thresholds[None, :].astype(float))


def _epoch(grade_weight: dict[int, float], grades: int):
    def epoch(params: list[np.ndarray], rows: list) -> list[np.ndarray]:
        w, cut = params
        past_w, past_cut = np.ones_like(w), np.ones_like(cut)
        for grade, at, x in rows:
            level = float(w[at] @ x)
            grade = int(grade)
            upper = float(_logistic(cut[grade] - level)) if grade < grades - 1 else 1.0
            lower = float(_logistic(cut[grade - 1] - level)) if grade > 0 else 0.0
            share = max(upper - lower, 1e-6)
            weight = grade_weight[grade]
            # The loss is -log(share); its slope in the level is 1 - upper - lower.
            g = weight * (1.0 - upper - lower) * x + DECAY * w[at]
            past_w[at] += g * g
            w[at] -= STEP * g / np.sqrt(past_w[at])
            for j, slope in ((grade, -upper * (1 - upper)), (grade - 1, lower * (1 - lower))):
                if 0 <= j < grades - 1:
                    s = weight * slope / share
                    past_cut[j] += s * s
                    cut[j] -= STEP * s / np.sqrt(past_cut[j])
            for j in range(1, grades - 1):
                cut[j] = max(cut[j], cut[j - 1] + GAP)
        return [w, cut]
    return epoch


def fit(rated: DataFrame, text_col: str = "text", grade_col: str = "grade",
        max_rows: int = MAX_TRAINING_ROWS) -> OrdinalModel:
    """Learn from the rows of ``rated`` with a grade 0..K-1."""
    table = training_table(rated, frequencies, max_rows, text_col, grade_col)
    counts = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    if any(g < 0 for g in counts):
        raise ValueError(f"grades are 0..K-1, found {sorted(counts)}")
    grades = max([1, *counts]) + 1
    if not counts:
        return OrdinalModel(np.zeros(1 << BITS, np.float32), np.zeros(1, np.float32))
    total = sum(counts.values())
    weight = {k: total / (grades * n) for k, n in counts.items()}
    start = [np.zeros(1 << BITS), np.linspace(-1.0, 1.0, grades - 1) if grades > 2 else np.zeros(1)]
    return OrdinalModel(*averaged_fit(table, start, _epoch(weight, grades), ROUNDS))


def predict(df: DataFrame, model: OrdinalModel, text_col: str = "text", grade_col: str = "expected_grade",
            tails_col: str = "tail_probs") -> DataFrame:
    """``df`` with the expected grade and ``array<double>`` of ``P(grade >= j)``, j = 1..K-1."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def tails(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = held.value
        for batch in batches:
            out = [list(row) for part in slices(batch)
                   for row in model.tails([frequencies(t) for t in part.to_pylist()])]
            yield pa.array(out, pa.list_(pa.float64()))

    return (df.withColumn(tails_col, tails(as_text(F.col(text_col))))
            .withColumn(grade_col, F.aggregate(tails_col, F.lit(0.0), lambda a, p: a + p)))
