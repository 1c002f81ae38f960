"""Profiling and grouped statistics (A1-A5).

Per-column statistics come from one wide aggregate (partial aggregation on
every partition, one tiny final row).  Distinct counts and exact quantiles
come from the long form ``(column, value) -> count``: a single shuffle for
all columns, map-side combined, so a value that holds a third of all rows is
one pre-aggregated row per partition, never a hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import materialize
from .ranking import cumulative, exact_rank, range_buckets

QUANTILES = (0.25, 0.5, 0.75)


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def numeric_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in cols if isinstance(types[c], NumericType)]


def long_values(df: DataFrame, cols: Sequence[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """Unpivot ``cols`` to ``(column_name, value, num, *extra)``.

    ``value`` is the text of the value, ``num`` its numeric value (null for
    non-numeric columns) so categories sort in their native order.
    """
    nums = set(numeric_columns(df, cols))
    extra = extra or {}
    items = [F.struct(F.lit(c).alias("column_name"), _q(c).cast("string").alias("value"),
                      (_q(c).cast("double") if c in nums else F.lit(None).cast("double")).alias("num"))
             for c in cols]
    return (df.select(F.explode(F.array(*items)).alias("_kv"), *[e.alias(n) for n, e in extra.items()])
              .select("_kv.*", *extra))


def value_counts(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    """``(column_name, value, num, n[, positives])`` per distinct value (nulls included)."""
    lv = long_values(df, cols, {"_y": _q(target)} if target else None)
    aggs = [F.count(F.lit(1)).alias("n")]
    if target:
        aggs.append(F.sum(F.col("_y").cast("bigint")).alias("positives"))
    return lv.groupBy("column_name", "value", "num").agg(*aggs)


def profile_columns(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = False,
                    accuracy: int = 10000) -> DataFrame:
    """A1: long-form profile, one row per column.

    ``(column_name, n_rows, n_null, n_distinct, mean, stddev, min, p25, p50,
    p75, max)``; numeric statistics are null for non-numeric columns.  The
    default uses sketches (``approx_count_distinct``, ``percentile_approx``:
    bounded memory); ``exact=True`` counts distinct values and finds exact
    (linearly interpolated) quantiles with a distributed rank.
    """
    cols = list(cols or df.columns)
    nums = numeric_columns(df, cols)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(_q(c).isNull()).alias(f"_null_{i}"))
        if not exact:
            aggs.append(F.approx_count_distinct(_q(c)).alias(f"_nd_{i}"))
        if c in nums:
            x = _q(c).cast("double")
            aggs += [F.avg(x).alias(f"_mean_{i}"), F.stddev_samp(x).alias(f"_std_{i}"),
                     F.min(x).alias(f"_min_{i}"), F.max(x).alias(f"_max_{i}")]
            if not exact:
                aggs.append(F.percentile_approx(x, list(QUANTILES), accuracy).alias(f"_pq_{i}"))
    wide = df.agg(*aggs)
    null_d = F.lit(None).cast("double")
    rows = []
    for i, c in enumerate(cols):
        isnum = c in nums
        rows.append(F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").cast("bigint").alias("n_rows"),
            F.col(f"_null_{i}").cast("bigint").alias("n_null"),
            (F.col(f"_nd_{i}").cast("bigint") if not exact else F.lit(None).cast("bigint"))
            .alias("n_distinct"),
            *[(F.col(f"_{s}_{i}") if isnum else null_d).alias(s) for s in ("mean", "std", "min")],
            *[((F.col(f"_pq_{i}")[k] if isnum else null_d) if not exact else null_d).alias(f"p{int(q * 100)}")
              for k, q in enumerate(QUANTILES)],
            (F.col(f"_max_{i}") if isnum else null_d).alias("max")))
    base = (wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
            .withColumnRenamed("std", "stddev"))
    if not exact:
        return base
    exact_stats = _exact_distinct_and_quantiles(df, cols, nums)
    return (base.drop("n_distinct", *[f"p{int(q * 100)}" for q in QUANTILES])
            .join(exact_stats, "column_name", "left")
            .select("column_name", "n_rows", "n_null", F.coalesce("n_distinct", F.lit(0).cast("bigint")).alias("n_distinct"), "mean", "stddev", "min",
                    *[f"p{int(q * 100)}" for q in QUANTILES], "max"))


def _exact_distinct_and_quantiles(df: DataFrame, cols: Sequence[str], nums: Sequence[str]) -> DataFrame:
    # One pass over the input; everything after reads the (small) checkpoint.
    vc = materialize(value_counts(df, cols).filter(F.col("value").isNotNull()), "value-counts")
    distinct = vc.groupBy("column_name").agg(F.count(F.lit(1)).cast("bigint").alias("n_distinct"))
    numeric = (vc.filter(F.col("column_name").isin(list(nums)))
                 .groupBy("column_name", "num").agg(F.sum("n").alias("n")))
    b = range_buckets(numeric, [F.col("column_name"), F.col("num")])
    cum = cumulative(b, [F.col("num")], F.col("_rb"), {"cum": F.col("n")}, ["column_name"],
                     totals={"cum": "tot"})
    aggs = []
    for q in QUANTILES:
        h = (F.col("tot") - 1) * F.lit(q)
        for side, r in (("lo", F.floor(h) + 1), ("hi", F.ceil(h) + 1)):
            hit = (F.col("cum") - F.col("n") < r) & (F.col("cum") >= r)
            aggs.append(F.max(F.when(hit, F.col("num"))).alias(f"_{side}_{int(q * 100)}"))
        aggs.append(F.first(h - F.floor(h)).alias(f"_fr_{int(q * 100)}"))
    qs = cum.groupBy("column_name").agg(*aggs).select(
        "column_name", *[(F.col(f"_lo_{p}") + F.col(f"_fr_{p}") * (F.col(f"_hi_{p}") - F.col(f"_lo_{p}")))
                         .alias(f"p{p}") for p in (int(q * 100) for q in QUANTILES)])
    return distinct.join(qs, "column_name", "left")


def cardinality_plan(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2: exact distinct non-null count per column and the encoder it implies:
    ``> 2`` one_hot, ``== 2`` binary, ``< 2`` drop (reported, not silent)."""
    vc = value_counts(df, cols).filter(F.col("value").isNotNull())
    n = vc.groupBy("column_name").agg(F.count(F.lit(1)).cast("bigint").alias("n_distinct"))
    present = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    n = present.join(n, "column_name", "left").fillna(0, ["n_distinct"])
    return n.withColumn("encoder", F.when(F.col("n_distinct") > 2, "one_hot")
                        .when(F.col("n_distinct") == 2, "binary").otherwise("drop"))


def grouped_target_stats(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """A3 + A4 in one pass: per ``(column, value)``: rows, positives, positive
    rate, and share of all rows.  Null is its own category."""
    vc = materialize(value_counts(df, cols, target), "value-counts")
    total = vc.filter(F.col("column_name") == cols[0]).agg(F.sum("n")).head()[0] or 0
    return vc.select("column_name", "value", "num",
                     F.col("n").cast("bigint").alias("n"),
                     F.col("positives").cast("bigint").alias("positives"),
                     (F.col("positives") / F.col("n")).alias("target_rate"),
                     (F.col("n") / F.lit(total)).alias("share"))


def target_rate(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """A3: positive-class rate and row count per category."""
    return grouped_target_stats(df, cols, target).select(
        "column_name", "value", "n", "positives", "target_rate")


def category_share(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    """A4: each category's share of all rows."""
    vc = materialize(value_counts(df, cols), "value-counts")
    total = vc.filter(F.col("column_name") == cols[0]).agg(F.sum("n")).head()[0] or 0
    return vc.select("column_name", "value", F.col("n").cast("bigint").alias("n"),
                     (F.col("n") / F.lit(total)).alias("share"))


def derive_ordinal(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """A5: ordinal code per category, ordered by positive rate (low to high),
    ties by the category text; nulls excluded."""
    st = grouped_target_stats(df, cols, target).filter(F.col("value").isNotNull())
    ranked = exact_rank(st, [F.col("target_rate"), F.col("value")], ["column_name"], rn="_rn")
    return ranked.select("column_name", "value", "target_rate",
                         (F.col("_rn") - 1).cast("int").alias("code"))
