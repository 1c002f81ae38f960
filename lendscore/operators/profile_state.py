"""Profiles that combine.

A state is a row per column: rows, nulls, minimum, maximum, mean and the sum of squared differences from it (exact moments),
a KLL sketch of the numbers and an HLL sketch of all values.  States of parts of a table (snapshots, days,
partitions) are stored and combined without reading the parts again: moments by the pairwise formula, sketches by
their own merge, which keeps their error bounds (``KLL_K``: rank error about 0.01 with 200; HLL: about 1.6 % with 12 bits).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import QUANTILES, numeric_columns

KLL_K, HLL_BITS = 200, 12


def profile_state(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``column_name, n_rows, n_null, mean, m2, min, max, numbers, distinct`` per column: one aggregate, one scan."""
    cols = list(cols or df.columns)
    nums = set(numeric_columns(df, cols))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        v, x = F.col(f"`{c}`"), F.col(f"`{c}`").cast("double")
        aggs += [F.count_if(v.isNull()).alias(f"null{i}"), F.hll_sketch_agg(v.cast("string"), F.lit(HLL_BITS)).alias(f"hll{i}")]
        if c in nums:
            aggs += [F.avg(x).alias(f"mean{i}"), (F.var_pop(x) * F.count(x)).alias(f"m2{i}"), F.min(x).alias(f"min{i}"),
                     F.max(x).alias(f"max{i}"), F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias(f"kll{i}")]
    wide = df.agg(*aggs)

    def part(name: str, i: int, c: str, kind: str = "double"):
        return (F.col(f"{name}{i}") if c in nums else F.lit(None)).cast(kind)

    rows = [F.struct(F.lit(c).alias("column_name"), F.col("_rows").cast("bigint").alias("n_rows"), F.col(f"null{i}").cast("bigint").alias("n_null"),
                     part("mean", i, c).alias("mean"), part("m2", i, c).alias("m2"), part("min", i, c).alias("min"), part("max", i, c).alias("max"),
                     part("kll", i, c, "binary").alias("numbers"), F.col(f"hll{i}").alias("distinct")) for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def merge_states(states: DataFrame) -> DataFrame:
    """States of several parts (all in one table) as one state per column."""
    n = F.col("n_rows") - F.col("n_null")
    both = states.withColumn("_n", n)
    means = both.groupBy("column_name").agg((F.sum(F.col("_n") * F.col("mean")) / F.nullif(F.sum("_n"), F.lit(0))).alias("_mean"))
    return (both.join(F.broadcast(means), "column_name").groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("_n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean"))).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("numbers").alias("numbers"),
        F.hll_union_agg("distinct").alias("distinct")))


def finished(state: DataFrame) -> DataFrame:
    """The profile a state stands for: ``column_name, n_rows, n_null, n_distinct, mean, stddev, min, p25, p50, p75, max``;
    distinct counts and quantiles are the sketches'."""
    n = F.col("n_rows") - F.col("n_null")
    quantiles = [F.when(F.col("mean").isNotNull(), F.kll_sketch_get_quantile_double("numbers", F.lit(q))).alias(f"p{int(q * 100)}")
                 for q in QUANTILES]
    return state.select("column_name", "n_rows", "n_null", F.hll_sketch_estimate("distinct").alias("n_distinct"), "mean",
                        F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("stddev"), "min", *quantiles, "max")
