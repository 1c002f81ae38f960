"""States of parts combine to the state of the whole."""

import numpy as np
from pyspark.sql import functions as F

from lendscore.operators import profile_state as P


def test_merged_moments_and_sketches(spark):
    df = spark.range(20_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(10 ** 6)) / 7.0 + 1e9).alias("x"),
                                    F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 500).alias("y"),
                                    (F.col("id") % 40).cast("string").alias("s"), F.lit(None).cast("double").alias("nothing"))
    cols = ["x", "y", "s", "nothing"]
    parts = [P.profile_state(df.filter(F.col("id") % 5 == k), cols) for k in range(4)]
    parts += [P.profile_state(df.filter(F.col("id") % 5 == 4), cols), P.profile_state(df.limit(0), cols)]
    states = parts[0]
    for p in parts[1:]:
        states = states.unionByName(p)
    got = {r["column_name"]: r for r in P.finished(P.merge_states(states)).collect()}
    rows = df.toPandas()
    for c in ("x", "y"):
        v = rows[c].dropna().to_numpy(float)
        r = got[c]
        assert (r["n_rows"], r["n_null"], r["min"], r["max"]) == (20_000, 20_000 - len(v), v.min(), v.max())
        assert np.isclose(r["mean"], v.mean(), rtol=1e-13) and np.isclose(r["stddev"], v.std(ddof=1), rtol=1e-9)
        assert abs(r["n_distinct"] / len(set(v.tolist())) - 1) < 0.06
        for q in (25, 50, 75):
            at = np.searchsorted(np.sort(v), [r[f"p{q}"]], side="left")[0], np.searchsorted(np.sort(v), [r[f"p{q}"]], side="right")[0]
            assert at[0] / len(v) - 0.03 <= q / 100 <= at[1] / len(v) + 0.03
    assert got["s"]["mean"] is None and got["s"]["p50"] is None and got["s"]["n_distinct"] == 40
    assert got["nothing"]["n_null"] == 20_000 and got["nothing"]["mean"] is None and got["nothing"]["stddev"] is None
