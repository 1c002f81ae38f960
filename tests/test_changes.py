"""Exact digests, ordered dictionaries, draws and snapshot differences."""

import tempfile
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lendscore.operators import features, split
from lendscore.sources import changes, tables


def test_digest_tells_any_two_doubles(spark):
    digest = lambda xs: spark.createDataFrame([(x,) for x in xs], "x double").agg(
        tables.content_digest(spark.createDataFrame([], "x double"))).first()[0]
    values = [0.0, 1e-20, 2e-20, 1e13, 1e13 + 0.5, 5e-324, 1e-323, 2.2250738585072014e-308, 1.7976931348623157e308, -1.5, 1.5,
              float("inf"), float("-inf"), float("nan"), 0.1, 0.30000000000000004, 0.3, 2.0 ** 52, 2.0 ** 53 - 1, 9.999999999999999e22]
    assert len({digest([v]) for v in values}) == len(values)
    assert digest([-0.0]) == digest([0.0]) and digest([1.5, 0.1]) == digest([0.1, 1.5])
    texts = {r["x"]: r["t"] for r in spark.createDataFrame([(v,) for v in values[:-1] if v == v and abs(v) != float("inf")], "x double")
             .select("x", tables.double_text(F.col("x")).alias("t")).collect()}
    for x, t in texts.items():
        if x:
            mantissa, exponent = t.split("e")
            assert abs(int(mantissa)).bit_length() == 53 and int(mantissa) * Fraction(2) ** (int(exponent) - 52) == Fraction(x)


def test_both_dictionary_forms_give_the_same_exact_codes(spark):
    rows = [(-9007199254740993, Decimal("100000000000000000001")), (-9007199254740992, Decimal("100000000000000000002")),
            (9007199254740993, Decimal("-100000000000000000002")), (9007199254740992, Decimal("-0.5")), (0, Decimal("0.25")), (None, None)]
    df = spark.createDataFrame(rows, "big long, dec decimal(38,2)")
    for c in ("big", "dec"):
        want = {v: k for k, v in enumerate(sorted({r["v"] for r in df.select(F.col(c).alias("v")).dropna().collect()}))}
        for limit in (1000, 1):
            model = features.CategoryCodes(inputCols=[c], outputCols=["code"], maxCategories=limit).fit(df)
            got = {r[c]: r["code"] for r in model.transform(df).collect()}
            assert got == {**want, None: -1}, (c, limit)
    dense = features.OneHotColumns(inputCols=["dec"]).fit(df).transform(df).collect()
    assert sum(sum(r[f"dec_oh{i}"] for i in range(5)) for r in dense) == 5


def test_only_rows_of_drawn_buckets_are_ranked(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    got = split.sample_with_replacement(df, 3, "k")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("LeftSemi")  # the filter is below the rank
    whole = [r["k"] for r in split.sample_with_replacement(df, 3, "k", unique_key=False).orderBy("draw").collect()]
    assert [r["k"] for r in got.orderBy("draw").collect()] == whole


def test_difference_reads_changed_ranges_only(spark):
    path = tempfile.mkdtemp(prefix="snapshots-")
    rows = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") * 1.5).alias("v"))
    one = rows.withColumn("v", F.when(F.col("k") == 17, 0.25).otherwise(F.col("v")))
    odd = one.unionByName(spark.createDataFrame([(None, 1.0), (None, 2.0)], "k long, v double"))
    wide = rows.withColumn("v", F.col("v").cast("float"))
    for n, df in enumerate((rows, one, odd, rows, wide)):
        assert tables.write_snapshot(df, path) == n
        changes.record(spark, path, n, "write")
        changes.index_snapshot(spark, path, n, ["k"])
    diff = lambda a, b: sorted(map(tuple, changes.changed_keys(spark, path, a, b, ["k"]).collect()), key=str)
    assert changes.differing_ranges(spark, path, 0, 3) == [] and diff(0, 3) == []
    ranges = changes.differing_ranges(spark, path, 0, 1)
    assert len(ranges) == 1 and diff(0, 1) == [(17, "changed")]
    read = changes.indexed_rows(spark, path, 0, ranges, ["k"])
    assert {f.split("range=")[1].split("/")[0] for f in read.inputFiles()} == set(ranges) and read.count() < 60
    assert diff(1, 2) == [(None, "added")] and diff(2, 1) == [(None, "removed")]
    assert len(diff(0, 4)) == 3000  # another type is a change of every row
    assert [(r["snapshot_id"], r["n_rows"]) for r in changes.history(spark, path).orderBy("snapshot_id").collect()] == [
        (0, 3000), (1, 3000), (2, 3002), (3, 3000), (4, 3000)]


def test_empty_snapshots(spark):
    path = tempfile.mkdtemp(prefix="snapshots-")
    assert changes.history(spark, path).count() == 0
    some = spark.createDataFrame([(1, 2.0)], "k long, v double")
    for n, df in enumerate((some.limit(0), some)):
        tables.write_snapshot(df, path)
        changes.index_snapshot(spark, path, n, ["k"])
    assert [tuple(r) for r in changes.changed_keys(spark, path, 0, 1, ["k"]).collect()] == [(1, "added")]
    with pytest.raises(Exception):
        changes.differing_ranges(spark, path, 0, 7)
