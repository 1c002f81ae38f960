import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from lendscore.operators import features, profile


def test_native_int_order(spark):
    df = spark.createDataFrame([(10,), (2,), (9,), (2,), (None,)], "Job int")
    assert features.fit_dictionaries(df, ["Job"]) == {"Job": [2, 9, 10]}
    m = features.CategoryCodes(inputCols=["Job"], outputCols=["code"]).fit(df)
    new = spark.createDataFrame([(10,), (2,), (7,), (None,)], "Job int")
    assert [r.code for r in m.transform(new).collect()] == [2, 0, -1, -1]


def test_scaler_population_std(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    m = features.PopulationStandardScaler(inputCols=["x"], outputCols=["z"]).fit(df)
    z = [r.z for r in m.transform(df).collect()]
    assert abs(sum(z)) < 1e-12
    assert abs(sum(v * v for v in z) / 3 - 1.0) < 1e-12          # population variance 1
    assert abs(z[0] - (1 - 7 / 3) / 1.247219128924647) < 1e-9


def test_scaler_zero_std(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    m = features.PopulationStandardScaler(inputCols=["x"]).fit(df)
    new = spark.createDataFrame([(5.0,), (7.0,)], "x double")
    assert [r.x for r in m.transform(new).collect()] == [0.0, 2.0]


def test_one_hot_unknown_all_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "p string")
    m = features.OneHotColumns(inputCols=["p"]).fit(df)
    new = spark.createDataFrame([("a",), ("z",), (None,)], "p string")
    out = m.transform(new).select(*m.output_names()).collect()
    assert [tuple(r) for r in out] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_binary_unknown_raises(spark):
    df = spark.createDataFrame([("own",), ("non-own",)], "h string")
    m = features.BinaryOrdinal(inputCols=["h"], outputCols=["hb"]).fit(df)
    assert [r.hb for r in m.transform(df).collect()] == [1, 0]
    with pytest.raises(Exception, match="unknown category in h: rent"):
        m.transform(spark.createDataFrame([("rent",)], "h string")).collect()


def test_dictionary_too_large_raises(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("s"))
    with pytest.raises(ValueError, match="too large"):
        features.fit_dictionaries(df, ["s"], max_size=10)
    d = features.dictionary_frame(df, ["s"]).orderBy("code").collect()
    assert [r.value for r in d[:3]] == ["0", "1", "10"] and d[-1].code == 49


def test_cardinality_plan(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("c", 1, None)], "a string, b int, c string")
    plan = {r.column_name: (r.n_distinct, r.encoder) for r in profile.cardinality_plan(df, ["a", "b", "c"]).collect()}
    assert plan == {"a": (3, "one_hot"), "b": (1, "drop"), "c": (2, "binary")}


def test_pipeline_save_load(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a", 3), (2.0, "b", 1), (4.0, "a", 2)], "x double, p string, j int")
    pipe = Pipeline(stages=[features.PopulationStandardScaler(inputCols=["x"], outputCols=["xs"]),
                            features.OneHotColumns(inputCols=["p"]),
                            features.CategoryCodes(inputCols=["j"], outputCols=["jc"])])
    m = pipe.fit(df)
    path = str(tmp_path / "pipe")
    m.write().overwrite().save(path)
    back = PipelineModel.load(path)
    assert sorted(map(tuple, back.transform(df).collect())) == sorted(map(tuple, m.transform(df).collect()))


def test_profile_exact_matches_pandas(spark):
    import pandas as pd
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, None]
    df = spark.createDataFrame([(v, "k" if v and v > 2 else "j") for v in vals], "x double, s string")
    r = {x.column_name: x for x in profile.profile_columns(df, exact=True).collect()}
    s = pd.Series([v for v in vals if v is not None])
    assert r["x"].n_rows == 9 and r["x"].n_null == 1 and r["x"].n_distinct == 7
    for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        assert abs(getattr(r["x"], name) - s.quantile(q)) < 1e-12
    assert abs(r["x"].stddev - s.std()) < 1e-12
    assert r["s"].n_distinct == 2 and r["s"].mean is None


def test_large_dictionary_codes_by_join(spark):
    df = spark.range(40).select((F.col("id") * 3).alias("k"))
    m = features.CategoryCodes(inputCols=["k"], outputCols=["c"], maxCategories=10).fit(df)
    assert "path" in m._state()["k"]
    new = spark.createDataFrame([(0,), (3,), (117,), (5,), (None,)], "k long")
    got = {r.k: r.c for r in m.transform(new).collect()}
    assert got == {0: 0, 3: 1, 117: 39, 5: -1, None: -1}
