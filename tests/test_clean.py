import pytest
from pyspark.sql import functions as F

from lendscore.config import CREDIT_RULES
from lendscore.functions.columns import normalize_column_names, normalized_name
from lendscore.operators import clean


def raw_fixture(spark):
    # One row per merge, token and real null of the credit rules.
    return spark.createDataFrame(
        [(11, "quite rich", None, "rent", "vacation/others", "bad"),
         (12, "moderate", "NA", "own", "business", "good"),
         (13, None, "little", "free", "repairs", "bad"),
         (14, "NA", "rich", "own", "domestic appliances", "good"),
         (15, "little", "moderate", "own", None, "good")],
        "id long, `Saving-accounts` string, `Checking account` string, Housing string, "
        "Purpose string, Risk string")


def test_normalized_name():
    assert normalized_name("Saving accounts") == "Saving_accounts"
    assert normalized_name("a  b") == "a__b"            # no collapsing
    assert normalized_name("col@#$") == "col___"
    assert normalized_name("größe") == "gr__e"          # non-ASCII -> _


def test_normalize_columns(spark):
    df = normalize_column_names(raw_fixture(spark))
    assert df.columns == ["id", "Saving_accounts", "Checking_account", "Housing", "Purpose", "Risk"]


def test_normalize_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`col@#$` int, `col!!!` int")
    with pytest.raises(ValueError, match="collide"):
        normalize_column_names(df)
    assert normalize_column_names(df, on_collision="suffix").columns == ["col___", "col____1"]


def test_feature_table_fixture_rows(spark):
    out = clean.feature_table(raw_fixture(spark), CREDIT_RULES).orderBy("id").collect()
    got = [(r.id, r.Saving_accounts, r.Checking_account, r.Housing, r.Purpose, r.Risk,
            r.Saving_accounts_ordinal_enc, r.Checking_account_ordinal_enc) for r in out]
    assert got == [
        (11, "rich", "no account/unknown", "non-own", "other", 1, 3, 3),
        (12, "moderate", "no account/unknown", "own", "business", 0, 1, 3),
        (13, "no account/unknown", "little", "non-own", "other", 1, 2, 0),
        (14, "no account/unknown", "rich", "own", "other", 0, 2, 2),
        (15, "little", "moderate", "own", None, 0, 0, 1),
    ]


def test_feature_table_is_one_project(spark):
    df = clean.feature_table(raw_fixture(spark), CREDIT_RULES)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1
    assert "PythonUDF" not in plan


def test_real_nulls_and_tokens(spark):
    df = spark.createDataFrame([("NA",), (None,), ("quite rich",), ("little",)], "Saving_accounts string")
    rules = CREDIT_RULES.columns[0]
    out = [r[0] for r in df.select(clean.column_expr(rules, F.col("Saving_accounts"))).collect()]
    assert out == ["no account/unknown", "no account/unknown", "rich", "little"]


def test_unknown_value_raises_or_nulls(spark):
    df = spark.createDataFrame([("rich",), ("poor",), (None,)], "s string")
    with pytest.raises(Exception, match="unmapped value in s: poor"):
        clean.ordinal_encode(df, ["s"], [{"rich": 1}], ["e"]).collect()
    out = clean.ordinal_encode(df, ["s"], [{"rich": 1}], ["e"], on_unknown="null").collect()
    assert [r.e for r in out] == [1, None, None]


def test_map_values_keeps_unmapped(spark):
    df = spark.createDataFrame([("good",), ("bad",), ("meh",), (None,)], "Risk string")
    out = [r.Risk for r in clean.map_values(df, {"good": "0", "bad": "1"}, ["Risk"]).collect()]
    assert out == ["0", "1", "meh", None]


def test_decode_and_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (0, 2.0)], "prediction int, x double")
    out = clean.nan_to_null(clean.decode_prediction(df)).orderBy("prediction").collect()
    assert [(r["Credit risk prediction"], r.x) for r in out] == [("good", 2.0), ("bad", None)]


def test_nan_to_null_keeps_float_and_any_header_renames(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "`a``b.c` float")
    named = normalize_column_names(df)
    out = clean.nan_to_null(named)
    assert named.columns == ["a_b_c"] and out.schema["a_b_c"].dataType.simpleString() == "float"
    assert [r[0] for r in out.collect()] == [None, 1.5, None]


def test_label_encode_decode_round_trip(spark):
    from lendscore.plans import catalog
    from tests.conftest import SF_SMALL
    raw = normalize_column_names(catalog.applications(spark, SF_SMALL)).select("CustomerId", "Risk")
    enc = clean.label_encode(raw, "Risk", CREDIT_RULES.encodings[2].mapping)
    dec = clean.decode_prediction(enc, "Risk", "Risk_text")
    mismatches = dec.join(raw.withColumnRenamed("Risk", "orig"), "CustomerId") \
        .filter(F.col("Risk_text") != F.col("orig")).count()
    assert mismatches == 0 and dec.count() == raw.count()
