import json
import tempfile

import pytest
from pyspark.sql import functions as F

from lendscore.operators import models
from lendscore.plans import catalog
from lendscore.sources import files, tables
from lendscore.streaming import scoring
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    f = catalog.feature_rows(spark, SF_SMALL)
    f.repartition(4).write.parquet(f"{base}/in")
    scorer = catalog.linear_scorer()
    out = scoring.run_available_now(spark, f"{base}/in", f.schema, scorer, ["CustomerId"], models.P1,
                                    f"{base}/out", f"{base}/ck", max_files_per_trigger=1)
    batch = scorer.transform(f).select("CustomerId", models.P1, "prediction")
    assert sorted(map(tuple, out.select("CustomerId", models.P1, "prediction").collect())) == \
        sorted(map(tuple, batch.collect()))
    # a restart with no new files writes nothing more (exactly once)
    again = scoring.run_available_now(spark, f"{base}/in", f.schema, scorer, ["CustomerId"], models.P1,
                                      f"{base}/out", f"{base}/ck")
    assert again.count() == f.count()


def test_csv_pandas_null_tokens(spark):
    path = tempfile.mkdtemp(prefix="csv-") + "/t.csv"
    with open(path, "w") as fh:
        fh.write("id,Saving accounts,amt\n1,NA,2.5\n2,rich,\n3,None,1\n4,n/a,3\n")
    df = files.read_csv(spark, path, schema="id int, `Saving accounts` string, amt double")
    rows = [tuple(r) for r in df.orderBy("id").collect()]
    assert rows == [(1, None, 2.5), (2, "rich", None), (3, None, 1.0), (4, None, 3.0)]


def test_json_records_keep_nulls(spark):
    df = spark.createDataFrame([(1, float("nan"), None)], "a int, b double, c string")
    rec = files.to_json_records(df).head()[0]
    assert rec == '{"a":1,"b":null,"c":null}'


def test_snapshots(spark):
    path = tempfile.mkdtemp(prefix="snap-") + "/t"
    df = spark.range(10)
    assert tables.write_snapshot(df, path) == 0
    assert tables.write_snapshot(df.filter("id < 3"), path) == 1
    assert tables.read_snapshot(spark, path).count() == 3
    assert tables.read_snapshot(spark, path, 0).count() == 10
    # A snapshot keeps its own schema, and only its own folder is read.
    assert tables.write_snapshot(df.select(F.col("id").cast("string"), F.lit(1).alias("more")), path) == 2
    assert tables.read_snapshot(spark, path).dtypes == [("id", "string"), ("more", "int")]
    assert tables.read_snapshot(spark, path, 0).dtypes == [("id", "bigint")]
    assert all("snapshot_id=2" in f for f in tables.read_snapshot(spark, path).inputFiles())
    with pytest.raises(FileExistsError):
        tables.write_snapshot(df, path, 1)
    with pytest.raises(ValueError, match="key constraint"):
        tables.write_snapshot(df.union(df), path, keys=["id"])
    assert tables.latest_snapshot_id(spark, path) == 2


def test_two_writers_get_two_snapshots(spark):
    from lendscore.session import claim
    path = tempfile.mkdtemp(prefix="snap-") + "/t"
    assert claim(spark, f"{path}/_claims/0") and not claim(spark, f"{path}/_claims/0")
    assert tables.write_snapshot(spark.range(2), path) == 1
    assert tables.latest_snapshot_id(spark, path) == 1


def test_csv_keeps_values(spark):
    path = tempfile.mkdtemp(prefix="csv-") + "/t.csv"
    with open(path, "w") as fh:
        fh.write('id,s,x\n1," car ",NA\n2,"a ""b"" c",1.5\n3,"two\nlines",2\n')
    df = files.read_csv(spark, path, infer=True)
    assert df.dtypes == [("id", "bigint"), ("s", "string"), ("x", "double")]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, " car ", None), (2, 'a "b" c', 1.5), (3, "two\nlines", 2.0)]


def test_digest_sees_every_column(spark):
    base = spark.createDataFrame([(1, 1.5, "a|b", "c"), (2, None, None, "d")], "i int, x double, s string, t string")
    digest = lambda df: df.agg(tables.content_digest(df)).head()[0]
    same = digest(base)
    assert digest(base.orderBy("i", ascending=False)) == same
    assert digest(base.withColumn("x", F.col("x") + 1e-9)) != same
    moved = spark.createDataFrame([(1, 1.5, "a", "b|c"), (2, None, None, "d")], base.schema)
    assert digest(moved) != same


def test_profile_keeps_empty_columns(spark):
    from lendscore.operators.profile import profile_columns
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    rows = {r["column_name"]: r for r in profile_columns(df, exact=True).collect()}
    assert set(rows) == {"a", "b"} and rows["b"]["n_distinct"] == 0 and rows["b"]["n_null"] == 2


def test_storage_root_needs_a_shared_folder():
    from types import SimpleNamespace

    from lendscore.session import storage_root
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage_root(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


def test_intermediates_are_removed(spark):
    from lendscore.session import Intermediates, path_exists
    with Intermediates(spark) as own:
        assert own.store(spark.range(3)).count() == 3
        kept = list(own.paths)
        assert all(path_exists(spark, p) for p in kept)
    assert not any(path_exists(spark, p) for p in kept)


def test_promotion_takes_effect_in_a_running_stream(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 10).cast("double").alias("x"))
    for i in range(4):
        rows.filter(F.col("k") % 4 == i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    scorers = {1: models.LinearScorer(weights=json.dumps({"x": 0.1})), 2: models.LinearScorer(weights=json.dumps({"x": -0.1}))}
    batches = []

    def resolve():
        batches.append(1 if len(batches) < 2 else 2)  # promoted while the stream runs
        if len(batches) == 3:
            raise ConnectionError("the third batch is lost once")
        return batches[-1], scorers[batches[-1]]

    def run():
        q = scoring.follow_champion(spark, f"{tmp_path}/in", rows.schema, resolve, ["k"], models.P1, f"{tmp_path}/out",
                                    f"{tmp_path}/checkpoint", max_files_per_trigger=1)
        q.awaitTermination()

    with pytest.raises(Exception, match="lost once"):
        run()
    run()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == out.select("k").distinct().count() == 400
    per_batch = out.groupBy("batch").agg(F.count_distinct("model_version").alias("n"), F.max("model_version").alias("v")).orderBy("batch").collect()
    assert [r["n"] for r in per_batch] == [1] * 4 and [r["v"] for r in per_batch] == [1, 1, 2, 2]
    joined = out.join(rows, "k")
    sign = F.when(F.col("model_version") == 1, 0.1).otherwise(-0.1)
    assert joined.filter(F.abs(F.col(models.P1) - 1 / (1 + F.exp(-sign * F.col("x")))) > 1e-12).isEmpty()
