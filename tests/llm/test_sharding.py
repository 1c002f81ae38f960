import random

import pytest
from pyspark.sql import functions as F

from lendscore.llm import queries, sharding
from tests.conftest import SF_ORACLE
from tests.llm.helpers import no_docs, odd_docs
from tests.oracle import compare, duck


def test_query_matches_oracle(spark):
    ok, msg = compare(queries.op4_sharding(spark, SF_ORACLE), duck(SF_ORACLE), queries.ORACLE["op4_sharding"])
    assert ok, msg


@pytest.mark.parametrize("limit", [120, 1_000, 10**9])
def test_shards_fit_and_cover_hot_keys(spark, limit):
    rng = random.Random(4)
    rows = [(i, "x" * rng.choice([0, 5, 50, 400])) for i in range(150)] + [(999, "y" * 50)] * 90 + [(None, None)]
    placed = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), limit_bytes=limit).cache()
    assert placed.count() == len(rows)
    shards = sharding.directory(placed)
    assert shards.filter((F.col("n_bytes") > limit) & (F.col("n_rows") > 1)).isEmpty()
    # Prefix-free: no shard lies inside another.
    all_of = [(r["depth"], r["prefix"]) for r in shards.collect()]
    taken = set(all_of)
    assert not any((d - k, p >> k) in taken for d, p in all_of for k in range(1, d + 1))
    # Only buckets over the limit split: no two sibling shards fit together.
    size = {(r["depth"], r["prefix"]): r["n_bytes"] for r in shards.collect()}
    assert all(size[d, p] + size.get((d, p ^ 1), limit + 1) > limit for d, p in all_of if d)


def test_odd_rows(spark, tmp_path):
    assert sharding.assign(odd_docs(spark), limit_bytes=1000).count() == 10
    assert sharding.assign(no_docs(spark)).count() == 0
    docs = odd_docs(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    sharding.write_shards(docs, str(tmp_path / "s"), limit_bytes=1000)
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count()


def test_written_shards_hold_every_row(spark, tmp_path):
    """Null keys, a hot key and odd rows, through more than one round."""
    rows = [(i, "x" * 50) for i in range(40)] + [(999, f"y{i}" * 20) for i in range(90)] + [(None, "z" * 30)] * 5 + [(None, None)]
    for name, df in (("hot", spark.createDataFrame(rows, "doc_id long, text string")), ("odd", odd_docs(spark))):
        path = str(tmp_path / name)
        names = sharding.write_shards(df, path, limit_bytes=300)
        assert names == (("depth", "prefix") if name == "hot" else ("shard_depth", "shard_prefix"))
        back = spark.read.parquet(path)
        columns = df.columns
        assert sorted(map(repr, back.select(columns).collect())) == sorted(map(repr, df.select(columns).collect()))
    shards = spark.read.parquet(str(tmp_path / "hot")).groupBy("depth", "prefix").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"))
    assert shards.filter("n > 1 AND b > 300").isEmpty() and shards.count() > 20
