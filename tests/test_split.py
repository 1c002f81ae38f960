from collections import Counter

from pyspark.sql import functions as F

from lendscore.operators import split
from lendscore.operators.ranking import bucketed_row_number, exact_rank
from lendscore.plans import catalog
from tests.conftest import SF_SMALL


def _features(spark):
    return catalog.feature_rows(spark, SF_SMALL)


def test_split_exact_proportions_and_complete(spark):
    f = _features(spark)
    s = split.stratified_split(f, "CustomerId", "Risk").collect()
    assert len(s) == f.count()
    assert len({r.CustomerId for r in s}) == len(s)
    by_class = Counter(r.Risk for r in s)
    test_by_class = Counter(r.Risk for r in s if r.is_test)
    for k, n in by_class.items():
        assert test_by_class[k] == (2 * n + 5) // 10


def test_split_independent_of_partitioning(spark):
    f = _features(spark)
    a = split.stratified_split(f.repartition(1), "CustomerId", "Risk").select("CustomerId", "is_test", "fold")
    b = split.stratified_split(f.repartition(7, "Age"), "CustomerId", "Risk", hex_digits=1) \
        .select("CustomerId", "is_test", "fold")
    assert sorted(a.collect()) == sorted(b.collect())


def test_folds_balanced_within_class(spark):
    s = split.stratified_split(_features(spark), "CustomerId", "Risk")
    counts = s.groupBy("Risk", "fold").count().collect()
    per_class = {}
    for r in counts:
        per_class.setdefault(r.Risk, []).append(r["count"])
    for sizes in per_class.values():
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_bucketed_rank_equals_plain_rank(spark):
    df = spark.range(0, 2000).select(F.col("id"), (F.col("id") % 3).alias("g"),
                                     F.md5(F.col("id").cast("string")).alias("h"))
    got = bucketed_row_number(df, [F.col("h")], F.substring("h", 1, 1), ["g"], rn="rn").collect()
    from pyspark.sql import Window
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("h"))).collect()
    assert sorted((r.id, r.rn) for r in got) == sorted((r.id, r.rn) for r in want)


def test_exact_rank_strings(spark):
    df = spark.createDataFrame([(w,) for w in ["pear", "apple", "fig", "kiwi", "banana"]], "w string")
    got = {r.w: r.rn for r in exact_rank(df, [F.col("w")], n_buckets=3).collect()}
    assert got == {"apple": 1, "banana": 2, "fig": 3, "kiwi": 4, "pear": 5}


def test_sample_with_replacement_exact_n(spark):
    f = _features(spark)
    s = split.sample_with_replacement(f, 250, "CustomerId", seed=1)
    rows = s.collect()
    assert len(rows) == 250
    assert sorted(r.draw for r in rows) == list(range(250))
    ids = {r.CustomerId for r in f.select("CustomerId").collect()}
    assert {r.CustomerId for r in rows} <= ids
    again = split.sample_with_replacement(f, 250, "CustomerId", seed=1).collect()
    assert sorted((r.draw, r.CustomerId) for r in rows) == sorted((r.draw, r.CustomerId) for r in again)


def test_split_with_a_hot_duplicated_key(spark):
    # one key holds a third of all rows; the range path spreads its copies
    rows = [(7, 1)] * 300 + [(i, i % 2) for i in range(1000, 1600)]
    df = spark.createDataFrame(rows, "k long, y int").repartition(5)
    s = split.stratified_split(df, "k", "y", unique_key=False)
    got = s.collect()
    assert len(got) == 900
    by_class = Counter(r.y for r in got)
    test_by_class = Counter(r.y for r in got if r.is_test)
    for c, n in by_class.items():
        assert test_by_class[c] == (2 * n + 5) // 10
    fold_sizes = Counter((r.y, r.fold) for r in got)
    for c in by_class:
        sizes = [fold_sizes[(c, f)] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    # the hot key's copies are ranked in more than one range bucket
    from lendscore.operators.ranking import range_buckets
    h = df.withColumn("_h", F.md5(F.concat(F.col("k").cast("string"), F.lit(":42")))) \
        .withColumn("_u", F.monotonically_increasing_id())
    b = range_buckets(h, [F.col("y"), F.col("_h"), F.col("k"), F.col("_u")], n_buckets=8)
    assert b.filter("k = 7").select("_rb").distinct().count() > 1
    # unique-key results are unchanged by the option when keys are unique
    u = df.filter("k != 7")
    a = split.stratified_split(u, "k", "y").select("k", "is_test", "fold")
    c = split.stratified_split(u, "k", "y", unique_key=False).select("k", "is_test", "fold")
    assert sorted(a.collect()) == sorted(c.collect())


def test_sample_with_duplicates(spark):
    rows = [(7,)] * 50 + [(i,) for i in range(100)]
    df = spark.createDataFrame(rows, "k long")
    s = split.sample_with_replacement(df, 40, "k", unique_key=False).collect()
    assert len(s) == 40 and sorted(r.draw for r in s) == list(range(40))
