"""S1 stratified train/test split, S2 stratified folds, S3 sampling with replacement.

All three rank rows by ``md5("<key>:<seed>")`` -- deterministic, independent
of partitioning and of the order rows arrive in -- using the bucket-parallel
rank of :mod:`.ranking` (buckets = first hex digits of the hash, uniform by
construction, so no class or key can make a bucket hot).
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hex_prefix_int, keyed_md5
from ..session import materialize
from .ranking import cumulative, exact_rank, hash_buckets, hash_row_number

# Longest hash prefix used as a bucket; the prefix actually used is sized from
# the data (see ranking.hash_row_number).
HEX_DIGITS = 15
# Broadcast a draw list up to this many rows; beyond it the join shuffles.
MAX_BROADCAST_DRAWS = 1_000_000
# Hash buckets for every draw of a sample, and most buckets of one.
BUCKETS_PER_DRAW, MOST_BUCKETS = 20, 1 << 20


def _rounded_share(total, fraction: Fraction):
    """``floor(total * p/q + 1/2)`` in exact integer arithmetic: with
    ``total = a * q + r`` it is ``a * p + floor((2 * p * r + q) / (2 * q))``, whose
    terms stay below 2^63 for q up to 1e9 and totals up to 9e18 / p * q."""
    p, q = fraction.numerator, fraction.denominator
    total = total.cast("bigint")
    whole = F.call_function("div", total, F.lit(q).cast("bigint"))
    rest = total % F.lit(q).cast("bigint")
    part = F.call_function("div", F.lit(2 * p).cast("bigint") * rest + F.lit(q).cast("bigint"),
                           F.lit(2 * q).cast("bigint"))
    return (whole * F.lit(p).cast("bigint") + part).cast("bigint")


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_text(key: str | Sequence[str]):
    """One column's text, or the texts of a composite key joined unambiguously."""
    keys = _keys(key)
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    texts = [F.coalesce(F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")),
                                  F.lit("|"), F.lit("\\p")), F.lit("\\N")) for k in keys]
    return F.concat_ws("|", *texts)


def _rank_rows(df: DataFrame, key: str | Sequence[str], seed: int, hex_digits: int, unique_key: bool,
               partition_by: list[str], total: str | None) -> DataFrame:
    """Rank rows by ``(md5(key:seed), key)`` within ``partition_by``.

    ``unique_key=True``: buckets are hash prefixes (uniform; one shuffle).
    ``unique_key=False``: copies of one key share a hash, so a hot key would
    fill one bucket.  Each row then gets a position id, stored with the rows
    (so it is stable under recomputation), and the order ``(hash, key, id)``
    is range-partitioned: the partitioner splits even a run of identical
    copies across tasks.  Copies rank in stored-position order.
    """
    d = df.withColumn("_h", keyed_md5(key_text(key), seed))
    if unique_key:
        # Hash-prefix buckets sized from the data; the offsets table has
        # (#classes x 16^digits) rows, counted before it is broadcast.
        return hash_row_number(d, "_h", [F.col("_h"), *map(F.col, _keys(key))], partition_by, rn="_rn",
                               total=total, max_digits=hex_digits)
    d = materialize(d.withColumn("_u", F.monotonically_increasing_id()), "rank-input")
    return exact_rank(d, [F.col("_h"), *map(F.col, _keys(key)), F.col("_u")], partition_by, rn="_rn",
                      total=total).drop("_u")


def stratified_split(df: DataFrame, key: str | Sequence[str], label: str, test_fraction: str | float = "0.2",
                     n_folds: int = 5, seed: int = 42, hex_digits: int = HEX_DIGITS,
                     unique_key: bool = True) -> DataFrame:
    """Add ``is_test`` (boolean) and ``fold`` (int, 0..n_folds-1).

    Inside each class, rows are ranked by ``(md5(key:seed), key)``; the first
    ``round(n_class * test_fraction)`` are test (exact class proportions,
    disjoint, complete).  ``fold = (rank - 1) % n_folds`` gives balanced
    stratified folds; the training rows' folds feed cross-validation.
    ``key`` may be a list of columns; their whole list orders and hashes the rows.
    Pass ``unique_key=False`` when the key may repeat (see :func:`_rank_rows`).
    """
    frac = Fraction(str(test_fraction)).limit_denominator(10 ** 9)
    ranked = _rank_rows(df, key, seed, hex_digits, unique_key, [label], "_tot")
    return (ranked
            .withColumn("is_test", F.col("_rn") <= _rounded_share(F.col("_tot"), frac))
            .withColumn("fold", ((F.col("_rn") - 1) % n_folds).cast("int"))
            .drop("_h", "_rn", "_tot"))


def train_test(df: DataFrame, key: str | Sequence[str], label: str, **kw) -> tuple[DataFrame, DataFrame]:
    s = stratified_split(df, key, label, **kw)
    return s.filter(~F.col("is_test")).drop("is_test"), s.filter("is_test").drop("is_test", "fold")


def sample_with_replacement(df: DataFrame, n: int, key: str | Sequence[str], seed: int = 42,
                            draw_seed: int = 7, hex_digits: int = HEX_DIGITS,
                            unique_key: bool = True) -> DataFrame:
    """Exactly ``n`` rows drawn uniformly with replacement (seeded).

    Rows get a global index 1..N (hash order); draw ``i`` picks index
    ``md5(i:draw_seed) mod N + 1``.  The draws are generated on the executors with ``range``.  Up to
    ``MAX_BROADCAST_DRAWS`` of them are first dealt to hash buckets by the table of bucket counts, and only rows of
    buckets that a draw falls into are ranked: about one row in ``BUCKETS_PER_DRAW`` is sorted.
    """
    spark = df.sparkSession
    if unique_key:
        indexed = df.withColumn("_h", keyed_md5(key_text(key), seed))
        few = n <= MAX_BROADCAST_DRAWS
        least = min(MOST_BUCKETS, BUCKETS_PER_DRAW * n) if few else 1
        per_bucket, digits, _ = hash_buckets(indexed, "_h", rn="_rn", max_digits=hex_digits, least_buckets=least)
        total = per_bucket.agg(F.sum("_s__rn")).head()[0] or 0
    else:
        indexed = _rank_rows(df, key, seed, hex_digits, False, [], "_tot")
        total = indexed.agg(F.max("_tot")).head()[0] or 0
        indexed = indexed.drop("_tot")
    if total == 0:
        raise ValueError("cannot sample from an empty DataFrame")
    draws = spark.range(n).select(
        F.col("id").alias("draw"),
        (hex_prefix_int(keyed_md5(F.col("id"), draw_seed), 15) % F.lit(total) + 1).alias("_rn"))
    if unique_key:
        bucket = F.substring("_h", 1, digits)
        if few:
            # Broadcast: at most one bucket per draw.
            indexed = indexed.join(F.broadcast(drawn_buckets(draws, per_bucket)), bucket == F.col("_drawn"), "left_semi")
        indexed = cumulative(indexed, [F.col("_h"), *map(F.col, _keys(key))], bucket, {"_rn": F.lit(1).cast("bigint")},
                             expected_buckets=16 ** digits, per_bucket=per_bucket)
    indexed = indexed.drop("_h")
    if n <= MAX_BROADCAST_DRAWS:
        draws = F.broadcast(draws)
    return draws.join(indexed, "_rn").drop("_rn")


def drawn_buckets(draws: DataFrame, per_bucket: DataFrame) -> DataFrame:
    """``_drawn``: buckets that hold the index of a draw.  Draws and buckets are put in one order by index; the
    bucket of a draw is the last before it.  Both are bounded (``MAX_BROADCAST_DRAWS``, the number of prefixes)."""
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select((F.coalesce(F.sum("_s__rn").over(before), F.lit(0)) + 1).alias("at"), "_bkt", F.lit(0).alias("kind"))
    both = starts.unionByName(draws.select(F.col("_rn").alias("at"), F.lit(None).cast("string").alias("_bkt"), F.lit(1).alias("kind")))
    upto = Window.orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.select("kind", F.last("_bkt", ignorenulls=True).over(upto).alias("_drawn"))
    return found.filter("kind = 1").select("_drawn").distinct()
