"""Exact global ranks and running sums without a single-task window.

A plain ``row_number() OVER (PARTITION BY cls ORDER BY h)`` sends each class
-- possibly a third of all rows or more -- to one task.  Instead the order is
cut into *buckets* that are a monotone prefix of the ordering (first hex
digits of a hash, or score quantiles):

1. count (or sum) per ``(partition, bucket)``: partial aggregation, tiny result
   whose size is bounded by ``#partitions x #buckets``;
2. exclusive prefix sums over that small table give each bucket's offset;
3. the offsets are broadcast-joined back (size bounded and checked);
4. a window over ``(partition, bucket)`` adds the local running value.

Every bucket is an independent window partition, so the work spreads over
as many tasks as there are buckets, and the result equals the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Broadcast only offset tables up to this many rows (~40 bytes per row).
MAX_BROADCAST_OFFSETS = 2_000_000
# Target size of one range bucket (one window task).
ROWS_PER_BUCKET = 2_000_000


def cumulative(df: DataFrame, order_by: Sequence[Column], bucket: Column,
               sums: Mapping[str, Column], partition_by: Sequence[str] = (),
               totals: Mapping[str, str] | None = None,
               expected_buckets: int | None = None, with_offsets: bool = False,
               per_bucket: DataFrame | None = None):
    """Add inclusive running sums of ``sums`` in ``order_by`` order.

    ``bucket`` must be monotone non-decreasing along ``order_by`` within each
    ``partition_by`` group.  ``totals`` maps a sum name to an output column for
    the per-partition grand total.  ``expected_buckets`` bounds the offset
    table: when ``#partitions x expected_buckets`` is known to be small it is
    broadcast; otherwise it is checkpointed, counted, and broadcast only if
    the count is under :data:`MAX_BROADCAST_OFFSETS` (else a shuffle join).
    ``with_offsets`` also returns the offsets table (``_s_<name>`` holds each
    bucket's own sum), e.g. to read grand totals without another pass.
    ``per_bucket`` supplies those per-bucket sums (columns ``partition_by``,
    ``_bkt``, ``_s_<name>``) when they are already known.
    """
    parts = list(partition_by)
    totals = dict(totals or {})
    d = df.withColumn("_bkt", bucket)
    for name, e in sums.items():
        d = d.withColumn(f"_v_{name}", e)
    if per_bucket is None:
        per_bucket = d.groupBy(*parts, "_bkt").agg(
            *[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in sums])
    w_run = Window.partitionBy(*parts).orderBy("_bkt")
    w_all = Window.partitionBy(*parts)
    offs = per_bucket.select(
        *parts, "_bkt",
        *[(F.sum(f"_s_{n}").over(w_run) - F.col(f"_s_{n}")).alias(f"_o_{n}") for n in sums],
        *[F.col(f"_s_{n}") for n in sums],
        *[F.sum(f"_s_{n}").over(w_all).alias(out) for n, out in totals.items()])
    offs = offs.withColumnsRenamed({**{c: f"_k_{c}" for c in parts}, "_bkt": "_k_bkt"})
    if expected_buckets is not None and expected_buckets <= MAX_BROADCAST_OFFSETS:
        small = True
    else:
        # Materialise the offsets once in the shared checkpoint folder (cuts
        # the lineage of the counting pass) and broadcast only if the table
        # really is small.
        offs = materialize(offs, "offsets")
        small = offs.count() <= MAX_BROADCAST_OFFSETS
    right = (F.broadcast(offs) if small else offs).alias("_r")
    cond = F.col("_l._bkt").eqNullSafe(F.col("_r._k_bkt"))
    for c in parts:
        cond = cond & F.col(f"_l.`{c}`").eqNullSafe(F.col(f"_r.`_k_{c}`"))
    j = d.alias("_l").join(right, cond).select(
        "_l.*", *[F.col(f"_r.`_o_{n}`") for n in sums],
        *[F.col(f"_r.`{out}`") for out in totals.values()])
    w_loc = (Window.partitionBy(*parts, "_bkt").orderBy(*order_by)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = j.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.sum(f"_v_{n}").over(w_loc) + F.col(f"_o_{n}")).alias(n) for n in sums],
        *[F.col(out) for out in totals.values()])
    return (out, offs) if with_offsets else out


def hash_row_number(df: DataFrame, hash_col: str, order_by: Sequence[Column],
                    partition_by: Sequence[str] = (), rn: str = "rn", total: str | None = None,
                    max_digits: int = 15, with_offsets: bool = False):
    """Exact ``row_number()`` where the order starts with a hex hash column.

    The bucket is a prefix of the hash whose length fits the data: it is chosen
    from the class sizes so the largest partition's buckets hold about
    :data:`ROWS_PER_BUCKET` rows (1 digit for small data, 5 for ~1e12 rows).
    """
    parts = list(partition_by)
    per_bucket, digits, groups = hash_buckets(df, hash_col, parts, rn, max_digits)
    return cumulative(df, order_by, F.substring(F.col(hash_col), 1, digits), {rn: F.lit(1).cast("bigint")},
                      parts, totals={rn: total} if total else None,
                      expected_buckets=max(1, groups) * 16 ** digits, with_offsets=with_offsets,
                      per_bucket=per_bucket)


def hash_buckets(df: DataFrame, hash_col: str, partition_by: Sequence[str] = (), rn: str = "rn",
                 max_digits: int = 15, least_buckets: int = 1) -> tuple[DataFrame, int, int]:
    """Stored rows per hash prefix (``partition_by``, ``_bkt``, ``_s_<rn>``), the prefix's length and the number of
    partitions.  The length fits the largest partition, and gives ``least_buckets`` prefixes at least."""
    parts = list(partition_by)
    # Class sizes first (one row per class and task), then one count per prefix of
    # the length they call for: either shuffle is far smaller than the input.
    sizes = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.max("_c").alias("largest"), F.count(F.lit(1)).alias("groups")).head()
    want = max(1.0, (sizes.largest or 0) / ROWS_PER_BUCKET, float(least_buckets))
    digits = int(min(max_digits, max(1, math.ceil(math.log(want, 16)))))
    per_bucket = materialize(df.groupBy(*parts, F.substring(F.col(hash_col), 1, digits).alias("_bkt"))
                             .agg(F.count(F.lit(1)).alias(f"_s_{rn}")), "bucket-counts")
    return per_bucket, digits, sizes.groups or 0


def bucketed_row_number(df: DataFrame, order_by: Sequence[Column], bucket: Column,
                        partition_by: Sequence[str] = (), rn: str = "rn",
                        total: str | None = None,
                        expected_buckets: int | None = None) -> DataFrame:
    """Exact ``row_number()`` (1-based) over ``partition_by`` in ``order_by``
    order, computed bucket-parallel.  ``total`` adds the partition's size."""
    out = cumulative(df, order_by, bucket, {rn: F.lit(1).cast("bigint")}, partition_by,
                     totals={rn: total} if total else None, expected_buckets=expected_buckets)
    return out


def range_buckets(df: DataFrame, order_by: Sequence[Column], n_buckets: int | None = None,
                  bucket: str = "_rb", return_count: bool = False):
    """Range-partition by ``order_by`` and record the partition as a bucket.

    The partition id is monotone along ``order_by``, so it is a valid bucket
    for :func:`cumulative`.  The result is written as a table in the shared
    checkpoint folder so the sampled range bounds (and thus the buckets) stay
    fixed across recomputation and executor loss.  ``n_buckets`` defaults to
    ``spark.sql.shuffle.partitions`` or more, so that no bucket holds much
    more than :data:`ROWS_PER_BUCKET` rows.
    """
    spark = df.sparkSession
    # The range partitioner samples its input in a separate job; keep the
    # input cached across that job and the shuffle so it is computed once.
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if n_buckets:
            n = n_buckets
        else:  # enough buckets that none holds much more than ROWS_PER_BUCKET
            rows = src.count()
            n = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                    -(-rows // ROWS_PER_BUCKET))
        out = src.repartitionByRange(n, *order_by).withColumn(bucket, F.spark_partition_id())
        out = materialize(out, "range-buckets")
        return (out, n) if return_count else out
    finally:
        src.unpersist()


def exact_rank(df: DataFrame, order_by: Sequence[Column], partition_by: Sequence[str] = (),
               rn: str = "rn", total: str | None = None,
               n_buckets: int | None = None) -> DataFrame:
    """Exact ``row_number()`` for any orderable keys (strings included)."""
    parts = [F.col(c) for c in partition_by]
    b, nb = range_buckets(df, [*parts, *order_by], n_buckets, return_count=True)
    # without partition columns the offsets table has at most nb rows
    out = bucketed_row_number(b, order_by, F.col("_rb"), partition_by, rn=rn, total=total,
                              expected_buckets=None if partition_by else nb)
    return out.drop("_rb")
