"""I4 table overwrite, I5 key checks, I6 snapshots, I7 dataset lineage.

Tables are plain parquet directories under the shared storage root (or
session-catalog tables).  A feature table is written once per snapshot into a
``snapshot_id=<n>`` folder, so "read as of" reads that folder alone, with its own
schema, and training/test both record the snapshot they read (resolved
*before* the read, so no race with a concurrent writer).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DataType, DoubleType, FloatType, MapType, StructType, TimestampType)

from ..session import child_names, claim, publish

SNAPSHOT_COL = "snapshot_id"


def overwrite_table(df: DataFrame, name_or_path: str, partition_by: Sequence[str] = (),
                    fmt: str = "parquet") -> None:
    """I4: replace the whole table, schema included.

    A path (contains ``/``) is written with ``mode("overwrite")``; a name goes
    to ``saveAsTable``.  Never call this while ``df`` still reads the same
    table (Spark refuses; write to a new snapshot instead).
    """
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in name_or_path:
        w.save(name_or_path)
    else:
        w.option("overwriteSchema", "true").saveAsTable(name_or_path)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per rule -- ``NOT NULL`` per key and the composite key's
    uniqueness -- with the number of violating rows.

    One scan: null counts ride along in the same aggregate that counts the
    duplicate groups (partial aggregation before the shuffle on the key).
    """
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    any_null = None
    for k in keys:
        c = F.col(k).isNull()
        any_null = c if any_null is None else (any_null | c)
    dup = per_key.agg(
        F.coalesce(F.sum(F.when((F.col("_n") > 1) & ~any_null, F.col("_n"))), F.lit(0))
         .cast("bigint").alias("dup_rows"),
        *[F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("_n"))), F.lit(0)).cast("bigint")
          .alias(f"null_{i}") for i, k in enumerate(keys)],
    )
    rules = [F.struct(F.lit(f"not_null:{k}").alias("rule"), F.col(f"null_{i}").alias("violations"))
             for i, k in enumerate(keys)]
    rules.append(F.struct(F.lit(f"primary_key:{','.join(keys)}").alias("rule"),
                          F.col("dup_rows").alias("violations")))
    return dup.select(F.explode(F.array(*rules)).alias("r")).select("r.rule", "r.violations")


def assert_keys(df: DataFrame, keys: Sequence[str]) -> None:
    bad = key_violations(df, keys).filter("violations > 0").collect()
    if bad:
        raise ValueError(f"key constraint violated: {[(r.rule, r.violations) for r in bad]}")


def snapshot_path(path: str, snapshot_id: int) -> str:
    return f"{path}/{SNAPSHOT_COL}={snapshot_id}"


def write_snapshot(df: DataFrame, path: str, snapshot_id: int | None = None,
                   keys: Sequence[str] = ()) -> int:
    """Store ``df`` as a new snapshot with a schema of its own; returns its id.

    The rows are staged, the stored rows' ``keys`` are checked, and only then is the
    folder published.  An id is claimed by a marker file first, so two writers
    get two ids; a given id that exists already fails.
    """
    spark = df.sparkSession
    staged = f"{path}/_staging/{uuid.uuid4().hex}"
    df.drop(SNAPSHOT_COL).write.parquet(staged)
    if keys:
        assert_keys(spark.read.parquet(staged), keys)
    if snapshot_id is None:
        last = latest_snapshot_id(spark, path)
        snapshot_id = 0 if last is None else last + 1
        while not claim(spark, f"{path}/_claims/{snapshot_id}"):
            snapshot_id += 1
    publish(spark, staged, snapshot_path(path, snapshot_id))
    return snapshot_id


def latest_snapshot_id(spark: SparkSession, path: str) -> int | None:
    """Newest published snapshot, from the folder listing (no file is read)."""
    ids = [int(name.split("=", 1)[1]) for name in child_names(spark, path) if name.startswith(f"{SNAPSHOT_COL}=")]
    return max(ids, default=None)


def read_snapshot(spark: SparkSession, path: str, snapshot_id: int | None = None) -> DataFrame:
    """One snapshot ("as of"; default the latest) with the schema it was written with."""
    if snapshot_id is None:
        snapshot_id = latest_snapshot_id(spark, path)
        if snapshot_id is None:
            raise FileNotFoundError(f"no snapshot under {path}")
    return spark.read.parquet(snapshot_path(path, snapshot_id))


def latest_snapshot(df: DataFrame, snapshot_col: str = SNAPSHOT_COL) -> DataFrame:
    """Rows of the newest snapshot in an already-loaded snapshotted table.

    ``max`` is a one-row aggregate; the filter is a broadcast-size semi-join
    of that single value, so no partition is shuffled.
    """
    newest = df.agg(F.max(snapshot_col).alias("_latest"))
    return (df.join(F.broadcast(newest), F.col(snapshot_col) == F.col("_latest"))
              .drop("_latest"))


def double_text(x: Column) -> Column:
    """``<sign><mantissa>e<exponent>`` of a double: multiplications by powers of two, which are exact.  A logarithm
    gives the exponent up to one, which two comparisons mend; tiny numbers are scaled up first."""
    tiny = F.abs(x) < F.lit(2.0 ** -500)
    size = F.when(tiny, F.abs(x) * F.lit(2.0 ** 600)).otherwise(F.abs(x))
    two = F.lit(2.0)
    near = F.floor(F.log2(size))
    exponent = (near - F.when(size < F.pow(two, near), 1).otherwise(0)
                + F.when(size >= F.pow(two, near) * two, 1).otherwise(0))
    # In two steps: the power may be too large for one.
    half = F.floor((F.lit(52) - exponent) / F.lit(2))
    mantissa = (size * F.pow(two, half) * F.pow(two, F.lit(52) - exponent - half)).cast("bigint")
    text = F.concat(F.when(x < 0, "-").otherwise(""), mantissa.cast("string"), F.lit("e"),
                    (exponent - F.when(tiny, 600).otherwise(0)).cast("string"))
    return (F.when(F.isnan(x), "NaN").when(x == 0, "0").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf").otherwise(text))


def canonical_text(col: Column, kind: DataType) -> Column:
    """Text of a value that other engines can form alike; null as ``\\N``.

    A double is its sign, 53-bit mantissa and exponent (both zeros are ``0``), so different doubles have different
    texts; times count microseconds; the separator and the backslash are escaped; nested values are their JSON.
    """
    if isinstance(kind, (FloatType, DoubleType)):
        text = double_text(col.cast("double"))
    elif isinstance(kind, TimestampType):
        text = F.unix_micros(col).cast("string")
    elif isinstance(kind, BinaryType):
        text = F.hex(col)
    elif isinstance(kind, (ArrayType, MapType, StructType)):
        text = F.to_json(col if not isinstance(kind, MapType) else F.map_entries(col))
    else:
        text = col.cast("string")
    text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\p"))
    return F.coalesce(text, F.lit("\\N"))


def content_digest(df: DataFrame) -> Column:
    """Order-insensitive digest of every column.

    Per row: md5 over the :func:`canonical_text` of all columns joined by ``|``, its first
    14 hex digits as an integer; the digest is their exact sum.
    """
    parts = [canonical_text(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    row_hash = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 14), 16, 10).cast("decimal(38,0)")
    return F.sum(row_hash).cast("string")


def dataset_lineage(datasets: Sequence[tuple[str, DataFrame, str, int | None]],
                    run_id: str) -> DataFrame:
    """One row per dataset a run used.

    ``datasets``: ``(table_name, df, context, snapshot_id)``.  Row count and
    digest come from one aggregate per dataset; the small per-dataset rows are
    unioned (no driver round trip).
    """
    out = None
    for table, df, context, snap in datasets:
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), content_digest(df).alias("digest")).select(
            F.lit(run_id).alias("run_id"), F.lit(table).alias("table_name"),
            F.lit(snap).cast("bigint").alias("snapshot_id"), F.lit(context).alias("context"),
            F.col("n_rows"), F.col("digest"))
        out = row if out is None else out.unionByName(row)
    return out
