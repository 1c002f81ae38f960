"""History of snapshots, and what changed between two of them.

Each indexed snapshot has a tree of digests: a row's key is hashed, a node is a prefix of that hash, and its digest is the
sum of the hashes of all rows below it (so a parent's is the sum of its children's).  Two snapshots are compared from the
root down, and only below nodes that differ.  The keys and row hashes themselves are stored by range (the prefix
of ``LEAF`` hex digits), so a comparison reads those ranges alone that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hex_prefix_int
from ..session import path_exists
from .tables import SNAPSHOT_COL, canonical_text, child_names, read_snapshot, snapshot_path

#: Hex digits of a range of keys (256 ranges).
LEAF = 2
HISTORY = "snapshot_id long, written timestamp, operation string, n_rows long"


# --- history -------------------------------------------------------------------
def record(spark: SparkSession, path: str, snapshot_id: int, operation: str) -> None:
    """Note how a published snapshot came about."""
    row = (read_snapshot(spark, path, snapshot_id).agg(F.count(F.lit(1)).alias("n_rows"))
           .select(F.lit(snapshot_id).cast("long").alias("snapshot_id"), F.current_timestamp().alias("written"),
                   F.lit(operation).alias("operation"), "n_rows"))
    row.coalesce(1).write.parquet(f"{path}/_history/{snapshot_id}")


def history(spark: SparkSession, path: str) -> DataFrame:
    """Recorded snapshots that still exist: id, time, operation and rows."""
    ids = [n for n in child_names(spark, f"{path}/_history") if path_exists(spark, snapshot_path(path, int(n)))]
    return spark.read.schema(HISTORY).parquet(*[f"{path}/_history/{n}" for n in ids]) if ids else spark.createDataFrame([], HISTORY)


# --- digests ---------------------------------------------------------------------
def _text(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[canonical_text(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns])


def index_path(path: str, snapshot_id: int) -> str:
    return f"{path}/_index/{SNAPSHOT_COL}={snapshot_id}"


def _stored(spark: SparkSession, path: str, snapshot_id: int, keys: Sequence[str], paths: Sequence[str]) -> DataFrame:
    """Indexed rows, with the types of the snapshot's keys; its folder may hold no file."""
    schema = read_snapshot(spark, path, snapshot_id).select(*keys).schema.add("row_hash", "string").add("range", "string")
    return spark.read.option("basePath", f"{index_path(path, snapshot_id)}/rows").schema(schema).parquet(*paths)


def index_snapshot(spark: SparkSession, path: str, snapshot_id: int, keys: Sequence[str]) -> None:
    """Store the keys, row hashes and digests of a snapshot.  One shuffle of narrow rows."""
    rows = read_snapshot(spark, path, snapshot_id)
    others = sorted(c for c in rows.columns if c not in keys)
    # Names and types belong to a row: a changed schema changes every row.
    kind = ",".join(f"{c}:{rows.schema[c].dataType.simpleString()}" for c in others)
    own = rows.select(*keys, F.substring(F.md5(_text(rows, keys)), 1, LEAF).alias("range"),
                      F.md5(F.concat_ws("|", F.lit(kind), _text(rows, others) if others else F.lit(""))).alias("row_hash"))
    root = index_path(path, snapshot_id)
    # By range, so that there are few files beside one per range; a large range is split.
    own.repartitionByRange("range", "row_hash").write.partitionBy("range").parquet(f"{root}/rows")
    stored = _stored(spark, path, snapshot_id, keys, [f"{root}/rows"])
    leaf = stored.groupBy(F.col("range").cast("string").alias("node")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(hex_prefix_int(F.md5(F.concat_ws("|", _text(stored, keys), "row_hash")), 14)
                                                 .cast("decimal(38,0)")).alias("digest"))
    for level in range(LEAF, -1, -1):
        leaf.withColumn("depth", F.lit(level)).coalesce(1).write.parquet(f"{root}/digests/{level}")
        leaf = (spark.read.parquet(f"{root}/digests/{level}").groupBy(F.substring("node", 1, level - 1).alias("node") if level > 1 else F.lit("").alias("node"))
                .agg(F.sum("n_rows").alias("n_rows"), F.sum("digest").cast("decimal(38,0)").alias("digest")))


def differing_ranges(spark: SparkSession, path: str, old: int, new: int) -> list[str]:
    """Ranges of keys in which two indexed snapshots differ (at most 16^LEAF): digests are read level by level,
    below nodes that differ only."""
    nodes = [""]
    for level in range(LEAF + 1):
        sides = [spark.read.parquet(f"{index_path(path, s)}/digests/{level}") for s in (old, new)]
        if level:
            sides = [s.filter(F.substring("node", 1, level - 1).isin(nodes)) if level > 1 else s for s in sides]
        a, b = (s.select("node", F.col("n_rows").alias(f"n{i}"), F.col("digest").alias(f"d{i}")) for i, s in enumerate(sides))
        both = a.join(b, "node", "full").filter(~(F.col("n0").eqNullSafe(F.col("n1")) & F.col("d0").eqNullSafe(F.col("d1"))))
        nodes = sorted(r["node"] for r in both.select("node").collect())
        if not nodes:
            return []
    return nodes


def indexed_rows(spark: SparkSession, path: str, snapshot_id: int, ranges: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Keys and row hashes of some ranges; other ranges' files are not read."""
    root = f"{index_path(path, snapshot_id)}/rows"
    have = set(child_names(spark, root))
    paths = [f"{root}/range={r}" for r in ranges if f"range={r}" in have]
    found = _stored(spark, path, snapshot_id, keys, paths or [root])
    return (found if paths else found.limit(0)).select(*keys, "row_hash")


def changed_keys(spark: SparkSession, path: str, old: int, new: int, keys: Sequence[str]) -> DataFrame:
    """``keys..., change``: keys that were ``added``, ``removed`` or ``changed`` from snapshot ``old`` to ``new``.  Keys
    with null parts are equal to themselves; a key that repeats has changed if its rows have."""
    ranges = differing_ranges(spark, path, old, new)
    sides = []
    for name, snapshot in (("_old", old), ("_new", new)):
        rows = indexed_rows(spark, path, snapshot, ranges, keys)
        # The sum of a key's row hashes: one row per key, whatever the number of its rows.
        total = F.concat_ws(":", F.count(F.lit(1)), F.sum(hex_prefix_int(F.col("row_hash"), 14).cast("decimal(38,0)")))
        sides.append(rows.groupBy(*keys).agg(total.alias(name)))
    a, b = sides[0].alias("a"), sides[1].alias("b")
    same = None
    for k in keys:
        one = F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`"))
        same = one if same is None else same & one
    both = a.join(b, same, "full").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
    return both.select(*[F.when(F.col("_new").isNotNull(), F.col(f"b.`{k}`")).otherwise(F.col(f"a.`{k}`")).alias(k) for k in keys],
                       change.alias("change"))
