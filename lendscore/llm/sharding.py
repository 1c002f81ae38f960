"""Sharding by extendible hashing (operator 4).

A directory over hash prefixes: all rows start in one bucket, and only buckets
over the byte limit split on another bit, until every bucket fits.  A bucket's shard is
its prefix and depth.  A bucket that cannot shrink further, a single row over the
limit, stays as it is.

The hash is 60 bits: 32 from the key and 28 from the row's place among the rows stored with
equal keys, so that a key with many rows splits like any other bucket.  Rows are hashed and stored narrow
(key, bytes, hash); their bytes are summed once per prefix of ``SPARE`` bits more than even
buckets need, and every depth up to there follows from those sums.  Buckets still too
large go to further rounds of ``MORE`` bits, which look only at their own rows.

All DataFrame operations; each sum is partial first, and no step sees more than one
row per prefix of a task's rows.

Defined results: a null or empty text has 0 bytes; a null key hashes like an empty one;
repeated rows are separate rows; an empty table gives an empty result; columns other than
key and text do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hex_prefix_int
from ..session import materialize

BITS, KEY_BITS = 60, 32
#: Bits of the first sums beyond log2(bytes / limit), and bits per further round.
SPARE, MORE = 4, 6
#: Default shard size.
LIMIT_BYTES = 128 << 20


def _prefix(hash_col: Column, bits) -> Column:
    return F.shiftrightunsigned(hash_col, BITS - bits)


def hashed_rows(df: DataFrame, key: str, text: str, whole: bool = False) -> DataFrame:
    """``key, n_bytes, hash`` of every row, stored (places are fixed by the storing); with
    ``whole``, also the ``row`` itself."""
    row = [F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias("row")] if whole else []
    rows = df.select(*row, F.col(key).alias("key"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
                     .alias("n_bytes"), F.monotonically_increasing_id().alias("place"))
    own = hex_prefix_int(F.md5(F.coalesce(F.col("key").cast("string"), F.lit(""))), KEY_BITS // 4)
    other = hex_prefix_int(F.md5(F.col("place").cast("string")), (BITS - KEY_BITS) // 4)
    return materialize(rows.select(*["row"] * whole, "key", "n_bytes", (F.shiftleft(own, BITS - KEY_BITS) + other).alias("hash")),
                       "shard-rows")


def _leaves(sums: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """``fine`` prefix at ``high`` bits, and the depth of the shallowest bucket above it that
    fits (null: none up to ``high``)."""
    depths = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")
    spread = sums.select("fine", "n_bytes", "n_rows", depths)
    above = F.expr(f"shiftrightunsigned(fine, {high} - depth)")
    buckets = (spread.groupBy("depth", above.alias("prefix"))
               .agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_rows").alias("n_rows"))
               .filter((F.col("n_bytes") <= limit) | (F.col("n_rows") == 1)))
    fits = sums.select("fine", depths).withColumn("prefix", above).join(
        buckets.select("depth", "prefix"), ["depth", "prefix"])
    found = fits.groupBy("fine").agg(F.min("depth").alias("leaf"))
    return sums.select("fine").join(found, "fine", "left")


def assign(df: DataFrame, key: str = "doc_id", text: str = "text", limit_bytes: int = LIMIT_BYTES,
           whole: bool = False) -> DataFrame:
    """``key, n_bytes, depth, prefix`` per row: the shard is the ``prefix`` of ``depth`` bits.
    With ``whole``, a struct ``row`` of all columns comes before them."""
    rows, kept = hashed_rows(df, key, text, whole), [*["row"] * whole, "key", "n_bytes"]
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit_bytes)))) + SPARE)
    out = None
    while True:
        fine = rows.withColumn("fine", _prefix(F.col("hash"), high))
        sums = fine.groupBy("fine").agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows"))
        leaves = materialize(_leaves(sums, low, high, limit_bytes), "shard-directory")
        if high == BITS:
            leaves = leaves.fillna(BITS, ["leaf"])
        placed = fine.join(leaves, "fine")
        done = placed.filter("leaf IS NOT NULL").select(
            *kept, F.col("leaf").alias("depth"),
            F.expr(f"shiftrightunsigned(hash, {BITS} - leaf)").alias("prefix"))
        out = done if out is None else out.unionByName(done)
        if high == BITS or leaves.filter("leaf IS NULL").isEmpty():
            return out
        rows = materialize(placed.filter("leaf IS NULL").select(*kept, "hash"), "shard-rows")
        low, high = high + 1, min(BITS, high + MORE)


def directory(assigned: DataFrame) -> DataFrame:
    """One row per shard: ``depth, prefix, n_rows, n_bytes``."""
    return assigned.groupBy("depth", "prefix").agg(F.count("*").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))


def write_shards(df: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 limit_bytes: int = LIMIT_BYTES) -> tuple[str, str]:
    """Write every row of ``df`` under ``path``, one folder per shard named by its depth and prefix; rows travel with
    their hash, so keys may be null or repeat.  Returns the folders' column names: ``depth`` and
    ``prefix``, or longer ones where ``df`` has such columns (in any case), which stay as they are."""
    taken, names = {c.lower() for c in df.columns}, []
    for name in ("depth", "prefix"):
        while name in taken:
            name = f"shard_{name}"
        names.append(name)
    placed = assign(df, key, text, limit_bytes, whole=True)
    (placed.select("row.*", F.col("depth").alias(names[0]), F.col("prefix").alias(names[1])).repartition(*names)
     .write.partitionBy(*names).parquet(path))
    return names[0], names[1]
