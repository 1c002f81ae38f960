"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 2 << 20


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever
    their working folder; a cluster without that path gets it with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def small_batches(spark: SparkSession) -> None:
    """Let texts reach Python in Arrow batches of about ``BATCH_BYTES``, unless the session sets a size.  A batch
    is held by the JVM outside its heap and by the worker, and neither gives such memory back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query are removed when it ends.  Else they stay until the driver happens to collect its
    garbage, and those of long jobs add up on the executors' disks."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(key: Column, mod: int) -> Column:
    """``crc32(key as text) mod n`` (null for a null key)."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(mod)


def temp_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name in taken:
        name += "_"
    return name


def as_text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def sample_share(distinct: int, max_rows: int) -> float:
    """Chance of a text to be in a sample of about ``max_rows`` texts, however many there are."""
    return min(1.0, max_rows / max(1, distinct))


def distinct_sample(df: DataFrame, text_col: str, max_rows: int) -> DataFrame:
    """Rows of about ``max_rows`` texts, chosen by a 64-bit hash; rows that repeat one count once, so a very common
    text is one row.  All texts, if there are no more."""
    h = F.xxhash64(F.col(text_col))
    share = sample_share(df.agg(F.approx_count_distinct(h)).first()[0], max_rows)
    chosen = df if share >= 1.0 else df.filter(h.cast("double") / 2.0 ** 64 + 0.5 < share)
    name = temp_name(df, "hash")
    others = [c for c in df.columns if c != text_col]
    return chosen.groupBy(h.alias(name), *others).agg(F.first(text_col).alias(text_col)).select(df.columns)


class BoundedCache(dict):
    """A dict that computes missing values with ``make`` and starts again when
    it holds ``limit`` entries, so that a long-lived worker stays bounded."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def list_array(parts: Sequence[np.ndarray], dtype, kind: pa.DataType) -> pa.ListArray:
    """Arrow list array of one numpy array per row."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if len(parts) else np.empty(0, dtype=dtype)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(dtype, copy=False), type=kind))


def slices(column: pa.Array, rows: int = 512) -> Iterable[pa.Array]:
    """Pieces of an Arrow column, so that work on one batch stays small."""
    for start in range(0, len(column), rows):
        yield column.slice(start, rows)
