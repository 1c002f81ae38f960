"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app_name: str = "lendscore",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this package assumes.

    On a cluster ``master`` is left to spark-submit; locally pass
    ``local[N]``.  AQE stays on so shuffle partitions are coalesced and
    skewed joins are split at runtime.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their working
    folder; a cluster without that path gets it with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def storage_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates, tables and stream state.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a local session without
    one gets a private temporary folder; on a cluster the executors
    could not see it, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lendscore-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared storage root."""
    return f"{storage_root(spark)}/lendscore/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage by writing ``df`` as a parquet table under the shared
    storage root and reading it back.

    Columnar and compressed (much cheaper than an RDD checkpoint of rows),
    survives executor loss (it lives on the shared file system, not on an
    executor), and gives later jobs exact statistics for join planning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path``; none, if it does not exist."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def claim(spark: SparkSession, path: str) -> bool:
    """Create the empty marker file ``path``; False, if another writer has it."""
    fs, p = _file_system(spark, path)
    fs.mkdirs(p.getParent())
    return not fs.exists(p) and bool(fs.createNewFile(p))


def marker_age(spark: SparkSession, path: str) -> float:
    """Seconds since a marker file was made."""
    fs, p = _file_system(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000.0


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Move a finished folder to its final place, which must not exist."""
    fs, p = _file_system(spark, staged)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(p, target):
        raise FileExistsError(f"{path} exists already")


class Intermediates:
    """Stored intermediates of one job, removed when the job is done::

        with Intermediates(spark) as own:
            table = own.store(df, "scored")
            ...
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def store(self, df: DataFrame, name: str = "stage") -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Remove one stored table that nothing reads any more."""
        for path in [p for p in self.paths if any(p in f for f in df.inputFiles()[:1])]:
            self._delete(path)
            self.paths.remove(path)

    def _delete(self, path: str) -> None:
        fs, p = _file_system(self.spark, path)
        fs.delete(p, True)

    def __enter__(self) -> Intermediates:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            self._delete(path)
        self.paths.clear()
