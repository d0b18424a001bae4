"""Shared scratch tables that cut lineage and survive the loss of executors.

Iterative operators write what they carry from round to round as Parquet below
``spark.checkpoint.dir``, the folder that the driver and all executors share.
Only where that setting is empty (unit tests, a laptop) a temporary folder of
this machine is used, and the setting is filled in for the session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder below which scratch tables go; never a local folder on a cluster."""
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tomeflow-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return root.rstrip("/")


class Workspace:
    """A private folder of scratch tables below the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/tomeflow/{name}-{uuid.uuid4().hex}"
        self._serial = 0

    def new_path(self, name: str) -> str:
        self._serial += 1
        return f"{self.path}/{self._serial:04d}-{name}"

    def stage(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write ``df`` once and return a reader of the written table."""
        path = self.new_path(name)
        df.write.options(compression="zstd", **options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete staged tables that nothing reads any more."""
        for df in tables:
            if path := getattr(df, "_staged_path", None):
                self._delete(path)

    def clear(self) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
