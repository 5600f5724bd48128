"""Intermediate tables in the folder that driver and executors share.

A written table cuts the lineage: a lost executor costs only the tasks that read or write at
that time. The folder is the session's ``spark.checkpoint.dir``; a local session without the
setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return "file:" + tempfile.mkdtemp(prefix="corpus-")


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _local_folder()


class Scratch:
    """Tables of one run of an operator, below a folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        """Write a table and read it again."""
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
