"""Small side tables of a stream, one version for each micro-batch.

A version is a folder ``batch_id=N`` below the table's path. A batch reads the newest version
before its own and writes its own, so a batch that runs again reads and writes the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _children(spark: SparkSession, path: str) -> dict[int, str]:
    """Finished versions by number; a folder without the writer's success mark is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    base = hadoop(path)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(base):
        return {}
    named = {s.getPath().getName(): s.getPath().toString() for s in files.listStatus(base)}
    return {int(n.removeprefix("batch_id=")): p for n, p in named.items() if n.startswith("batch_id=") and files.exists(hadoop(p, "_SUCCESS"))}


def newest(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """Number of the newest version (before a batch)."""
    return max((n for n in _children(spark, path) if before is None or n < before), default=None)


def read(spark: SparkSession, path: str, schema, before: int | None = None) -> DataFrame:
    """The newest version (before a batch); no rows if there is none."""
    number = newest(spark, path, before)
    return spark.createDataFrame([], schema) if number is None else spark.read.schema(schema).parquet(f"{path}/batch_id={number}")


def write(df: DataFrame, path: str, batch_id: int, keep: int = 3) -> None:
    """Write a batch's version; versions older than the last ``keep`` go."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    old = sorted(n for n in _children(spark, path) if n < batch_id)[: -keep or None]
    for number in old:
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={number}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
