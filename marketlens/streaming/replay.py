"""Stored rows read again as a stream, in a given order, to its end.

A replay runs a streaming plan over a table as it would run over live rows: the rows are written
as files in the order of a column, read one file for each micro-batch, and the query ends when all
are read. An end row with a far later time lets the watermark pass everything before it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.streaming import jobs

FILES = 4


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return "file:" + tempfile.mkdtemp(prefix="replay-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, below ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = _local_folder()
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_stream(rows: DataFrame, folder: str, order: str | None = None, end: dict[str, Column] | None = None, files: int = FILES, latest_first: bool = False) -> DataFrame:
    """Write rows in the order of a column and return them as a stream of one file a batch.

    Rows of one value stay in one file. ``end`` gives the columns in which the end row differs
    from one of the rows. The files' change times are set, as the stream reads by them.
    """
    spark = rows.sparkSession
    dealt = rows.coalesce(1) if order is None else rows.repartitionByRange(files, order)
    dealt.write.parquet(f"{folder}/rows")
    written = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    if end is not None:
        written.limit(1).withColumns(end).select(*[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]).coalesce(1).write.parquet(f"{folder}/zend")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files_of = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [s.getPath() for part in ("rows", "zend") if files_of.exists(hadoop(f"{folder}/{part}")) for s in sorted(
        files_of.listStatus(hadoop(f"{folder}/{part}")), key=lambda s: s.getPath().getName()) if s.getPath().getName().startswith("part-")]
    for number, path in enumerate(reversed(parts) if latest_first else parts):
        files_of.setTimes(path, 1_600_000_000_000 + 60_000 * number, -1)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def run(df: DataFrame, folder: str, mode: str = "append", sink: jobs.Batch | None = None) -> DataFrame | None:
    """Run a streaming plan to its end. Without a sink, returns the rows it wrote, or in update
    mode those of every batch with its number as ``batch_id``."""
    out = f"{folder}/out"
    if mode == "update" and sink is None:
        def sink(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        own = True
    else:
        own = sink is None
    jobs.start(df, f"{folder}/checkpoint", sink or out, mode, {"availableNow": True}).awaitTermination()
    return df.sparkSession.read.parquet(out) if own else None


def kept(folder: str, change: Callable[[DataFrame], DataFrame]) -> jobs.Batch:
    """A sink that writes each batch, changed, below a folder of its number."""
    def write(batch: DataFrame, batch_id: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")
    return write
