"""Rows behind the watermark: kept, counted, and added to the totals they belong to.

``late_totals_sink`` writes, for a stream of rows with ``event_time``, below one folder:

* ``partials``: each micro-batch's aggregates per window and keys, apart for rows in time and
  late rows (those whose window had already ended when they came);
* ``late_rows``: the late rows themselves;
* ``progress``: the largest event time so far.

Every batch owns its partitions and replaces them when it runs again, so each row counts once.
Aggregation combines before the shuffle; a hot window or key is no single task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.functions.calendar import ms_day
from marketlens.operators.ordered import BEFORE
from marketlens.sources.sinks import merge_partitions, overwrite_dynamic
from marketlens.streaming import versions

Batch = Callable[[DataFrame, int], None]


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def late_totals_sink(folder: str, size: int, lateness: int, keys: list[str], sums: dict[str, Column]) -> Batch:
    """Totals per window of ``size`` milliseconds and keys from micro-batches.

    The watermark of a batch is the largest event time of the batches before it less ``lateness``
    milliseconds. ``sums`` are expressions that are added up; ``n_rows`` is counted besides. Rows
    without an event time must be routed away before.
    """
    progress = "ms long"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        reached = versions.read(spark, f"{folder}/progress", progress, batch_id).agg(F.max("ms")).first()[0]
        ms = F.unix_millis("event_time")
        start = (F.floor(ms / size) * size).cast("long")
        closed = F.lit(False) if reached is None else start + size <= reached - lateness
        rows = batch.withColumns({"window_start": start, "late": closed})
        batch.persist()
        try:
            partials = rows.groupBy("late", "window_start", *keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()], F.count(F.lit(1)).alias("n_rows"))
            overwrite_dynamic(partials.withColumns({"stat_date": ms_day("window_start"), "batch_id": F.lit(batch_id)}),
                              f"{folder}/partials", ["stat_date", "late", "batch_id"])
            rows.where("late").drop("late").write.mode("overwrite").parquet(f"{folder}/late_rows/batch_id={batch_id}")
            top = batch.agg(F.max(ms).alias("ms")).select(F.greatest("ms", F.lit(reached).cast("long")).alias("ms"))
            versions.write(top, f"{folder}/progress", batch_id)
        finally:
            batch.unpersist()
    return write


def totals(spark: SparkSession, folder: str, keys: list[str], names: list[str], with_late: bool = True) -> DataFrame:
    """(stat_date, window_start, keys, sums, n_rows); without late rows, what the windows held as they ended."""
    partials = spark.read.parquet(f"{folder}/partials")
    own = partials if with_late else partials.where("not late")
    return own.groupBy(F.col("stat_date").cast("string").alias("stat_date"), "window_start", *keys).agg(*[F.sum(n).alias(n) for n in (*names, "n_rows")])


def late_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_id, n_late) of every batch that had late rows."""
    found = _table(spark, f"{folder}/late_rows")
    if found is None or "batch_id" not in found.columns:
        return spark.createDataFrame([], "batch_id int, n_late long")
    return found.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_late"))


def repair(spark: SparkSession, folder: str, target: str, keys: list[str], names: list[str], since: int = -1) -> None:
    """Upsert the totals of the windows that got late rows after batch ``since`` into a table.

    ``target`` holds what ``totals`` returns, partitioned by day; a window's row with more rows is
    the newer one, so a repair that runs again changes nothing. Only days with late rows are
    written.
    """
    partials = spark.read.parquet(f"{folder}/partials")
    touched = partials.where(F.col("late") & (F.col("batch_id") > since)).select(F.col("stat_date").cast("string").alias("stat_date"), "window_start").distinct()
    fixed = totals(spark, folder, keys, names).join(touched, ["stat_date", "window_start"], "left_semi")
    merge_partitions(spark, target, fixed, ["window_start", *keys], "n_rows", ["stat_date"])


def running_count_sink(folder: str, keys: list[str]) -> Batch:
    """Finish ``stateful.places``: ``running_count`` of every row, written below ``rows``.

    A batch holds whole slices, later ones than all batches before it. A row's count is its place
    in the slice, the slices before it in the batch, and the key's total of earlier batches, which
    is kept in ``totals``, one row for each key.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = T.StructType([*[T.StructField(k, batch.schema[k].dataType) for k in keys], T.StructField("total", T.LongType())])
        held = versions.read(spark, f"{folder}/totals", schema, batch_id)
        batch.persist()
        try:
            slices = batch.groupBy(*keys, "_chunk").agg(F.max("_place").alias("_size"))
            # The earlier total enters as a slice before all others; null keys group like any others.
            both = slices.unionByName(held.select(*keys, F.lit(-(1 << 62)).alias("_chunk"), F.col("total").alias("_size")))
            ordered = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(*BEFORE)
            offsets = both.withColumn("_before", F.coalesce(F.sum("_size").over(ordered), F.lit(0))).drop("_size")
            same = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in (*keys, "_chunk")]
            counted = batch.alias("r").join(offsets.alias("o"), reduce(and_, same)).select(
                *[f"r.{c}" for c in batch.columns if c not in ("_chunk", "_place")], (F.col("_place") + F.col("_before")).alias("running_count"))
            counted.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")
            versions.write(both.groupBy(*keys).agg(F.sum("_size").alias("total")), f"{folder}/totals", batch_id)
        finally:
            batch.unpersist()
    return write
