"""Streams: event time, windows, day totals, de-duplication, interval joins, keyed sinks.

Every function takes a streaming DataFrame (the batch forms take the same columns) and leaves
the plan to Structured Streaming. State is bounded by the watermark that ``with_event_time`` sets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlens.functions.calendar import day_text, epoch_ms
from marketlens.operators.joins import merge_columns
from marketlens.sources.sinks import fan_out, merge_partitions

Batch = Callable[[DataFrame, int], None]


def with_event_time(df: DataFrame, ts: str, lateness: str = "5 seconds") -> DataFrame:
    """Rows with a readable time as ``event_time``, under a watermark."""
    timed = df.withColumn("event_time", F.timestamp_millis(epoch_ms(F.col(ts).try_cast("long"))))
    return timed.where("event_time is not null").withWatermark("event_time", lateness)


def without_time(df: DataFrame, ts: str) -> DataFrame:
    """The rows that ``with_event_time`` leaves out, as JSON lines for a reject sink."""
    return df.where(F.col(ts).try_cast("long").isNull()).select(F.to_json(F.struct(*df.columns)).alias("line"))


def window_totals(df: DataFrame, size: str, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Aggregates per tumbling window and keys, each emitted once when the watermark has passed.

    Rows later than the watermark allows are left out, as the window is closed.
    """
    return df.groupBy(F.window("event_time", size).alias("w"), *keys).agg(*[c.alias(name) for name, c in aggs.items()]).select(
        F.unix_millis("w.start").alias("window_start"), F.unix_millis("w.end").alias("window_end"), *keys, *aggs)


def day_totals(df: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Aggregates per day and keys, for update mode: a changed row is emitted again.

    The day is a window, so its state leaves with the watermark.
    """
    return df.groupBy(F.window("event_time", "1 day").alias("w"), *keys).agg(*[c.alias(name) for name, c in aggs.items()]).select(
        day_text("w.start").alias("stat_date"), *keys, *aggs)


def first_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The first row to arrive of every key; keys are forgotten after the watermark's delay."""
    return df.dropDuplicatesWithinWatermark(keys)


def first_per_payload(df: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose whole payload has not arrived before, as far as the watermark reaches."""
    return df.dropDuplicatesWithinWatermark([c for c in df.columns if c not in ignore])


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, before: str, after: str,
                  policy: str = "prefix", take: list[str] | None = None) -> DataFrame:
    """Pairs of equal key with the right ``event_time`` in [left - before, left + after].

    Both sides need a watermark; with the time bounds it limits how long rows are kept.
    """
    near = (F.col(f"a.{left_key}") == F.col(f"b.{right_key}")) & F.col("b.event_time").between(
        F.col("a.event_time") - F.expr(f"interval {before}"), F.col("a.event_time") + F.expr(f"interval {after}"))
    return merge_columns(left.alias("a").join(right.alias("b"), near), left.columns, right.columns, policy, take)


def upsert_sink(path: str, keys: list[str], order_col: str, partitions: list[str]) -> Batch:
    """Micro-batches merged into a partitioned table by key; running one again changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        merge_partitions(batch.sparkSession, path, batch, keys, order_col, partitions)
    return write


def fan_out_sink(outputs: Callable[[DataFrame], dict[str, tuple[DataFrame, str]]]) -> Batch:
    """Micro-batches written to several places, each below a folder of its batch number."""
    def write(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, outputs(batch), batch_id)
    return write


def start(df: DataFrame, checkpoint: str, sink: Batch | str, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Start a query whose progress is kept in ``checkpoint``, a folder all executors reach.

    ``sink`` is a function of micro-batches or the folder of a Parquet table. Sources that can be
    read again and the sinks above together write every row's effect exactly once.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"}))
    if callable(sink):
        return writer.foreachBatch(sink).start()
    return writer.format("parquet").start(sink)
