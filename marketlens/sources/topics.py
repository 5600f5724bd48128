"""Message topics: JSON rows in and out, from Kafka or from files of the same records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.streaming.jobs import with_event_time, without_time


def kafka_options(servers: str, topic: str, start: str | int = "latest") -> dict:
    """Source options; ``start`` is earliest, latest or an epoch millisecond."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "failOnDataLoss": "false"}
    if isinstance(start, int):
        out["startingTimestamp"] = str(start)
        out["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        out["startingOffsets"] = start
    return out


def kafka_sink_options(servers: str, topic: str) -> dict:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": "true"}


def decode(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Typed rows of JSON messages. Missing fields are null; empty and unreadable messages
    are dropped here (``rejects`` returns them)."""
    text = F.col(value).cast("string")
    return df.select(F.from_json(text, schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"),
                     text.alias("_text")).where("_text is not null and trim(_text) <> '' and r._bad is null").select("r.*").drop("_bad")


def rejects(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    text = F.col(value).cast("string")
    parsed = F.from_json(text, schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return df.select(text.alias("line"), parsed.alias("r")).where("line is not null and trim(line) <> '' and r._bad is not null").select("line")


def raw_stream(spark: SparkSession, source: dict) -> DataFrame:
    """Messages as they come, with their text in ``value``.

    ``source`` is either ``{"format": "kafka", **kafka_options(...)}`` or
    ``{"format": "text", "path": folder}``.
    """
    options = {k: v for k, v in source.items() if k not in ("format", "path")}
    return spark.readStream.format(source["format"]).options(**options).load(source.get("path"))


def read_json_stream(spark: SparkSession, source: dict, schema: str, ts: str, lateness: str = "5 seconds") -> tuple[DataFrame, DataFrame]:
    """Typed rows with event time and watermark, and beside them the rejects as text lines.

    Rejects are messages that are not JSON of the schema, and rows without a readable time. Each
    of the two frames is a query of its own when started.
    """
    raw = raw_stream(spark, source)
    rows = decode(raw, schema)
    return with_event_time(rows, ts, lateness), rejects(raw, schema).unionByName(without_time(rows, ts))


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON messages, keyed if asked."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def write_json_stream(df: DataFrame, sink: dict, checkpoint: str, trigger: dict | None = None):
    """Start a query that writes JSON messages to a topic, or to text files in tests."""
    key = sink.get("key_column") if sink["format"] == "kafka" else None
    return write_messages(to_messages(df, key), sink, checkpoint, trigger)


def pass_through(raw: DataFrame, key: str | None = None, value: str = "value") -> DataFrame:
    """Messages of a change log as they are, byte for byte, for another topic or for files.

    ``key`` is a JSON path whose value becomes the message key, such as ``$.source.table``; null
    messages (tombstones) go on too.
    """
    text = F.col(value).cast("string")
    return raw.select(F.get_json_object(text, key).alias("key"), text.alias("value")) if key else raw.select(text.alias("value"))


def write_messages(messages: DataFrame, sink: dict, checkpoint: str, trigger: dict | None = None):
    """Start a query that writes (key, value) messages to a topic, or their values to text files."""
    options = {k: v for k, v in sink.items() if k not in ("format", "path", "key_column")}
    own = messages if sink["format"] == "kafka" else messages.select("value")
    writer = own.writeStream.format(sink["format"]).options(**options).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "30 seconds"}))
    return writer.start(sink["path"]) if "path" in sink else writer.start()
