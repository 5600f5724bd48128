"""A stream over files ends with what the batch form gives for the same rows."""

import json

import pytest
from pyspark.sql import functions as F

from marketlens.streaming import jobs
from tests.streams import put

SCHEMA = "id long, user string, kind string, amount long, ts string"
DAY = 1_704_067_200_000
NOW = {"availableNow": True}


@pytest.fixture
def folder(tmp_path):
    """Three files, read in this order: rows out of order, repeated, without a time, and at last far later rows."""
    path = str(tmp_path / "in")
    def row(k, ms, kind="buy"):
        return {"id": k, "user": f"u{k % 3}", "kind": kind, "amount": k, "ts": str(ms)}
    files = [[row(k, DAY + 1000 * ((k * 7) % 50)) for k in range(50)],
             [row(k, DAY + 60_000 + 1000 * k, "view") for k in range(50, 80)] + [row(7, DAY + 1000 * 49)] + [{"id": 99, "ts": "never"}, {"id": 98}],
             [row(200, DAY + 90_000_000)]]
    for n, rows in enumerate(files):
        put(path, n, rows)
    return path


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)


def test_rows_without_a_time_are_rejected_not_lost(spark, folder, tmp_path):
    jobs.start(jobs.without_time(stream(spark, folder), "ts"), str(tmp_path / "c"), str(tmp_path / "bad"), trigger=NOW).awaitTermination(120)
    assert sorted(json.loads(r.line)["id"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == [98, 99]


def test_windows_equal_the_batch(spark, folder, tmp_path):
    rows = jobs.with_event_time(stream(spark, folder), "ts", "1 minute")
    totals = jobs.window_totals(rows, "10 seconds", ["kind"], {"n": F.count("*"), "amount": F.sum("amount")})
    jobs.start(totals, str(tmp_path / "c"), str(tmp_path / "out"), trigger=NOW).awaitTermination(120)
    batch = spark.read.schema(SCHEMA).json(folder).where("try_cast(ts as long) is not null and id < 200")
    start = F.floor(F.col("ts").cast("long") / 10_000) * 10_000
    expected = batch.groupBy(start.alias("w"), "kind").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    found = spark.read.parquet(str(tmp_path / "out")).where(F.col("window_start") < DAY + 80_000_000)
    assert sorted((r.window_start, r.kind, r.n, r.amount) for r in found.collect()) == sorted((r.w, r.kind, r.n, r.amount) for r in expected.collect())


def test_day_totals_are_merged_by_key(spark, folder, tmp_path):
    rows = jobs.with_event_time(stream(spark, folder), "ts", "1 hour")
    totals = jobs.day_totals(rows, ["user"], {"n": F.count("*")})
    sink = jobs.upsert_sink(str(tmp_path / "days"), ["user"], "n", ["stat_date"])
    jobs.start(totals, str(tmp_path / "c"), sink, "update", NOW).awaitTermination(180)
    found = {(str(r.stat_date), r.user): r.n for r in spark.read.parquet(str(tmp_path / "days")).collect()}
    batch = spark.read.schema(SCHEMA).json(folder).where("try_cast(ts as long) is not null").groupBy(
        F.date_format(F.timestamp_millis(F.col("ts").cast("long")), "yyyy-MM-dd").alias("d"), "user").agg(F.count("*").alias("n"))
    assert found == {(r.d, r.user): r.n for r in batch.collect()}


def test_repeats_are_dropped(spark, folder, tmp_path):
    rows = jobs.with_event_time(stream(spark, folder), "ts", "1 hour")
    jobs.start(jobs.first_per_key(rows, ["id"]), str(tmp_path / "c"), str(tmp_path / "out"), trigger=NOW).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [*range(80), 200]


def test_interval_join_equals_the_batch(spark, folder, tmp_path):
    rows = jobs.with_event_time(stream(spark, folder), "ts", "1 hour").select("id", "user", "kind", "event_time")
    again = jobs.with_event_time(stream(spark, folder), "ts", "1 hour").select("id", "user", "kind", "event_time")
    joined = jobs.interval_join(rows.where("kind = 'buy'"), again.where("kind = 'view'"), "user", "user", "0 seconds", "40 seconds")
    jobs.start(joined.select("id", "info_id"), str(tmp_path / "c"), str(tmp_path / "out"), trigger=NOW).awaitTermination(180)
    batch = spark.read.schema(SCHEMA).json(folder).where("try_cast(ts as long) is not null").selectExpr("id", "user", "kind", "cast(ts as long) as ms")
    a, b = batch.where("kind = 'buy'").alias("a"), batch.where("kind = 'view'").alias("b")
    expected = a.join(b, F.expr("a.user = b.user and b.ms between a.ms and a.ms + 40000")).selectExpr("a.id", "b.id as other")
    assert sorted((r.id, r.info_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted((r.id, r.other) for r in expected.collect())


def test_a_fan_out_writes_each_batch_once(spark, folder, tmp_path):
    sink = jobs.fan_out_sink(lambda b: {"buy": (b.where("kind = 'buy'"), str(tmp_path / "buy")), "view": (b.where("kind = 'view'"), str(tmp_path / "view"))})
    jobs.start(stream(spark, folder), str(tmp_path / "c"), sink, trigger=NOW).awaitTermination(120)
    sink(spark.read.schema(SCHEMA).json(folder + "/0.json"), 0)  # a retry of the first batch
    assert spark.read.json(str(tmp_path / "buy")).count() == 52 and spark.read.json(str(tmp_path / "view")).count() == 30
