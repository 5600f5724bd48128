"""The stateful streams over the tables, replayed to their end; each equals its batch report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.calendar import DAY_MS, epoch_ms
from marketlens.functions.columns import money
from marketlens.operators.windows import window_text
from marketlens.plans import behaviour, oracles, sales
from marketlens.sources import changes as chg
from marketlens.sources import pagelog
from marketlens.sources.shop import Shop
from marketlens.streaming import jobs, late, stateful
from marketlens.streaming.replay import kept, new_folder, run, stored_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
END_MS = 1_900_000_000_000  # a time after all rows
END_ID = -1


def query(equals: str):
    """Register a stream with the SQL of the batch report that it equals."""
    def add(fn: Callable[[Shop, str], DataFrame]) -> Callable[[Shop, str], DataFrame]:
        QUERIES[fn.__name__] = lambda spark, folder: fn(Shop(spark, folder), new_folder(spark, fn.__name__))
        ORACLES[fn.__name__] = oracles.ORACLES[equals]
        return fn
    return add


def _log(s: Shop, folder: str) -> DataFrame:
    """The page log as a stream under a watermark, with an end row of a user of its own."""
    rows = s.page_log().withColumn("ms", epoch_ms("ts"))
    end = {"ms": F.lit(END_MS), "ts": F.lit(END_MS), "user_id": F.lit(END_ID), "log_id": F.lit(END_ID), "log_type": F.lit("home_page")}
    return jobs.with_event_time(stored_stream(rows, f"{folder}/in", "ms", end), "ts", "1 hour")


@query("session_restarts")
def stream_session_restarts(s, folder):
    return run(stateful.session_restarts(_log(s, folder)), folder)


@query("user_paths")
def stream_user_paths(s, folder):
    return run(stateful.user_paths(_log(s, folder)), folder)


@query("running_counts")
def stream_running_counts(s, folder):
    keys = ["stat_date", "log_type"]
    rows = behaviour.with_ms(_log(s, folder)).select("log_id", *keys, "ms", "event_time")
    run(stateful.places(rows, keys, "ms", "log_id"), folder, sink=late.running_count_sink(f"{folder}/counts", keys))
    return s.spark.read.parquet(f"{folder}/counts/rows").where(F.col("log_id") != END_ID).select("log_id", "stat_date", F.col("log_type").alias("page"), "running_count")


@query("last_per_interval")
def stream_last_per_interval(s, folder):
    rows = _log(s, folder).select("log_id", "user_id", "log_type", "ms", "event_time")
    return run(stateful.last_per_interval(rows, "user_id", "ms", "log_id", 7_200_000), folder)


@query("user_profiles")
def stream_user_profiles(s, folder):
    rows = s.page_log().withColumn("ms", epoch_ms("ts"))
    every = run(stateful.user_profiles(stored_stream(rows, f"{folder}/in", "ms")), folder, "update")
    latest = every.groupBy("user_id").agg(F.max_by(F.struct(*[c for c in every.columns if c != "user_id"]), "events").alias("r"))
    return latest.select("user_id", "r.*").drop("events", "batch_id")


@query("user_log_profile")
def stream_user_log_profile(s, folder):
    pages = pagelog.reshape_page_log(pagelog.parse_log(s.raw_log()))
    timed = jobs.with_event_time(stored_stream(pages, f"{folder}/in", "ts"), "ts", "1 hour")
    every = run(stateful.user_log_profile(jobs.first_per_payload(timed, ignore=("log_id",))), folder, "update").drop("batch_id")
    latest = every.groupBy("uid").agg(F.max("pv").alias("pv"))
    return every.join(latest, ["uid", "pv"]).withColumn("last_search", F.coalesce("last_search", F.lit("")))


@query("cumulate_measures")
def stream_cumulate_measures(s, folder):
    rows = sales.sale_rows(s.oms_sale()).select("user_id", "ms", "amount", F.lit(1).cast("long").alias("one"))
    timed = jobs.with_event_time(stored_stream(rows, f"{folder}/in", "ms", {"ms": F.lit(END_MS)}), "ms", "1 hour")
    sums, distinct = {"gmv": F.col("amount"), "orders": F.col("one")}, {"buyers": "user_id"}
    parts = stateful.cumulate(timed, sales.TEN_MINUTES, sums, [], distinct)
    run(parts, folder, sink=kept(folder, lambda part: stateful.cumulated(part, [], [*sums, *distinct])))
    found = s.spark.read.parquet(f"{folder}/out").where(F.col("window_start") < END_MS - DAY_MS)
    return window_text(found).select("window_start", "window_end", money("gmv").alias("gmv"), "orders", "buyers")


@query("tumble")
def stream_late_totals(s, folder):
    """The newest file comes first, so all others are late; with them the totals are whole."""
    rows = sales.sale_rows(s.oms_sale()).select("id", "ms", "amount")
    timed = jobs.with_event_time(stored_stream(rows, f"{folder}/in", "ms", latest_first=True), "ms")
    run(timed, folder, sink=late.late_totals_sink(f"{folder}/totals", sales.TEN_MINUTES, 60_000, [], {"amount": F.col("amount")}))
    found = late.totals(s.spark, f"{folder}/totals", [], ["amount"]).withColumn("window_end", F.col("window_start") + sales.TEN_MINUTES)
    return window_text(found).select("window_start", "window_end", money("amount").alias("window_sales"), F.col("n_rows").alias("order_count"))


@query("repair_is_new")
def stream_repair_is_new(s, folder):
    log = pagelog.parse_log(s.raw_log()).where("_bad is null and common is not null")
    rows = log.select("log_id", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts")
    return run(stateful.repair_is_new(stored_stream(rows, f"{folder}/in", "ts")), folder)


@query("route_changes")
def stream_route_changes(s, folder):
    changes = stored_stream(chg.parse_changes(s.change_log()), f"{folder}/in", "ts_ms")
    config = stored_stream(s.routing_config(), f"{folder}/config")
    return run(stateful.route_changes(changes, config), folder).select("sink_table", "row_key", "ts_ms")
