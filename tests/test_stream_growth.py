"""Stateful streams keep the work of a key inside Spark: what a task asks its state does not grow with rows or days."""

import pytest

from marketlens.streaming import jobs, stateful
from tests.streams import DAY, HOUR, put, rows, run, source

LOG = "log_id long, user_id long, ts long, log_type string"


def log(spark, path):
    return jobs.with_event_time(source(spark, path, LOG), "ts", "1 hour")


@pytest.mark.parametrize("stream", ["last", "places", "restarts"])
def test_windows_are_aggregated_by_spark(spark, tmp_path, stream):
    put(str(tmp_path / "in"), 0, [{"log_id": 1, "user_id": 1, "ts": DAY, "log_type": "search"}])
    rows_of = log(spark, str(tmp_path / "in"))
    built = {"last": lambda: stateful.last_per_interval(rows_of, "user_id", "ts", "log_id", HOUR),
             "places": lambda: stateful.places(rows_of, ["log_type"], "ts", "log_id"),
             "restarts": lambda: stateful.session_restarts(rows_of)}[stream]()
    plan = built._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "Aggregate" in plan


def test_a_path_asks_for_the_user_once_in_a_batch(spark, tmp_path):
    put(str(tmp_path / "in"), 0, [{"log_id": d, "user_id": 1, "ts": DAY + d * 24 * HOUR, "log_type": "payment"} for d in range(3)])
    plan = stateful.user_paths(log(spark, str(tmp_path / "in")))._jdf.queryExecution().analyzed().toString()
    assert plan.index("TransformWithState") < plan.index("Aggregate")


def test_sessions_of_days_in_another_zone(spark, tmp_path):
    """A day of New York lies in two days of UTC."""
    at = [DAY + 20 * HOUR, DAY + 23 * HOUR, DAY + 26 * HOUR, DAY + 30 * HOUR, DAY + 96 * HOUR]
    put(str(tmp_path / "in"), 0, [{"log_id": n, "user_id": 1, "ts": ms, "log_type": "search"} for n, ms in enumerate(at)])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        run(stateful.session_restarts(log(spark, str(tmp_path / "in"))), tmp_path / "c", tmp_path / "out")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(found, ["session_start"]) == [(at[1],), (at[2],)]
