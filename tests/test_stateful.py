"""Stateful streams end with what the batch forms give for the same rows."""

import random
import time

import pytest
from pyspark.sql import functions as F

from marketlens.operators import ordered, windows
from marketlens.plans import behaviour, labels
from marketlens.sources import pagelog
from marketlens.streaming import jobs, late, stateful
from tests.streams import DAY, HOUR, Running, put, rows, run, source

LOG = ("log_id long, user_id long, ts long, log_type string, keyword string, order_id long, product_id long, net string, "
       "brand string, plat string, platv string, amount long")
PAGES = ["app_launch", "home_page", "search", "product_list", "product_detail", "add_cart", "order_confirm", "payment"]


def events(n=400, days=3, seed=5):
    """Events of six users, one of them with half of all; some times are equal, some keys null."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        ms = DAY + rng.randrange(days * 24 * 12) * 300_000 + rng.choice([0, 0, 1, 999])
        page = rng.choice(PAGES)
        out.append({
            "log_id": k, "user_id": rng.choice([1, 1, 1, 2, 3, 4, 5, None]), "ts": ms, "log_type": rng.choice([page, page, "other"]),
            "keyword": rng.choice(["red", "blue", " ", None]) if page == "search" else None, "order_id": rng.choice([k % 7, None]),
            "product_id": k % 11, "net": rng.choice(["wifi", "5g", None]), "brand": f"b{k % 3}", "plat": "ios", "platv": rng.choice(["1", None]),
            "amount": rng.choice([k, -k, None])})
    return out


def arrivals(found, lateness=HOUR // 2):
    """The events in an order of arrival that is off by less than ``lateness``."""
    rng = random.Random(3)
    return sorted(found, key=lambda r: r["ts"] + rng.randrange(lateness))


FLUSH = {"log_id": 10**6, "user_id": 99, "ts": DAY + 6 * 24 * HOUR, "log_type": "home_page", "product_id": 0}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log"))
    found = arrivals(events())
    for n in range(4):
        put(path, n, found[n * 100 : n * 100 + 100])
    put(path, 4, [FLUSH])
    return path


@pytest.fixture(scope="module")
def batch(spark, folder):
    return spark.read.schema(LOG).json(folder).where("log_id < 1000000").cache()


def log(spark, folder, per_batch=1):
    return jobs.with_event_time(source(spark, folder, LOG, per_batch), "ts", "1 hour")


def test_session_restarts_across_two_runs(spark, batch, tmp_path):
    found, path = arrivals(events()), str(tmp_path / "in")
    put(path, 0, found[:150])
    put(path, 1, found[150:220])
    restarts = stateful.session_restarts(log(spark, path))
    run(restarts, tmp_path / "c", tmp_path / "out")
    before = spark.read.parquet(str(tmp_path / "out")).count()
    put(path, 2, found[220:])
    put(path, 3, [FLUSH])
    run(stateful.session_restarts(log(spark, path)), tmp_path / "c", tmp_path / "out")
    out, expected = spark.read.parquet(str(tmp_path / "out")), behaviour.session_restarts(batch)
    assert rows(out) == rows(expected) and 0 < before < out.count()


@pytest.mark.parametrize("keys,distinct", [([], {"users": "user_id", "orders": "order_id"}), (["plat", "log_type"], {})])
def test_cumulating_windows(spark, folder, batch, tmp_path, keys, distinct):
    sums = {"n": F.lit(1).cast("long"), "amount": F.col("amount")}
    parts = stateful.cumulate(log(spark, folder), 7_200_000, sums, keys, distinct, buckets=3)
    def sink(part, number):
        stateful.cumulated(part, keys, [*sums, *distinct]).write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={number}")
    run(parts, tmp_path / "c", sink)
    expected = windows.cumulate(batch, "ts", 7_200_000, sums, keys, distinct)
    names = ["window_start", "window_end", *keys, *sums, *distinct]
    found = spark.read.parquet(f"{tmp_path}/out").where(F.col("window_start") < DAY + 5 * 24 * HOUR)
    assert rows(found.fillna(0, list(distinct)), names) == rows(expected.fillna(0, list(distinct)), names)


def test_cumulating_windows_want_a_step_that_divides_the_day(spark, folder):
    with pytest.raises(ValueError):
        stateful.cumulate(log(spark, folder), 7_000_000, {})


def test_running_counts(spark, folder, batch, tmp_path):
    keys = ["log_type", "net"]
    placed = stateful.places(log(spark, folder), keys, "ts", "log_id", HOUR)
    sink = late.running_count_sink(str(tmp_path / "out"), keys)
    run(placed, tmp_path / "c", sink)
    names = ["log_id", *keys, "running_count"]
    expected = ordered.running_counts(batch, keys, "ts", "log_id")
    found = spark.read.parquet(f"{tmp_path}/out/rows")
    assert rows(found.where("log_id < 1000000"), names) == rows(expected, names)


def test_last_value_by_event_time(spark, folder, batch, tmp_path):
    run(stateful.last_per_interval(log(spark, folder), "user_id", "ts", "log_id", 2 * HOUR), tmp_path / "c", tmp_path / "out")
    expected = windows.last_per_interval(batch, "user_id", "ts", "log_id", 2 * HOUR)
    names = ["window_start", "user_id", "log_id", "ts", "keyword", "amount"]
    assert rows(spark.read.parquet(str(tmp_path / "out")).where("log_id < 1000000"), names) == rows(expected, names)


def test_last_value_by_the_clock(spark, tmp_path):
    path = str(tmp_path / "in")
    put(path, 0, [{"log_id": 1, "user_id": 1, "ts": 50}, {"log_id": 2, "user_id": 1, "ts": 40}, {"log_id": 3, "user_id": 2, "ts": 1}])
    last = stateful.last_per_interval(source(spark, path, LOG), "user_id", "ts", "log_id", 1500, stateful.PROCESSING)
    def kept():
        return sorted(r.log_id for r in spark.read.schema(LOG).parquet(str(tmp_path / "out")).collect())
    with Running(last, tmp_path / "c", tmp_path / "out") as held:
        held.until(lambda: kept() == [1, 3])
        put(path, 1, [{"log_id": 4, "user_id": 1, "ts": 7}])
        held.until(lambda: kept() == [1, 3, 4])


def test_rising_rows_and_their_expiry(spark, tmp_path):
    path, schema = str(tmp_path / "in"), "k long, ts long, arrival long, id long"
    rng = random.Random(1)
    found = [{"k": rng.randrange(4), "ts": rng.randrange(50), "arrival": n // 20, "id": n} for n in range(60)]
    for n in range(3):
        put(path, n, found[n * 20 : n * 20 + 20])
    run(stateful.keep_rising(source(spark, path, schema), "k", "ts", "id"), tmp_path / "c", tmp_path / "out")
    expected = ordered.keep_rising(spark.createDataFrame([tuple(r.values()) for r in found], schema), ["k"], "arrival", "ts", width=1)
    assert rows(spark.read.parquet(str(tmp_path / "out")), ["k", "ts"]) == rows(expected, ["k", "ts"])
    # After a key's time to live its next row is kept, whatever its time.
    def put_one(number, ts):
        put(str(tmp_path / "short"), number, [{"k": 1, "ts": ts, "arrival": 0, "id": number}])
    put_one(0, 100)
    with Running(stateful.keep_rising(source(spark, tmp_path / "short", schema), "k", "ts", "id", ttl=8000), tmp_path / "cs", tmp_path / "outs") as held:
        held.until_read(1)
        put_one(1, 50)
        held.until_read(2)
        time.sleep(9)
        put_one(2, 40)
        held.until_read(3)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "outs")).collect()) == [0, 2]


def test_first_visits_and_their_expiry(spark, tmp_path):
    schema = "log_id long, mid string, is_new string, ts long"
    rng = random.Random(2)
    found = sorted(({"log_id": n, "mid": f"m{rng.randrange(6)}", "is_new": rng.choice("01"), "ts": DAY + rng.randrange(4 * 24) * HOUR} for n in range(120)),
                   key=lambda r: (r["ts"], r["log_id"]))
    for n in range(3):
        put(str(tmp_path / "in"), n, found[n * 40 : n * 40 + 40])
    run(stateful.repair_is_new(source(spark, tmp_path / "in", schema)), tmp_path / "c", tmp_path / "out")
    nested = spark.createDataFrame([tuple(r.values()) for r in found], schema).select(
        "log_id", F.struct("mid", "is_new").alias("common"), "ts", F.lit(None).cast("string").alias("_bad"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(pagelog.repair_is_new(nested), ["log_id", "mid", "is_new", "ts"])
    def put_one(number, ts):
        put(str(tmp_path / "short"), number, [{"log_id": number, "mid": "m", "is_new": "1", "ts": ts}])
    put_one(0, DAY)
    with Running(stateful.repair_is_new(source(spark, tmp_path / "short", schema), ttl=8000), tmp_path / "cs", tmp_path / "outs") as held:
        held.until_read(1)
        put_one(1, DAY + 48 * HOUR)
        held.until_read(2)
        time.sleep(9)
        put_one(2, DAY + 72 * HOUR)
        held.until_read(3)
    assert {r.log_id: r.is_new for r in spark.read.parquet(str(tmp_path / "outs")).collect()} == {0: "1", 1: "0", 2: "1"}


@pytest.mark.parametrize("rule", ["v1107", "v1106"])
def test_daily_paths(spark, folder, batch, tmp_path, rule):
    run(stateful.user_paths(log(spark, folder), rule, part_size=9), tmp_path / "c", tmp_path / "out")
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(behaviour.user_paths(batch, rule, part_size=9))


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1]])
def test_profiles_in_any_order_of_arrival(spark, batch, tmp_path, order):
    found = arrivals(events())
    for number, n in enumerate(order):
        put(str(tmp_path / "in"), number, found[n * 134 : n * 134 + 134])
    def sink(part, number):
        part.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={number}")
    run(stateful.user_profiles(source(spark, tmp_path / "in", LOG)), tmp_path / "c", sink, "update")
    every = spark.read.parquet(f"{tmp_path}/out")
    expected = behaviour.user_profiles(batch)
    now = every.groupBy("user_id").agg(F.max_by(F.struct(*every.columns), "events").alias("r")).select("r.*")
    assert rows(now, expected.columns) == rows(expected) and every.count() > now.count()


def test_log_profiles(spark, tmp_path):
    schema = "log_id long, uid string, ts long, os string, ch string, md string, ba string, search_item string"
    rng = random.Random(8)
    found = [{"log_id": n, "uid": rng.choice(["1", "1", "2", "-1"]), "ts": DAY + n, "os": rng.choice(["ios", "android", None]), "ch": f"c{n % 3}", "md": "m",
              "ba": None, "search_item": rng.choice(["a", "b", "c", "d", None])} for n in range(90)]
    rng.shuffle(found)
    for n in range(3):
        put(str(tmp_path / "in"), n, found[n * 30 : n * 30 + 30] + found[:2])
    pages = jobs.with_event_time(source(spark, tmp_path / "in", schema), "ts", "1 day")
    def sink(part, number):
        part.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={number}")
    profiles = stateful.user_log_profile(jobs.first_per_payload(pages, ignore=("log_id",)), part_size=3)
    run(profiles, tmp_path / "c", sink, "update")
    every = spark.read.parquet(f"{tmp_path}/out")
    now = every.join(every.groupBy("uid").agg(F.max("pv").alias("pv")), ["uid", "pv"], "left_semi")
    expected = labels.user_log_profile(spark.createDataFrame([tuple(r.values()) for r in found], schema))
    joined = now.groupBy("uid").agg(F.expr("listagg(search_item, ',') within group (order by part)").alias("search_item"), *[
        F.max(c).alias(c) for c in ("pv", "os", "ch", "md", "ba", "last_search", "ts_ms")])
    assert rows(joined) == rows(expected.drop("part")) and now.count() > joined.count()


def test_an_interrupted_run_equals_an_unbroken_one(spark, folder, tmp_path):
    def paths():
        return stateful.user_paths(log(spark, folder))
    run(paths(), tmp_path / "one", tmp_path / "whole")
    with Running(paths(), tmp_path / "c", tmp_path / "out", every="0 seconds") as held:
        held.until(lambda: any(p["batchId"] >= 1 for p in held.query.recentProgress))
    assert held.query.lastProgress["batchId"] < 5
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert provider.endswith("RocksDBStateStoreProvider")
    run(paths(), tmp_path / "c", tmp_path / "out")
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(spark.read.parquet(str(tmp_path / "whole")))
