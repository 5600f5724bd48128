"""Late rows, refreshing rules, change routing, snapshot marks, pass-through and rejects on streams."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from marketlens.operators import joins
from marketlens.plans import vehicles
from marketlens.sources import topics
from marketlens.streaming import jobs, late, rules, stateful, versions
from tests.streams import DAY, HOUR, NOW, Running, put, rows, run, source

SCHEMA = "id long, user string, kind string, amount long, ts string"


def row(k, ms, kind="buy"):
    return {"id": k, "user": f"u{k % 3}", "kind": kind, "amount": k, "ts": str(ms)}


FILES = [[row(k, DAY + 1000 * ((k * 7) % 50)) for k in range(50)], [row(k, DAY + 60_000 + 1000 * k, "view") for k in range(50, 80)] + [row(7, DAY + 49_000)],
         [row(200, DAY + 25 * HOUR)]]


def sums():
    return {"amount": F.col("amount"), "buys": F.when(F.col("kind") == "buy", 1).cast("long")}


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0], [2, 0, 1]])
def test_totals_with_repair_equal_the_batch_in_any_order(spark, tmp_path, order):
    for number, n in enumerate(order):
        put(str(tmp_path / "in"), number, FILES[n])
    folder, target, keys = str(tmp_path / "days"), str(tmp_path / "target"), ["kind"]
    sink = late.late_totals_sink(folder, 10_000, 60_000, keys, sums())
    timed = jobs.with_event_time(source(spark, tmp_path / "in", SCHEMA), "ts")
    run(timed, tmp_path / "c", sink)
    batch = spark.read.schema(SCHEMA).json(str(tmp_path / "in")).withColumn("ms", F.col("ts").cast("long"))
    expected = batch.groupBy((F.floor(F.col("ms") / 10_000) * 10_000).alias("window_start"), "kind").agg(
        *[F.sum(c).alias(n) for n, c in sums().items()], F.count("*").alias("n_rows"))
    names = ["window_start", "kind", "amount", "buys", "n_rows"]
    assert rows(late.totals(spark, folder, keys, ["amount", "buys"]), names) == rows(expected, names)
    # The table as the windows ended, then repaired.
    first = late.totals(spark, folder, keys, ["amount", "buys"], with_late=False)
    first.write.partitionBy("stat_date").parquet(target)
    missed = sum(r.n_late for r in late.late_counts(spark, folder).collect())
    assert missed == {0: 0, 2: 81}.get(order[0], 50 if order[:2] == [1, 2] else 0) and expected.agg(F.sum("n_rows")).first()[0] - first.agg(F.sum("n_rows")).first()[0] == missed
    for _ in range(2):
        late.repair(spark, folder, target, keys, ["amount", "buys"])
    assert rows(spark.read.parquet(target), names) == rows(expected, names)
    # A batch that runs again changes nothing.
    sink(jobs.with_event_time(spark.read.schema(SCHEMA).json(f"{tmp_path}/in/2.json"), "ts"), 2)
    assert rows(late.totals(spark, folder, keys, ["amount", "buys"]), names) == rows(expected, names)
    assert sum(r.n_late for r in late.late_counts(spark, folder).collect()) == missed


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    assert versions.newest(spark, path) is None and versions.read(spark, path, "k long").count() == 0
    for n in range(6):
        versions.write(spark.range(n).withColumnRenamed("id", "k"), path, n)
    assert versions.newest(spark, path) == 5 and versions.newest(spark, path, before=5) == 4
    assert versions.read(spark, path, "k long", before=5).count() == 4 and len(os.listdir(path)) <= 4


def test_alarms_follow_the_rules_folder(spark, tmp_path):
    schema, folder = "rule_type string, vehicleno string", tmp_path / "rules"
    folder.mkdir()
    def put_rules(text):
        (folder / "new~").write_text(text)
        os.rename(folder / "new~", folder / "rules.json")
    put_rules('{"rule_type": "2", "vehicleno": "A"}\n')
    held = rules.RefreshingRules(spark, lambda: spark.read.schema(schema).json(f"{folder}/rules.json"), str(tmp_path / "good"), schema,
                                 F.col("rule_type").isin("1", "2"), every=0, retries=2, pause=0.01)
    reports = "id long, vehicleno string, emergency_alarm long"
    sink = rules.ruled_sink(held, vehicles.vehicle_alarms, str(tmp_path / "out"))
    put(str(tmp_path / "in"), 0, [{"id": 0, "vehicleno": "A"}])
    def alarms():
        return sorted((r.id, r.alarm_kind) for r in spark.read.schema("id long, alarm_kind string").json(f"{tmp_path}/out").collect())
    with Running(source(spark, tmp_path / "in", reports), tmp_path / "c", sink) as held_query:
        held_query.until_read(1)
        put_rules('{"rule_type": "2", "vehicleno": "B"}\n{"rule_type": "1"}\n')
        put(str(tmp_path / "in"), 1, [{"id": 1, "vehicleno": "A"}, {"id": 2, "vehicleno": "B"}, {"id": 3, "vehicleno": "C", "emergency_alarm": 1}])
        held_query.until_read(4)
        put_rules('{"rule_type": "7"}\n')  # not valid: the last good version stays
        put(str(tmp_path / "in"), 2, [{"id": 4, "vehicleno": "B"}])
        held_query.until_read(5)
        os.remove(folder / "rules.json")  # not there at all
        put(str(tmp_path / "in"), 3, [{"id": 5, "vehicleno": "B"}, {"id": 6, "vehicleno": "A"}])
        held_query.until_read(7)
    assert alarms() == [(0, "vehicleno"), (2, "vehicleno"), (3, "emergency"), (4, "vehicleno"), (5, "vehicleno")]
    assert held.failures >= 4 and versions.newest(spark, str(tmp_path / "good")) == 1
    again = rules.RefreshingRules(spark, lambda: spark.read.schema(schema).json(f"{folder}/rules.json"), str(tmp_path / "good"), schema, retries=1)
    assert sorted(r.vehicleno or "" for r in again.current().collect()) == ["", "B"]  # a restart begins with the last good version
    with pytest.raises(ValueError):
        rules.RefreshingRules(spark, lambda: spark.read.schema(schema).json(f"{folder}/rules.json"), str(tmp_path / "none"), schema, retries=1).current()


CHANGE = "db string, `table` string, op string, snapshot string, ts_ms long, after string"
CONFIG = "source_table string, sink_table string, sink_row_key string, op string, ts_ms long"


def change(table, k, op="c"):
    return {"db": "d", "table": table, "op": op, "ts_ms": k, "after": json.dumps({"id": k, "no": f"n{k}"})}


def test_routing_follows_the_config(spark, tmp_path):
    ins, cfg = str(tmp_path / "in"), str(tmp_path / "cfg")
    def entry(table, sink, key, ts, op="c"):
        return {"source_table": table, "sink_table": sink, "sink_row_key": key, "op": op, "ts_ms": ts}
    def step(number, changes, entries):
        put(ins, number, changes)
        put(cfg, number, entries)
        routed = stateful.route_changes(source(spark, ins, CHANGE), source(spark, cfg, CONFIG), parts=3)
        run(routed, tmp_path / "c", tmp_path / "out")
        return spark.read.parquet(str(tmp_path / "out"))
    first = [change("a", k) for k in range(10)] + [change("b", k) for k in range(10, 15)] + [change("x", 99), change("a", 98, "d"), {"table": "a", "op": "u"}]
    assert step(0, first, [entry("a", "dim_a", "id", 1)]).count() == 10  # those of b and x wait
    out = step(1, [change("a", 20)], [entry("b", "dim_b", "no", 2)])
    config = spark.createDataFrame([("a", "dim_a", "id", "c", 1), ("b", "dim_b", "no", "c", 2)], CONFIG)
    expected = joins.route_changes(spark.read.schema(CHANGE).json(ins), config)
    assert rows(out) == rows(expected) and out.count() == 16
    # Another target for a, and none any more for b; an older entry changes nothing.
    out = step(2, [change("a", 30), change("b", 31)], [entry("a", "new_a", "no", 5), entry("b", "dim_b", "no", 6, "d"), entry("a", "old_a", "no", 3)])
    assert sorted((r.sink_table, r.ts_ms) for r in out.where("ts_ms >= 30").collect()) == [("new_a", 30)]
    out = step(3, [change("b", 40), change("a", 41)], [])
    assert sorted((r.sink_table, r.ts_ms) for r in out.where("ts_ms >= 40").collect()) == [("new_a", 41)]


def test_a_snapshot_ends_once(spark, tmp_path):
    ins = str(tmp_path / "in")
    put(ins, 0, [change("live", k, "r") for k in range(30)] + [change("idle", k, "r") for k in range(5)] + [{**change("idle", 7), "snapshot": "true"}])
    def marks():
        return sorted(tuple(r) for r in spark.read.schema("table string, snapshot_rows long, reason string").parquet(str(tmp_path / "out")).collect())
    with Running(stateful.snapshot_marks(source(spark, ins, CHANGE), idle=4000), tmp_path / "c", tmp_path / "out") as held:
        held.until_read(36)
        put(ins, 1, [change("live", 50, "r"), change("live", 51, "u"), change("live", 52, "u")])
        held.until(lambda: len(marks()) == 2)
        put(ins, 2, [change("live", 60, "u"), change("idle", 61, "u"), change("idle", 62, "r")])
        held.until_read(42)
        time.sleep(5)
    assert marks() == [("idle", 6, "idle"), ("live", 31, "live")]


def test_messages_pass_through_and_rejects_are_kept(spark, tmp_path):
    ins = tmp_path / "in"
    lines = ['{"id": 1, "ts": "1704067200000", "source": {"table": "t"}}', "not json", '{"id": 2, "ts": "never"}', '{"id": "x", "ts": "5"}', "  ", '{"id": 3, "ts": 1704067201}']
    os.makedirs(ins)
    (ins / "0.txt").write_text("\n".join(lines) + "\n")
    spec = {"format": "text", "path": str(ins)}
    good, bad = topics.read_json_stream(spark, spec, "id long, ts string", "ts")
    run(good, tmp_path / "cg", tmp_path / "good")
    run(bad, tmp_path / "cb", tmp_path / "bad")
    assert sorted((r.id, r.event_time.timestamp()) for r in spark.read.parquet(str(tmp_path / "good")).collect()) == [(1, 1704067200.0), (3, 1704067201.0)]
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == sorted(
        ["not json", '{"id": "x", "ts": "5"}', '{"id":2,"ts":"never"}'])
    passed = topics.pass_through(topics.raw_stream(spark, spec), "$.source.table")
    assert passed.columns == ["key", "value"]
    topics.write_messages(passed, {"format": "text", "path": str(tmp_path / "out")}, str(tmp_path / "cp"), NOW).awaitTermination(100)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == sorted(lines)
    topics.write_json_stream(good, {"format": "text", "path": str(tmp_path / "json")}, str(tmp_path / "cj"), NOW).awaitTermination(100)
    assert sorted(json.loads(r.value)["id"] for r in spark.read.text(str(tmp_path / "json")).collect()) == [1, 3]
