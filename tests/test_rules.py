"""Results stay whole however large a group is, and odd rows don't stop or change a query."""

import json
import re

from pyspark.sql import functions as F

from marketlens.functions import calendar as cal
from marketlens.functions import columns as col
from marketlens.operators import joins, ordered, windows
from marketlens.operators.text import word_hits
from marketlens.plans import behaviour, clustering, comments, labels, vehicles, warehouse
from marketlens.sources import sinks
from marketlens.sources.shop import Shop

STEP = 600_000


def test_all_search_words_reach_the_record_lists(spark):
    pages = spark.range(1500).selectExpr(
        "id as log_id", "'7' as uid", "'iOS' as os", "'c' as ch", "'m' as md", "'b' as ba", "concat('w', id) as search_item", "id as ts")
    profile = labels.user_log_profile(pages)
    words = [w for r in profile.orderBy("part").collect() for w in r.search_item.split(",")]
    assert words == [f"w{k}" for k in range(1500)]
    none = spark.createDataFrame([], "category3_name string, b1_name string, category_name string, search_category string, id int")
    scored = labels.device_search_scores(profile, none, none)
    assert scored.count() == 1


def test_merge_of_many_partitions_touches_no_others(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(1300).selectExpr("id", "id as seq", "'a' as v", "id as p")
    sinks.merge_partitions(spark, path, first, ["id"], "seq", ["p"])
    before = {f.name for f in (tmp_path / "t" / "p=1250").iterdir()}
    batch = spark.range(1200).selectExpr("id", "id + 1 as seq", "'b' as v", "id as p")
    for _ in range(2):
        sinks.merge_partitions(spark, path, batch, ["id"], "seq", ["p"])
    found = {r.v: r.n for r in spark.read.parquet(path).groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert found == {"a": 100, "b": 1200} and before == {f.name for f in (tmp_path / "t" / "p=1250").iterdir()}


def test_ordered_work_over_many_slices(spark):
    rows = spark.range(400).selectExpr("if(id % 4 = 0, cast(null as string), 'k') as k", "id", "id * 977 % 400 * 100000 as ms", "id % 7 as v")
    plain = {}
    for r in sorted(rows.collect(), key=lambda r: (r.k or "", r.ms, r.id)):
        plain.setdefault(r.k, []).append(r)
    back = {r.id: r.prev.v if r.prev else None for r in ordered.previous_row(rows, ["k"], "ms", "id", ["v"]).collect()}
    rising = {r.id for r in ordered.keep_rising(rows, ["k"], "ms", "v").collect()}
    recent = {r.id: r.recent for r in ordered.count_recent(rows, ["k"], "ms", 250_000).collect()}
    texts = {r.k: [] for r in rows.collect()}
    for r in ordered.ordered_list(rows, ["k"], F.col("id"), "ms", "id", part_size=30).orderBy("part").collect():
        texts[r.k] += r["items"].split(",")
    for k, own in plain.items():
        top = None
        for n, r in enumerate(own):
            assert back[r.id] == (own[n - 1].v if n else None)
            assert recent[r.id] == sum(r.ms - 250_000 < x.ms <= r.ms for x in own)
            assert (r.id in rising) == (top is None or r.v > top)
            top = r.v if top is None else max(top, r.v)
        assert texts[k] == [str(r.id) for r in own]


def test_best_items_after_a_refund(spark):
    rows = spark.createDataFrame([(0, "A", 100), (1, "B", 50), (2, "C", 40), (STEP, "A", -90)], "ms long, item string, amount long")
    best = windows.cumulate_top(rows, "ms", STEP, "item", F.col("amount"), 2)
    last = best.where(F.col("window_end") == 2 * STEP).orderBy("rn").collect()
    assert [(r.item, r.amount) for r in last] == [("B", 50), ("C", 40)]


def test_partial_update_keeps_rows_without_operation(spark):
    batch = spark.createDataFrame([(1, 5, "x", None), (1, 6, "gone", "d"), (1, 4, "old", "u"), (2, 1, None, "u")], "id int, seq int, v string, op string")
    found = sinks.partial_update(batch.drop("op").where("false"), batch, ["id"], "seq")
    assert sorted((r.id, r.seq, r.v) for r in found.collect()) == [(1, 5, "x"), (2, 1, None)]


def test_listed_words_in_any_case_and_length(spark):
    texts = spark.createDataFrame([(1, "so MacBooks are IN here" + " x" * 500 + " Supercalifragilistic"), (2, "nothing"), (3, None), (4, "")], "id int, t string")
    words = spark.createDataFrame([("MacBook",), ("in",), ("supercalifragilistic",), ("absent words",), ("",)], "w string")
    found = sorted((r.id, r.word) for r in word_hits(texts, words, "id", "t").collect())
    assert found == [(1, "MacBook"), (1, "in"), (1, "supercalifragilistic"), (2, "in")]
    assert sorted((r.id, r.word) for r in word_hits(texts, words, "id", "t", "token").collect()) == [(1, "in"), (1, "supercalifragilistic")]
    assert word_hits(texts, words.limit(0), "id", "t").count() == 0


def test_vehicles_with_one_fix_and_bad_times(spark):
    fixes = spark.createDataFrame([("a", 1, 0.0, 0.0, "20240101000000"), ("a", 2, 0.0, 1.0, "20240101010000"), ("b", 3, 1.0, 1.0, "20240101000000"), ("c", 4, 1.0, 1.0, "not a time")],
                                  "vehicleno string, id int, lon double, lat double, dateTime string")
    for method in ("haversine", "ellipsoid"):
        found = {r.vehicleno: r for r in vehicles.trip_distance(fixes, method).collect()}
        assert set(found) == {"a", "b"} and found["b"].distance_m == 0 and found["b"].idle_fixes == 0
        assert 110_000 < found["a"].distance_m < 112_000 and found["a"].jumps == 1


def test_device_tree_is_one_document_a_day(spark):
    log = spark.createDataFrame([(0, "ios", "b", "1"), (1, "ios", "a", "2"), (2, "android", "a", "1"), (3, "ios", "a", "2"), (4, None, "a", "1")], "ts long, plat string, brand string, platv string")
    assert json.loads(behaviour.device_tree(log).first().log_content) == {"android": {"a": {"1": 1}}, "ios": {"a": {"2": 2}, "b": {"1": 1}}}


def test_lookup_of_a_code_listed_twice(spark):
    codes = spark.createDataFrame([("1", "b"), ("1", "a")], "code string, name string")
    assert joins.lookup(spark.createDataFrame([(1, "1"), (2, "9")], "id int, c string"), codes, "c", "code", "name").orderBy("id").collect() == [(1, "1", "a"), (2, "9", "N/A")]


def test_retried_batches_are_written_once(spark, tmp_path):
    batch = spark.createDataFrame([("1704067200000",), ("x",)], "ts string")
    for _ in range(2):
        sinks.write_day_buckets(batch, "ts", str(tmp_path / "days"), 7)
        sinks.fan_out(batch, {"a": (batch, str(tmp_path / "a")), "b": (batch.limit(1), str(tmp_path / "b"))}, 7)
    assert spark.read.json(str(tmp_path / "days")).count() == 2
    assert spark.read.json(str(tmp_path / "a")).count() == 2 and spark.read.json(str(tmp_path / "b")).count() == 1


def test_overwrite_of_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_dynamic(spark.range(4).selectExpr("id", "id % 2 as p"), path, ["p"])
    sinks.overwrite_partition(spark.range(10, 11), path, "p", 1)
    sinks.append(spark.range(20, 21).withColumn("p", F.lit(0)), path, ["p"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 10, 20]


def test_day_parts_bands_and_signs(spark):
    hours = spark.createDataFrame([(h,) for h in (5, 6, 9, 12, 14, 18, 22)], "h int").select(cal.day_part(F.make_timestamp_ntz(*(F.lit(x) for x in (2024, 1, 1)), "h", F.lit(0), F.lit(0))).alias("p"))
    assert [r.p for r in hours.collect()] == ["凌晨", "早晨", "上午", "中午", "下午", "晚上", "夜间"]
    ten = spark.createDataFrame([(p,) for p in (99.99, 200.0, 200.01, 1000.0, 1000.01)], "p double").select(col.price_band("p").alias("b"))
    assert [r.b for r in ten.collect()] == ["0-99", "100-199", "200-299", "900-999", "1000+"]
    closed = spark.createDataFrame([(p,) for p in (99.0, 99.5, 100.0, 999.5)], "p double").select(col.price_band("p", "closed").alias("b"))
    assert [r.b for r in closed.collect()] == ["0-99", "1000+", "100-199", "1000+"]
    days = spark.createDataFrame([(d,) for d in ("2000-12-22", "2000-01-19", "2000-01-20", "2000-06-21", "2000-06-22")], "d string").select(cal.zodiac_sign(F.to_date("d")).alias("z"))
    assert [r.z for r in days.collect()] == ["摩羯座", "摩羯座", "水瓶座", "双子座", "巨蟹座"]
    power = spark.createDataFrame([(a,) for a in (999.99, 1000.0, 1000.01, 4000.0)], "a double").select(labels.spending_power("a").alias("s"))
    assert [r.s for r in power.collect()] == ["低消费", "高消费", "中消费", "高消费"]


def test_moderation_names_words_in_the_order_of_the_text(spark):
    words = spark.createDataFrame([("Alpha",), ("bad",), ("badly",), ("",)], "word string")
    rows = spark.createDataFrame([(1, 1, "zebra BAD then Alpha word"), (2, 1, "so BADLY"), (3, 1, "x, y,bad"), (4, 1, None), (5, 1, "fine")], "id long, user_id long, comment_txt string")
    found = {r.id: (r.violation_grade, r.violation_msg) for r in comments.moderate(rows, words).collect()}
    assert found == {1: ("P1", "bad, Alpha"), 2: ("P1", "bad, badly"), 3: ("P0", "bad"), 4: ("", ""), 5: ("", "")}
    tokens = {r.id: r.violation_msg for r in comments.moderate(rows, words, match="token").collect()}
    assert tokens[1] == "bad, Alpha" and tokens[2] == "badly"


def test_a_short_list_is_sent_to_the_texts(spark, monkeypatch):
    texts = spark.range(400).selectExpr("id", "concat(repeat('prefixa ', 30), 'prefix', id % 7) as text")
    words = spark.createDataFrame([(f"prefix{k}",) for k in range(3)] + [("prefixb",)], "word string")
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    small = word_hits(texts, words, "id", "text")
    assert re.search(r"BroadcastHashJoin \[_start#\d+\], \[_start#\d+\], Inner, BuildRight", plan(small))
    expected = sorted((k, f"prefix{k % 7}") for k in range(400) if k % 7 < 3)
    assert sorted((r.id, r.word) for r in small.collect()) == expected
    monkeypatch.setattr("marketlens.operators.text.LIST_ROWS", 2)  # a long list meets the texts in a shuffled join
    assert sorted((r.id, r.word) for r in word_hits(texts, words, "id", "text").collect()) == expected


def test_shop_numbers_follow_the_order(spark):
    rows = spark.range(2500).selectExpr("id % 2 as k", "id * 1000 as n").repartition(5)
    found = {(r.k, r.n): r.shop_id for r in warehouse.shop_bucket(rows, "k", "n").collect()}
    assert all(found[n % 2, n * 1000] == f"SHOP_{(n // 2 + 1) % 10 + 1}" for n in range(2500))


def test_profiles_as_records(spark):
    folder = "/root/testdata/sf0.001"
    profiles = behaviour.user_profiles(Shop(spark, folder).page_log())
    records = {r.user_id: json.loads(r.profile) for r in behaviour.profile_json(profiles).collect()}
    for r in profiles.limit(20).collect():
        own = records[r.user_id]
        assert own["login_dates"] == r.login_dates.split(",") and own["behavior"]["has_search"] == (r.search_days != "")
        assert own["behavior"]["purchase_days"] == [d for d in r.purchase_days.split(",") if d] and own["device"]["plat"] == r.plat
        assert own["order_count"] == r.order_count and ",".join(own["user_tags"]) == r.user_tags


def test_order_columns_of_the_daily_summaries(spark):
    acts = spark.createDataFrame(
        [(1, 7, "order", "2024-01-01 10:00:00", 2, 30.0), (1, 7, "order", "2024-01-01 11:00:00", 1, 5.0), (2, 7, "order", "2024-01-01 12:00:00", 4, 8.0), (3, 7, "favor", "2024-01-01 12:30:00", None, None)],
        "user_id long, sku_id long, behavior_type string, behavior_time string, sku_num int, total_amount double").selectExpr(
        "user_id", "sku_id", "behavior_type", "cast(behavior_time as timestamp_ntz) as behavior_time", "sku_num", "cast(total_amount as decimal(16,2)) as total_amount",
        "cast(null as int) as cart_num", "cast(null as string) as appraise", "cast(null as string) as is_cancel", "cast(null as decimal(10,2)) as order_price")
    per_user = {r.user_id: r for r in warehouse._behaviour_per_user(acts, ["sku_id"]).collect()}
    assert (per_user[1].order_n, per_user[1].order_num, float(per_user[1].order_amount)) == (2, 3, 35.0)
    assert (per_user[2].order_n, per_user[2].order_num, per_user[3].order_n) == (1, 4, 0)


def test_clusters_of_separate_points(spark):
    rows = [(k, [float(k % 3) * 50 + (k % 5) * 0.1, float(k % 3) * -20 + (k % 7) * 0.1]) for k in range(300)]
    points = spark.createDataFrame(rows, "id long, embedding array<float>")
    sizes = clustering.cluster_sizes(clustering.cluster(points, "embedding", 3)).collect()
    assert sorted(r[-1] for r in sizes) == [100, 100, 100]
