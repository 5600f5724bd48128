"""All batch queries by name: each takes the session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import calendar as cal
from marketlens.functions import columns as col
from marketlens.functions.identity import amount_text, register
from marketlens.operators import joins, ordered, skew, windows
from marketlens.operators.text import word_hits
from marketlens.plans import behaviour, clustering, comments, dashboard, labels, market, quality, sales, vehicles, warehouse
from marketlens.sources import changes as chg
from marketlens.sources import files, pagelog, sinks
from marketlens.sources.shop import Shop
from marketlens.streaming.replay import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TODAY = "2024-01-15"
AS_OF = "2024-06-30"


def query(fn: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, folder: fn(Shop(spark, folder))
    return fn


def _behaviour(s: Shop) -> DataFrame:
    return warehouse.behaviour_union(s.dim_cart(), s.dim_favorite(), s.comment_info())


def _trade(s: Shop) -> DataFrame:
    codes = s.table("region").selectExpr(
        "case r_regionkey when 0 then 'CREATED' when 1 then 'PAID' else cast(r_regionkey as string) end as dic_code",
        "case r_regionkey when 0 then '已下单' when 1 then '已支付' else '' end as dic_name")
    return warehouse.trade_detail(s.order_info(), s.order_detail(), s.sku_info(), codes)


def _facts(s: Shop) -> tuple[DataFrame, ...]:
    return s.ods_logs(), s.dim_favorite(), s.dim_cart(), s.order_info(), s.order_detail()


# ---- sources, changes, sinks ---------------------------------------------------------
@query
def parse_changes(s):
    parsed = chg.parse_changes(s.change_log())
    return parsed.groupBy("db", "table", "op", "snapshot").agg(
        F.count(F.lit(1)).alias("n"), F.count("before").alias("befores"), F.count("after").alias("afters"), F.max("ts_ms").alias("last_ts_ms"))


@query
def flatten_changes(s):
    flat = chg.flatten_changes(chg.parse_changes(s.change_log()))
    return flat.select("table", "op", "ts_ms", F.get_json_object("row", "$.id").cast("long").alias("id"))


@query
def table_changes(s):
    rows = chg.table_changes(chg.parse_changes(s.change_log()), "order_info", "id long, user_id long, status string, total_amount string")
    return rows.select("op", "ts_ms", "id", "user_id", "status", col.safe_number("total_amount", "decimal(12,2)").cast("double").alias("total_amount"))


@query
def change_filter(s):
    return chg.op_filter(chg.parse_changes(s.change_log())).groupBy("table", cal.ms_day("ts_ms").alias("stat_date")).agg(F.count(F.lit(1)).alias("n"))


@query
def snapshot_rows(s):
    return chg.snapshot_rows(chg.parse_changes(s.change_log())).select("table", F.get_json_object("after", "$.id").cast("long").alias("id"))


@query
def scan_partition(s):
    rows = files.scan_partition(s.ods_logs(), "ds", F.lit(TODAY).cast("date"))
    return rows.groupBy("shop_no").agg(F.count(F.lit(1)).alias("n"))


@query
def scan_days(s):
    rows = files.scan_days(s.ods_logs(), "event_time", TODAY, 7)
    return rows.groupBy("shop_no").agg(F.count(F.lit(1)).alias("n"))


@query
def generate_rows(s):
    return files.generate_rows(s.table("supplier").select("s_suppkey"), F.col("s_suppkey") % 5 + 1)


def _price_list(s: Shop) -> tuple[DataFrame, DataFrame]:
    target = s.table("part").selectExpr("p_partkey as id", "cast(p_retailprice as decimal(12,2)) as price", "cast(0 as bigint) as ts_ms")
    batch = s.ecommerce_data().select((F.col("sku_id") * 25).alias("id"), "price", (cal.millis("visit_time") * 1000000 + F.col("event_id")).alias("ts_ms"))
    return target, batch


@query
def upsert_by_key(s):
    target, batch = _price_list(s)
    return sinks.upsert_by_key(target, batch, ["id"], "ts_ms").select("id", col.money("price").alias("price"), "ts_ms")


@query
def partial_update(s):
    batch = s.ev().select(
        F.col("user_id").alias("id"), cal.day_text("ts").alias("ds"), cal.millis("ts").alias("ts_ms"),
        F.when(F.col("event_type") == "click", F.col("k")).alias("sku_num"), F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("sku_id"),
        F.when(F.col("event_type") == "error", "d").otherwise("u").alias("op"))
    return sinks.partial_update(batch.drop("op").where("false"), batch, ["id", "ds"], "ts_ms")


@query
def dim_upsert(s):
    batch = s.table("orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("seq"))
    return sinks.dim_upsert(None, batch, "id", "seq").drop("_order")


@query
def write_day_buckets(s):
    broken = s.page_log().select(F.when(F.col("log_id") % 29 == 0, "no time").otherwise(F.col("ts").cast("string")).alias("ts"))
    folder = new_folder(s.spark, "day-buckets")
    sinks.write_day_buckets(broken, "ts", folder)
    day = F.col("day").cast("string")
    label = F.when(day == "error_bucket", day).otherwise(F.concat(F.lit("day="), day))
    return s.spark.read.json(folder).groupBy(label.alias("day")).agg(F.count(F.lit(1)).alias("n"))


# ---- projections and functions -------------------------------------------------------
@query
def price_band(s):
    frames = [s.ecommerce_data().groupBy(F.lit(kind).alias("bands"), col.price_band("price", kind).alias("label")).agg(F.count(F.lit(1)).alias("n"))
              for kind in ("ten", "half_open", "closed")]
    return sinks.stack(frames)


@query
def json_text(s):
    return s.table("events").select("event_id", col.json_text("props", "k").alias("k"))


@query
def has_keys(s):
    log = s.raw_log().withColumns({
        "keyed": col.has_keys("line", ["common.uid", "ts"]).cast("long"), "worded": col.has_keys("line", ["page.item"], not_blank=True).cast("long")})
    return log.groupBy("keyed", "worded").agg(F.count(F.lit(1)).alias("n"))


@query
def platform_filter(s):
    return s.page_log().where(F.col("plat").isin("ios", "android") & F.col("log_type").isin(*behaviour.PATH_PAGES[4:])).groupBy(
        "plat", "log_type").agg(F.count(F.lit(1)).alias("n"))


@query
def safe_number(s):
    text = F.when(F.col("event_id") % 7 == 0, "").when(F.col("event_id") % 11 == 0, "n/a").otherwise(F.col("value").cast("string"))
    return s.ev().select("event_id", col.safe_number(text).cast("double").alias("amount")).where("amount is not null")


@query
def safe_ratio(s):
    counts = s.ev().groupBy("k").agg(F.count_if(F.col("event_type") == "purchase").alias("a"), F.count_if(F.col("event_type") == "view").alias("b"))
    return counts.select("k", col.safe_ratio("a", F.col("b") % 7, 4, 0).alias("zeroed"), col.safe_ratio("a", "b", 6).alias("ratio"), col.percent("a", "b").alias("pct"))


@query
def default_values(s):
    orders = s.order_info().select("id", F.coalesce("pay_time", F.lit("2024-01-01").cast("timestamp_ntz")).alias("t"), F.lit(None).cast("string").alias("store"))
    return orders.select("id", cal.second_text("t").alias("operate_time"), F.coalesce("store", F.lit("none")).alias("store_no"))


@query
def clean_id(s):
    dirty = F.concat(F.lit(" "), F.col("k").cast("string"), F.lit("\n "))
    return s.ev().select("event_id", col.clean_id(dirty).alias("product_id"))


@query
def shop_bucket(s):
    sold = s.order_detail().groupBy("product_id", "order_id").agg(F.sum("qty").alias("qty"))
    return warehouse.shop_bucket(sold, "product_id", "order_id")


@query
def string_functions(s):
    d = s.table("documents")
    return d.select(
        "doc_id", F.length(F.regexp_replace("text", "[0-9]+", "#")).cast("long").alias("masked_length"),
        F.concat_ws("-", "lang", "source").alias("tag"), F.md5(comments.last_comma_part("text")).alias("last_part_md5"),
        col.is_blank("text").cast("long").alias("blank"), col.allowed_text(F.col("source")).cast("long").alias("allowed"))


@query
def date_functions(s):
    e = s.ev()
    return e.select(
        "event_id", cal.hour_key("ts").alias("hour_key"), cal.day_text("ts", "yyyyMMdd").alias("ds"), cal.millis("ts").alias("ms"),
        cal.ms_second(cal.text_epoch_ms(F.when(F.col("event_id") % 3 == 0, "").when(
            F.col("event_id") % 3 == 1, F.concat((F.floor(cal.millis("ts") / 1000)).cast("string"), F.lit(".5"))).otherwise(cal.millis("ts").cast("string")),
            cal.millis("ts"))).alias("text_time"),
        F.date_format(F.date_sub(F.col("ts").cast("date"), 30), "yyyy-MM-dd").alias("month_before"))


@query
def math_functions(s):
    return s.ev().select("event_id", col.half_up(F.col("value") / 7, 3).cast("double").alias("third"), (F.col("event_id") % 10 + 1).alias("bucket"),
                         F.nullif(F.col("k") % 5, F.lit(0)).alias("no_zero"))


@query
def json_functions(s):
    log = pagelog.parse_log(s.raw_log()).where("_bad is null")
    return log.select("log_id", F.coalesce("common.uid", F.lit("-1")).alias("uid"), F.coalesce("page.item", F.lit("")).alias("item"),
                      F.coalesce(F.size("displays"), F.lit(0)).cast("long").alias("displays"), F.coalesce(F.get_json_object("err", "$.error_code"), F.lit("")).alias("error_code"))


@query
def array_functions(s):
    per_word = s.page_log().where("keyword is not null").groupBy("user_id", "keyword").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("keyword", "n")))
    return per_word.groupBy("user_id").agg(
        F.array_join(F.transform(pairs, lambda p: p["keyword"]), ",").alias("words"),
        F.array_join(F.transform(pairs, lambda p: p["n"].cast("string")), ",").alias("freqs"))


@query
def calendar_features(s):
    return cal.calendar_features(s.user_info(), "birthday", AS_OF).select(
        "uid", "age", "decade", "zodiac_sign", cal.day_text("birthday").alias("birthday"))


@query
def day_part(s):
    return s.ev().select("event_id", cal.day_part("ts").alias("pay_time_slot"))


@query
def time_slots(s):
    return cal.time_slots(s.ev(), "user_id", "ts")


@query
def salt_keys(s):
    return skew.bucket_sizes(s.ev(), "user_id", 128)


# ---- reshaping -----------------------------------------------------------------------
@query
def reshape_orders(s):
    return s.label_orders().select("id", "uid", "consignee", col.money("total_amount").alias("total_amount"), cal.day_part("create_time").alias("pay_time_slot"), "ts_ms")


@query
def reshape_details(s):
    return s.label_details().select("id", "order_id", "sku_id", "sku_num", col.money("split_coupon_amount").alias("split_coupon_amount"), "ts_ms")


@query
def reshape_users(s):
    rows = chg.table_changes(chg.parse_changes(s.change_log()), "user_info", "id long, name string, user_level long, birthday int, gender string")
    dated = rows.withColumn("birthday", cal.epoch_day_date("birthday"))
    return cal.calendar_features(dated, "birthday", AS_OF).select(
        F.col("id").alias("uid"), F.col("name").alias("uname"), "user_level", F.coalesce("gender", F.lit("home")).alias("gender"),
        cal.day_text("birthday").alias("birthday"), "age", "decade", "zodiac_sign", "ts_ms")


@query
def reshape_cart(s):
    rows = chg.op_filter(chg.parse_changes(s.change_log()).where("table = 'order_info'"))
    return rows.select(F.get_json_object("after", "$.id").cast("long").alias("id"), F.get_json_object("after", "$.user_id").alias("user_id"), "ts_ms",
                       F.regexp_replace(cal.ms_day("ts_ms"), "-", "").alias("ds"))


@query
def reshape_page_log(s):
    return pagelog.reshape_page_log(pagelog.parse_log(s.raw_log()))


@query
def flatten_vehicle(s):
    flat = vehicles.flatten_vehicle(s.vehicle_reports())
    return flat.select("id", "vehicleno", F.round(col.safe_number("lon", "double"), 4).alias("lon"), F.round(col.safe_number("lat", "double"), 4).alias("lat"),
                       F.coalesce("vec1", F.lit("-")).alias("vec1"), F.coalesce("vec2", F.lit("-")).alias("vec2"), "ds", F.coalesce("ts", F.lit(-1)).alias("ts"),
                       F.coalesce("emergency_alarm", F.lit(-1)).alias("emergency_alarm"))


@query
def split_log(s):
    tagged = pagelog.tag_records(pagelog.parse_log(s.raw_log()))
    detail = F.coalesce(F.get_json_object("body", "$.error_code"), F.get_json_object("body", "$.entry"), F.get_json_object("body", "$.item"),
                        F.when(F.col("kind") == "dirty", F.col("body")), F.col("page.item_type"), F.lit(""))
    return tagged.select("log_id", "kind", detail.alias("detail"), F.coalesce("ts", F.lit(-1)).alias("ts"))


@query
def repair_is_new(s):
    return pagelog.repair_is_new(pagelog.parse_log(s.raw_log()))


@query
def drop_repeats(s):
    rows = pagelog.reshape_page_log(pagelog.parse_log(s.raw_log())).withColumn("day", cal.ms_day("ts")).drop("log_id", "ts", "search_item")
    return pagelog.drop_repeats(rows, "uid")


@query
def drop_seen(s):
    rows = s.ev().select("user_id", F.floor(cal.millis("ts") / 3600000).alias("hour"), "event_id", "k")
    return pagelog.drop_seen(rows, ["user_id", "hour"], "event_id")


# ---- joins ---------------------------------------------------------------------------
@query
def order_lines(s):
    return joins.order_lines(s.order_info(), s.order_detail()).select(
        "id", "order_id", "product_id", "user_id", "shop_no", "status", "qty", col.money("amount").alias("amount"), cal.second_text("order_time").alias("order_time"))


@query
def sku_dimension(s):
    wide = joins.sku_dimension(s.sku_info(), s.category3(), s.category2(), s.category1())
    return wide.select("sku_id", "sku_name", "spu_id", "tm_id", "tm_name", "category3_id", "category3_name", "category2_id", "category2_name",
                       "category1_id", "category1_name", col.money("price").alias("price"))


@query
def category_tree(s):
    return joins.category_tree(s.category3(), s.category2(), s.category1()).select(
        "category3_id", "category3_name", "category2_id", "category2_name", "category1_id", "category1_name")


@query
def trade_detail(s):
    return _trade(s).select("order_id", "user_id", "sku_id", "sku_name", col.money("order_price").alias("order_price"), F.col("sku_num").cast("long").alias("sku_num"),
                            col.money("total_amount").alias("total_amount"), "order_status", "order_status_name", "tm_id", cal.second_text("payment_time").alias("payment_time"))


@query
def visit_to_purchase(s):
    return joins.visit_to_purchase(s.ecommerce_data())


@query
def full_join_metrics(s):
    logs, fav, cart, *_ = _facts(s)
    return joins.full_join_metrics([dashboard.hourly_page_metrics(logs).drop("avg_duration", "bounce_rate"), dashboard.hourly_favourites(fav), dashboard.hourly_cart(cart)],
                                   dashboard.HOUR_KEYS)


@query
def join_agg(s):
    views = s.ods_logs().groupBy("product_id").agg(F.count(F.lit(1)).alias("pv"))
    sold = s.order_detail().groupBy("product_id").agg(F.sum("qty").alias("qty"))
    return joins.join_agg(views, [sold], ["product_id"]).fillna(0)


@query
def join_on_day(s):
    left = s.dim_cart().select("user_id", F.col("id").alias("cart_id"), "add_time")
    right = s.order_info().groupBy("user_id", F.col("order_time").cast("date").alias("d")).agg(F.count(F.lit(1)).alias("orders"))
    return joins.join_on_day(left, right, "user_id", "add_time", "d").select("user_id", "stat_date", "cart_id", F.coalesce("orders", F.lit(0)).alias("orders"))


@query
def with_scalar(s):
    users = s.ev().groupBy("k").agg(F.count_distinct("user_id").alias("uv"))
    return joins.with_scalar(users, s.ev().select(F.count_distinct("user_id").alias("n")), "total_uv")


@query
def join_windows(s):
    rows = sales.sale_rows(s.oms_sale())
    a = windows.tumble(rows, "ms", sales.TEN_MINUTES, [], [F.count(F.lit(1)).alias("sales")])
    b = windows.tumble(s.dim_cart().withColumn("ms", cal.millis("add_time")), "ms", sales.TEN_MINUTES, [], [F.count(F.lit(1)).alias("carts")])
    return windows.window_text(joins.join_windows(a, b).fillna(0))


@query
def interval_join(s):
    """Clicks and purchases of a user less than ten minutes apart."""
    a = s.ev().where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), cal.millis("ts").alias("click_ms"))
    b = s.ev().where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("buy_id"), cal.millis("ts").alias("buy_ms"))
    return joins.interval_join(a, b, "user_id", "user_id", "click_ms", "buy_ms", 600_000, 600_000)


@query
def merge_columns(s):
    """The three ways to combine the columns of two records."""
    a, b = s.user_info().select("uid", "uname", "gender"), s.label_bodies().selectExpr("uid", "height as uname", "weight")
    joined = a.alias("a").join(b.alias("b"), F.col("a.uid") == F.col("b.uid"))
    right = joins.merge_columns(joined, a.columns, b.columns, "right").select(F.lit("right").alias("policy"), "uid", "uname", F.col("weight").alias("extra"))
    prefix = joins.merge_columns(joined, a.columns, b.columns, "prefix").select(F.lit("prefix").alias("policy"), "uid", "uname", F.col("info_uname").alias("extra"))
    select = joins.merge_columns(joined, a.columns, b.columns, "select", ["weight"]).select(F.lit("select").alias("policy"), "uid", "uname", F.col("weight").alias("extra"))
    return right.unionByName(prefix).unionByName(select)


@query
def lookup(s):
    return joins.lookup(s.comment_info(), s.code_names(), "appraise", "dic_code", "dic_name").select("id", "appraise", "dic_name")


@query
def search_interest(s):
    words = s.page_log().where("keyword is not null").select("log_id", F.col("keyword").alias("search_item"))
    return joins.search_interest(words, s.label_categories(), s.label_interests()).select(
        "log_id", "search_item", F.coalesce("b1_category", F.lit("")).alias("b1_category"), "search_category")


@query
def route_changes(s):
    return joins.route_changes(chg.parse_changes(s.change_log()), s.routing_config()).select("sink_table", "row_key", "ts_ms")


@query
def vehicle_alarms(s):
    return vehicles.vehicle_alarms(vehicles.flatten_vehicle(s.vehicle_reports()), s.vehicle_rules())


@query
def word_flag(s):
    return joins.word_flag(s.comment_info(), s.block_words(), comments.last_comma_part("comment_txt")).select("id", "is_violation")


@query
def word_semi(s):
    return joins.word_flag(s.comment_info(), s.block_words(), comments.last_comma_part("comment_txt"), "semi").select("id")


@query
def join_reports(s):
    beh, trade, sku = _behaviour(s), _trade(s), s.sku_info()
    report = joins.join_reports(warehouse.sku_conversion(sku, beh, trade), warehouse.sku_interaction(sku, beh), s.order_detail())
    return report.select("sku_id", "pay_num", "inter_favor_num", "inter_cart_num", F.coalesce("detail_id", F.lit(-1)).alias("detail_id"), F.coalesce("line_qty", F.lit(0)).alias("line_qty"))


# ---- dashboard -----------------------------------------------------------------------
@query
def product_visits(s):
    return dashboard.product_visits(s.ecommerce_data())


@query
def purchase_conversion(s):
    return dashboard.purchase_conversion(s.ecommerce_data())


@query
def price_band_sales(s):
    return dashboard.price_band_sales(s.ecommerce_data())


@query
def channel_conversion(s):
    return dashboard.channel_conversion(s.ecommerce_data())


@query
def channel_share(s):
    return dashboard.channel_share(s.ecommerce_data())


@query
def rating_histogram(s):
    return dashboard.rating_histogram(s.ecommerce_data())


@query
def hourly_page_metrics(s):
    return dashboard.hourly_page_metrics(s.ods_logs())


@query
def hourly_favourites(s):
    return dashboard.hourly_favourites(s.dim_favorite())


@query
def hourly_cart(s):
    return dashboard.hourly_cart(s.dim_cart())


@query
def hourly_orders(s):
    return dashboard.hourly_orders(s.order_info(), s.order_detail())


@query
def hourly_payments(s):
    return dashboard.hourly_payments(s.order_info(), s.order_detail())


@query
def hourly_product_result(s):
    return dashboard.hourly_product_result(*_facts(s), dt=AS_OF)


@query
def pay_price_buckets(s):
    return dashboard.pay_price_buckets(s.order_info(), s.order_detail())


@query
def top_products_by_views(s):
    return dashboard.top_products_by_views(s.ods_logs())


@query
def sample(s):
    """A handful of rows to look at; which rows is not defined."""
    return s.oms_sale().limit(10)


# ---- warehouse -----------------------------------------------------------------------
@query
def behaviour_union(s):
    return _behaviour(s).groupBy("behavior_type", cal.day_text("behavior_time").alias("ds")).agg(
        F.count(F.lit(1)).alias("n"), F.count("cart_num").alias("cart_rows"), F.count("appraise").alias("appraised"), F.count("is_cancel").alias("cancel_flags"))


@query
def product_wide(s):
    return warehouse.product_wide(*_facts(s))


@query
def product_wide_joined(s):
    return warehouse.product_wide(*_facts(s), mode="joined")


@query
def product_full_metrics(s):
    return warehouse.product_full_metrics(*_facts(s))


@query
def sku_daily(s):
    return warehouse.sku_daily(_behaviour(s), _trade(s), s.sku_info(), s.category3())


@query
def category_daily(s):
    tree = joins.category_tree(s.category3(), s.category2(), s.category1())
    return warehouse.category_daily(warehouse.sku_daily(_behaviour(s), _trade(s), s.sku_info(), s.category3()), tree)


@query
def brand_daily(s):
    return warehouse.brand_daily(warehouse.sku_daily(_behaviour(s), _trade(s), s.sku_info(), s.category3()))


@query
def user_daily(s):
    return warehouse.user_daily(_behaviour(s), _trade(s))


@query
def sku_traffic(s):
    return warehouse.sku_traffic(s.sku_info(), _behaviour(s))


@query
def sku_conversion(s):
    return warehouse.sku_conversion(s.sku_info(), _behaviour(s), _trade(s))


@query
def sku_interaction(s):
    return warehouse.sku_interaction(s.sku_info(), _behaviour(s))


@query
def sku_customers(s):
    return warehouse.sku_customers(_behaviour(s), s.user_info())


@query
def sku_comments(s):
    return warehouse.sku_comments(s.sku_info(), s.comment_info())


@query
def count_audit(s):
    names = ["ods_logs", "dim_favorite", "dim_cart", "order_info", "order_detail"]
    return warehouse.count_audit(dict(zip(names, _facts(s))))


@query
def partition_audit(s):
    return warehouse.partition_audit(s.ods_logs(), "ds")


# ---- behaviour log -------------------------------------------------------------------
@query
def page_views_daily(s):
    return behaviour.page_views_daily(s.page_log())


@query
def region_heat(s):
    return behaviour.region_heat(s.page_log(), s.ip_regions(), ["province"])


@query
def region_city_heat(s):
    return behaviour.region_heat(s.page_log(), s.ip_regions(), ["province", "city"])


@query
def ranked_map(s):
    return behaviour.ranked_map(behaviour.region_heat(s.page_log(), s.ip_regions(), ["province"]), "stat_date", "province", "visit_count")


@query
def device_daily(s):
    return behaviour.device_daily(s.page_log())


@query
def device_history_today(s):
    return behaviour.device_history_today(s.page_log(), TODAY)


@query
def device_tree(s):
    return behaviour.device_tree(s.page_log())


@query
def top_words_daily(s):
    return behaviour.top_words_daily(s.page_log())


@query
def top_word_map(s):
    return behaviour.top_word_map(s.page_log())


@query
def top_n(s):
    counts = s.ecommerce_data().groupBy("channel", "product_id").agg(F.count(F.lit(1)).alias("visits"))
    return ordered.top_n(counts, ["channel"], "visits", "product_id", 10)


@query
def with_history(s):
    history, live = s.page_log().where("log_id % 2 = 0"), s.page_log().where("log_id % 2 = 1")
    return behaviour.page_views_daily(behaviour.union_history(history, live))


@query
def tag_history(s):
    return behaviour.tag_history(s.page_log(), TODAY).groupBy("data_type", "stat_date").agg(F.count(F.lit(1)).alias("n"))


@query
def page_transitions(s):
    return behaviour.page_transitions(s.page_log()).select("user_id", F.coalesce("last_page", F.lit("")).alias("last_page"), "current_page", "ts_ms",
                                                          F.coalesce("stay_seconds", F.lit(-1)).alias("stay_seconds"))


@query
def path_anomalies(s):
    return behaviour.path_anomalies(s.page_log())


@query
def user_paths(s):
    return behaviour.user_paths(s.page_log())


@query
def user_paths_v1106(s):
    return behaviour.user_paths(s.page_log(), rule="v1106")


@query
def user_paths_literal(s):
    return behaviour.user_paths(s.page_log(), history="through")


@query
def session_restarts(s):
    return behaviour.session_restarts(s.page_log())


@query
def user_profiles(s):
    return behaviour.user_profiles(s.page_log())


@query
def profile_daily_summary(s):
    return behaviour.profile_daily_summary(s.page_log())


@query
def daily_totals(s):
    return behaviour.daily_totals(s.page_log(), ["plat", "brand", "platv"])


@query
def running_counts(s):
    return ordered.running_counts(behaviour.with_ms(s.page_log()).select("log_id", "stat_date", "log_type", "ms"), ["stat_date", "log_type"], "ms", "log_id").select(
        "log_id", "stat_date", F.col("log_type").alias("page"), "running_count")


@query
def keep_rising(s):
    """Sales whose pieces exceed all earlier ones of the product, in order of arrival."""
    rows = s.oms_sale().select("id", "product_id", F.col("sale_num").cast("long").alias("num"))
    return ordered.keep_rising(rows, ["product_id"], "id", "num")


@query
def last_per_interval(s):
    rows = s.page_log().select("log_id", "user_id", "log_type", cal.epoch_ms("ts").alias("ms"))
    return windows.last_per_interval(rows, "user_id", "ms", "log_id", 7_200_000)


# ---- sales windows -------------------------------------------------------------------
@query
def tumble(s):
    return sales.window_totals(s.oms_sale())


@query
def window_top(s):
    return sales.window_top(s.oms_sale(), size=3_600_000)


@query
def rank_pivot(s):
    return sales.window_top_ids(s.oms_sale(), size=3_600_000)


@query
def cumulate(s):
    return sales.cumulative_sales(s.oms_sale(), sales.TEN_MINUTES)


@query
def cumulate_seconds(s):
    return sales.cumulative_sales(s.oms_sale())


@query
def cumulate_measures(s):
    return sales.cumulative_measures(s.oms_sale())


@query
def cumulate_by_product(s):
    return sales.cumulative_by_product(s.oms_sale(), 3_600_000)


@query
def cumulative_report(s):
    return sales.cumulative_report(s.oms_sale())


@query
def cumulative_top_sold(s):
    return sales.cumulative_top_sold(s.oms_sale())


@query
def cumulative_process(s):
    return sales.cumulative_process(s.oms_sale())


@query
def running_sales(s):
    return sales.running_sales(s.oms_sale())


@query
def ordered_list(s):
    return sales.order_items(s.order_detail())


# ---- market --------------------------------------------------------------------------
@query
def median_and_mean(s):
    return market.median_and_mean(s.ecommerce_data())


@query
def rolling_product(s):
    return market.rolling_product(s.ods_logs(), s.order_info(), s.order_detail())


@query
def co_items(s):
    return market.onward_items(s.ecommerce_data())


@query
def title_words(s):
    return market.title_words(s.sku_info(), s.ecommerce_data())


@query
def content_top(s):
    return market.content_top(s.ecommerce_data())


@query
def crowd_portrait(s):
    return market.crowd_portrait(s.ecommerce_data(), s.user_info())


@query
def attribute_sales(s):
    return market.attribute_sales(s.order_detail())


@query
def attribute_sales_size(s):
    return market.attribute_sales(s.order_detail(), "sku_size")


@query
def price_trend(s):
    return market.price_trend(s.order_info(), s.order_detail(), s.ods_logs())


# ---- labels --------------------------------------------------------------------------
def _log_profile(s: Shop) -> DataFrame:
    return labels.user_log_profile(pagelog.reshape_page_log(pagelog.parse_log(s.raw_log())))


def _log_scores(s: Shop) -> DataFrame:
    return labels.device_search_scores(_log_profile(s).where("uid <> '-1'"), s.label_categories(), s.label_interests())


def _line_scores(s: Shop) -> DataFrame:
    return labels.order_scores(labels.order_facts(s.label_orders(), s.label_details()), s.label_sku(), s.label_categories())


def _base(s: Shop) -> DataFrame:
    return labels.base_profile(s.label_users(), s.label_bodies(), AS_OF)


def _bands(*parts: str) -> list[str]:
    return [f"{p}_{b}" for p in parts for b in labels.BANDS]


@query
def user_log_profile(s):
    return _log_profile(s).withColumn("last_search", F.coalesce("last_search", F.lit("")))


@query
def device_search_scores(s):
    return _log_scores(s).select("uid", "judge_os", "search_category", *_bands("device", "search"))


@query
def order_facts(s):
    return labels.order_facts(s.label_orders(), s.label_details()).select("detail_id", "id", "uid", "sku_id", "sku_num", "pay_time_slot",
                                                                         col.money("split_coupon_amount").alias("split_coupon_amount"), "ts_ms")


@query
def order_scores(s):
    return _line_scores(s).select("detail_id", "spending_pow", "tname", "b1_name", *_bands("pay_time", "amount", "tname", "b1name"))


@query
def base_profile(s):
    return _base(s).select("uid", "uname", "gender", "birthday", "age", "decade", "zodiac_sign", "height", "weight", "ts_ms")


@query
def score_sums(s):
    return labels.user_scores(_log_scores(s), _line_scores(s)).select("detail_id", "uid", *_bands("sum"))


@query
def score_sums_literal(s):
    return labels.user_scores(_log_scores(s), _line_scores(s), "literal").select("detail_id", "uid", *_bands("sum"))


@query
def best_band(s):
    scored = labels.best_band(labels.user_scores(_log_scores(s), _line_scores(s)))
    return scored.select("detail_id", F.coalesce("calculate_age", F.lit("")).alias("calculate_age"), F.coalesce("calculate_score", F.lit(0.0)).alias("calculate_score"))


@query
def user_labels(s):
    found = labels.user_labels(labels.user_scores(_log_scores(s), _line_scores(s)), _base(s))
    return found.select("uid", "detail_id", "consignee", "age", "zodiac_sign", "height", "spending_pow", "calculate_age", "ds")


@query
def label_records(s):
    return labels.label_records(labels.user_labels(labels.user_scores(_log_scores(s), _line_scores(s)), _base(s)), _log_profile(s).where("uid <> '-1'"))


# ---- comments, vehicles, quality, clusters -------------------------------------------
@query
def comment_facts(s):
    facts = comments.comment_facts(
        s.comment_info().select("id", "user_id", "appraise", "order_id", F.md5("comment_txt").alias("text_md5"), cal.millis("create_time").alias("ts_ms")),
        s.label_orders().select("id", "consignee", (F.col("ts_ms") + F.col("id") % 100 * 1000).alias("ts_ms")), s.code_names())
    return facts.select("id", "user_id", "dic_name", "info_consignee", "info_ts_ms", "text_md5", "ds")


@query
def moderate(s):
    return comments.moderate(s.comment_info(), s.block_words())


@query
def moderate_tokens(s):
    return comments.moderate(s.comment_info(), s.block_words(), match="token")


@query
def word_counts(s):
    """In how many texts each listed word occurs."""
    return word_hits(s.table("documents"), s.block_words(), "doc_id", "text").groupBy("word").agg(F.count(F.lit(1)).alias("texts"))


@query
def trip_distance(s):
    return vehicles.trip_distance(s.vehicle())


@query
def trip_distance_ellipsoid(s):
    return vehicles.trip_distance(s.vehicle(), "ellipsoid")


@query
def cluster(s):
    return clustering.cluster_sizes(clustering.cluster(s.table("embeddings"), "embedding"))


@query
def id_audit(s):
    return quality.id_audit(s.identity_numbers(), "id_number")


@query
def id_audit_counts(s):
    return quality.id_audit_counts(s.identity_numbers(), "id_number")


@query
def amount_words(s):
    return quality.spelled_orders(s.order_detail())


@query
def amount_words_literal(s):
    return quality.spelled_orders(s.order_detail(), "literal")


@query
def sql_functions(s):
    """The two registered SQL functions, called from SQL text."""
    register(s.spark)
    rows = s.identity_numbers().selectExpr("uid", "validate_id_card(id_number) as verdict",
                                           "convert_number_chinese_amount(cast(uid * 1.25 as decimal(20,4))) as words")
    return rows
