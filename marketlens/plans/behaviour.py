"""Behaviour-log analytics: views, regions, devices, search words, paths and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.calendar import epoch_ms, ms_day, ms_second, primary_slot, slot_counts
from marketlens.functions.columns import is_blank
from marketlens.operators.ordered import count_recent, ordered_list, previous_row, top_n

# The pages a user path may consist of.
PATH_PAGES = ["app_launch", "home_page", "search", "product_list", "product_detail", "add_cart", "order_confirm", "payment"]
ARROW = " → "


def with_ms(log: DataFrame) -> DataFrame:
    """Epoch milliseconds, whatever unit the row carries, and the event day."""
    return log.withColumn("ms", epoch_ms("ts")).withColumn("stat_date", ms_day("ms"))


def path_events(log: DataFrame) -> DataFrame:
    """Rows with user, page and time whose page belongs to the path pages."""
    return with_ms(log.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull() & F.col("log_type").isin(*PATH_PAGES)))


# ---- counts --------------------------------------------------------------------------
def daily_totals(log: DataFrame, keys: list[str]) -> DataFrame:
    return with_ms(log).groupBy("stat_date", *keys).agg(F.count(F.lit(1)).alias("total"))


def page_views_daily(log: DataFrame) -> DataFrame:
    return with_ms(log).groupBy(F.col("stat_date").alias("visit_date"), F.col("log_type").alias("page")).agg(F.count(F.lit(1)).alias("pv"))


def ip_prefix(ip) -> Column:
    return F.substring_index(ip, ".", 2)


def region_heat(log: DataFrame, regions: DataFrame, by: list[str]) -> DataFrame:
    """Visits per region and day with their rank inside the day.

    Visits are first counted per address prefix, so the region join sees prefixes, not rows.
    """
    prefixes = with_ms(log.where(~is_blank("ip"))).groupBy("stat_date", ip_prefix("ip").alias("ip_prefix")).agg(F.count(F.lit(1)).alias("n"))
    counted = prefixes.join(regions, "ip_prefix").groupBy("stat_date", *by).agg(F.sum("n").alias("visit_count"))
    best = Window.partitionBy("stat_date").orderBy(F.desc("visit_count"), *by)
    return counted.withColumn("rank", F.row_number().over(best).cast("long"))


def ranked_map(counted: DataFrame, key: str, item: str, value: str) -> DataFrame:
    """All items of a key as one text ``item=value``, largest first; items are a closed set."""
    pairs = F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("v"), F.col(item).cast("string").alias("i"))))
    text = F.transform(pairs, lambda p: F.concat(p["i"], F.lit("="), (-p["v"]).cast("string")))
    return counted.groupBy(key).agg(F.array_join(text, ",").alias("ranking"))


def device_daily(log: DataFrame) -> DataFrame:
    """Users per platform, brand and version on every day, for the two phone platforms."""
    phones = with_ms(log).where(F.col("plat").isin("ios", "android"))
    return phones.groupBy("stat_date", "plat", "brand", "platv").agg(F.count_distinct("user_id").alias("device_count"))


def device_history_today(log: DataFrame, today: str) -> DataFrame:
    """Users per brand, platform and network before a day and on it."""
    tagged = tag_history(log, today)
    return tagged.groupBy("brand", "plat", "net", "data_type").agg(F.count_distinct("user_id").alias("user_cnt"))


def tag_history(log: DataFrame, today: str) -> DataFrame:
    day = F.col("stat_date")
    return with_ms(log).where(day <= today).withColumn("data_type", F.when(day < today, "history").otherwise("today"))


def device_tree(log: DataFrame) -> DataFrame:
    """Rows per device of a day as one nested document {platform: {brand: {version: rows}}}."""
    counted = with_ms(log.where("plat is not null and brand is not null and platv is not null")).groupBy(
        "stat_date", "plat", "brand", "platv").agg(F.count(F.lit(1)).alias("n"))
    def nest(frame, keys, name, value):
        # Names of one level are distinct; devices, brands and versions of a day are closed sets.
        entries = F.array_sort(F.collect_list(F.struct(F.col(name).alias("key"), F.col(value).alias("value"))),
                               lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        return frame.groupBy(*keys).agg(F.map_from_entries(entries).alias("inner"))
    versions = nest(counted, ["stat_date", "plat", "brand"], "platv", "n")
    brands = nest(versions.withColumnRenamed("inner", "v"), ["stat_date", "plat"], "brand", "v")
    plats = nest(brands.withColumnRenamed("inner", "b"), ["stat_date"], "plat", "b")
    return plats.select("stat_date", F.to_json("inner").alias("log_content"))


def top_words_daily(log: DataFrame, n: int = 10) -> DataFrame:
    counts = with_ms(log.where((F.col("log_type") == "search") & F.col("keyword").isNotNull())).groupBy(
        "stat_date", "keyword").agg(F.count(F.lit(1)).alias("cnt"))
    return top_n(counts, ["stat_date"], "cnt", "keyword", n)


def top_word_map(log: DataFrame, n: int = 10) -> DataFrame:
    return ranked_map(top_words_daily(log, n), "stat_date", "keyword", "cnt")


def union_history(history: DataFrame, live: DataFrame) -> DataFrame:
    return history.unionByName(live, allowMissingColumns=True)


# ---- paths ---------------------------------------------------------------------------
def page_transitions(log: DataFrame) -> DataFrame:
    """Previous and current page per user with the time spent in between."""
    rows = path_events(log).select("user_id", "log_id", "ms", "log_type")
    back = previous_row(rows, ["user_id"], "ms", "log_id", ["log_type", "ms"])
    return back.select(
        "user_id", F.col("prev.log_type").alias("last_page"), F.col("log_type").alias("current_page"),
        F.col("ms").alias("ts_ms"), F.floor((F.col("ms") - F.col("prev.ms")) / 1000).cast("long").alias("stay_seconds"))


def path_anomalies(log: DataFrame) -> DataFrame:
    """More than five equal actions inside 60 s, and a product page right after payment or order."""
    rows = path_events(log).select("user_id", "stat_date", "log_id", "ms", "log_type", "order_id")
    days = ["user_id", "stat_date"]
    repeats = count_recent(rows, [*days, "log_type"], "ms").where("recent > 5").select(
        "user_id", "ms", F.lit("repeat").alias("kind"), F.concat_ws(":", "log_type", F.col("recent").cast("string")).alias("detail"))
    back = previous_row(rows, days, "ms", "log_id", ["log_type", "order_id"])
    steps = back.where((F.col("log_type") == "product_detail") & F.col("prev.log_type").isin("payment", "order_confirm")).select(
        "user_id", "ms", F.when(F.col("prev.log_type") == "payment", "after_payment").otherwise("hesitation").alias("kind"),
        F.coalesce(F.col("prev.order_id").cast("string"), F.lit("")).alias("detail"))
    return repeats.unionByName(steps).withColumnRenamed("ms", "ts_ms")


def path_days(log: DataFrame) -> DataFrame:
    """Per user and day: events, first and last time, and whether a payment happened."""
    return path_events(log).groupBy("user_id", F.col("stat_date").alias("analysis_date")).agg(
        F.count(F.lit(1)).alias("event_count"), F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"),
        F.max(F.when(F.col("log_type") == "payment", 1).otherwise(0)).cast("long").alias("converted"))


def user_types(days: DataFrame, rule: str = "v1107", history: str = "before") -> DataFrame:
    """User type of each day from the payments of the earlier days.

    ``history="through"`` also counts the day itself, as the jobs this follows did.
    """
    frame = Window.partitionBy("user_id").orderBy("analysis_date").rowsBetween(
        Window.unboundedPreceding, -1 if history == "before" else 0)
    past = days.withColumns({"past_days": F.count(F.lit(1)).over(frame), "past_paid": F.coalesce(F.sum("converted").over(frame), F.lit(0))})
    paid, bought = F.col("past_paid") > 0, F.col("converted") == 1
    if rule == "v1107":
        kind = F.when(paid & bought, "高价值用户").when(~paid & ~bought, "普通用户").otherwise("观望用户")
    elif rule == "v1106":
        kind = F.when(paid & bought, "高价值用户").when((F.col("past_days") >= 3) & ~paid, "观望用户").when(
            bought & (F.col("past_days") == 0), "新用户首单").otherwise("普通用户")
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return past.withColumn("user_type", kind)


def user_paths(log: DataFrame, rule: str = "v1107", history: str = "before", part_size: int = 1000) -> DataFrame:
    """Daily path of every user with conversion, size, duration and user type.

    A path longer than ``part_size`` pages continues in the rows ``part`` 1, 2, ...
    """
    days = user_types(path_days(log), rule, history)
    rows = path_events(log).select("user_id", F.col("stat_date").alias("analysis_date"), "ms", "log_id", "log_type")
    paths = ordered_list(rows, ["user_id", "analysis_date"], F.col("log_type"), "ms", "log_id", ARROW, part_size)
    return paths.join(days, ["user_id", "analysis_date"]).select(
        "user_id", "analysis_date", "part", F.col("items").alias("path_sequence"),
        F.when(F.col("converted") == 1, "已转化").otherwise("未转化").alias("conversion_status"),
        "event_count", F.floor((F.col("last_ms") - F.col("first_ms")) / 1000).cast("long").alias("total_duration"), "user_type")


def session_restarts(log: DataFrame, minutes: int = 30) -> DataFrame:
    """Times at which a user's session begins anew: the first event more than ``minutes``
    after the running session's **start**, counted per day.

    Each restart depends on the one before, so a day of a user is read in time order once,
    holding only the current start. Equal times are merged first, which bounds the rows of
    one user and day by the clock, and days of one user go to different tasks.
    """
    times = path_events(log).select("user_id", "stat_date", "ms").distinct()
    ordered = times.repartition("user_id", "stat_date").sortWithinPartitions("user_id", "stat_date", "ms")
    limit = minutes * 60_000

    def walk(batches):
        import pandas as pd
        key, start = None, None
        for batch in batches:
            found = []
            groups = batch.groupby(["user_id", "stat_date"], sort=False, dropna=False)["ms"]
            for day, values in groups:
                values = values.to_numpy()
                if day != key:
                    key, start = day, int(values[0])
                at = values.searchsorted(start + limit, side="right")
                while at < len(values):
                    start = int(values[at])
                    found.append((*day, start))
                    at = values.searchsorted(start + limit, side="right")
            yield pd.DataFrame(found, columns=["user_id", "stat_date", "session_start"])

    return ordered.mapInPandas(walk, "user_id long, stat_date string, session_start long")


# ---- profiles ------------------------------------------------------------------------
def user_profiles(log: DataFrame, keywords: int = 10) -> DataFrame:
    """One profile per user: days, behaviour, slots, words, products, orders, device, tags, level.

    Distinct things are counted from one row per (user, thing), so no set grows with a
    user's rows; only the ten most frequent words and the days are listed.
    """
    rows = with_ms(log.where("user_id is not null and log_type is not null and ts is not null"))
    hour = F.hour(F.timestamp_millis("ms"))
    kind = F.col("log_type")
    searched = (kind == "search") & F.col("keyword").isNotNull()
    bought = (kind == "payment") | ((kind == "order_confirm") & F.col("order_id").isNotNull())
    browsed = kind.isin("product_detail", "product_list")

    days = rows.groupBy("user_id", "stat_date").agg(
        F.max(searched).alias("s"), F.max(bought).alias("p"), F.max(browsed).alias("b"),
        *[c.alias(n) for n, c in slot_counts(hour).items()],
        F.min_by(F.struct("brand", "plat", "platv"), F.struct("ms", "log_id")).alias("device"), F.min("ms").alias("first_ms"))

    def listed(flag, name):
        return F.array_join(F.array_sort(F.collect_set(F.when(flag, F.col("stat_date")))), ",").alias(name)

    base = days.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("login_days_count"), listed(F.lit(True), "login_dates"), listed(F.col("s"), "search_days"),
        listed(F.col("p"), "purchase_days"), listed(F.col("b"), "browse_days"),
        *[F.sum(n).alias(n) for n in slot_counts(hour)], F.min_by("device", "first_ms").alias("device"))

    def things(flag, column, name):
        return rows.where(flag & F.col(column).isNotNull()).groupBy("user_id").agg(F.count_distinct(column).alias(name))

    words = rows.where(searched & ~is_blank("keyword")).groupBy("user_id", "keyword").agg(F.count(F.lit(1)).alias("cnt"))
    word_count = words.groupBy("user_id").agg(F.count(F.lit(1)).alias("search_keyword_count"))
    best = top_n(words, ["user_id"], "cnt", "keyword", keywords).groupBy("user_id").agg(
        F.expr("listagg(keyword, ',') within group (order by rn)").alias("top_search_keywords"))
    nets = rows.where("net is not null").groupBy("user_id", "net").agg(F.count(F.lit(1)).alias("n")).groupBy("user_id").agg(
        F.expr("listagg(concat(net, '=', n), ',') within group (order by net)").alias("network_types"))
    joined = base
    for part in (things(bought, "order_id", "order_count"), things(browsed, "product_id", "browsed_products_count"), word_count, best, nets):
        joined = joined.join(part, "user_id", "left")
    counts = ["order_count", "browsed_products_count", "search_keyword_count"]
    filled = joined.fillna(0, counts).fillna("", ["top_search_keywords", "network_types"]).withColumn("primary_time_slot", primary_slot())
    return filled.select(
        "user_id", "login_days_count", "login_dates", "search_days", "purchase_days", "browse_days",
        *slot_counts(hour), "primary_time_slot", "top_search_keywords", *counts,
        F.col("device.brand").alias("brand"), F.col("device.plat").alias("plat"), F.col("device.platv").alias("platv"),
        "network_types", F.array_join(tags_of(), ",").alias("user_tags"), level_of().alias("user_level"))


def tags_of() -> Column:
    days, orders = F.col("login_days_count"), F.col("order_count")
    converted = F.col("purchase_days") != ""
    return F.array_compact(F.array(
        F.when(days >= 7, "高频用户").when(days >= 3, "活跃用户").otherwise("低频用户"),
        F.when(converted, "已转化").otherwise("潜在用户"),
        F.when(converted & (orders >= 3), "高价值用户"),
        F.when(F.col("search_days") != "", "有搜索意图"),
        F.when(F.col("browsed_products_count") >= 10, "高浏览用户"),
        F.concat("primary_time_slot", F.lit("活跃"))))


def level_of() -> Column:
    score = F.col("login_days_count") * 2 + F.col("order_count") * 10 + F.col("browsed_products_count") + F.col("search_keyword_count")
    return F.when(score >= 100, "VIP").when(score >= 50, "高级").when(score >= 20, "中级").otherwise("普通")


def profile_daily_summary(log: DataFrame) -> DataFrame:
    return user_profiles(log).select(
        "user_id", F.col("login_days_count").alias("total_login_days"), F.col("order_count").alias("total_orders"),
        F.col("browsed_products_count").alias("total_browsed_products"), F.col("search_keyword_count").alias("total_search_keywords"), "user_level")


def profile_json(profiles: DataFrame) -> DataFrame:
    """The profile as the JSON record a downstream topic carries."""
    days = lambda c: F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, ","))
    behaviour = F.struct(*[f for name in ("search", "purchase", "browse") for f in (
        (F.col(f"{name}_days") != "").alias(f"has_{name}"), days(f"{name}_days").alias(f"{name}_days"))])
    slots = F.struct("morning_6_12", "afternoon_12_18", "evening_18_24", "night_0_6", "primary_time_slot")
    return profiles.select("user_id", F.to_json(F.struct(
        "user_id", "login_days_count", days("login_dates").alias("login_dates"), behaviour.alias("behavior"), slots.alias("time_slots"),
        days("top_search_keywords").alias("top_search_keywords"), "browsed_products_count", "order_count",
        F.struct("brand", "plat", "platv").alias("device"), F.expr("str_to_map(network_types, ',', '=')").alias("network_types"),
        F.split("user_tags", ",").alias("user_tags"))).alias("profile"))
