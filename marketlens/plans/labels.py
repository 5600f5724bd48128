"""User age labels: scores for six age bands, their sums and the final label record."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.calendar import calendar_features, day_part, epoch_day_date, ms_day, day_text
from marketlens.functions.columns import half_up
from marketlens.operators.joins import interval_join, search_interest
from marketlens.operators.ordered import keep_rising, ordered_list

MINUTE, HOUR = 60_000, 3_600_000
BANDS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]

# Weight of each score.
WEIGHTS = {"device": 0.1, "search": 0.15, "pay_time": 0.1, "amount": 0.15, "tname": 0.2, "b1name": 0.3}
# Score per age band, in the order of BANDS.
DEVICE_SCORES = {
    "iOS": [0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "Android": [0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
}
SEARCH_SCORES = {
    "时尚与潮流": [0.9, 0.7, 0.5, 0.3, 0.2, 0.1],
    "性价比": [0.2, 0.4, 0.6, 0.7, 0.8, 0.8],
    "健康与养生": [0.1, 0.2, 0.4, 0.6, 0.8, 0.7],
    "家庭与育儿": [0.1, 0.2, 0.4, 0.6, 0.8, 0.7],
    "科技与数码": [0.8, 0.6, 0.4, 0.3, 0.2, 0.1],
    "学习与发展": [0.4, 0.5, 0.6, 0.7, 0.8, 0.7],
}
PAY_TIME_SCORES = {
    "凌晨": [0.2, 0.1, 0.1, 0.1, 0.1, 0.1],
    "早晨": [0.1, 0.1, 0.1, 0.1, 0.2, 0.3],
    "上午": [0.2, 0.2, 0.2, 0.2, 0.3, 0.4],
    "中午": [0.4, 0.4, 0.4, 0.4, 0.4, 0.3],
    "下午": [0.4, 0.5, 0.5, 0.5, 0.5, 0.4],
    "晚上": [0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
    "夜间": [0.9, 0.7, 0.5, 0.3, 0.2, 0.1],
}
AMOUNT_SCORES = {
    "低消费": [0.8, 0.6, 0.4, 0.3, 0.2, 0.1],
    "中消费": [0.2, 0.4, 0.6, 0.7, 0.8, 0.7],
    "高消费": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6],
}
BRAND_SCORES = {
    "TCL": [0.2, 0.3, 0.4, 0.5, 0.6, 0.7],
    "苹果": [0.9, 0.8, 0.7, 0.7, 0.7, 0.5],
    "联想": [0.9, 0.8, 0.7, 0.7, 0.7, 0.5],
    "小米": [0.9, 0.8, 0.7, 0.7, 0.7, 0.5],
    "欧莱雅": [0.5, 0.6, 0.8, 0.8, 0.9, 0.2],
    "香奈儿": [0.3, 0.4, 0.6, 0.8, 0.9, 0.2],
}
OTHER_BRAND = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6]
YOUNG_CATEGORY = [0.9, 0.8, 0.6, 0.4, 0.2, 0.1]
HOME_CATEGORY = [0.2, 0.4, 0.6, 0.8, 0.9, 0.7]
OTHER_CATEGORY = [0.1, 0.2, 0.4, 0.5, 0.8, 0.9]
CATEGORY_SCORES = {
    **dict.fromkeys(["数码", "手机", "电脑办公", "个护化妆", "服饰内衣"], YOUNG_CATEGORY),
    **dict.fromkeys(["家居家装", "图书、音像、电子书刊", "厨具", "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器"], HOME_CATEGORY),
}


def band_scores(value: Column, table: dict[str, list[float]], name: str, other: list[float] | None = None) -> dict[str, Column]:
    """Six weighted scores of a value; values outside the table score ``other`` or 0.

    The table is a constant map inside the expression, so scoring needs no join.
    """
    scores = F.create_map(*chain.from_iterable((F.lit(k), F.array(*map(F.lit, v))) for k, v in table.items()))
    found = F.coalesce(F.try_element_at(scores, value), F.array(*map(F.lit, other or [0.0] * 6)))
    found = F.when(value.isNull(), F.array(*[F.lit(0.0)] * 6)).otherwise(found)
    return {f"{name}_{band}": half_up(found[i] * WEIGHTS[name]) for i, band in enumerate(BANDS)}


def spending_power(amount) -> Column:
    """Below 1000 low, strictly between 1000 and 4000 middle, everything else high."""
    a = F.col(amount) if isinstance(amount, str) else amount
    return F.when(a < 1000, "低消费").when((a > 1000) & (a < 4000), "中消费").otherwise("高消费")


def user_log_profile(pages: DataFrame) -> DataFrame:
    """Page views, device values and search words per user from reshaped page-log rows.

    ``search_item`` lists the distinct words in the order first searched; a list longer than
    1000 words continues in the rows ``part`` 1, 2, ... The device columns are closed sets.
    """
    unique = pages.dropDuplicates([c for c in pages.columns if c != "log_id"])
    def joined(c):
        return F.array_join(F.array_sort(F.collect_set(c)), ",").alias(c)
    base = unique.groupBy("uid").agg(
        F.count(F.lit(1)).alias("pv"), *[joined(c) for c in ("os", "ch", "md", "ba")],
        F.max_by("search_item", F.when(F.col("search_item").isNotNull(), F.col("ts"))).alias("last_search"), F.max("ts").alias("ts_ms"))
    words = unique.where("search_item is not null").groupBy("uid", "search_item").agg(F.min("ts").alias("ms"))
    lists = ordered_list(words, ["uid"], F.col("search_item"), "ms", "search_item")
    return base.join(lists.select("uid", "part", F.col("items").alias("search_item")), "uid", "left").fillna(0, ["part"]).fillna("", ["search_item"])


def device_search_scores(profile: DataFrame, categories: DataFrame, interests: DataFrame, search: str = "last_search") -> DataFrame:
    """Scores from the first operating system and the interest class of a search word.

    One row for each user; the word lists, which may take several rows, join the record later.
    """
    users = profile.drop("part", "search_item").distinct()
    known = search_interest(users, categories, interests, search).withColumn("judge_os", F.split("os", ",")[0])
    return known.withColumns({**band_scores(F.col("judge_os"), DEVICE_SCORES, "device"),
                              **band_scores(F.col("search_category"), SEARCH_SCORES, "search")})


def order_facts(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Order lines written within two minutes of their order, the newest per line."""
    head = orders.withColumn("pay_time_slot", day_part("create_time")).drop("create_time")
    lines = details.withColumnRenamed("id", "detail_id").withColumnRenamed("ts_ms", "detail_ms")
    joined = interval_join(head, lines, "id", "order_id", "ts_ms", "detail_ms", 2 * MINUTE, 2 * MINUTE, "select",
                           ["detail_id", "order_id", "sku_id", "sku_num", "split_coupon_amount", "order_price", "detail_ms"])
    return keep_rising(joined, ["detail_id"], "detail_ms", "ts_ms")


def order_scores(lines: DataFrame, sku: DataFrame, categories: DataFrame) -> DataFrame:
    """Scores from pay time, amount, brand and top category of each order line."""
    names = sku.join(categories.select("category3_id", "b1_name"), "category3_id", "left").select("sku_id", "sku_name", "tname", "b1_name")
    known = lines.join(names, "sku_id", "left").withColumn("spending_pow", spending_power("total_amount"))
    return known.withColumns({
        **band_scores(F.col("pay_time_slot"), PAY_TIME_SCORES, "pay_time"), **band_scores(F.col("spending_pow"), AMOUNT_SCORES, "amount"),
        **band_scores(F.col("tname"), BRAND_SCORES, "tname", OTHER_BRAND), **band_scores(F.col("b1_name"), CATEGORY_SCORES, "b1name", OTHER_CATEGORY)})


# Parts the literal sums read under a name that exists, per band.
ORDER_PARTS, LOG_PARTS = ["b1name", "amount", "tname", "pay_time"], ["device", "search"]
LITERAL_PARTS = {"25_29": ORDER_PARTS, "30_34": ORDER_PARTS, "35_39": LOG_PARTS, "40_49": LOG_PARTS}


def score_sums(scored: DataFrame, mode: str = "all") -> DataFrame:
    """Sum of the six scores per band; ``literal`` leaves out the parts the jobs misname."""
    def parts(band):
        return LITERAL_PARTS.get(band, ORDER_PARTS + LOG_PARTS) if mode == "literal" else ORDER_PARTS + LOG_PARTS
    return scored.withColumns({
        f"sum_{band}": half_up(sum((F.col(f"{p}_{band}") for p in parts(band)), F.lit(0.0))) for band in BANDS})


def best_band(summed: DataFrame) -> DataFrame:
    """Band of the largest sum (the younger on a tie); none when no sum is above zero."""
    top = F.greatest(*[F.col(f"sum_{b}") for b in BANDS])
    band = F.coalesce(*[F.when(F.col(f"sum_{b}") == top, F.lit(b)) for b in BANDS])
    return summed.withColumns({"calculate_age": F.when(top > 0, band), "calculate_score": F.when(top > 0, top)})


def base_profile(users: DataFrame, bodies: DataFrame, as_of: str) -> DataFrame:
    """User record with age, decade and zodiac, joined with height and weight (within five minutes)."""
    dated = users.withColumn("birthday", epoch_day_date("birthday")).withColumn("gender", F.coalesce("gender", F.lit("home")))
    known = calendar_features(dated, "birthday", as_of).withColumn("birthday", day_text("birthday"))
    sup = bodies.withColumnRenamed("ts_ms", "body_ms").withColumnRenamed("uid", "body_uid")
    return interval_join(known, sup, "uid", "body_uid", "ts_ms", "body_ms", 5 * MINUTE, 5 * MINUTE, "select",
                         ["height", "unit_height", "weight", "unit_weight"])


def user_scores(log_scores: DataFrame, line_scores: DataFrame, mode: str = "all") -> DataFrame:
    """Log scores joined with the order scores of the same user within six hours, and their sums."""
    log = log_scores.select(F.col("uid").cast("long").alias("log_uid"), F.col("ts_ms").alias("log_ms"), "pv", "os", "ch", "md", "ba",
                            "judge_os", *[f"{p}_{b}" for p in LOG_PARTS for b in BANDS])
    joined = interval_join(log, line_scores, "log_uid", "uid", "log_ms", "ts_ms", 6 * HOUR, 6 * HOUR)
    return score_sums(joined, mode)


def user_labels(scores: DataFrame, base: DataFrame) -> DataFrame:
    """Final label rows: scores joined with the base profile of the user within six hours."""
    profile = base.select(F.col("uid").alias("base_uid"), F.col("ts_ms").alias("base_ms"), "decade", "zodiac_sign", "gender", "height",
                          "weight", "user_level", "birthday", "age")
    joined = interval_join(best_band(scores), profile, "uid", "base_uid", "ts_ms", "base_ms", 6 * HOUR, 6 * HOUR)
    return joined.withColumn("ds", F.regexp_replace(ms_day("ts_ms"), "-", ""))


def label_records(labels: DataFrame, profile: DataFrame) -> DataFrame:
    """The label rows as nested JSON records, one per topic message.

    A user's search words come from all rows of ``profile``; a list that takes several rows
    gives as many records, numbered by ``part``.
    """
    words = profile.select(F.col("uid").cast("long").alias("_uid"), "part", "search_item")
    labels = labels.join(words, F.col("uid") == F.col("_uid"))
    record = F.struct(
        "uid", F.col("consignee").alias("uname"), "ts_ms",
        F.struct("decade", "zodiac_sign", "gender", "height", "weight", "user_level", "birthday", "judge_os", F.col("age").alias("base_age")).alias("user_base_label"),
        F.struct(F.col("pv").alias("intraday_pv"), "search_item").alias("user_log_label"),
        F.struct("md", "ba", "os", "ch", F.col("pay_time_slot").alias("login_time_slot")).alias("user_device_label"),
        F.struct(F.struct(*[F.col(f"sum_{b}").alias(f"age_sum{b}") for b in BANDS]).alias("computer_age_info"), "spending_pow",
                 F.struct("calculate_age", "calculate_score").alias("calculate_age")).alias("user_calculate_label"),
        F.struct("sku_name", "b1_name", "tname", "sku_id").alias("sup_info_message"), "ds")
    return labels.select("uid", "detail_id", "part", F.to_json(record).alias("record"))
