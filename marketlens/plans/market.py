"""Product market analysis: medians, rolling periods, onward traffic, titles, crowds, prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.calendar import day_text, millis
from marketlens.functions.columns import money, percent, safe_ratio
from marketlens.operators.joins import order_lines
from marketlens.operators.ordered import exact_median, previous_row, top_n
from marketlens.operators.windows import rolling_distinct, rolling_sums

PERIODS = (1, 7, 15, 30)


def median_and_mean(ecommerce: DataFrame) -> DataFrame:
    return exact_median(ecommerce, ["product_id"], "price").select("product_id", F.round("median", 4).alias("median"), F.round("mean", 4).alias("mean"))


def _day_number(ts: str):
    return F.unix_date(F.col(ts).cast("date")).cast("long")


def rolling_product(logs: DataFrame, orders: DataFrame, details: DataFrame, days: tuple[int, ...] = PERIODS) -> DataFrame:
    """Views, visitors and paid amount per product over the last 1, 7, 15 and 30 days.

    One row per product and day with a view; visitors are distinct over the whole period.
    """
    views = logs.select("product_id", "user_id", _day_number("event_time").alias("day"))
    paid = order_lines(orders.where("status = 'PAID'"), details).groupBy("product_id", _day_number("order_time").alias("day")).agg(
        F.sum("amount").alias("pay"))
    daily = views.groupBy("product_id", "day").agg(F.count(F.lit(1)).alias("pv")).unionByName(paid, allowMissingColumns=True).groupBy(
        "product_id", "day").agg(F.sum("pv").alias("pv"), F.sum("pay").alias("pay"))
    sums = rolling_sums(daily, "product_id", "day", ["pv", "pay"], days)
    users = rolling_distinct(views, "product_id", "user_id", "day", days, "uv")
    seen = daily.where("pv is not null").select("product_id", "day")
    out = seen.join(sums, ["product_id", "day"]).join(users, ["product_id", "day"])
    return out.select(
        "product_id", F.date_format(F.date_from_unix_date(F.col("day").cast("int")), "yyyy-MM-dd").alias("stat_date"),
        *[F.col(f"pv_{n}d") for n in days], *[F.col(f"uv_{n}d") for n in days],
        *[money(F.coalesce(f"pay_{n}d", F.lit(0))).alias(f"pay_{n}d") for n in days])


def onward_items(ecommerce: DataFrame, k: int = 5) -> DataFrame:
    """To which products the visitors of a product move on next: users, moves and the best ``k``.

    Each event leads to one next product, so the work is linear in the events; pairs of all
    products of a user are never formed.
    """
    rows = ecommerce.select("user_id", "event_id", "product_id", millis("visit_time").alias("ms"))
    back = previous_row(rows, ["user_id"], "ms", "event_id", ["product_id"])
    moves = back.where(F.col("prev").isNotNull() & (F.col("prev.product_id") != F.col("product_id"))).select(
        F.col("prev.product_id").alias("item_a"), F.col("product_id").alias("item_b"), "user_id")
    counts = moves.groupBy("item_a", "item_b", "user_id").agg(F.count(F.lit(1)).alias("n")).groupBy("item_a", "item_b").agg(
        F.count(F.lit(1)).alias("users"), F.sum("n").alias("moves"))
    return top_n(counts, ["item_a"], "moves", "item_b", k).withColumnRenamed("rn", "rank")


def title_words(sku: DataFrame, ecommerce: DataFrame) -> DataFrame:
    """Visits, visitors and buyers brought by each word of the product titles."""
    words = sku.select(F.col("sku_id").alias("product_id"), F.explode(F.array_distinct(F.split(F.lower("sku_name"), r"\s+"))).alias("word"))
    per_user = ecommerce.where(F.col("action").isin("visit", "purchase")).groupBy("product_id", "user_id").agg(
        F.count_if(F.col("action") == "visit").alias("visits"), F.max(F.col("action") == "purchase").alias("bought"))
    per_word = per_user.join(words, "product_id").groupBy("word", "user_id").agg(F.sum("visits").alias("visits"), F.max("bought").alias("bought"))
    return per_word.groupBy("word").agg(
        F.sum("visits").alias("visits"), F.count_if(F.col("visits") > 0).alias("visitors"), F.count_if("bought").alias("buyers"),
    ).withColumn("conversion_rate", percent("buyers", "visitors"))


def content_top(ecommerce: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` most visited items (SKUs) of every product."""
    counts = ecommerce.groupBy("product_id", "sku_id").agg(
        F.count(F.lit(1)).alias("visits"), F.count_if(F.col("action") == "purchase").alias("purchases"))
    return top_n(counts, ["product_id"], "visits", "sku_id", n)


def crowd_portrait(ecommerce: DataFrame, users: DataFrame) -> DataFrame:
    """Size of the searching, visiting and paying crowds by gender and level."""
    flags = ecommerce.groupBy("user_id").agg(
        F.max(F.col("channel") == "search").alias("search"), F.max(F.col("action") == "visit").alias("visit"),
        F.max(F.col("action") == "purchase").alias("pay"))
    crowds = F.filter(F.array(*[F.when(F.col(c), F.lit(c)) for c in ("search", "visit", "pay")]), lambda c: c.isNotNull())
    people = flags.select(F.col("user_id").alias("uid"), F.explode(crowds).alias("crowd")).join(users, "uid")
    return people.groupBy("crowd", F.coalesce("gender", F.lit("home")).alias("gender"), "user_level").agg(F.count(F.lit(1)).alias("users"))


def attribute_sales(details: DataFrame, attribute: str = "sku_color") -> DataFrame:
    """Sales and rank of each value of one attribute inside its product (values are a closed set)."""
    sums = details.groupBy("product_id", F.col(attribute).alias("attribute")).agg(
        F.sum("qty").alias("sold"), money(F.sum("amount")).alias("amount"))
    best = Window.partitionBy("product_id").orderBy(F.desc("sold"), F.asc("attribute"))
    return sums.withColumn("rank", F.row_number().over(best).cast("long"))


def price_trend(orders: DataFrame, details: DataFrame, logs: DataFrame) -> DataFrame:
    """Average paid price per product and day, its change against the last paid day, and visits."""
    paid = order_lines(orders.where("status = 'PAID'"), details).groupBy("product_id", day_text("order_time").alias("stat_date")).agg(
        F.sum("amount").alias("amount"), F.sum("qty").alias("qty"))
    priced = paid.withColumn("avg_price", safe_ratio("amount", "qty", 4))
    before = F.lag("avg_price").over(Window.partitionBy("product_id").orderBy("stat_date"))
    visits = logs.groupBy("product_id", day_text("event_time").alias("stat_date")).agg(F.count(F.lit(1)).alias("visits"))
    return priced.withColumn("price_change", F.round(F.coalesce(F.col("avg_price") - before, F.lit(0.0)), 4)).join(
        visits, ["product_id", "stat_date"], "left").select(
        "product_id", "stat_date", "avg_price", "price_change", F.coalesce("visits", F.lit(0)).alias("visits"))
