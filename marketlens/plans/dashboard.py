"""Product dashboard: event-table reports and the hourly product result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.calendar import hour_key
from marketlens.functions.columns import money, percent, price_band, safe_ratio
from marketlens.operators.joins import full_join_metrics, order_lines

HOUR_KEYS = ["shop_no", "product_id", "stat_hour"]


def product_visits(ecommerce: DataFrame) -> DataFrame:
    """Visitors, page views, cart adds and cart users per product, from one row per user."""
    per_user = ecommerce.groupBy("product_id", "user_id").agg(
        F.count_if(F.col("action") == "visit").alias("views"),
        F.count_if(F.col("action") == "add_to_cart").alias("adds"))
    return per_user.groupBy("product_id").agg(
        F.count("user_id").alias("visitor_count"), F.sum("views").alias("page_views"),
        F.sum("adds").alias("add_to_cart_count"), F.count_if(F.col("adds") > 0).alias("add_to_cart_users"))


def purchase_conversion(ecommerce: DataFrame) -> DataFrame:
    """Share of a product's visitors who bought it."""
    bought = ecommerce.where(F.col("action").isin("visit", "purchase")).groupBy("product_id", "user_id").agg(
        F.max(F.col("action") == "visit").alias("visited"), F.max(F.col("action") == "purchase").alias("bought"))
    counts = bought.where("visited").groupBy("product_id").agg(
        F.count("user_id").alias("visitors"), F.count_if("bought").alias("purchasers"))
    return counts.withColumn("conversion_rate", percent("purchasers", "visitors"))


def price_band_sales(ecommerce: DataFrame, bands: str = "ten") -> DataFrame:
    return ecommerce.where("action = 'purchase'").groupBy(price_band("price", bands).alias("price_band")).agg(
        F.count(F.lit(1)).alias("purchase_count"), money(F.sum("price")).alias("total_revenue"))


def channel_conversion(ecommerce: DataFrame) -> DataFrame:
    return ecommerce.groupBy("channel").agg(
        F.count(F.lit(1)).alias("total_visits"), F.count_if(F.col("action") == "purchase").alias("total_purchases"),
    ).withColumn("conversion_rate", percent("total_purchases", "total_visits"))


def channel_share(ecommerce: DataFrame) -> DataFrame:
    """Visitors per traffic source, their share of all, and conversion by people."""
    people = ecommerce.groupBy("channel", "user_id").agg(F.max(F.col("action") == "purchase").alias("bought"))
    per_channel = people.groupBy("channel").agg(
        F.count("user_id").alias("visitors"), F.count_if("bought").alias("buyers"))
    total = per_channel.select(F.sum("visitors")).scalar()
    return per_channel.select("channel", "visitors", "buyers", safe_ratio("visitors", total, 6).alias("share"),
                              percent("buyers", "visitors").alias("conversion_rate"))


def rating_histogram(ecommerce: DataFrame) -> DataFrame:
    return ecommerce.groupBy("product_id", "rating").agg(F.count(F.lit(1)).alias("rating_count"))


def hourly_page_metrics(logs: DataFrame) -> DataFrame:
    per_user = logs.groupBy("shop_no", "product_id", hour_key("event_time").alias("stat_hour"), "user_id").agg(
        F.count(F.lit(1)).alias("views"), F.sum("duration_seconds").alias("stay"), F.sum("is_bounce").alias("bounces"))
    return per_user.groupBy(*HOUR_KEYS).agg(
        F.sum("views").alias("product_pv"), F.count("user_id").alias("product_uv"),
        safe_ratio(F.sum("stay"), F.sum("views"), 6, 0).alias("avg_duration"),
        safe_ratio(F.sum("bounces"), F.sum("views"), 6, 0).alias("bounce_rate"))


def hourly_favourites(favourites: DataFrame) -> DataFrame:
    return favourites.groupBy("shop_no", "product_id", hour_key("favor_time").alias("stat_hour")).agg(
        F.count_distinct("user_id").alias("fav_users"))


def hourly_cart(cart: DataFrame) -> DataFrame:
    return cart.groupBy("shop_no", "product_id", hour_key("add_time").alias("stat_hour")).agg(
        F.sum("qty").alias("cart_qty"), F.count_distinct("user_id").alias("cart_users"))


def _hourly_lines(lines: DataFrame, time: str, prefix: str, counts: str) -> DataFrame:
    per_user = lines.groupBy("shop_no", "product_id", hour_key(time).alias("stat_hour"), "user_id").agg(
        F.sum("qty").alias("qty"), F.sum("amount").alias("amount"), F.max(F.expr(counts)).alias("counted"))
    return per_user.groupBy(*HOUR_KEYS).agg(
        F.count_if("counted").alias(f"{prefix}_users"), F.sum("qty").alias(f"{prefix}_qty"),
        money(F.sum("amount")).alias(f"{prefix}_amount"))


def hourly_orders(orders: DataFrame, details: DataFrame) -> DataFrame:
    """All ordered lines count in quantity and amount; buyers only of created or paid orders."""
    return _hourly_lines(order_lines(orders, details), "order_time", "order", "status in ('CREATED', 'PAID')")


def hourly_payments(orders: DataFrame, details: DataFrame) -> DataFrame:
    paid = orders.where("status = 'PAID' and pay_time is not null")
    return _hourly_lines(order_lines(paid, details), "pay_time", "pay", "true")


def hourly_product_result(logs: DataFrame, favourites: DataFrame, cart: DataFrame, orders: DataFrame,
                          details: DataFrame, dt: str) -> DataFrame:
    """The 21-column result per shop, product and hour of every metric set that has a row."""
    sets = [hourly_page_metrics(logs), hourly_favourites(favourites), hourly_cart(cart),
            hourly_orders(orders, details), hourly_payments(orders, details)]
    joined = full_join_metrics(sets, HOUR_KEYS)

    def per_visitor(users):
        return safe_ratio(users, "product_uv", 6, 0)

    return joined.select(
        F.lit(dt).alias("dt"), "shop_no", "stat_hour", "product_id", "product_pv", "product_uv", "avg_duration",
        "bounce_rate", "fav_users", "cart_qty", "cart_users", per_visitor("fav_users").alias("visit_to_fav_rate"),
        per_visitor("cart_users").alias("visit_to_cart_rate"), "order_users", "order_qty", "order_amount",
        per_visitor("order_users").alias("order_rate"), "pay_users", "pay_qty", "pay_amount",
        per_visitor("pay_users").alias("pay_rate"))


def pay_price_buckets(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Paid quantity and amount per product, hour and band of the average unit price."""
    pay = hourly_payments(orders, details)
    unit = F.try_divide("pay_amount", "pay_qty")
    return pay.groupBy(*HOUR_KEYS, price_band(unit, "half_open").alias("price_bucket")).agg(
        F.sum("pay_qty").alias("bucket_pay_qty"), F.sum("pay_amount").alias("bucket_pay_amount"))


def top_products_by_views(logs: DataFrame, n: int = 20) -> DataFrame:
    """Most viewed products; the limit keeps ``n`` rows per task before they meet."""
    return logs.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("pv"), F.count_distinct("user_id").alias("uv")
    ).orderBy(F.desc("pv"), "product_id").limit(n)
