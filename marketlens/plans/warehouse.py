"""Layered warehouse: detail facts, daily summaries and product reports.

Facts are brought to one row per (group, user) or per group before they meet, so no join
multiplies rows and a heavy group reaches a task only as a few partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.calendar import day_text, second_text
from marketlens.functions.columns import money, price_band, safe_ratio
from marketlens.operators.joins import full_join_metrics, join_agg, order_lines
from marketlens.operators.ordered import running_total
from marketlens.operators.skew import chunk_of

def one() -> Column:
    return F.lit(1)


# ---- detail layer --------------------------------------------------------------------
def behaviour_union(cart: DataFrame, favourites: DataFrame, comments: DataFrame) -> DataFrame:
    """Cart, favourite and comment facts in one table; columns a fact lacks are typed nulls."""
    a = cart.selectExpr(
        "user_id", "product_id as sku_id", "'cart' as behavior_type", "add_time as behavior_time",
        "cast(cart_price as decimal(10,2)) as order_price", "cast(qty as int) as sku_num",
        "cast(cart_price * qty as decimal(16,2)) as total_amount", "cast(qty as int) as cart_num")
    b = favourites.selectExpr("user_id", "product_id as sku_id", "'favor' as behavior_type",
                              "favor_time as behavior_time", "'0' as is_cancel")
    c = comments.selectExpr("user_id", "sku_id", "'comment' as behavior_type", "create_time as behavior_time",
                            "order_id", "appraise", "comment_txt")
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


def trade_detail(orders: DataFrame, details: DataFrame, sku: DataFrame, codes: DataFrame) -> DataFrame:
    """Order lines with product, brand, category and status name; payment time, or else order time."""
    lines = order_lines(orders, details)
    products = sku.selectExpr("sku_id", "sku_name", "tm_id", "tm_name", "category3_id")
    return lines.withColumnRenamed("product_id", "sku_id").join(products, "sku_id", "left").join(
        codes.selectExpr("dic_code as status", "dic_name as order_status_name"), "status", "left",
    ).selectExpr(
        "order_id", "user_id", "sku_id", "sku_name", "cast(unit_price as decimal(10,2)) as order_price",
        "cast(qty as int) as sku_num", "cast(amount as decimal(16,2)) as total_amount",
        "cast(0 as decimal(16,2)) as coupon_amount", "status as order_status",
        "coalesce(order_status_name, 'N/A') as order_status_name", "category3_id", "tm_id", "tm_name",
        "coalesce(pay_time, order_time) as payment_time")


# ---- wide summary --------------------------------------------------------------------
def _page_sets(logs: DataFrame) -> DataFrame:
    """Views, visitors, stay and bounces per day, shop and product, from one row per user."""
    stay = F.unix_seconds(F.max("event_time").cast("timestamp")) - F.unix_seconds(F.min("event_time").cast("timestamp"))
    per_user = logs.groupBy(day_text("event_time").alias("ds"), F.col("shop_no").alias("store_no"), "product_id", "user_id").agg(
        F.count(one()).alias("visits"), stay.alias("stay"))
    return per_user.groupBy("ds", "store_no", "product_id").agg(
        F.count("user_id").alias("uv"), F.sum("visits").alias("pv_cnt"),
        safe_ratio(F.sum("stay"), F.count("user_id"), 4).alias("avg_stay_seconds"),
        safe_ratio(F.count_if(F.col("visits") == 1), F.count("user_id"), 4).alias("detail_page_bounce_rate"))


def _favour_sets(favourites: DataFrame, keys: list[str]) -> DataFrame:
    return favourites.select("*", day_text("favor_time").alias("day"), F.col("shop_no").alias("store_no")).drop("ds").withColumnRenamed(
        "day", "ds").groupBy(*keys).agg(F.count(one()).alias("favor_rows"), F.count_distinct("user_id").alias("favor_user_cnt"))


def _cart_sets(cart: DataFrame) -> DataFrame:
    return cart.groupBy(day_text("add_time").alias("ds"), F.col("shop_no").alias("store_no"), "product_id").agg(
        F.count(one()).alias("cart_rows"), F.count_distinct("user_id").alias("cart_user_cnt"), F.sum("qty").alias("cart_quantity"))


def _pay_sets(orders: DataFrame, details: DataFrame) -> DataFrame:
    lines = order_lines(orders.where("status = 'PAID'"), details)
    return lines.groupBy(day_text("order_time").alias("ds"), F.col("shop_no").alias("store_no"), "product_id").agg(
        F.count(one()).alias("pay_rows"), F.count_distinct("user_id").alias("pay_user_cnt"),
        F.sum("qty").alias("pay_quantity"), F.sum(F.col("unit_price") * F.col("qty")).alias("pay_amount"))


WIDE_KEYS = ["ds", "store_no", "product_id"]
WIDE_COLUMNS = ["uv", "pv_cnt", "favor_user_cnt", "cart_user_cnt", "cart_quantity", "pay_user_cnt", "pay_quantity", "pay_amount"]


def product_wide(logs: DataFrame, favourites: DataFrame, cart: DataFrame, orders: DataFrame, details: DataFrame,
                 mode: str = "pre_agg") -> DataFrame:
    """Daily wide summary per shop and product.

    ``pre_agg``: each fact on its own, every product with any fact. ``joined``: the numbers
    a row-by-row left join of the four facts gives, where counts and sums of one fact are
    multiplied by the row counts of the others. They follow from the per-fact counts, so the
    multiplied rows are never made.
    """
    pages = _page_sets(logs).select(*WIDE_KEYS, "uv", "pv_cnt")
    carts, pays = _cart_sets(cart), _pay_sets(orders, details)
    if mode == "pre_agg":
        sets = [pages, _favour_sets(favourites, WIDE_KEYS).drop("favor_rows"), carts.drop("cart_rows"), pays.drop("pay_rows")]
        return full_join_metrics(sets, WIDE_KEYS).withColumn("pay_amount", money("pay_amount")).select(*WIDE_KEYS, *WIDE_COLUMNS)
    favours = _favour_sets(favourites, ["ds", "product_id"])
    joined = pages.join(carts, WIDE_KEYS, "left").join(pays, WIDE_KEYS, "left").join(favours, ["ds", "product_id"], "left")
    rows = {n: F.coalesce(F.col(n), one()) for n in ("favor_rows", "cart_rows", "pay_rows")}
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return joined.select(
        *WIDE_KEYS, "uv", (F.col("pv_cnt") * rows["favor_rows"] * rows["cart_rows"] * rows["pay_rows"]).alias("pv_cnt"),
        zero("favor_user_cnt").alias("favor_user_cnt"), zero("cart_user_cnt").alias("cart_user_cnt"),
        zero("cart_quantity").__mul__(F.col("pv_cnt") * rows["favor_rows"] * rows["pay_rows"]).alias("cart_quantity"),
        zero("pay_user_cnt").alias("pay_user_cnt"),
        zero("pay_quantity").__mul__(F.col("pv_cnt") * rows["favor_rows"] * rows["cart_rows"]).alias("pay_quantity"),
        money(zero("pay_amount") * F.col("pv_cnt") * rows["favor_rows"] * rows["cart_rows"]).alias("pay_amount"))


def product_full_metrics(logs: DataFrame, favourites: DataFrame, cart: DataFrame, orders: DataFrame, details: DataFrame) -> DataFrame:
    """21-column product report with one row per price range that was paid for."""
    lines = order_lines(orders.where("status = 'PAID'"), details).select(
        day_text("order_time").alias("ds"), F.col("shop_no").alias("store_no"), "product_id", "qty",
        (F.col("unit_price") * F.col("qty")).alias("paid"))
    ranges = lines.groupBy(*WIDE_KEYS, price_band("paid", "closed").alias("price_range")).agg(
        F.sum("qty").alias("price_range_pay_quantity"), money(F.sum("paid")).alias("price_range_pay_amount"))
    base = join_agg(_page_sets(logs), [
        _favour_sets(favourites, WIDE_KEYS), _cart_sets(cart), _pay_sets(orders, details), ranges], WIDE_KEYS)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return base.select(
        *WIDE_KEYS, F.col("uv").alias("sku_uv"), F.col("pv_cnt").alias("sku_pv"), F.lit(1).cast("long").alias("active_product_cnt"),
        "avg_stay_seconds", "detail_page_bounce_rate", zero("favor_user_cnt").alias("favor_user_cnt"),
        zero("cart_user_cnt").alias("cart_user_cnt"), zero("cart_quantity").alias("cart_quantity"),
        safe_ratio(zero("cart_user_cnt"), "uv", 4).alias("cart_conversion_rate"),
        safe_ratio(zero("favor_user_cnt"), "uv", 4).alias("favor_conversion_rate"),
        zero("pay_user_cnt").alias("pay_user_cnt"), zero("pay_quantity").alias("pay_quantity"),
        money(zero("pay_amount")).alias("pay_amount"),
        F.when(F.col("pay_rows").isNotNull(), 1).otherwise(0).cast("long").alias("pay_product_cnt"),
        safe_ratio(zero("pay_user_cnt"), "uv", 4).alias("pay_conversion_rate"),
        F.coalesce("price_range", F.lit("")).alias("price_range"),
        zero("price_range_pay_quantity").alias("price_range_pay_quantity"),
        zero("price_range_pay_amount").cast("double").alias("price_range_pay_amount"))


# ---- daily summaries -----------------------------------------------------------------
def price_of(amount: str, n: str) -> Column:
    """Amount by number, exactly rounded to cents; 0 without a number."""
    exact = F.try_divide(F.col(amount).cast("decimal(16,2)"), F.col(n).cast("decimal(12,0)"))
    return F.coalesce(F.round(exact, 2), F.lit(0)).cast("double")


def _users_who(kind: str) -> Column:
    return F.count_if(F.col(f"{kind}_n") > 0)


def _behaviour_per_user(behaviour: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group and user with counts per kind of behaviour."""
    kind = F.col("behavior_type")
    return behaviour.withColumn("stat_date", day_text("behavior_time")).groupBy(*keys, "user_id").agg(
        F.count(one()).alias("rows_n"), F.count_if(kind == "favor").alias("favor_n"), F.count_if(kind == "cart").alias("cart_n"),
        F.count_if(kind == "order").alias("order_n"), F.sum(F.when(kind == "cart", F.col("cart_num"))).alias("cart_num"),
        F.sum(F.when(kind == "order", F.col("sku_num"))).alias("order_num"),
        F.sum(F.when(kind == "order", F.col("total_amount"))).alias("order_amount"),
        F.max("behavior_time").alias("last_time"))


def sku_daily(behaviour: DataFrame, trade: DataFrame, sku: DataFrame, categories: DataFrame) -> DataFrame:
    """Product summary per day: interaction, orders, payments, conversion and value."""
    keys = ["stat_date", "sku_id"]
    seen = _behaviour_per_user(behaviour, keys).groupBy(*keys).agg(
        F.count("user_id").alias("visitor_count"), F.sum("rows_n").alias("page_view_count"),
        _users_who("favor").alias("favor_count"), F.coalesce(F.sum("cart_num"), F.lit(0)).alias("cart_count"),
        _users_who("cart").alias("cart_user_count"), _users_who("order").alias("order_user_count"),
        F.coalesce(F.sum("order_num"), F.lit(0)).alias("order_sku_count"),
        F.coalesce(F.sum("order_amount"), F.lit(0)).alias("order_amount"))
    paid = trade.withColumn("stat_date", day_text("payment_time")).groupBy(*keys).agg(
        F.count_distinct("user_id").alias("payment_user_count"), F.sum("sku_num").alias("payment_sku_count"),
        F.sum("total_amount").alias("payment_amount"))
    names = sku.select("sku_id", "sku_name", "category3_id", "tm_id", "tm_name").join(
        categories.select("category3_id", "category3_name"), "category3_id", "left")
    both = seen.join(paid, keys, "left").fillna(0, ["payment_user_count", "payment_sku_count"]).withColumn(
        "payment_amount", F.coalesce("payment_amount", F.lit(0)))
    rate = lambda users: safe_ratio(users, "visitor_count", 4)
    return both.join(names, "sku_id", "left").select(
        "stat_date", "sku_id", "sku_name", "category3_id", "category3_name", "tm_id", "tm_name", "visitor_count", "page_view_count",
        "favor_count", "cart_count", "cart_user_count", "order_user_count", "order_sku_count",
        money("order_amount").alias("order_amount"), "payment_user_count", "payment_sku_count",
        money("payment_amount").alias("payment_amount"), rate("favor_count").alias("visitor_to_favor_rate"),
        rate("cart_user_count").alias("visitor_to_cart_rate"), rate("order_user_count").alias("visitor_to_order_rate"),
        rate("payment_user_count").alias("visitor_to_payment_rate"),
        price_of("payment_amount", "payment_user_count").alias("avg_order_price"),
        price_of("payment_amount", "visitor_count").alias("visitor_avg_value"))


def _roll_up(daily: DataFrame, keys: list[str]) -> DataFrame:
    # Products are unique per day in the daily table, so distinct products are plain counts.
    return daily.groupBy(*keys).agg(
        F.sum("visitor_count").alias("visitor_count"), F.count(one()).alias("sku_with_visitor_count"),
        F.sum("payment_user_count").alias("payment_user_count"), F.sum("payment_sku_count").alias("payment_sku_count"),
        F.sum(F.col("payment_amount").cast("decimal(16,2)")).alias("payment_amount"),
        F.count_if(F.col("payment_user_count") > 0).alias("sku_with_payment_count"),
    ).withColumns({
        "payment_conversion_rate": safe_ratio("payment_user_count", "visitor_count", 4),
        "avg_order_price": price_of("payment_amount", "payment_user_count"), "payment_amount": money("payment_amount")})


def category_daily(daily: DataFrame, tree: DataFrame) -> DataFrame:
    levels = tree.select("category3_id", "category3_name", "category2_id", "category2_name", "category1_id", "category1_name")
    return _roll_up(daily, ["stat_date", "category3_id"]).join(levels, "category3_id", "left")


def brand_daily(daily: DataFrame) -> DataFrame:
    return _roll_up(daily, ["stat_date", "tm_id", "tm_name"])


def user_daily(behaviour: DataFrame, trade: DataFrame) -> DataFrame:
    """Behaviour and payments per user and day with the last time seen."""
    keys = ["stat_date", "user_id"]
    acts = _behaviour_per_user(behaviour, ["stat_date"])
    paid = trade.withColumn("stat_date", day_text("payment_time")).groupBy(*keys).agg(
        F.count_distinct("order_id").alias("payment_count"), F.sum("total_amount").alias("total_payment_amount"))
    return acts.join(paid, keys, "left").select(
        "stat_date", "user_id", F.col("rows_n").alias("page_view_count"), F.col("favor_n").alias("favor_count"),
        F.col("cart_n").alias("cart_count"), F.col("order_n").alias("order_count"),
        F.coalesce("payment_count", F.lit(0)).alias("payment_count"),
        money(F.coalesce("order_amount", F.lit(0))).alias("total_order_amount"),
        money(F.coalesce("total_payment_amount", F.lit(0))).alias("total_payment_amount"),
        F.lit(1).cast("long").alias("active_days"), second_text("last_time").alias("last_behavior_time"))


# ---- product reports -----------------------------------------------------------------
def sku_traffic(sku: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Traffic per product; a product nobody touched keeps one page view, as a left join counts it."""
    per_user = _behaviour_per_user(behaviour, ["sku_id"])
    seen = per_user.groupBy("sku_id").agg(
        F.count("user_id").alias("sku_uv"), F.sum("rows_n").alias("pv"),
        F.count_if((F.col("favor_n") > 0) | (F.col("cart_n") > 0)).alias("sku_micro_uv"),
        F.count_if(F.col("rows_n") == 1).alias("single_users"), F.sum("cart_num").alias("clicks"))
    everyone = behaviour.select(F.count_distinct("user_id").alias("n"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return sku.join(seen, "sku_id", "left").select(
        "sku_id", "sku_name", F.col("shop_no").alias("shop_id"), "tm_name", "category3_id",
        everyone.scalar().alias("total_uv"), zero("sku_uv").alias("sku_uv"), F.coalesce("pv", one()).cast("long").alias("sku_pv"),
        zero("sku_micro_uv").alias("sku_micro_uv"),
        safe_ratio(F.col("pv") * 30, "sku_uv", 2, 0).alias("avg_stay_time"),
        safe_ratio("single_users", "sku_uv", 4, 0).alias("sku_jump_rate"), zero("clicks").alias("sku_click_cnt"))


def sku_conversion(sku: DataFrame, behaviour: DataFrame, trade: DataFrame) -> DataFrame:
    per_user = _behaviour_per_user(behaviour, ["sku_id"])
    seen = per_user.groupBy("sku_id").agg(
        F.count("user_id").alias("visitors"), F.sum("cart_num").alias("cart_num"),
        _users_who("cart").alias("cart_buyer_num"), _users_who("favor").alias("favor_buyer_num"))
    paid = trade.groupBy("sku_id").agg(
        F.count_distinct("user_id").alias("pay_buyer_num"), F.sum("sku_num").alias("pay_num"), F.sum("total_amount").alias("pay_amt"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return join_agg(sku, [seen, paid], ["sku_id"]).select(
        "sku_id", "sku_name", F.col("shop_no").alias("shop_id"), "category3_id",
        safe_ratio(zero("pay_buyer_num"), "visitors", 4, 0).alias("pay_conversion_rate"),
        money(zero("pay_amt")).alias("pay_amt"), zero("pay_num").alias("pay_num"), zero("pay_buyer_num").alias("pay_buyer_num"),
        zero("cart_num").alias("cart_num"), zero("cart_buyer_num").alias("cart_buyer_num"), zero("favor_buyer_num").alias("favor_buyer_num"))


def sku_interaction(sku: DataFrame, behaviour: DataFrame) -> DataFrame:
    acts = _behaviour_per_user(behaviour.where(F.col("behavior_type").isin("favor", "cart")), ["sku_id"]).groupBy("sku_id").agg(
        _users_who("favor").alias("favor_buyer_num"), _users_who("cart").alias("cart_buyer_num"))
    return sku.join(acts, "sku_id", "left").select(
        "sku_id", "sku_name", F.col("shop_no").alias("shop_id"), "tm_name",
        F.coalesce("favor_buyer_num", F.lit(0)).alias("favor_buyer_num"), F.coalesce("cart_buyer_num", F.lit(0)).alias("cart_buyer_num"))


def sku_customers(behaviour: DataFrame, users: DataFrame) -> DataFrame:
    """Visitors per product and day: new (first seen that day) and old users, gender shares."""
    visits = behaviour.select(day_text("behavior_time").alias("stat_date"), "sku_id", "user_id").distinct()
    first = behaviour.groupBy("user_id").agg(day_text(F.min("behavior_time")).alias("first_date"))
    people = users.selectExpr("uid as user_id", "gender")
    known = visits.join(first, "user_id").join(people, "user_id", "left")
    return known.groupBy("stat_date", "sku_id").agg(
        F.count("user_id").alias("total_visitor_num"), F.count_if(F.col("first_date") == F.col("stat_date")).alias("new_user_num"),
        F.count_if(F.col("gender") == "M").alias("_m"), F.count_if(F.col("gender") == "F").alias("_f"),
    ).select(
        "stat_date", "sku_id", "total_visitor_num", "new_user_num", (F.col("total_visitor_num") - F.col("new_user_num")).alias("old_user_num"),
        safe_ratio("new_user_num", "total_visitor_num", 4).alias("new_old_ratio"),
        safe_ratio("_m", "total_visitor_num", 4).alias("male_ratio"), safe_ratio("_f", "total_visitor_num", 4).alias("female_ratio"))


def sku_comments(sku: DataFrame, comments: DataFrame) -> DataFrame:
    """Comment counts, score (good 5, middle 3, bad 1) and good rate per product."""
    unique = comments.groupBy("sku_id", "id").agg(F.max("appraise").alias("appraise"))
    counts = unique.groupBy("sku_id").agg(
        F.count(one()).alias("n"), *[F.count_if(F.col("appraise") == code).alias(name) for code, name in (("1", "good"), ("2", "mid"), ("3", "bad"))])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return sku.join(counts, "sku_id", "left").select(
        "sku_id", "sku_name", F.col("shop_no").alias("shop_id"), "tm_name", zero("n").alias("total_comment_num"),
        zero("good").alias("good_comment_num"), zero("mid").alias("mid_comment_num"), zero("bad").alias("bad_comment_num"),
        safe_ratio(F.col("good") * 5 + F.col("mid") * 3 + F.col("bad"), "n", 2, 0).alias("avg_score"),
        safe_ratio("good", "n", 4, 0).alias("good_comment_rate"))


def shop_bucket(df: DataFrame, key: str, order: str, n: int = 10, prefix: str = "SHOP_", width: int = 1_000_000) -> DataFrame:
    """Shop label from the row number inside each key (the numbering starts again per key).

    Rows are numbered by ``order``, a number that is unique within a key, in slices of ``width``.
    """
    placed = running_total(df, [key], [order], {"_place": F.lit(1).cast("long")}, chunk_of(F.col(order), width))
    return placed.withColumn("shop_id", F.concat(F.lit(prefix), (F.col("_place") % n + 1).cast("string"))).drop("_place")


def count_audit(frames: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables, one row each."""
    counts = [f.agg(F.count(one()).alias("row_count")).select(F.lit(name).alias("tbl"), "row_count") for name, f in frames.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out


def partition_audit(df: DataFrame, partition: str) -> DataFrame:
    return df.groupBy(F.col(partition).cast("string").alias("ds")).agg(F.count(one()).alias("row_count"))
