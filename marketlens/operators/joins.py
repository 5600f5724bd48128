"""Joins: interval, lookup, routing, star and report joins, and payload policies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.calendar import day_text
from marketlens.functions.columns import row_key


def merge_columns(joined: DataFrame, left: list[str], right: list[str], policy: str = "right",
                  take: list[str] | None = None, prefix: str = "info_") -> DataFrame:
    """Choose the columns of two joined records aliased ``a`` and ``b``.

    ``right``: a right column replaces a left one of the same name. ``prefix``: all right
    columns are kept under a prefix. ``select``: only the named right columns are added.
    """
    if policy == "right":
        picked = [F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) if c in right else F.col(f"a.{c}") for c in left]
        picked += [F.col(f"b.{c}") for c in right if c not in left]
    elif policy == "prefix":
        picked = [F.col(f"a.{c}") for c in left] + [F.col(f"b.{c}").alias(prefix + c) for c in right]
    elif policy == "select":
        chosen = take or []
        picked = [F.col(f"a.{c}") for c in left if c not in chosen] + [F.col(f"b.{c}") for c in chosen]
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return joined.select(*picked)


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ms: str, right_ms: str,
                  before: int, after: int, policy: str = "right", take: list[str] | None = None) -> DataFrame:
    """Pairs of equal key with ``right_ms`` in ``[left_ms - before, left_ms + after]``.

    The key alone would make one task compare all rows of a hot key. Time is cut into
    slices as wide as the interval: a left row reaches into two slices at most, a right row
    lies in one, and the join key becomes (key, slice). No pair is met twice.
    """
    width = before + after
    a = left.withColumn("_slice", F.explode(F.sequence(
        F.floor((F.col(left_ms) - before) / width).cast("long"), F.floor((F.col(left_ms) + after) / width).cast("long"))))
    b = right.withColumn("_slice", F.floor(F.col(right_ms) / width).cast("long"))
    near = (
        (F.col(f"a.{left_key}") == F.col(f"b.{right_key}")) & (F.col("a._slice") == F.col("b._slice"))
        & F.col(f"b.{right_ms}").between(F.col(f"a.{left_ms}") - before, F.col(f"a.{left_ms}") + after)
    )
    return merge_columns(a.alias("a").join(b.alias("b"), near), left.columns, right.columns, policy, take)


def lookup(df: DataFrame, dim: DataFrame, on: str, dim_key: str, take: str, default: str = "N/A",
           out: str | None = None) -> DataFrame:
    """Name of a code, or ``default`` where the dictionary has none.

    A code listed twice has the smallest of its names. Spark broadcasts the dictionary when its
    size allows.
    """
    names = dim.groupBy(F.col(dim_key).alias("_code")).agg(F.min(take).alias("_name"))
    return df.join(names, df[on] == names["_code"], "left").withColumn(
        out or take, F.coalesce("_name", F.lit(default))).drop("_code", "_name")


def search_interest(df: DataFrame, categories: DataFrame, compare: DataFrame, item: str = "search_item") -> DataFrame:
    """Search word to top category to interest class; the smallest entry of a word wins."""
    words = categories.groupBy(F.col("category3_name").alias("_word")).agg(F.min("b1_name").alias("b1_category"))
    classes = compare.groupBy(F.col("category_name").alias("_class")).agg(
        F.min_by("search_category", "id").alias("search_category"))
    with_category = df.join(words, df[item] == words["_word"], "left").drop("_word")
    return with_category.join(classes, F.col("b1_category") == F.col("_class"), "left").drop("_class").withColumn(
        "search_category", F.coalesce("search_category", F.lit("unknown")))


def sku_dimension(sku: DataFrame, c3: DataFrame, c2: DataFrame, c1: DataFrame) -> DataFrame:
    """Product with brand and all category levels; products without a category stay."""
    return sku.join(c3, "category3_id", "left").join(c2, "category2_id", "left").join(c1, "category1_id", "left")


def category_tree(c3: DataFrame, c2: DataFrame, c1: DataFrame) -> DataFrame:
    """Category levels 3, 2 and 1 in one row; incomplete branches are left out."""
    return c3.join(c2, "category2_id").join(c1, "category1_id")


def order_lines(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Order lines with the buyer, times and status of their order."""
    head = orders.selectExpr("id as order_id", "user_id", "shop_no", "order_time", "pay_time", "status")
    return details.drop("shop_no", "create_time").join(head, "order_id")


def visit_to_purchase(events: DataFrame) -> DataFrame:
    """User and product pairs that were visited, with the flag whether they were bought.

    Both sides come from one table with the same two keys, so one grouping replaces the join.
    """
    return events.where(F.col("action").isin("visit", "purchase")).groupBy("product_id", "user_id").agg(
        F.count_if(F.col("action") == "visit").alias("visits"),
        F.count_if(F.col("action") == "purchase").alias("purchases"),
    ).where("visits > 0").withColumn("purchased", F.when(F.col("purchases") > 0, 1).otherwise(0).cast("long"))


def full_join_metrics(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of metric sets that are unique by key, missing numbers as zero.

    Instead of one shuffle per join the sets are stacked and grouped once.
    """
    names = [c for f in frames for c in f.columns if c not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.groupBy(*keys).agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in names])


def join_agg(base: DataFrame, parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Left join of aggregates that share the keys of the base; they also share its shuffle."""
    return reduce(lambda a, b: a.join(b, keys, "left"), parts, base)


def join_on_day(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str) -> DataFrame:
    """Left join on the key and the calendar day of both times."""
    a = left.withColumn("stat_date", day_text(left_ts))
    b = right.withColumn("stat_date", day_text(right_ts)).drop(right_ts)
    return a.join(b, [key, "stat_date"], "left")


def with_scalar(df: DataFrame, single: DataFrame, out: str) -> DataFrame:
    """Add the only value of a one-row frame as a column (an uncorrelated sub-query)."""
    return df.withColumn(out, single.scalar())


def join_windows(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, ["window_start", "window_end"], "left")


def join_reports(conversion: DataFrame, interaction: DataFrame, lines: DataFrame) -> DataFrame:
    """Conversion report with the interaction report and the order lines of each product."""
    seen = interaction.select("sku_id", F.col("favor_buyer_num").alias("inter_favor_num"),
                              F.col("cart_buyer_num").alias("inter_cart_num"))
    return conversion.join(seen, "sku_id", "left").join(
        lines.select(F.col("product_id").alias("sku_id"), F.col("id").alias("detail_id"), F.col("qty").alias("line_qty")),
        "sku_id", "left")


def current_routes(config: DataFrame) -> DataFrame:
    """Latest entry per source table; a deleted entry routes nothing."""
    return config.groupBy("source_table").agg(
        F.max_by(F.struct("sink_table", "sink_row_key", "op"), "ts_ms").alias("r")
    ).where("not (r.op <=> 'd')").select("source_table", "r.sink_table", "r.sink_row_key")


def route_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Target table, md5 row key and payload of every routed, not deleted change."""
    live = changes.where("not (op <=> 'd') and after is not null")
    routed = live.join(current_routes(config), live["table"] == F.col("source_table"))
    key = F.expr("get_json_object(after, concat('$.', sink_row_key))")
    return routed.select("sink_table", row_key(key).alias("row_key"), F.col("after").alias("payload"), "ts_ms")


def word_flag(df: DataFrame, words: DataFrame, col: Column, how: str = "flag") -> DataFrame:
    """Is the value one of the listed words: as a 0/1 flag, or keep / drop the matching rows."""
    listed = words.select(F.col(words.columns[0]).alias("_word")).distinct()
    keyed = df.withColumn("_value", col)
    if how == "flag":
        return keyed.join(listed, F.col("_value") == F.col("_word"), "left").withColumn(
            "is_violation", F.when(F.col("_word").isNotNull(), 1).otherwise(0).cast("long")).drop("_word", "_value")
    kind = {"semi": "left_semi", "anti": "left_anti"}[how]
    return keyed.join(listed, F.col("_value") == F.col("_word"), kind).drop("_value")
