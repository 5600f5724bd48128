"""Order-stream sales over tumbling and cumulating windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.calendar import DAY_MS, millis, ms_day
from marketlens.functions.columns import clean_id, money, safe_number
from marketlens.operators.joins import join_windows
from marketlens.operators.ordered import ordered_list, rank_pivot, running_total, top_n
from marketlens.operators.skew import chunk_of
from marketlens.operators.windows import cumulate, cumulate_top, tumble, window_text

TEN_SECONDS, FIVE_MINUTES, TEN_MINUTES = 10_000, 300_000, 600_000


def sale_rows(sales: DataFrame) -> DataFrame:
    """Readable sales: numbers parsed from text, empty or unreadable amounts left out."""
    return sales.select(
        "id", clean_id(F.col("product_id").cast("string")).cast("long").alias("product_id"), "user_id", millis("event_time").alias("ms"),
        safe_number("total_amount").alias("amount"), safe_number("sale_num", "int").alias("num"),
    ).where("amount is not null")


def window_totals(sales: DataFrame, size: int = TEN_MINUTES) -> DataFrame:
    """Sales and distinct orders per tumbling window."""
    return window_text(tumble(sale_rows(sales), "ms", size, [], [
        money(F.sum("amount")).alias("window_sales"), F.count_distinct("id").alias("order_count")]))


def _window_top(sales: DataFrame, item: str, n: int, size: int) -> DataFrame:
    rows = sale_rows(sales).where("num is not null and id is not null")
    sold = tumble(rows, "ms", size, [item], [F.sum("num").alias("sold")])
    return top_n(sold, ["window_start", "window_end"], "sold", item, n)


def window_top(sales: DataFrame, item: str = "product_id", n: int = 5, size: int = FIVE_MINUTES) -> DataFrame:
    """The best sold items of each tumbling window, one row per rank."""
    return window_text(_window_top(sales, item, n, size))


def window_top_ids(sales: DataFrame, item: str = "id", n: int = 5, size: int = FIVE_MINUTES) -> DataFrame:
    """The best sold items of each tumbling window in one comma text."""
    return window_text(rank_pivot(_window_top(sales, item, n, size), ["window_start", "window_end"], item, n, "top5_ids"))


def cumulative_sales(sales: DataFrame, step: int = TEN_SECONDS) -> DataFrame:
    """Sales from midnight to the end of every step."""
    grown = cumulate(sale_rows(sales), "ms", step, {"total": F.col("amount")})
    return window_text(grown).select("window_start", "window_end", money("total").alias("total_cumulative_amount"))


def cumulative_measures(sales: DataFrame, step: int = TEN_MINUTES) -> DataFrame:
    """Sales, orders and distinct buyers from midnight to the end of every step."""
    rows = sale_rows(sales).withColumn("one", F.lit(1).cast("long"))
    grown = cumulate(rows, "ms", step, {"gmv": F.col("amount"), "orders": F.col("one")}, distinct={"buyers": "user_id"})
    return window_text(grown).select("window_start", "window_end", money("gmv").alias("gmv"), "orders", "buyers")


def cumulative_by_product(sales: DataFrame, step: int = TEN_MINUTES) -> DataFrame:
    grown = cumulate(sale_rows(sales), "ms", step, {"gmv": F.col("amount")}, keys=["product_id"])
    return window_text(grown).select("window_start", "window_end", "product_id", money("gmv").alias("gmv"))


def cumulative_report(sales: DataFrame, step: int = TEN_MINUTES, n: int = 5) -> DataFrame:
    """Per cumulating window: all sales, and the best products with their amounts."""
    rows = sale_rows(sales)
    total = cumulate(rows, "ms", step, {"win": F.col("amount")})
    best = cumulate_top(rows, "ms", step, "product_id", F.col("amount"), n).groupBy("window_start", "window_end").agg(
        money(F.sum("amount")).alias("top5_gmv"),
        F.expr("listagg(cast(product_id as string), ',') within group (order by rn)").alias("top5_product_ids"))
    joined = join_windows(total, best)
    return window_text(joined.withColumn("ds", ms_day("window_start"))).select(
        "ds", "window_start", "window_end", money("win").alias("win_gmv"), "top5_gmv", "top5_product_ids")


def cumulative_top_sold(sales: DataFrame, step: int = TEN_MINUTES, n: int = 5) -> DataFrame:
    """Best products by pieces in every cumulating window, as ``id(pieces)``."""
    rows = sale_rows(sales).where("num is not null")
    best = cumulate_top(rows, "ms", step, "product_id", F.col("num").cast("long"), n)
    return window_text(best.groupBy("window_start", "window_end").agg(F.expr(
        "listagg(concat(product_id, '(', amount, ')'), ', ') within group (order by rn)").alias("top5_product_ids")))


def cumulative_process(sales: DataFrame, step: int = TEN_MINUTES, part_size: int = 1000) -> DataFrame:
    """How the cumulating amount came about: ``id(amount)`` of the orders of each step.

    The text of a whole window is the text of its day's steps up to the window's end, in
    (window_end, part) order; writing it out again for every window would make each order
    appear in all later windows of the day.
    """
    rows = sale_rows(sales).withColumn("window_start", (F.floor(F.col("ms") / DAY_MS) * DAY_MS).cast("long")).withColumn(
        "window_end", ((F.floor(F.col("ms") / step) + 1) * step).cast("long"))
    keys = ["window_start", "window_end"]
    entry = F.concat(F.col("id").cast("string"), F.lit("("), F.col("amount").cast("string"), F.lit(")"))
    texts = ordered_list(rows, keys, entry, "ms", "id", "+", part_size)
    grown = cumulate(rows.select("ms", "amount"), "ms", step, {"total": F.col("amount")})
    return window_text(texts.join(grown, keys)).select(
        "window_start", "window_end", "part", F.col("items").alias("step_process"), "item_count", money("total").alias("period_amount"))


def running_sales(sales: DataFrame) -> DataFrame:
    """Every order with the sales of its day up to and including it."""
    rows = sale_rows(sales).withColumn("stat_date", ms_day("ms"))
    grown = running_total(rows, ["stat_date"], ["ms", "id"], {"run": F.col("amount")}, chunk_of(F.col("ms"), 60_000))
    return grown.select("stat_date", "id", money("amount").alias("amount"), money("run").alias("running_amount"))


def order_items(details: DataFrame) -> DataFrame:
    """Products of each order as one ordered text."""
    rows = details.select("order_id", "product_id", "id", millis("create_time").alias("ms"))
    return ordered_list(rows, ["order_id"], F.col("product_id"), "ms", "id")
