"""Tumbling, cumulating and rolling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.calendar import DAY_MS, ms_second
from marketlens.operators.ordered import top_n

MINUTE = 60_000


def tumble(df: DataFrame, ms: str, size: int, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates per window of ``size`` milliseconds and keys."""
    start = (F.floor(F.col(ms) / size) * size).cast("long")
    return df.groupBy(start.alias("window_start"), (start + size).alias("window_end"), *keys).agg(*aggs)


def window_text(df: DataFrame) -> DataFrame:
    """Window bounds as text."""
    return df.withColumns({"window_start": ms_second("window_start"), "window_end": ms_second("window_end")})


def steps(df: DataFrame, ms: str, step: int) -> DataFrame:
    """Add ``_day`` (first millisecond) and ``_step`` (number of the step inside the day)."""
    day = (F.floor(F.col(ms) / DAY_MS) * DAY_MS).cast("long")
    return df.withColumns({"_day": day, "_step": F.floor((F.col(ms) - day) / step).cast("long")})


def fill_forward(sparse: DataFrame, keys: list[str], step: int) -> DataFrame:
    """Repeat each step's row until the next filled step of the same day, or the day's end."""
    per_day = Window.partitionBy("_day", *keys).orderBy("_step")
    until = F.coalesce(F.lead("_step").over(per_day), F.lit(DAY_MS // step)) - 1
    return sparse.withColumn("_until", until).withColumn("_step", F.explode(F.sequence("_step", "_until"))).drop("_until")


def window_bounds(df: DataFrame, step: int) -> DataFrame:
    return df.withColumns({
        "window_start": F.col("_day"), "window_end": F.col("_day") + (F.col("_step") + 1) * step}).drop("_day", "_step")


def cumulate(df: DataFrame, ms: str, step: int, sums: dict[str, Column], keys: list[str] | None = None,
             distinct: dict[str, str] | None = None) -> DataFrame:
    """Cumulating day windows that grow by ``step``: running sums and distinct counts.

    Rows are summed per step before anything else; the running totals and the repeated
    steps without rows only touch that small frame. A distinct value counts in the step of
    the day in which it is first seen.
    """
    keys, distinct = keys or [], distinct or {}
    cut = steps(df, ms, step)
    parts = [cut.groupBy("_day", "_step", *keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])]
    for name, col in distinct.items():
        first = cut.where(F.col(col).isNotNull()).groupBy("_day", *keys, col).agg(F.min("_step").alias("_step"))
        parts.append(first.groupBy("_day", "_step", *keys).agg(F.count(F.lit(1)).alias(name)))
    names = [*sums, *distinct]
    per_step = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            per_step = per_step.unionByName(part, allowMissingColumns=True)
        per_step = per_step.groupBy("_day", "_step", *keys).agg(*[F.sum(n).alias(n) for n in names])
    upto = Window.partitionBy("_day", *keys).orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)
    running = per_step.withColumns({n: F.sum(n).over(upto) for n in names})
    return window_bounds(fill_forward(running, keys, step), step)


def cumulate_top(df: DataFrame, ms: str, step: int, item: str, amount: Column, n: int = 5) -> DataFrame:
    """Top items by amount in every cumulating day window.

    On a day without negative amounts, an item outside the best ``n`` of the items that sold in
    its step cannot come back before it sells again: later steps only raise the others.
    Candidates are then at most ``n`` rows per step, whatever the number of items. On a day with
    a negative amount (a refund) every item is a candidate in each step until it sells again.
    """
    per_step = steps(df, ms, step).groupBy("_day", item, "_step").agg(F.sum(amount).alias("_amount"))
    upto = Window.partitionBy("_day", item).orderBy("_step")
    running = per_step.withColumns({
        "amount": F.sum("_amount").over(upto.rowsBetween(Window.unboundedPreceding, 0)),
        "_next": F.coalesce(F.lead("_step").over(upto), F.lit(DAY_MS // step)),
    }).drop("_amount")
    falls = per_step.where("_amount < 0").select("_day").distinct()
    candidates = top_n(running.join(falls, "_day", "left_anti"), ["_day", "_step"], "amount", item, n).drop("rn").unionByName(
        running.join(falls, "_day", "left_semi"))
    shown = candidates.withColumn("_step", F.explode(F.sequence("_step", F.col("_next") - 1))).drop("_next")
    return window_bounds(top_n(shown, ["_day", "_step"], "amount", item, n), step)


def last_per_interval(df: DataFrame, key: str, ms: str, tie: str, size: int) -> DataFrame:
    """The last row of each key in each window of ``size`` milliseconds."""
    start = (F.floor(F.col(ms) / size) * size).cast("long")
    return df.groupBy(F.col(key).alias("_key"), start.alias("window_start")).agg(
        F.max_by(F.struct(*df.columns), F.struct(ms, tie)).alias("r")).select("window_start", "r.*")


def rolling_sums(daily: DataFrame, key: str, day: str, names: list[str], days: tuple[int, ...]) -> DataFrame:
    """Sums over the last 1, 7, ... days for every key and day present; ``day`` is a day number."""
    def span(n):
        return Window.partitionBy(key).orderBy(day).rangeBetween(-(n - 1), 0)
    return daily.select(key, day, *[F.sum(c).over(span(n)).alias(f"{c}_{n}d") for c in names for n in days])


def rolling_distinct(df: DataFrame, key: str, user: str, day: str, days: tuple[int, ...], name: str) -> DataFrame:
    """Distinct users over the last 1, 7, ... days per key, for each day the count changes.

    A user seen on a day counts until the window has passed or the user is seen again, so
    every distinct (key, user, day) adds one and takes one away; running sums of those
    steps are the distinct counts. Nothing is copied once per window day.
    """
    seen = df.select(key, user, day).distinct()
    again = F.lead(day).over(Window.partitionBy(key, user).orderBy(day))
    moves = seen.withColumn("_again", again)
    change = F.array(*[
        F.struct(F.col(day).alias("_day"), *[F.lit(1).cast("long").alias(f"_{n}") for n in days])
    ], *[
        F.struct(F.least(F.col(day) + n, F.coalesce("_again", F.col(day) + n)).alias("_day"),
                 *[F.lit(-1 if m == n else 0).cast("long").alias(f"_{m}") for m in days])
        for n in days
    ])
    steps_ = moves.select(key, F.explode(change).alias("m")).select(key, "m.*").groupBy(key, "_day").agg(
        *[F.sum(f"_{n}").alias(f"_{n}") for n in days])
    upto = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    return steps_.select(key, F.col("_day").alias(day), *[F.sum(f"_{n}").over(upto).alias(f"{name}_{n}d") for n in days])
