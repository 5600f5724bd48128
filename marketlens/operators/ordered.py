"""Ordered operators: previous row, running totals, latest row, top-N, repeats, text lists.

Groups that can be large are always worked on in slices: per (key, slice) inside one task,
then across slices on a frame with one row per slice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators.skew import chunk_of

MINUTE_MS, HOUR_MS = 60_000, 3_600_000
BEFORE = (Window.unboundedPreceding, -1)


def previous_row(df: DataFrame, keys: list[str], ms: str, tie: str, take: list[str], width: int = HOUR_MS) -> DataFrame:
    """Add ``prev``: a struct of ``take`` from the row before, per key in (ms, tie) order."""
    payload = F.struct(*take)
    sliced = df.withColumn("_chunk", chunk_of(F.col(ms), width))
    last = sliced.groupBy(*keys, "_chunk").agg(F.max_by(payload, F.struct(ms, tie)).alias("_last"))
    carry = last.select(*keys, "_chunk", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_carry"))
    inside = sliced.withColumn("prev", F.lag(payload).over(Window.partitionBy(*keys, "_chunk").orderBy(ms, tie)))
    return _beside(inside, carry, keys).withColumn("prev", F.coalesce("prev", "_carry")).drop("_chunk", "_carry")


def _beside(rows: DataFrame, slices: DataFrame, keys: list[str]) -> DataFrame:
    """Each row with its slice's row; null keys are equal."""
    on = [*keys, "_chunk"]
    right = slices.withColumnsRenamed({c: f"_of_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on])
    return rows.join(right, same, "left").drop(*[f"_of_{c}" for c in on])


def running_total(df: DataFrame, keys: list[str], order: list[str], totals: dict[str, Column],
                  chunk: Column) -> DataFrame:
    """Running sums per key in ``order``; ``chunk`` must rise with ``order`` inside a key."""
    sliced = df.withColumn("_chunk", chunk)
    sums = sliced.groupBy(*keys, "_chunk").agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()])
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(*BEFORE)
    offsets = sums.select(*keys, "_chunk", *[
        F.sum(f"_sum_{n}").over(across).alias(f"_before_{n}") for n in totals])
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = sliced.withColumns({f"_in_{n}": F.sum(c).over(inside) for n, c in totals.items()})
    return _beside(running, offsets, keys).withColumns({
        n: F.col(f"_in_{n}") + F.coalesce(F.col(f"_before_{n}"), F.lit(0)) for n in totals
    }).drop("_chunk", *[f"_{p}_{n}" for n in totals for p in ("in", "before")])


def running_counts(df: DataFrame, keys: list[str], ms: str, tie: str, width: int = MINUTE_MS) -> DataFrame:
    """Add ``running_count``: how many rows of the key there were up to and with this one."""
    return running_total(df, keys, [ms, tie], {"running_count": F.lit(1).cast("long")}, chunk_of(F.col(ms), width))


def keep_rising(df: DataFrame, keys: list[str], arrival: str, ts: str, width: int = 1_000_000, tie: str | None = None) -> DataFrame:
    """Keep a row when its ``ts`` is above every ``ts`` that arrived before it for the key.

    Rows that arrive together are taken by rising ``ts`` unless ``tie`` orders them.
    """
    sliced = df.withColumn("_chunk", chunk_of(F.col(arrival), width))
    tops = sliced.groupBy(*keys, "_chunk").agg(F.max(ts).alias("_top"))
    carry = tops.select(*keys, "_chunk", F.max("_top").over(
        Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(*BEFORE)).alias("_carry"))
    seen = F.max(ts).over(Window.partitionBy(*keys, "_chunk").orderBy(arrival, tie or ts).rowsBetween(*BEFORE))
    return _beside(sliced.withColumn("_seen", seen), carry, keys).withColumn(
        "_seen", F.greatest("_seen", "_carry")
    ).where(F.col("_seen").isNull() | (F.col(ts) > F.col("_seen"))).drop("_seen", "_carry", "_chunk")


def count_recent(df: DataFrame, keys: list[str], ms: str, span: int = MINUTE_MS) -> DataFrame:
    """Add ``recent``: rows of the key less than ``span`` milliseconds back, itself included.

    Rows are copied into the slice after their own, so each slice of width ``span`` holds every
    row its members look back at; the copies are dropped afterwards.
    """
    own = df.withColumn("_own", chunk_of(F.col(ms), span))
    recent = Window.partitionBy(*keys, "_chunk").orderBy(ms).rangeBetween(-(span - 1), 0)
    return own.withColumn("_chunk", F.explode(F.array("_own", F.col("_own") + 1))).withColumn(
        "recent", F.count(F.lit(1)).over(recent)).where("_chunk = _own").drop("_chunk", "_own")


def top_n(df: DataFrame, keys: list[str], value: str, tie: str, n: int) -> DataFrame:
    """The ``n`` largest rows per key with their rank ``rn``; ties go to the smaller ``tie``.

    The rank filter is applied before the shuffle too, so a task sends at most ``n`` rows per key.
    """
    best = Window.partitionBy(*keys).orderBy(F.desc(value), F.asc(tie))
    return df.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= n).withColumn("rn", F.col("rn").cast("long"))


def ordered_list(df: DataFrame, keys: list[str], item: Column, ms: str, tie: str, sep: str = ",",
                 part_size: int = 1000, width: int = HOUR_MS) -> DataFrame:
    """Join items as text in (ms, tie) order.

    A list longer than ``part_size`` continues in further rows: ``part`` 0, 1, 2, ... joined
    in that order give the whole list, while no row ever holds an unbounded group.
    """
    listed = df.select(*keys, F.col(ms).alias("_ms"), F.col(tie).alias("_tie"), item.cast("string").alias("_item"))
    numbered = running_total(listed, keys, ["_ms", "_tie"], {"_place": F.lit(1).cast("long")}, chunk_of(F.col("_ms"), width))
    return numbered.withColumn("part", F.floor((F.col("_place") - 1) / part_size).cast("long")).groupBy(*keys, "part").agg(
        F.expr(f"listagg(_item, '{sep}') within group (order by _place)").alias("items"),
        F.count("_item").alias("item_count"))


def rank_pivot(ranked: DataFrame, keys: list[str], item: str, n: int, out: str) -> DataFrame:
    """Ranks 1..n of a key side by side, joined with commas; missing ranks stay empty."""
    places = [F.max(F.when(F.col("rn") == i, F.col(item).cast("string")).otherwise("")) for i in range(1, n + 1)]
    return ranked.groupBy(*keys).agg(F.concat_ws(",", *places).alias(out))


def exact_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exact median and mean from a histogram of distinct values, never from collected rows."""
    bins = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(bins, keys, [value], {"_upto": F.col("_n")}, F.floor(F.col(value)).cast("long"))
    sizes = bins.groupBy(*keys).agg(F.sum("_n").alias("_size"), F.sum(F.col(value) * F.col("_n")).alias("_total"))
    low, high = F.floor((F.col("_size") + 1) / 2), F.floor(F.col("_size") / 2) + 1
    def covers(place):
        return (F.col("_upto") >= place) & (F.col("_upto") - F.col("_n") < place)
    return upto.join(sizes, keys).groupBy(*keys).agg(
        ((F.max(F.when(covers(low), F.col(value).cast("double"))) + F.max(F.when(covers(high), F.col(value).cast("double")))) / 2).alias("median"),
        (F.max("_total").cast("double") / F.max("_size")).alias("mean"))
