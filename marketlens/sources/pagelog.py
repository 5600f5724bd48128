"""Nested page log: parsing, splitting by kind, reshaping, visitor repair, repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.calendar import ms_day

PAGE_LOG = (
    "common struct<uid: string, mid: string, sid: string, is_new: string, os: string, ch: string, md: string, ba: string>, "
    "page struct<item: string, item_type: string>, start string, displays array<string>, actions array<string>, err string, ts long"
)
KINDS = ["dirty", "err", "start", "display", "action", "page"]
DAY_MS = 86_400_000


def parse_log(raw: DataFrame, line: str = "line") -> DataFrame:
    """Typed page-log rows; ``_bad`` holds the text of a line that is not JSON."""
    parsed = F.from_json(line, PAGE_LOG + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return raw.withColumn("r", parsed).select("log_id", "r.*")


def tag_records(log: DataFrame) -> DataFrame:
    """All records the log splits into, in one pass: the rows of an error, a start, each
    display, each action and the page itself, tagged with their kind."""
    text = "cast(null as string)"
    def rows(kind, values, when):
        return f"case when {when} then transform({values}, b -> named_struct('kind', '{kind}', 'body', b)) else array() end"
    pages = "_bad is null and start is null"
    parts = ", ".join([
        rows("dirty", "array(_bad)", "_bad is not null"), rows("err", "array(err)", "_bad is null and err is not null"),
        rows("start", "array(start)", "_bad is null and start is not null"),
        rows("display", "displays", f"{pages} and displays is not null"), rows("action", "actions", f"{pages} and actions is not null"),
        rows("page", f"array({text})", pages)])
    return log.withColumn("t", F.expr(f"explode(concat({parts}))")).select("log_id", "t.kind", "common", "page", "t.body", "ts")


def split_log(tagged: DataFrame) -> dict[str, DataFrame]:
    """One frame per kind of record."""
    return {kind: tagged.where(F.col("kind") == kind).drop("kind") for kind in KINDS}


def reshape_page_log(log: DataFrame) -> DataFrame:
    """User (or -1), device values without ids, first word of the system, searched word."""
    good = log.where("_bad is null and common is not null")
    return good.select(
        "log_id", F.coalesce("common.uid", F.lit("-1")).alias("uid"), "ts", F.split("common.os", " ")[0].alias("os"),
        F.col("common.ch").alias("ch"), F.col("common.md").alias("md"), F.col("common.ba").alias("ba"),
        F.when(F.col("page.item_type") == "keyword", F.col("page.item")).alias("search_item"))


def repair_is_new(log: DataFrame) -> DataFrame:
    """Correct the new-visitor flag per device from its first record.

    A device first seen as new is new on that day only; one first seen as old never is.
    The first record is found by a combining aggregate, so a device with very many rows is
    joined to one small row instead of being sorted in one task.
    """
    rows = log.where("_bad is null and common is not null").select(
        "log_id", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts")
    first = rows.groupBy("mid").agg(F.min_by(F.struct("ts", "is_new"), F.struct("ts", "log_id")).alias("f")).select(
        "mid", ms_day(F.when(F.col("f.is_new") == "1", F.col("f.ts")).otherwise(F.col("f.ts") - DAY_MS)).alias("_first_day"))
    stale = (F.col("is_new") == "1") & (ms_day("ts") != F.col("_first_day"))
    return rows.join(first, "mid").withColumn("is_new", F.when(stale, "0").otherwise(F.col("is_new"))).drop("_first_day")


def drop_repeats(df: DataFrame, key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose whole payload was not seen before for the key."""
    return df.drop(*ignore).dropDuplicates([key, *[c for c in df.columns if c not in (*ignore, key)]])


def drop_seen(df: DataFrame, keys: list[str], first_by: str) -> DataFrame:
    """First row (by ``first_by``) of every key combination, exactly and without false drops."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), first_by).alias("r")).select(*keys, "r.*")
