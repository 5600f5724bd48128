"""Comment facts and two-grade moderation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.calendar import ms_day
from marketlens.operators.joins import interval_join, lookup, word_flag
from marketlens.operators.text import kept_words, word_hits

MINUTE = 60_000


def comment_facts(comments: DataFrame, orders: DataFrame, codes: DataFrame) -> DataFrame:
    """Comments with the name of their grade and the order placed within a minute of them."""
    named = lookup(comments, codes, "appraise", "dic_code", "dic_name")
    joined = interval_join(named, orders, "order_id", "id", "ts_ms", "ts_ms", MINUTE, MINUTE, "prefix")
    return joined.withColumn("ds", F.regexp_replace(ms_day("ts_ms"), "-", ""))


def last_comma_part(text: str):
    """Text after the last comma, commas at the very end ignored."""
    return F.substring_index(F.regexp_replace(text, ",+$", ""), ",", -1)


def moderate(comments: DataFrame, words: DataFrame, text: str = "comment_txt", match: str = "inside") -> DataFrame:
    """Grade P0: the last comma part is a listed word. Grade P1: another text holds listed
    words; they are named in the order in which they first appear, two at one place by the word."""
    words = kept_words(words)
    hits = word_hits(comments, words, "id", text, match).groupBy("id").agg(F.collect_list("word").alias("_words"))
    # One character more than the longest word tells a longer part from all words.
    longest = words.select(F.max(F.length(words.columns[0]))).scalar()
    last = F.substring(last_comma_part(text), F.lit(1), longest + 1)
    rows = comments.select("id", "user_id", F.lower(text).alias("_text"), last.alias("_last")).join(hits, "id", "left")
    placed = F.transform("_words", lambda w: F.struct(F.instr("_text", F.lower(w)).alias("at"), w.alias("w")))
    named = F.array_join(F.transform(F.array_sort(placed), lambda p: p["w"]), ", ")
    # The texts stay behind; only what they said meets the list.
    flagged = word_flag(rows.select("id", "user_id", "_last", named.alias("_named")), words, F.col("_last"))
    first = F.col("is_violation") == 1
    return flagged.select(
        "id", "user_id", "is_violation",
        F.when(first, "P0").when(F.col("_named").isNotNull(), "P1").otherwise("").alias("violation_grade"),
        F.when(first, F.col("_last")).when(F.col("_named").isNotNull(), F.col("_named")).otherwise("").alias("violation_msg"))
