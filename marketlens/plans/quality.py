"""Data quality: identity numbers and amounts in words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.columns import money
from marketlens.functions.identity import VALID, amount_text, birth_date_exists, id_verdict


def id_audit(df: DataFrame, col: str) -> DataFrame:
    """Verdict of every identity number, and whether its birth date is a real day."""
    return df.withColumn("verdict", id_verdict(col)).withColumn(
        "real_birth_date", F.when(birth_date_exists(col), 1).otherwise(0).cast("long"))


def id_audit_counts(df: DataFrame, col: str) -> DataFrame:
    return id_audit(df, col).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def id_rejects(df: DataFrame, col: str) -> DataFrame:
    return id_audit(df, col).where(F.col("verdict") != VALID)


def spelled_orders(lines: DataFrame, mode: str = "correct") -> DataFrame:
    """Order totals with the amount in Chinese capital numerals."""
    totals = lines.groupBy("order_id").agg(F.sum("amount").alias("total"))
    return totals.select("order_id", money("total").alias("total"), amount_text("total", mode).alias("amount_words"))
