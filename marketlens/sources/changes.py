"""Change records of captured tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENVELOPE = "op string, ts_ms long, source struct<db: string, `table`: string, snapshot: string>, before string, after string"


def parse_changes(df: DataFrame, value: str = "value") -> DataFrame:
    """Envelope fields; ``before`` and ``after`` stay JSON text because tables differ in columns."""
    r = df.select(F.from_json(F.col(value), ENVELOPE).alias("r"))
    return r.select("r.op", "r.ts_ms", F.col("r.source.db").alias("db"), F.col("r.source.table").alias("table"),
                    F.col("r.source.snapshot").alias("snapshot"), "r.before", "r.after")


def flatten_changes(changes: DataFrame) -> DataFrame:
    """One row image per change: the old row of a delete, the new row of everything else."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.coalesce("after", "before"))
    return changes.select("db", "table", "op", "ts_ms", row.alias("row"))


def table_changes(changes: DataFrame, table: str, row_schema: str) -> DataFrame:
    """Typed rows of one table out of a shared change topic."""
    one = flatten_changes(changes.where(F.col("table") == table))
    return one.select("db", "table", "op", "ts_ms", F.from_json("row", row_schema).alias("r")).select("db", "table", "op", "ts_ms", "r.*")


def op_filter(changes: DataFrame, ops: tuple[str, ...] = ("c", "u")) -> DataFrame:
    return changes.where(F.col("op").isin(*ops))


def snapshot_rows(changes: DataFrame) -> DataFrame:
    """Rows of the first full read of a table."""
    return changes.where((F.col("op") == "r") | (F.col("snapshot") == "true"))
