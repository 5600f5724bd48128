"""Database sources."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(options: dict, table: str, part_col: str | None = None, bounds: tuple | None = None, n: int = 1) -> dict:
    """Reader options; with a partition column the table is read by ``n`` parallel range queries."""
    out = {"dbtable": table, "fetchsize": "10000", **options}
    if part_col:
        out.update(partitionColumn=part_col, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(n))
    return out


def read_jdbc(spark: SparkSession, options: dict, table: str, part_col: str | None = None, bounds: tuple | None = None, n: int = 1) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(options, table, part_col, bounds, n)).load()


def camel(name: str) -> str:
    return re.sub(r"_([a-z0-9])", lambda m: m.group(1).upper(), name.lower())


def rename_camel(df: DataFrame) -> DataFrame:
    """Columns ``like_this`` become ``likeThis``."""
    return df.toDF(*[camel(c) for c in df.columns])


def read_dimension(spark: SparkSession, options: dict, sql: str, rename: bool = True) -> DataFrame:
    df = spark.read.format("jdbc").options(**options).option("query", sql).load()
    return rename_camel(df) if rename else df


def write_jdbc(df: DataFrame, options: dict, table: str, batch_rows: int = 500) -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch_rows).mode("append").save()


def null_safe(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.trim(column) != ""))
