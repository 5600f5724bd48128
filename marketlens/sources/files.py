"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, _parse_datatype_string


def _struct(schema: StructType | str) -> StructType:
    return _parse_datatype_string(schema) if isinstance(schema, str) else schema


def read_json_lines(spark: SparkSession, path: str, schema, reject_col: str = "_bad") -> DataFrame:
    """JSON lines with an explicit schema; an unreadable line keeps its text in ``reject_col``."""
    full = StructType([*_struct(schema).fields]).add(reject_col, StringType())
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", reject_col).json(path)


def good_and_bad(df: DataFrame, reject_col: str = "_bad") -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the text of the unreadable ones."""
    return df.where(F.col(reject_col).isNull()).drop(reject_col), df.where(F.col(reject_col).isNotNull()).select(reject_col)


def read_partitioned_csv(spark: SparkSession, path: str, schema, base_path: str | None = None) -> DataFrame:
    """Quoted CSV below ``key=value`` folders; new folders are found on every read."""
    reader = spark.read.schema(_struct(schema)).option("quote", '"').option("escape", "\\")
    return reader.option("basePath", base_path or path).csv(path)


def read_delimited(spark: SparkSession, path: str, schema, sep: str = ",") -> DataFrame:
    return spark.read.schema(_struct(schema)).csv(path, sep=sep)


def scan_partition(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one partition; on a partitioned table only its files are listed and read."""
    return df.where(F.col(column) == value)


def scan_days(df: DataFrame, column: str, last, days: int = 30) -> DataFrame:
    """Rows of the ``days`` days before ``last`` and of that day; the bounds are constants."""
    end = F.lit(last).cast("date")
    return df.where((F.col(column) >= F.date_sub(end, days)) & (F.col(column) < F.date_add(end, 1)))


def ingest_new_files(spark: SparkSession, folder: str, schema=None, max_files: int | None = None) -> DataFrame:
    """Stream of lines (or JSON rows) of files not yet seen; the query's checkpoint keeps the position."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder) if schema is None else reader.schema(_struct(schema)).json(folder)


def generate_rows(df: DataFrame, count, name: str = "n") -> DataFrame:
    """Repeat each row ``count`` times, numbered from 1."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), count.cast("long"))))
