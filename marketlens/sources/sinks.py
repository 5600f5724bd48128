"""Sinks: partition overwrite, keyed upsert, partial update, day buckets, fan-out."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.calendar import day_bucket
from marketlens.functions.columns import row_key


def overwrite_partition(df: DataFrame, path: str, column: str, value) -> None:
    """Replace one partition of a table and leave the others."""
    overwrite_dynamic(df.withColumn(column, F.lit(value)), path, [column])


def overwrite_dynamic(df: DataFrame, path: str, columns: list[str]) -> None:
    """Replace exactly the partitions that occur in the rows."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def append(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*columns) if columns else writer).parquet(path)


def upsert_by_key(target: DataFrame, batch: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Target after inserting or replacing the rows of a batch; the row with the highest
    ``order_col`` wins, and a batch row wins over an equally old target row.

    One grouping instead of join plus union: each key's rows meet once, partly before the shuffle.
    """
    both = target.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    rest = [c for c in target.columns if c not in keys]
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order_col, "_new")).alias("r"))
    return best.select(*keys, "r.*").select(*target.columns)


def partial_update(target: DataFrame, batch: DataFrame, keys: list[str], seq_col: str, op_col: str | None = "op") -> DataFrame:
    """Merge where each column keeps its latest non-null value; deletes change nothing.

    Rows without an operation count as updates. Of equally late values the largest stays.
    """
    live = batch.where(~F.col(op_col).eqNullSafe("d")).drop(op_col) if op_col and op_col in batch.columns else batch
    rest = [c for c in target.columns if c not in (*keys, seq_col)]
    def latest(c):
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(seq_col, c))).alias(c)
    return target.unionByName(live).groupBy(*keys).agg(F.max(seq_col).alias(seq_col), *[latest(c) for c in rest]).select(*target.columns)


def dim_upsert(target: DataFrame | None, batch: DataFrame, key_col: str, order_col: str) -> DataFrame:
    """Dimension keyed by the md5 of a column, all values as text, newest row per key."""
    text = batch.select(row_key(key_col).alias("row_key"), F.col(order_col).alias("_order"),
                        *[F.col(c).cast("string").alias(c) for c in batch.columns])
    target = text.where("false") if target is None else target
    return upsert_by_key(target, text, ["row_key"], "_order")


def merge_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], order_col: str, partitions: list[str]) -> None:
    """Upsert a batch into a partitioned Parquet table, rewriting only the partitions it touches.

    The merge keeps the newest row per key, so running the same batch again changes nothing.
    New partitions are created as they appear.
    """
    try:
        current = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)
    except AnalysisException as missing:  # the first batch creates the table
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        current = batch.where("false")
    # Only rows of partitions that the batch touches are merged and written again; Spark prunes
    # the others by the join with the batch's distinct partition values.
    touched = batch.select(*[F.col(p).alias(f"_{p}") for p in partitions]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in partitions])
    current = current.join(touched, same, "left_semi")
    merged = upsert_by_key(current, batch, [*keys, *[p for p in partitions if p not in keys]], order_col)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def with_day_bucket(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumn("day", day_bucket(ts_col))


def write_day_buckets(df: DataFrame, ts_col: str, path: str, batch_id: int = 0) -> None:
    """Rolling JSON files, one folder per day and one for rows without a readable time.

    Each batch owns a folder below its days, which a retry of the batch replaces.
    """
    day = F.regexp_replace(day_bucket(ts_col), "^day=", "")
    named = df.withColumns({"day": day, "batch_id": F.lit(batch_id)})
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").json(path)


def load_report(batch: DataFrame, batch_id: int, path: str) -> None:
    """Idempotent load: each batch owns a folder that a retry replaces."""
    batch.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")


def fan_out(batch: DataFrame, outputs: dict[str, tuple[DataFrame, str]], batch_id: int) -> None:
    """Several writes of one micro-batch, computed once; a retry replaces what it wrote."""
    batch.persist()
    try:
        for frame, path in outputs.values():
            load_report(frame, batch_id, path)
    finally:
        batch.unpersist()


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
