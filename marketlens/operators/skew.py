"""Hot keys: slices and salted buckets.

A key may hold a large share of all rows. Aggregations combine before their shuffle and are
safe; ordered (window) work is not, because one key is one task. Ordered operators therefore
cut every key into slices of its order, run per (key, slice), and carry results across slice
borders on a small frame of one row per slice. All keys take the same plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def chunk_of(order: Column, width: int) -> Column:
    return F.floor(order / width).cast("long")


# Addresses that own a bucket of their own in the salted layout.
RESERVED_BUCKETS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}


def hash_bucket(key, n: int = 128) -> Column:
    """Four-digit bucket: the last three hex digits of the md5, modulo ``n``."""
    digest = F.md5((F.col(key) if isinstance(key, str) else key).cast("string"))
    return F.lpad((F.conv(F.substring(digest, 30, 3), 16, 10).cast("int") % n).cast("string"), 4, "0")


def salt_keys(df: DataFrame, key: str, n: int = 128, hot: dict[str, str] | None = None) -> DataFrame:
    """Add ``bucket`` for a bucketed layout; keys named in ``hot`` own a bucket each."""
    hot = RESERVED_BUCKETS if hot is None else hot
    text = F.lower(F.col(key).cast("string"))
    pinned = reduce(lambda acc, kv: acc.when(text == kv[0], kv[1]), hot.items(), F.when(F.lit(False), ""))
    return df.withColumn("bucket", F.coalesce(pinned, hash_bucket(key, n)))


def bucket_sizes(df: DataFrame, key: str, n: int = 128, hot: dict[str, str] | None = None) -> DataFrame:
    """Skew report: rows and distinct keys per bucket."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return salt_keys(per_key, key, n, hot).groupBy("bucket").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("keys"))
