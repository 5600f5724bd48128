"""Bounded samples of labelled rows, and metrics, shared by the trained operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_share(rank: Column) -> Column:
    """The place of a 64-bit hash among all, from 0 to 1."""
    return rank / 2.0**64 + 0.5


def enough(max_rows: int, n: int) -> float:
    """A share of ``n`` hashes that holds ``max_rows`` of them, but for a chance far below 10^-9."""
    return min(1.0, (max_rows + 10 * max_rows**0.5 + 100) / max(1, n))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, max_rows: int,
    key: str = "doc_id", text: str = "text", max_bytes: int | None = None,
) -> DataFrame:
    """At most ``max_rows`` labelled keys with a text each: (key, text, label).

    ``keep`` selects the keys that may be learned from. A key labelled twice counts with its
    largest label, a key with several texts gives the one with the smallest hash; null keys and
    labels are left out. The sample is the rows with the smallest hash of the key, so it is the
    same on every run. The labelled side is bounded by ``max_rows`` and is therefore safe to
    broadcast. With ``max_bytes``, rows are taken in that order while all their texts together
    have no more bytes.
    """
    wanted = (
        labels.where(keep).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).dropna()
        .groupBy("key").agg(F.max("label").alias("label")))
    rank = F.xxhash64("key")
    # Only rows that can be among the smallest go to the one task that orders them.
    wanted = wanted.where(hash_share(rank) <= enough(max_rows, wanted.count())).orderBy(rank, "key").limit(max_rows)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(wanted), "key").groupBy("key", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    if max_bytes is not None:
        sizes = sample.select("key", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
        upto = F.sum("size").over(Window.orderBy(rank, "key").rowsBetween(Window.unboundedPreceding, 0))  # max_rows rows at most
        sample = sample.join(F.broadcast(sizes.select("key", upto.alias("upto")).where(F.col("upto") <= max_bytes).select("key")), "key", "left_semi")
    return sample.select("key", "text", "label")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))
