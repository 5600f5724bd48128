"""k-means over a vector column."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster(df: DataFrame, col: str, k: int = 2, seed: int = 1) -> DataFrame:
    """Add ``prediction``, the cluster of each row's vector."""
    vectors = df.withColumn("_vector", array_to_vector(F.col(col).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_vector", predictionCol="prediction").fit(vectors)
    return model.transform(vectors).drop("_vector")


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy(F.col("prediction").cast("long").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
