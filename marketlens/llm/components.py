"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.storage import Scratch


def connected(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) of every node in (x, y) links; the label is the smallest node it reaches.

    Alternates two contractions of the links until they are stars: each node hands its larger
    neighbours, then its smaller ones, to the smallest node it knows. Rounds grow with the
    logarithm of the longest path; a node's neighbours only meet in minimum aggregates.
    """
    def turned(edges: DataFrame) -> DataFrame:
        return edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))

    def smallest(edges: DataFrame, larger: bool) -> DataFrame:
        """Links of each node's larger (or its smaller) neighbours to the smallest of all."""
        own = turned(edges) if larger else edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
        least = own.groupBy("x").agg(F.min("y").alias("m")).withColumn("m", F.least("x", "m"))
        met = own.join(least, "x")
        if larger:
            return met.where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).where("x != y").distinct()
        found = met.select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(met.select("x", F.col("m").alias("y")))
        return found.where("x != y").distinct()

    edges, step, before = scratch.save(links.select("x", "y").where("x != y").distinct(), f"{name}0"), 0, None
    while True:
        step += 1
        edges = scratch.save(smallest(smallest(edges, True), False), f"{name}{step}")
        scratch.drop(f"{name}{step - 1}")
        # Links that don't change any more are stars.
        state = edges.select(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = edges.select(F.col("x").alias("node"), F.col("y").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
