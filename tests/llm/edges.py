"""Rows that every operator has to get along with."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

# Columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, key string, n_words int, id int, body string, node int, n_lines int, rank int"


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), 0.5, "x", "k", 1, 2, "b", 3, 4, 5) for i, t in rows], SCHEMA)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["the", "of", "and", "river", "stone", "quiet", "walks", "under", "seven", "Lamps", "glow", "é", "42", "north"]
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(n))


def rows() -> list[tuple[int | None, str | None]]:
    long = prose(9, 30_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, prose(1, 80)), (6, prose(1, 80)), (6, prose(1, 80)),
        (None, prose(1, 80)), (None, None), (7, long), (8, prose(2, 200)), (8, prose(3, 60)), (9, "\U0001f600 é\x00 tail"), (10, prose(2, 200) + " end")]
