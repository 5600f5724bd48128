"""Helpers for stream tests: files that are read in a fixed order, and queries run to their end."""

import json
import os
import time

from marketlens.streaming import jobs

NOW = {"availableNow": True}
DAY = 1_704_067_200_000  # 2024-01-01 UTC
HOUR = 3_600_000


def put(folder, number, rows):
    """File ``number`` of a folder; rising change times fix the order of reading."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{number}.json")
    with open(path + "~", "w", encoding="utf-8") as file:
        file.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)
    os.utime(path + "~", (1_700_000_000 + number, 1_700_000_000 + number))
    os.rename(path + "~", path)


def source(spark, folder, schema, per_batch=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).option("pathGlobFilter", "*.json").json(str(folder))


def begin(df, checkpoint, sink, mode="append", trigger=None):
    """Start a query with few state partitions."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        return jobs.start(df, str(checkpoint), sink if callable(sink) else str(sink), mode, trigger or NOW)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def run(df, checkpoint, sink, mode="append"):
    """All that there is; a query that waits for the clock would never end."""
    query = begin(df, checkpoint, sink, mode)
    if not query.awaitTermination(90):
        query.stop()
        raise AssertionError("the query did not end")


class Running:
    """A query that goes on while rows are put."""

    def __init__(self, df, checkpoint, sink, mode="append", every="300 milliseconds"):
        self.query = begin(df, checkpoint, sink, mode, {"processingTime": every})

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.query.stop()

    def until(self, done, seconds=60):
        end = time.time() + seconds
        while not done():
            assert time.time() < end and self.query.exception() is None, str(self.query.exception())
            time.sleep(0.2)

    def until_read(self, rows):
        """Until so many input rows have been worked on."""
        self.until(lambda: sum(p["numInputRows"] for p in self.query.recentProgress) >= rows)


def rows(frame, columns=None):
    names = sorted(columns or frame.columns)
    return sorted((tuple(r[c] for c in names) for r in frame.select(*names).collect()), key=str)
