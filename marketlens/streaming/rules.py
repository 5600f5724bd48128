"""Rules that change while a stream runs."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.sinks import load_report
from marketlens.streaming import versions

Batch = Callable[[DataFrame, int], None]


class RefreshingRules:
    """A rules table that is read again while a stream runs, with the last good version at hand.

    ``read`` returns the rules as they are now. They are good if reading succeeds, there is at
    least one row and ``valid`` holds for all. A good read whose rows differ from the last version
    is written below ``folder`` as the next one; batches use the written version, so a source that
    changes or breaks during a batch does no harm, and a restarted stream has rules before the
    first read. A failed read is tried ``retries`` times, ``pause`` seconds apart. Reads are at
    least ``every`` seconds apart.
    """

    def __init__(self, spark: SparkSession, read: Callable[[], DataFrame], folder: str, schema: str, valid: Column | None = None,
                 every: float = 5.0, retries: int = 3, pause: float = 0.5):
        self.spark, self.read, self.folder, self.schema = spark, read, folder, schema
        self.valid, self.every, self.retries, self.pause = valid, every, retries, pause
        self.next_read, self.failures = 0.0, 0

    def _good(self) -> DataFrame | None:
        for attempt in range(self.retries):
            try:
                rules = self.read().select(*self.spark.createDataFrame([], self.schema).columns)
                bad = F.lit(False) if self.valid is None else ~F.coalesce(self.valid, F.lit(False))
                rows, wrong = rules.select(F.count(F.lit(1)), F.count_if(bad)).first()
                if rows and not wrong:
                    return rules
            except PySparkException:
                pass
            self.failures += 1
            if attempt + 1 < self.retries:
                time.sleep(self.pause)
        return None

    @staticmethod
    def _digest(rules: DataFrame):
        return rules.select(F.count(F.lit(1)), F.sum(F.xxhash64(*rules.columns).cast("decimal(38,0)"))).first()

    def current(self) -> DataFrame:
        """The rules of the newest good version; raises if there has been none."""
        if time.monotonic() >= self.next_read:
            found, number = self._good(), versions.newest(self.spark, self.folder)
            self.next_read = time.monotonic() + self.every
            if found is not None and (number is None or self._digest(found) != self._digest(self._version(number))):
                versions.write(found, self.folder, 0 if number is None else number + 1)
        number = versions.newest(self.spark, self.folder)
        if number is None:
            raise ValueError("no good version of the rules has been read")
        return self._version(number)

    def _version(self, number: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/batch_id={number}")


def ruled_sink(rules: RefreshingRules, apply: Callable[[DataFrame, DataFrame], DataFrame], path: str) -> Batch:
    """Micro-batches with the rules of their time applied, each below a folder of its number."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # rules of several kinds read it more than once
        try:
            load_report(apply(batch, rules.current()), batch_id, path)
        finally:
            batch.unpersist()
    return write
