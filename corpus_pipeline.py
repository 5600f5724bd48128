"""Corpus pipeline: five stages, each over all that the one before it kept.

Each stage takes (spark, docs, folder) and returns a DataFrame; it is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``. The
stages need no particular ids: repeated ids and null ids are rows like any others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, line_dedup, near_dup, quality_classifier
from marketlens.llm.fitting import labelled_sample
from marketlens.llm.queries import table, token_digest
from marketlens.llm.storage import Scratch
from marketlens.llm.text import remainder_of

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

MIN_QUALITY = 0.3
MIN_ITEM_WORDS = 5  # of an item whose one occurrence is enough for a document to go
MAX_HIT_SHARE = 0.2  # of a document's words, for shorter items


def _packed(docs: DataFrame, *apart: str) -> DataFrame:
    """All columns in one, ``doc``, which an operator carries as its key, so that no name can
    clash; the columns ``apart`` and the text stand beside it."""
    return docs.select(F.struct(*(c for c in docs.columns if c not in apart)).alias("doc"), *dict.fromkeys([*apart, "text"]))


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose quality score is under ``MIN_QUALITY`` go."""
    sample = labelled_sample(docs, table(spark, folder, "labels"), "quality", remainder_of("doc_id", 5) != 0, quality_classifier.MAX_ROWS)
    scored = quality_classifier.score(_packed(docs), quality_classifier.fit(sample), key="doc")
    return scored.where(F.col("score") >= MIN_QUALITY).select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which nothing is left."""
    cut = line_dedup.dedup_lines(_packed(docs, "doc_id", "text"))
    left = cut.where((F.col("n_deleted") == 0) | (F.col("n_deleted") < F.col("n_lines")))
    changed = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("doc.n_chars")).cast(docs.schema["n_chars"].dataType)
    return left.select(*(changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near duplicates stays, the one with the smallest id; a null id is the largest."""
    return near_dup.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a whole benchmark window or a whole item of ``MIN_ITEM_WORDS`` go, as do those largely made of shorter items."""
    found = decontaminate.matches(_packed(docs, "text"), table(spark, folder, "benchmark"), key="doc")
    long = F.exists("spans", lambda s: s["end"] - s["start"] >= MIN_ITEM_WORDS)
    large = decontaminate.hit_words() > MAX_HIT_SHARE * F.col("n_words")
    return found.where(~(long | large)).select(*(F.col("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns))


def byte_bpe(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of the encoded and the decoded text."""
    return token_digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminated),
    ("byte_bpe", byte_bpe),
]

# Training a classifier can't be said in SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each stage's table is written to the shared folder."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
