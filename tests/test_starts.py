"""The search of texts for all listed words at once, and what it sends through Spark."""

import random
import re

import pyarrow as pa

from marketlens.operators import starts, text
from marketlens.operators.text import word_hits
from marketlens.plans import comments
from marketlens.sources import shop


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_search_equals_a_plain_one(monkeypatch):
    """Strings of any length, across windows and borders of texts, with zero bytes and null texts."""
    r = random.Random(3)
    for n in range(150):
        monkeypatch.setattr(starts, "WINDOW", r.choice([1, 7, 64, 1 << 18]))
        letters = r.choice(["ab", "abc\0", "aé😀", "abcdefgh"])
        words = sorted({"".join(r.choices(letters, k=r.choice([1, 2, 3, 7, 8, 9, 12, 16, 17, 30]))) for _ in range(n % 40)})
        texts = [r.choice(["", "".join(r.choices(letters, k=r.choice([1, 5, 20, 200]))), *words]) + r.choice(["", *words]) for _ in range(n % 20)]
        texts = [None if r.random() < 0.1 else t for t in texts]
        column = pa.array([None, "ab", *texts], pa.string())[2:]
        rows, found = starts.Starts(pa.array(words, pa.string())).find(*starts.byte_column(column))
        assert [*zip(rows.tolist(), found.tolist())] == [(i, j) for i, t in enumerate(texts) for j, w in enumerate(words) if t and w in t]


def test_only_found_starts_leave_the_texts(spark, monkeypatch):
    """For a list of any length: places of texts are no rows, and a start shared by many words meets none but its own."""
    words = spark.range(60).selectExpr("concat('Prefix', lpad(cast(id as string), 3, '0')) as word").unionAll(
        spark.createDataFrame([("é",), ("P" + "refix00" * 9,), ("P" + "refix00" * 9 + "1",)], "word string"))
    texts = spark.range(40).selectExpr("id % 30 as id", "concat(repeat('prefix00 ', 200), 'prefix', lpad(cast(id as string), 3, '0'), if(id = 3, repeat('prefix00', 9), 'É')) as text")
    expected = sorted({(k % 30, f"Prefix{k:03d}") for k in range(40)} | {(k % 30, "é") for k in range(40) if k != 3})
    for rows, block in ((200_000, 1_000_000), (2, 1_000_000), (2, 7)):
        monkeypatch.setattr(text, "LIST_ROWS", rows)
        monkeypatch.setattr(text, "BLOCK", block)
        hits = word_hits(texts, words.where("length(word) < 60"), "id", "text")
        assert "Generate" not in plan_of(hits) and "MapInArrow" in plan_of(hits)
        assert sorted((r.id, r.word) for r in hits.collect()) == expected
        assert sorted((r.id, r.word) for r in word_hits(texts, words, "id", "text").collect()) == expected


def test_texts_are_not_shuffled_for_their_labels(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "Wicked, wicked word"), (2, "normal wicked"), (3, "harmless normal"), (3, "harmful"), (4, "unlabelled"), (None, "missing"), (5, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 1), (3, 0), (3, 1), (None, 1), (5, 1), (1, None)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        words = shop.Shop(spark, str(tmp_path)).block_words()
        assert "hashpartitioning(doc_id" not in plan_of(words)
        monkeypatch.setattr(shop, "LABEL_ROWS", 3)  # more labels meet the texts in a shuffled join
        shuffled = shop.Shop(spark, str(tmp_path)).block_words()
        assert "hashpartitioning(doc_id" in plan_of(shuffled)
        assert [r.word for r in words.collect()] == [r.word for r in shuffled.collect()] == ["wicked"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_moderation_shuffles_a_text_once(spark):
    """Rows of one id share their words, rows without an id have none; the flag is found without the texts."""
    words = spark.createDataFrame([("Bad",), ("worse",), ("",), (None,)], "word string")
    rows = spark.createDataFrame(
        [(1, 1, "so worse, then bad"), (1, 2, "worse"), (1, 3, None), (1, 4, "x,Bad,,"), (None, 5, "bad"), (None, 6, "bad,Bad"), (2, 7, ""), (3, 8, "x" * 50), (4, 9, "fine,wors"), (5, 10, None)],
        "id long, user_id long, comment_txt string")
    expected = [
        (1, 0, "P1", "worse, Bad"), (2, 1, "P0", "worse"), (3, 0, "P1", "Bad, worse"), (4, 1, "P0", "Bad"), (5, 0, "", ""),
        (6, 1, "P0", "Bad"), (7, 1, "P0", ""), (8, 0, "", ""), (9, 0, "", ""), (10, 0, "", "")]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for bytes_ in (threshold, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bytes_)
            found = comments.moderate(rows, words)
            assert sorted((r.user_id, r.is_violation, r.violation_grade, r.violation_msg) for r in found.collect()) == expected
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"Join LeftOuter, \(_value#\d+ = _word#\d+\)\n *:- Project \[id#\d+L, user_id#\d+L, _last#\d+, array_join\(.* AS _named#\d+, _last#\d+ AS _value#\d+\]\n", plan)
        none = comments.moderate(rows, words.limit(0)).collect()
        assert {(r.is_violation, r.violation_grade, r.violation_msg) for r in none} == {(0, "", "")} and len(none) == len(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
