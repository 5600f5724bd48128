import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import edges
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_near_dup import plain as plain_components

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    passage = "Seven quiet lamps glow under the north river stone, and walks of 42 more words"
    good = [edges.prose(k, 60 + k % 30) for k in range(60)]
    junk = ["@@ " + " ## ".join(f"!!{w}" for w in edges.prose(k, 60).split()) for k in range(30)]
    rows = [(k, t) for k, t in enumerate(good + junk)]
    rows += [(200, good[3]), (201, good[4] + " and one more word"), (202, good[5] + " " + passage), (203, None), (204, ""), (None, good[7]), (206, good[6]), (206, good[6])]
    edges.frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(k < 60), 0) for k in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_against_a_plain_version(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert after.columns == docs.columns
        rows = sorted(((r.doc_id, r.text) for r in after.collect()), key=lambda r: (r[0] is not None, r[0] or 0)) if k < 4 else after.collect()
        if name == "quality_classifier":
            ids = {i for i, _ in rows}
            assert set(range(60)) <= ids and not set(range(60, 90)) & ids
        elif name == "line_dedup":
            kept = {}
            for (i, t), (n, gone, text) in zip(before, plain_lines(list(dict.fromkeys(before)), 10), strict=False):
                kept[i] = (n, gone, text)
            whole = {i: t for i, t in rows}
            assert all(whole.get(i) == text for i, (n, gone, text) in kept.items() if gone < n or not n)
            assert after.where("n_chars <> length(text)").count() == 0
        elif name == "near_dedup":
            # A null id is larger than all others here; rows of one id and text are one.
            known = [(10**9 if i is None else i, t) for i, t in dict.fromkeys(before)]
            kept = plain_components([r for r in known if (r[1] or "").strip()], 5, 80)
            expected = [(i, t) for i, t in known if not (t or "").strip() or kept[i][2]]
            assert sorted(((10**9 if i is None else i, t) for i, t in rows), key=str) == sorted(expected, key=str)
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            assert {i for i, _ in rows} == {i for i, t in before if not plain_hits(t, items, 10)[1]}
        else:
            assert sorted(r.decoded_sha256 for r in rows) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in before)
        docs = after


def test_run_gives_the_rows_of_the_stages(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(found.columns)
    rows = {r.doc_id: r.n_tokens for r in found.collect()}
    assert 3 in rows and 200 not in rows and 202 not in rows and not set(range(60, 90)) & set(rows)


def test_equal_rows_and_rows_without_id_collapse(spark):
    text, other = edges.prose(41, 60), edges.prose(42, 60)
    rows = [(1, text), (1, text), (None, text), (None, text), (None, other), (None, other), (None, other + " end"), (None, None), (None, None), (3, "")]
    found = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, edges.frame(spark, rows), "").collect()), key=str)
    assert len(found) == 4 and (1, text) in found and (None, None) in found and (3, "") in found and found.count((None, text)) == 0
    assert sum(i is None and t is not None and t.startswith(other) for i, t in found) == 1


def test_short_items_and_tables_without_lengths(spark, folder, tmp_path):
    item = "seven lamps glow under the quiet stone tonight now"
    spark.createDataFrame([(1, item), (2, "the")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = edges.prose(50, 60)
    docs = edges.frame(spark, [(1, clean), (2, clean + " " + item), (3, "the the the")]).drop("n_chars")
    assert [r.doc_id for r in corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).collect()] == [1]
    assert corpus_pipeline.lines(spark, docs, str(tmp_path)).columns == docs.columns


def test_every_stage_takes_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for stage in STAGES.values():
        assert stage(spark, docs, folder).count() == 0
    assert re.fullmatch("[a-z_]+", corpus_pipeline.STAGES[0][0]) and docs.select(F.lit(1)).count() == 0
