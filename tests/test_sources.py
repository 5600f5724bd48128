"""File sources: typed rows, rejects, partitions and files that come later."""

from pyspark.sql import functions as F

from marketlens.sources import files, jdbc, topics
from marketlens.sources.sinks import write_day_buckets
from tests.streams import run


def test_json_lines_keep_what_is_unreadable(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "name": "é"}\nbroken {\n{"id": "x"}\n{"id": 2, "more": [1]}\n\n{}\n')
    rows = files.read_json_lines(spark, str(tmp_path), "id long, name string").cache()
    good, bad = files.good_and_bad(rows)
    assert sorted(((r.id, r.name) for r in good.collect()), key=str) == [(1, "é"), (2, None), (None, None)]
    assert sorted(r[0] for r in bad.collect()) == ["broken {", '{"id": "x"}'] and good.columns == ["id", "name"]


def test_partitioned_csv_finds_new_folders(spark, tmp_path):
    def add(ds, text):
        (tmp_path / f"ds={ds}").mkdir()
        (tmp_path / f"ds={ds}" / "f.csv").write_text(text)
    add("2024-01-01", '1,"a, b"\n2,"say \\"x\\""\n')
    read = lambda: files.read_partitioned_csv(spark, str(tmp_path), "id long, text string, ds string")
    assert sorted((r.id, r.text, r.ds) for r in read().collect()) == [(1, "a, b", "2024-01-01"), (2, 'say "x"', "2024-01-01")]
    add("2024-01-02", "3,\n4\n")
    assert sorted((r.id, r.text) for r in files.scan_partition(read(), "ds", "2024-01-02").collect()) == [(3, None), (4, None)]
    plan = files.scan_partition(read(), "ds", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_delimited_text(spark, tmp_path):
    (tmp_path / "f.txt").write_text("1\tx y\t0.5\nno number\tz\t\n3\n")
    rows = files.read_delimited(spark, str(tmp_path), "id long, text string, value double", "\t").collect()
    assert sorted(((r.id, r.text, r.value) for r in rows), key=str) == [(1, "x y", 0.5), (3, None, None), (None, "z", None)]


def test_each_file_is_taken_in_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    def ingest():
        run(files.ingest_new_files(spark, str(source), "id long", max_files=1), tmp_path / "c", tmp_path / "out")
        return sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    (source / "a.json").write_text('{"id": 1}\n{"id": 2}\n')
    assert ingest() == [1, 2]
    (source / "b.json").write_text('{"id": 3}\n')
    assert ingest() == [1, 2, 3] and ingest() == [1, 2, 3]
    run(files.ingest_new_files(spark, str(source)), tmp_path / "ct", tmp_path / "lines")
    assert spark.read.parquet(str(tmp_path / "lines")).count() == 3


def test_day_buckets_are_replaced_by_a_retry(spark, tmp_path):
    rows = spark.createDataFrame([("1704067200",), ("1704067200000",), ("1704153600",), ("never",), (None,)], "ts string")
    for _ in range(2):
        write_day_buckets(rows, "ts", str(tmp_path), batch_id=3)
    found = spark.read.json(str(tmp_path)).groupBy(F.col("day").cast("string")).count().collect()
    assert {r[0]: r[1] for r in found} == {"20240101": 2, "20240102": 1, "error_bucket": 2}


def test_messages_are_typed_and_keyed(spark):
    raw = spark.createDataFrame([('{"id": 1, "at": {"x": 2}}',), ("{",), ("",), (None,)], "value string")
    rows = topics.decode(raw, "id long, at struct<x: int>")
    assert [(r.id, r.at.x) for r in rows.collect()] == [(1, 2)] and [r.line for r in topics.rejects(raw, "id long").collect()] == ["{"]
    message = topics.to_messages(rows, "id").first()
    assert (message.key, message.value) == ("1", '{"id":1,"at":{"x":2}}') and topics.to_messages(rows).columns == ["value"]


def test_topic_options():
    assert topics.kafka_options("h:1", "t", "earliest")["startingOffsets"] == "earliest"
    timed = topics.kafka_options("h:1", "t", 1_704_067_200_000)
    assert timed["startingTimestamp"] == "1704067200000" and "startingOffsets" not in timed
    assert topics.kafka_sink_options("h:1", "t")["topic"] == "t"


def test_database_options_and_names(spark):
    options = jdbc.jdbc_options({"url": "u"}, "orders", "id", (1, 100), 8)
    assert options["numPartitions"] == "8" and options["upperBound"] == "100" and options["dbtable"] == "orders"
    assert "partitionColumn" not in jdbc.jdbc_options({"url": "u"}, "orders")
    rows = jdbc.rename_camel(spark.createDataFrame([(1, " "), (2, "x"), (3, None)], "user_id long, tm_name_2 string"))
    assert rows.columns == ["userId", "tmName2"] and [r.userId for r in jdbc.null_safe(rows, "tmName2").collect()] == [2]
