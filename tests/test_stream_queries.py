"""Each replayed stream against the DuckDB query of its batch report."""

import pytest

from marketlens.plans.streams import ORACLES, QUERIES
from tests.test_oracles import FOLDER, duck, rows  # noqa: F401


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_stream_equals_the_batch_report(spark, duck, name):  # noqa: F811
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        ours = QUERIES[name](spark, FOLDER)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = duck.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(ours.columns) == sorted(names)
    assert rows(ours.columns, ours.collect()) == rows(names, found.fetchall())
