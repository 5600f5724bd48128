"""Each report against its DuckDB query on the smallest tables."""

import duckdb
import pytest

from marketlens.plans.catalog import QUERIES
from marketlens.plans.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def text(value):
    if value is None or value != value:
        return ""
    return f"{value:.6f}" if isinstance(value, float) else str(value)


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(text(row[k]) for k in order) for row in values)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_report_equals_its_oracle(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER)
    found = duck.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(ours.columns) == sorted(names)
    assert rows(ours.columns, ours.collect()) == rows(names, found.fetchall())
