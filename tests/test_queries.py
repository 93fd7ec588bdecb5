"""Every registered query of the engine's own operators against its SQL, on the smallest tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

from quillwort.plans import registry

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def _cell(x):
    if isinstance(x, datetime.date | datetime.datetime):
        return str(x)
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    return float(x) if isinstance(x, int) and not isinstance(x, bool) else x


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, str(DATA))
    want = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    ours, theirs = _rows(got.columns, [tuple(r) for r in got.collect()]), _rows(names, want.fetchall())
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs, strict=True):
        assert all(x == y or isinstance(x, float) and isinstance(y, float) and abs(x - y) < 1e-5 for x, y in zip(a, b, strict=True)), (a, b)


@pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")
def test_fuzzy_resolution_removes_and_keeps(spark):
    fuzzy = registry.QUERIES["dedupe_fuzzy"](spark, str(DATA))
    exact = registry.QUERIES["dedupe_exact_ladder"](spark, str(DATA))
    assert 0 < fuzzy.count() <= exact.count()
    row = registry.QUERIES["marginal_contribution"](spark, str(DATA)).first()
    assert row["both"] - row["base"] == row["added"] >= 0
