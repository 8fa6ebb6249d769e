"""Every registered query against its SQL text in DuckDB, on whole test tables."""

import math

import duckdb
import pytest
from testdata import TESTDATA

import __spark_entry__ as registry

SCALES = [s for s in ("sf0.001", "sf0.01") if (TESTDATA / s).is_dir()]
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module", params=SCALES)
def tables(request):
    folder = TESTDATA / request.param
    db = duckdb.connect()
    for file in folder.glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield str(folder), db
    db.close()


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in values), key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, tables, name):
    folder, db = tables
    result = registry.queries()[name](spark, folder)
    expected = db.execute(registry.oracle_sql()[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(result.columns)
    assert {n: KINDS[str(c[1])] for n, c in zip(names, expected.description)} == dict(result.dtypes)
    want, got = rows(names, expected.fetchall()), rows(result.columns, [tuple(r) for r in result.collect()])
    assert got == want
    assert all(not (isinstance(v, float) and math.isnan(v)) for row in got for v in row)


def test_all_reports_have_sql():
    assert set(registry.queries()) - set(registry.oracle_sql()) <= registry.TRAINING


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["seller_id", "seller_state", "revenue"]
    assert result.count() > 0
