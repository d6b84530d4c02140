"""Every query with an oracle gives the rows that DuckDB gives."""

from __future__ import annotations

from pathlib import Path

import pytest

from sparkquill.plans import catalog, mechanisms

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = catalog.QUERIES | mechanisms.QUERIES, catalog.ORACLES | mechanisms.ORACLES
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    held = duckdb.connect()
    held.execute("set timezone = 'UTC'")
    for name in TABLES:
        held.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return held


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    found = QUERIES[name](spark, str(DATA))
    rows = found.collect()
    if name not in ORACLES:
        assert rows
        return
    wanted = tables.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    assert _rows(found.columns, rows) == _rows(columns, wanted.fetchall())


def test_flagship(spark):
    assert catalog.flagship(spark, str(DATA)).count() > 0
