"""Every registered query against its DuckDB SQL on the smallest tables."""

import os

import duckdb
import pytest

from lodestone.plans import catalogue

SF = os.environ.get("LODESTONE_TEST_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    out = [tuple(round(r[k], 6) if isinstance(r[k], float) else r[k] for k in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_matches_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if name not in catalogue.oracle_sql():
        assert rows
        return
    res = duck.execute(catalogue.oracle_sql()[name])
    names = [c[0] for c in res.description]
    assert sorted(names) == sorted(got.columns)
    assert norm(rows, got.columns) == norm(res.fetchall(), names)
