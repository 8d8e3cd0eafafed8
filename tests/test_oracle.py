"""Every registered query with an oracle, at sf0.001, against DuckDB."""

import math

import duckdb
import pytest

from demandflow.plans.registry import load_all
from demandflow.sources.observations import TABLES

SF = "/root/testdata/sf0.001"
REG = load_all()
NAMES = [n for n, (_, sql) in REG.items() if sql is not None]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def canon(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, repr(round(v, 9) + 0.0))
    if isinstance(v, (int, bool)):
        return (2, repr(float(v)))
    return (3, str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    fn, sql = REG[name]
    sdf = fn(spark, SF)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(c.lower() for c in sdf.columns) == sorted(c.lower() for c in dcols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(dcols, res.fetchall())
