"""Every registered query of the lot against its DuckDB SQL on the smallest tables."""

import os

import duckdb
import pytest

from vestigo.plans import more, queries as plans  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _value(v):
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(_value, v))
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    found = duck.execute(plans.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, found.fetchall())


def test_entry_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "rates_wilson" in e.queries()
