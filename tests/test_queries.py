"""Every query against its SQL counterpart on the smallest tables, as the driver compares them."""

import duckdb
import pytest

from skein.plans.library import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def shown(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    rows = sorted(tuple(map(shown, r)) for r in df.select(sorted(df.columns)).collect())
    assert rows
    if name in ORACLE_SQL:
        got = duck.sql(ORACLE_SQL[name])
        order = sorted(range(len(got.columns)), key=lambda i: got.columns[i])
        assert sorted(df.columns) == [got.columns[i] for i in order]
        assert rows == sorted(tuple(shown(r[i]) for i in order) for r in got.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
