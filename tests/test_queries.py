"""Registered queries against their SQL at the smallest size."""

import duckdb
import pytest

from chronoweave.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def canonical(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    text = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(columns), sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    got = canonical(df.columns, df.collect())
    if name in SQL:
        rel = con.sql(SQL[name])
        assert got == canonical(rel.columns, rel.fetchall())
    else:
        assert got[1]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
