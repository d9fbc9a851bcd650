"""Every query with SQL gives the SQL's rows on the small tables."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.exists(DATA), reason="needs the synthetic tables")
@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op")))
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = entry.queries()[name](spark, DATA)
    cell = lambda x: "" if x is None or x != x else repr(float(x)) if isinstance(x, int | float) and not isinstance(x, bool) else str(x)
    order = sorted(df.columns)
    got = sorted(tuple(cell(r[c]) for c in order) for r in df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = sorted(tuple(cell(dict(zip(names, r, strict=True))[c]) for c in order) for r in cur.fetchall())
    assert sorted(names) == order and got == want
