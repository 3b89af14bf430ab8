"""Every query with SQL against DuckDB on the smallest tables."""

import math

import pytest

import __spark_entry__ as entry

SQL = entry.oracle_sql()
QUERIES = entry.queries()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return str([plain(x) for x in v])
    return str(v)


@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith("p1_")))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in cur.fetchall())
    assert got == want


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
