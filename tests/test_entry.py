"""The driver's contract, and every query that has SQL against it on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else str(round(value, 6))
    return str(round(float(value), 6)) if type(value).__name__ == "Decimal" else str(value)


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = con.execute(entry.oracle_sql()[name])
    theirs = [x[0] for x in result.description]
    assert sorted(theirs) == columns
    at = [theirs.index(c) for c in columns]
    assert ours == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())
