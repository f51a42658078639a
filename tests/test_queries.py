"""Every registered query of the matrix engine against its SQL, order aside."""

import os

import duckdb
import pandas as pd
import pytest

from amplicore.plans import catalog

SF_DIR = os.environ.get("AMPLICORE_TEST_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and v != v:
            return None
        v = v.item() if hasattr(v, "item") else v
        return round(v, 5) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return sorted((tuple(plain(v) for v in r) for r in df[sorted(df.columns)].astype(object).values.tolist()), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF_DIR).count() > 0
