"""Every registered query of the corpus operators against its SQL twin, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from corpusflow import queries, unit_queries  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(df: pd.DataFrame) -> list[tuple]:
    show = lambda x: "null" if x is None or x is pd.NA or x != x else repr(round(float(x), 6)) if isinstance(x, (int, float)) and not isinstance(x, bool) or hasattr(x, "dtype") and x.dtype.kind in "if" else str(x)
    return sorted(tuple(map(show, row)) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = db.execute(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_entry_module_imports_and_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
