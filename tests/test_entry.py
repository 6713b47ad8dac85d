"""Driver contract: entry() smoke, and every query against its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from planekit.plans.catalog import ORACLE, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["probe_id", "n_matches"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def _canon(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(repr(v) for v in r) for r in pdf.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    s = E.queries()[name](spark, SF001).toPandas()
    o = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert _canon(s) == _canon(o)
