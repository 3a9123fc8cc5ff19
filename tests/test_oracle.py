"""Every SQL-checked query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

from conftest import SF0001

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return str(v).replace("T", " ")
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    srecs = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    a, b = _rows(df.columns, srecs), _rows(rel.columns, rel.fetchall())
    assert len(a) == len(b)
    assert [repr(x) for x in a] == [repr(x) for x in b]


def test_every_query_has_oracle_or_is_rows_only():
    from tickforge.plans import catalog
    rows_only = set(catalog.queries()) - set(catalog.oracle_sql())
    assert rows_only <= {"text_embedding", "gold", "boosted_tree_scores", "linear_scores",
                         "heldout_metrics", "param_search", "refit_metrics", "forecast"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "target" == df.columns[-1]
