"""Every registered query of the engine against its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from corpus_helpers import SF
from invdex.plans.catalog import QUERIES
from invdex.plans.oracles import ORACLES

SF1 = f"{SF}/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["documents", "benchmark", "conversations"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF1}/{t}.parquet')")
    return c


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF1)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _norm(df.columns, df.collect()) == _norm(cols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_name"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries())


# Index statistics of the sf0.01 documents table.
SF01_SIZES = dict(n_terms=93_796, n_postings=272_716, plain_bytes=1_609_556, vb_bytes=388_325,
                  gamma_bytes=455_355)


def test_index_size_sf001(spark):
    row = E.queries()["index_size"](spark, f"{SF}/sf0.01").first().asDict()
    assert row == SF01_SIZES
