"""Every registered query against its DuckDB oracle on the smallest test tables
(the driver repeats this at sf0.01)."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from hearth.plans.forms import FORMS
from hearth.plans.testbed import QUERIES
from hearth.plans.testbed_all import DERIVED_QUERIES, DERIVED_SQL

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


# the warehouse queries; the optional training-data queries have tests of their own
ALL = QUERIES | DERIVED_QUERIES
# of the form tables, which run the same code, a plain one, a grouped one and one that is scanned without its type
FEW_FORMS = {"m_asthma_followup", "m_epilepsy_initial", "m_art_visits"}
NAMES = sorted(set(E.queries()) & set(ALL) - {f"m_{f[3:]}" for f in FORMS} | FEW_FORMS)


def test_every_query_has_an_oracle():
    assert not set(QUERIES) & set(DERIVED_QUERIES) and set(DERIVED_QUERIES) == set(DERIVED_SQL)
    assert set(ALL) <= set(E.queries()) and not set(ALL) - set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[name])
    d_cols, d_rows = [d[0] for d in rel.description], rel.fetchall()
    assert _canon(s_cols, s_rows) == _canon(d_cols, d_rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["c_custkey", "c_mktsegment"]
    assert df.count() >= 0
