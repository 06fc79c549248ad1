"""Every SQL-checked query equals its DuckDB oracle (sf0.001, order-insensitive, exact values)."""

import math

import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

# The optional operators have tests of their own.
NAMES = sorted(n for n in entry.oracle_sql() if not n.startswith(("op", "pipeline")))


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_parity(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    drows = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert srows == drows
