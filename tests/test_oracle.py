"""Every registered query against its DuckDB oracle on sf0.01 (order-insensitive)."""

from __future__ import annotations

import pytest

import __spark_entry__ as ent
from lexisieve.plans.oracle import SQL
from conftest import SF_ORACLE
from tools.check_oracle import SPARK_TO_DUCK, digest, duck

NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF_ORACLE)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    rel = con.sql(ent.oracle_sql()[name])
    drows, dcols = rel.fetchall(), rel.columns
    assert sorted(cols) == sorted(dcols)
    stypes = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in df.schema.fields}
    assert stypes == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert len(rows) == len(drows)
    assert digest(rows, cols) == digest(drows, dcols)


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.columns == ["req_id", "part", "line"]
    assert df.count() > 0
