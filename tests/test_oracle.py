"""Differential test: every registered query against its DuckDB oracle on the smallest driver tables."""
import math

import duckdb
import pandas as pd
import pytest

from playledger.plans.analogs import TABLES
from playledger.plans.catalog import load_all
from tests.conftest import SF_SMALL


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(pdf):
    cols = sorted(pdf.columns)
    out = []
    for r in pdf[cols].astype(object).to_dict("records"):
        vals = []
        for c in cols:
            x = norm(r[c])
            if isinstance(x, float) and x == int(x):
                x = int(x)
            vals.append(repr(x))
        out.append(tuple(vals))
    return cols, sorted(out)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in load_all().items() if sql))
def test_matches_oracle(spark, con, name):
    fn, sql = load_all()[name]
    got = canon(fn(spark, SF_SMALL).toPandas())
    want = canon(con.execute(sql).fetchdf())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
