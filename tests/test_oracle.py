"""Registered queries against their DuckDB oracle SQL at sf0.001."""
import math

import pytest

import __spark_entry__ as E
from credit_spark.plans.registry import ORACLE
from tests.conftest import SF_SMALL

# Every query of the applicant pipeline with SQL but the one that needs all
# models fitted in full (tools/check_oracle.py runs that too).
NAMES = sorted(set(ORACLE) - {"run_log_sizes"})

def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return round(float(v), 6)
    return v


def canon(rows, cols):
    out = [tuple(norm(r[c]) for c in cols) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [r.asDict() for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    drows = [dict(zip(cols, r)) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(cols)
    key = sorted(cols)
    assert canon(srows, key) == canon(drows, key)


def test_every_query_has_a_callable_and_most_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80 and len(o) >= 70


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["class", "applicants", "debt_fails", "expense_fails", "affordability_fails"]
    assert df.count() == 3
