"""Physical-plan properties: pushdown, pruning, no Python in the hot path."""
import re

import pytest

import __spark_entry__ as E
from credit_spark.plans import stages as S
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_reads_three_order_columns(spark):
    p = plan(E.queries()["risk_summary"](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    raw = plan(S.raw(spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in raw


def test_id_lookup_is_pushed_to_the_scan(spark):
    p = plan(E.queries()["rows_by_id"](spark, SF_SMALL))
    assert "PushedFilters" in p and "o_orderkey" in p.split("PushedFilters")[1][:200]


def test_cleaning_has_one_dedupe_shuffle_and_no_udf(spark):
    from credit_spark.operators import clean as C
    text = C.clean_text(C.dedupe(S.raw(spark, SF_SMALL)))
    p = plan(text)
    # The dedupe, and the round-robin that only a source below SPREAD_BYTES gets.
    assert sorted(re.findall(r"Exchange (\w+)", p)) == ["RoundRobinPartitioning", "hashpartitioning"]
    assert "PythonUDF" not in p


def test_a_large_source_is_not_moved_before_the_dedupe(spark, monkeypatch):
    from credit_spark.operators import clean as C
    from credit_spark.sources import applicants as A
    monkeypatch.setattr(A, "SPREAD_BYTES", 0)
    p = plan(C.clean_text(C.dedupe(A.load_applicants(spark, SF_SMALL))))
    assert re.findall(r"Exchange (\w+)", p) == ["hashpartitioning"]


@pytest.mark.parametrize("name,step", [("select_by_correlation", "select_features"), ("prune_correlated", "select_features"),
                                       ("correlation_matrix", "correlation_matrix")])
def test_correlations_read_a_written_model_table(spark, monkeypatch, name, step):
    """Several passes read every column; the cleaning and scaling expressions run in none of them."""
    from credit_spark.plans import queries_features as QF
    seen = []
    plain = getattr(QF.K, step)
    monkeypatch.setattr(QF.K, step, lambda df, *a, **k: (seen.append(df), plain(df, *a, **k))[1])
    E.queries()[name](spark, SF_SMALL)
    assert seen and all("model-table" in f for f in seen[0].inputFiles())
