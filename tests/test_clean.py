import pytest
from pyspark.sql import functions as F

from credit_spark.operators import clean as C
from credit_spark.operators import correlate as K
from credit_spark.operators import encode as E
from credit_spark.plans import stages as S
from credit_spark.schema import CATEGORICAL, NUMERIC, TITLE_CASED
from tests.conftest import SF_SMALL


def test_duplicates_nan_null_signed_zero(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, float("nan")), (1, 0.0), (1, -0.0)],
                               "a int, b double")
    assert C.dedupe(df).count() == 2
    rep = C.dedupe_report(df).first()
    assert (rep.rows_before, rep.rows_after, rep.rows_removed) == (4, 2, 2)


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "gender string")
    st = C.fit_fill(df)
    assert st.modes["gender"] == "a"


def test_iqr_quartiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "x double")
    q1, q3 = C.fit_quartiles(df, ["x"])
    assert (q1["x"], q3["x"]) == (1.75, 5.25)
    st = C.fit_fill(df)
    assert st.medians["x"] == 3.0


def test_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    assert K.pair_values(df, [("a", "b")])[("a", "b")] is None
    st = E.fit_scaler(df, ["a"])
    assert E.standardize(df, st, ["a"]).agg(F.max(F.abs("a"))).first()[0] == 0.0


def test_cleaning_invariants(spark):
    cleaned, st = S.cleaned(spark, SF_SMALL, return_stats=True)
    rows = cleaned.count()
    assert rows == cleaned.dropDuplicates().count()
    # No NULL left in features after filling.
    nulls = cleaned.select([F.count_if(F.col(c).isNull()).alias(c) for c in NUMERIC + CATEGORICAL]).first()
    assert all(v == 0 for v in nulls)
    # Capped values lie within their bounds (checked before the log step).
    capped = S.capped(spark, SF_SMALL)
    for c in NUMERIC:
        lo, hi = st.bounds(c)
        mn, mx = capped.agg(F.min(c), F.max(c)).first()
        assert lo - 1e-9 <= mn and mx <= hi + 1e-9, c


def test_text_cleaning_idempotent(spark):
    t = S.text(spark, SF_SMALL, persist=False)
    again = C.clean_text(t)
    diff = t.select(*TITLE_CASED, "gender").exceptAll(again.select(*TITLE_CASED, "gender"))
    assert diff.count() == 0


def test_missing_required_column(spark):
    df = spark.createDataFrame([("1",)], "age string")
    with pytest.raises(ValueError):
        C.clean_text(df)
