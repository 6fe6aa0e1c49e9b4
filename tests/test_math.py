from pyspark.sql import functions as F

from credit_spark.functions import math as M
from credit_spark.operators import features as FE


def col(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_round_half_even(spark):
    assert col(spark, [0.5, 2.5, 3.5, -2.5], M.round_half_even) == [0.0, 2.0, 4.0, -2.0]


def test_log_domain(spark):
    assert col(spark, [0.0, -1.0, -2.0], M.log1p) == [0.0, None, None]


def test_clamp(spark):
    assert col(spark, [-3.0, float("nan"), 12.345, None], M.clamp_amount) == [0.0, 0.0, 12.34, 0.0]


def test_clip_keeps_null(spark):
    assert col(spark, [None, 10.0, -5.0], lambda c: M.clip(c, 0.0, 5.0)) == [None, 5.0, 0.0]


def test_expense_nulls_count_as_zero(spark):
    from credit_spark.schema import EXPENSES
    df = spark.createDataFrame([(None,) * 6, (1.0, None, 2.0, None, None, 3.0)],
                               ", ".join(f"{c} double" for c in EXPENSES))
    assert [r[0] for r in df.select(M.row_sum(EXPENSES)).collect()] == [0.0, 6.0]


def test_zero_denominator_forms(spark):
    df = spark.createDataFrame([(100.0, 0.0, 0.0, 1.0, 30.0, 1.0, 2.0, 4.0, 1000.0, 12.0)] +
                               [(100.0, 0.5, 0.0, 1.0, 30.0, 1.0, 2.0, 4.0, 1000.0, 12.0)],
                               "current_emi_amount double, monthly_salary double, school_fees double, "
                               "college_fees double, age double, years_of_employment double, "
                               "dependents double, family_size double, requested_amount double, "
                               "requested_tenure double")
    df = df.withColumns({c: F.lit(0.0) for c in ("travel_expenses", "groceries_utilities",
                                                  "other_monthly_expenses", "monthly_rent")})
    t = FE.derive(df, "training").select("debt_to_income").collect()
    s = FE.derive(df, "scoring").select("debt_to_income").collect()
    assert t[0][0] is None and s[0][0] == 100.0
    assert t[1][0] == 200.0 and s[1][0] == 100.0
