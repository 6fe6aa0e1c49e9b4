"""Derived affordability features (one projection, no aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import math as M
from ..schema import DERIVED, EXPENSES


def derived_columns(form: str = "training") -> dict:
    """Expressions of the nine derived features, in creation order.

    ``training``: a zero denominator makes the ratio missing.
    ``scoring``: the denominator is floored at 1.
    Later entries refer to earlier ones; ``withColumns`` resolves them in
    order inside a single Project."""
    div = M.safe_div if form == "training" else M.floor_one_div
    c = F.col
    return {
        "debt_to_income": div(c("current_emi_amount"), c("monthly_salary")),
        "total_monthly_expenses": M.row_sum(EXPENSES),
        "expense_to_income": div(c("total_monthly_expenses"), c("monthly_salary")),
        "monthly_disposable": (c("monthly_salary") - c("total_monthly_expenses")
                               - c("current_emi_amount")),
        "instalment_if_approved": div(c("requested_amount"), c("requested_tenure")),
        "affordability_ratio": div(c("monthly_disposable"), c("instalment_if_approved")),
        "employment_stability": div(c("years_of_employment"), c("age")),
        "loan_to_income_ratio": div(c("requested_amount"), c("monthly_salary")),
        "dependents_ratio": div(c("dependents"), c("family_size")),
    }


def derive(df: DataFrame, form: str = "training") -> DataFrame:
    """Append the nine derived features; NaN/±inf among them become NULL.
    Unused ones are pruned by the optimizer."""
    df = df.withColumns(derived_columns(form))
    return df.withColumns({n: M.nullify_nonfinite(F.col(n)) for n in DERIVED})


def nullify_infinities(df: DataFrame, cols=None) -> DataFrame:
    """NaN/±inf → NULL on the given (default: all floating) columns."""
    from pyspark.sql.types import DoubleType, FloatType
    cols = cols or [f.name for f in df.schema.fields
                    if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: M.nullify_nonfinite(F.col(c)) for c in cols})
