"""SQL text of each registered query, for DuckDB, used as the oracle.

The SQL is generated from the same column groups as the Spark plans, as a
chain of CTEs that mirrors the stages: applicants → dedupe → text repair →
fill → cap → log → features → codes → scaling.
"""

from __future__ import annotations

from ..schema import (CATEGORICAL, DERIVED, EXPENSES, GENDER_MAP, INTEGER, IQR_FENCE,
                      MISSING_LABEL, NA_TOKENS, NUMERIC, RAW_SCHEMA, SCALED, SKEWED,
                      TARGET_AMOUNT, TARGET_CLASS, TITLE_CASED)
from ..sources.applicants import applicants_sql
from pyspark.sql import types as T

NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

RAW_STRING = {f.name for f in RAW_SCHEMA.fields if isinstance(f.dataType, T.StringType)}
RAW_COLS = [f.name for f in RAW_SCHEMA.fields]
FEATURE_CATS = [c for c in RAW_COLS if c in CATEGORICAL]
FEATURE_NUMS = [c for c in RAW_COLS if c in NUMERIC]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(e):
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def na_to_null(e):
    toks = ", ".join(q(t) for t in NA_TOKENS)
    return f"(CASE WHEN {e} IN ({toks}) THEN NULL ELSE {e} END)"


def title_case(e):
    return (f"array_to_string(list_transform(regexp_extract_all({e}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
            f"lambda w: upper(w[1]) || lower(w[2:])), '')")


def clean_category(e):
    return strip(title_case(f"coalesce({e}, {q(MISSING_LABEL.lower())})"))


def clean_gender(e):
    key = f"lower({strip(f'coalesce({e}, {q(MISSING_LABEL.lower())})')})"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in GENDER_MAP.items())
    return f"(CASE {key} {whens} END)"


def parse_number(e):
    return (f"(CASE WHEN regexp_matches({e}, '{NUMBER_PATTERN}') "
            f"THEN TRY_CAST({strip(e)} AS DOUBLE) END)")


def numeric_text(e):
    return parse_number(f"replace(replace(CAST({e} AS VARCHAR), '.0.0', ''), '.0', '')")


def extract_age(e):
    return f"TRY_CAST(regexp_extract({e}, '(\\d+)', 1) AS DOUBLE)"


def r6(e):
    return f"round({e}, 6)"


def applicants():
    """CTE prefix defining ``applicants``."""
    return applicants_sql("orders")


def text_ctes():
    """CTEs ``_dedup`` and ``_text`` (after ``applicants``)."""
    sel = []
    for c in RAW_COLS:
        e = c
        if c in RAW_STRING:
            e = na_to_null(e)
        if c == "age":
            e = extract_age(e)
        elif c == "gender":
            e = clean_gender(e)
        elif c in TITLE_CASED:
            e = clean_category(e)
        if c in NUMERIC:
            if c == "age":
                pass
            elif c in RAW_STRING:
                e = numeric_text(e)
            else:
                e = f"CAST({e} AS DOUBLE)"
            if c in INTEGER:
                e = f"round_even({e}, 0)"
        sel.append(f"{e} AS {c}")
    return (",\n_dedup AS (SELECT DISTINCT * FROM applicants),\n"
            f"_text AS (SELECT {', '.join(sel)} FROM _dedup)\n")


def typed_inputs():
    """Raw inputs as entered, with numbers parsed."""
    sel = []
    for c in RAW_COLS:
        e = na_to_null(c) if c in RAW_STRING else c
        if c == "age":
            e = extract_age(e)
        elif c in NUMERIC:
            e = numeric_text(e) if c in RAW_STRING else f"CAST({e} AS DOUBLE)"
        sel.append(f"{e} AS {c}")
    return ", ".join(sel)


def mode_sql(col, src):
    return (f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} ASC LIMIT 1)")


def fill_ctes(src="_text"):
    """``_med`` (medians + modes) and ``_filled``."""
    fill_cats = [c for c in FEATURE_CATS if c not in TITLE_CASED]
    meds = ", ".join(f"median({c}) AS m_{c}" for c in FEATURE_NUMS)
    modes = ", ".join(f"{mode_sql(c, src)} AS o_{c}" for c in fill_cats)
    sel = []
    for c in RAW_COLS:
        if c in NUMERIC:
            sel.append(f"coalesce({c}, m_{c}) AS {c}")
        elif c in fill_cats:
            sel.append(f"coalesce({c}, o_{c}) AS {c}")
        else:
            sel.append(c)
    return (f",\n_med AS (SELECT {meds}, {modes} FROM {src}),\n"
            f"_filled AS (SELECT {', '.join(sel)} FROM {src}, _med)\n")


def cap_ctes(src="_filled"):
    """``_q`` (quartiles and bounds) and ``_capped``."""
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
                   for c in FEATURE_NUMS)
    bounds = ", ".join(
        f"q1_{c} - {IQR_FENCE} * (q3_{c} - q1_{c}) AS lo_{c}, "
        f"q3_{c} + {IQR_FENCE} * (q3_{c} - q1_{c}) AS hi_{c}" for c in FEATURE_NUMS)
    sel = [f"greatest(lo_{c}, least(hi_{c}, {c})) AS {c}" if c in NUMERIC else c
           for c in RAW_COLS]
    return (f",\n_q0 AS (SELECT {qs} FROM {src}),\n"
            f"_q AS (SELECT *, {bounds} FROM _q0),\n"
            f"_capped AS (SELECT {', '.join(sel)} FROM {src}, _q)\n")


def log_cte(src="_capped", name="cleaned"):
    sel = [f"(CASE WHEN {c} > -1 THEN ln(1 + {c}) END) AS {c}" if c in SKEWED else c
           for c in RAW_COLS]
    return f",\n{name} AS (SELECT {', '.join(sel)} FROM {src})\n"


def cleaned_prefix():
    """CTEs through ``cleaned`` (dedupe, text, fill, cap, log1p)."""
    return applicants().rstrip("\n") + text_ctes() + fill_ctes() + cap_ctes() + log_cte()


def filled_prefix():
    """CTEs through ``_filled`` (no capping, raw scale)."""
    return applicants().rstrip("\n") + text_ctes() + fill_ctes()


def derived_exprs(form="training"):
    """(name, expr) of the nine derived features referencing earlier ones
    by expression text (DuckDB has no lateral aliases in all positions)."""
    def div(a, b):
        if form == "training":
            return f"({a}) / nullif({b}, 0)"
        return f"({a}) / greatest({b}, 1)"

    tme = " + ".join(f"coalesce({c}, 0)" for c in EXPENSES)
    tme = f"({tme})"
    disp = f"(monthly_salary - {tme} - current_emi_amount)"
    inst = div("requested_amount", "requested_tenure")
    out = [
        ("debt_to_income", div("current_emi_amount", "monthly_salary")),
        ("total_monthly_expenses", tme),
        ("expense_to_income", div(tme, "monthly_salary")),
        ("monthly_disposable", disp),
        ("instalment_if_approved", inst),
        ("affordability_ratio", div(disp, f"({inst})")),
        ("employment_stability", div("years_of_employment", "age")),
        ("loan_to_income_ratio", div("requested_amount", "monthly_salary")),
        ("dependents_ratio", div("dependents", "family_size")),
    ]
    assert tuple(n for n, _ in out) == DERIVED
    return out


def features_cte(src, name="feat", form="training"):
    """``name`` = src.* plus the derived features (non-finite → NULL)."""
    sel = ", ".join(
        f"(CASE WHEN isnan({e}) OR isinf({e}) THEN NULL ELSE {e} END) AS {n}"
        for n, e in derived_exprs(form))
    return f",\n{name} AS (SELECT *, {sel} FROM {src})\n"


__all__ = [
    "CATEGORICAL", "SCALED", "TARGET_AMOUNT", "TARGET_CLASS", "applicants", "cleaned_prefix",
    "features_cte", "filled_prefix", "r6",
]
