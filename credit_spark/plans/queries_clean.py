"""Registered queries: scan, dedupe, text repair, fill, cap, profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import math as M
from ..functions import text as X
from ..operators import clean as C
from ..operators import features as FE
from ..operators import profile as P
from ..operators import recommend as R
from ..schema import (CATEGORICAL, DOMAINS, FEATURES, ID, INTEGER, NUMERIC, RANGES, RAW_COLUMNS, RAW_SCHEMA,
                      SKEWED, TARGET_AMOUNT, TARGET_CLASS, TITLE_CASED, cleaned_schema)
from ..session import scratch_path
from ..sources import applicants as A
from . import oracle as O
from . import stages as S
from .catalog import register, rounded

APP = O.applicants()
CLEANED = O.cleaned_prefix()
FILLED = O.filled_prefix()
TEXT = APP.rstrip("\n") + O.text_ctes()
CAPPED = FILLED.rstrip("\n") + O.cap_ctes()
CLEAN_COLS = list(RAW_COLUMNS)


def _cols(cols, double=()):
    return ", ".join(O.r6(c) + f" AS {c}" if c in double else c for c in cols)


DOUBLES_CLEAN = set(NUMERIC) | {TARGET_AMOUNT}

# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------


@register("scan_applicants", APP + f"SELECT {_cols(CLEAN_COLS, {'years_of_employment', 'monthly_rent', 'school_fees', 'college_fees', 'travel_expenses', 'groceries_utilities', 'other_monthly_expenses', 'current_emi_amount', 'credit_score', 'emergency_fund', 'requested_amount', TARGET_AMOUNT})} FROM applicants")
def scan_applicants(spark, sf_dir):
    """Raw applicants written as CSV to the shared folder, then scanned
    back by header name (numbers stay STRING, as written), and cast."""
    path = scratch_path(spark, "applicants-csv")
    A.write_csv(S.raw(spark, sf_dir), path)
    back = A.read_applicants_csv(spark, path)
    return rounded(back.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields]))


@register("clean_csv_numbers", TEXT + f"SELECT {_cols(CLEAN_COLS, DOUBLES_CLEAN)} FROM (SELECT * REPLACE ("
          "CASE applicant_id % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 720.0 WHEN 3 THEN 105.0 "
          "ELSE NULL END AS credit_score) FROM _text)")
def clean_csv_numbers(spark, sf_dir):
    """Dirty numbers in a CSV column (``nan``, ``inf``, ``720.0.0``,
    ``10.05``, ``NA``), read back by header name and repaired."""
    dirty = F.element_at(F.array(*map(F.lit, ("nan", "inf", "720.0.0", "10.05", "NA"))),
                         (F.col(ID) % 5 + 1).cast("int"))
    path = scratch_path(spark, "dirty-csv")
    raw = S.raw(spark, sf_dir).withColumn("credit_score", dirty)
    A.write_csv(raw.select(*reversed(raw.columns)), path)
    return rounded(C.clean_text(C.dedupe(A.read_applicants_csv(spark, path))).select(*RAW_COLUMNS))


# A file as it comes from elsewhere: a note that the schema doesn't know, with quoted line breaks; rows
# with a field too many or with fields missing; ids that are no numbers.
_SURPLUS, _SHORT, _ODD_ID = "applicant_id % 11 = 3", "applicant_id % 13 = 5", "applicant_id % 17 = 7"
_BAD_ROW = f"({_SURPLUS} OR {_SHORT})"
_NOTE = ("CASE WHEN applicant_id % 5 = 0 THEN concat('first line', chr(10), 'second, \"quoted\"') "
         "ELSE concat('n', CAST(applicant_id AS {text})) END")


FILE_ROWS = 100_000


def _ingested(spark, sf_dir):
    """The applicants as lines of such a file, written to the shared folder and taken in."""
    raw = S.raw(spark, sf_dir)
    texts = [F.expr(f"CASE WHEN {_ODD_ID} THEN concat('A-', applicant_id) ELSE CAST(applicant_id AS STRING) END")
             if c == ID else F.col(c).cast("string") for c in RAW_COLUMNS]
    texts.append(F.expr(_NOTE.format(text="STRING")))
    fields = [F.coalesce(F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
              for t in texts]
    line = F.when(F.expr(_SURPLUS), F.concat_ws(",", *fields, F.lit('"surplus"'))).when(
        F.expr(_SHORT), F.concat_ws(",", *fields[:6])).otherwise(F.concat_ws(",", *fields))
    path = scratch_path(spark, "foreign-csv")
    # Such a file is read by one task, so there are many, however few tasks write them.
    raw.select(line.alias("value")).write.option("maxRecordsPerFile", FILE_ROWS).text(path)
    return A.ingest_applicants_csv(spark, path, scratch_path(spark, "ingested"), [*RAW_COLUMNS, "note"])


@register("ingest_kept", APP + f"SELECT {_cols(CLEAN_COLS, {f.name for f in RAW_SCHEMA.fields if f.dataType.typeName() == 'double'})}, "
          f"{_NOTE.format(text='VARCHAR')} AS note FROM applicants WHERE NOT {_BAD_ROW} AND NOT ({_ODD_ID})")
def ingest_kept(spark, sf_dir):
    """Rows of a foreign CSV that fit, with the column that the schema doesn't know."""
    kept = _ingested(spark, sf_dir).kept
    return rounded(kept.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields], "note"))


@register("ingest_rejected", APP + f"""SELECT applicant_id, CASE WHEN {_BAD_ROW} THEN 'columns' ELSE 'id' END AS reason
FROM applicants WHERE {_BAD_ROW} OR {_ODD_ID}""")
def ingest_rejected(spark, sf_dir):
    """Rows that are set aside, known by what stands in their first field."""
    return _ingested(spark, sf_dir).rejected.select(
        F.regexp_extract("record", '^"(?:A-)?([0-9]+)"', 1).cast("long").alias("applicant_id"), "reason")


@register("ingest_counts", APP + f"""SELECT CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (WHERE NOT {_BAD_ROW} AND NOT ({_ODD_ID})) AS BIGINT) AS kept,
  CAST(count(*) FILTER (WHERE {_BAD_ROW}) AS BIGINT) AS rejected_columns,
  CAST(count(*) FILTER (WHERE NOT {_BAD_ROW} AND {_ODD_ID}) AS BIGINT) AS rejected_id FROM applicants""")
def ingest_counts(spark, sf_dir):
    """What the ingest observed while it wrote, beside what then lies there."""
    got = _ingested(spark, sf_dir)
    there = (got.rejected.groupBy().agg(F.count_if(F.col("reason") == "columns").alias("rejected_columns"),
                                        F.count_if(F.col("reason") == "id").alias("rejected_id"))
             .crossJoin(got.kept.groupBy().agg(F.count(F.lit(1)).alias("kept"))))     # one row each
    return there.select(F.lit(got.counts["rows"]).cast("long").alias("rows"), "kept", "rejected_columns", "rejected_id")


# ---------------------------------------------------------------------------
# Deduplication
# ---------------------------------------------------------------------------


@register("dedupe_rows", APP + f"SELECT DISTINCT {_cols(CLEAN_COLS, {TARGET_AMOUNT})} FROM applicants")
def dedupe_rows(spark, sf_dir):
    return rounded(C.dedupe(S.raw(spark, sf_dir)))


@register("dedupe_report", APP + """SELECT CAST(sum(n) AS BIGINT) AS rows_before,
  CAST(count(*) AS BIGINT) AS rows_after, CAST(sum(n) - count(*) AS BIGINT) AS rows_removed
FROM (SELECT count(*) AS n FROM applicants GROUP BY ALL_COLS)""".replace(
    "ALL_COLS", ", ".join(RAW_COLUMNS)))
def dedupe_report(spark, sf_dir):
    return C.dedupe_report(S.raw(spark, sf_dir))


# ---------------------------------------------------------------------------
# Text repair (per row, on the raw table)
# ---------------------------------------------------------------------------


@register("clean_age", APP + f"SELECT applicant_id, age AS age_text, {O.extract_age(O.na_to_null('age'))} AS age FROM applicants")
def clean_age(spark, sf_dir):
    r = S.raw(spark, sf_dir)
    return r.select(ID, F.col("age").alias("age_text"),
                    X.extract_age(X.na_to_null("age")).alias("age"))


@register("clean_gender", APP + f"SELECT applicant_id, gender AS gender_text, {O.clean_gender(O.na_to_null('gender'))} AS gender FROM applicants")
def clean_gender(spark, sf_dir):
    r = S.raw(spark, sf_dir)
    return r.select(ID, F.col("gender").alias("gender_text"),
                    X.clean_gender(X.na_to_null("gender")).alias("gender"))


@register("title_case_categories", APP + "SELECT applicant_id, "
          + ", ".join(f"{O.clean_category(O.na_to_null(c))} AS {c}" for c in TITLE_CASED)
          + " FROM applicants")
def title_case_categories(spark, sf_dir):
    r = S.raw(spark, sf_dir)
    return r.select(ID, *[X.clean_category(X.na_to_null(c)).alias(c) for c in TITLE_CASED])


_NUM_TEXT_COLS = [c for c in RAW_COLUMNS if c in NUMERIC and c != "age"]


@register("clean_numeric_strings", APP + "SELECT applicant_id, "
          + ", ".join(O.r6(O.numeric_text(O.na_to_null(c)) if c in O.RAW_STRING
                           else f"CAST({c} AS DOUBLE)") + f" AS {c}" for c in _NUM_TEXT_COLS)
          + " FROM applicants")
def clean_numeric_strings(spark, sf_dir):
    r = S.raw(spark, sf_dir)
    dt = {f.name: f.dataType for f in r.schema.fields}
    return rounded(r.select(ID, *[X.numeric_value(X.na_to_null(c) if c in O.RAW_STRING
                                                  else F.col(c), dt[c]).alias(c)
                                  for c in _NUM_TEXT_COLS]))


_COMMA = ("age", "monthly_salary", "bank_balance")


@register("clean_comma_numbers", APP + "SELECT applicant_id, "
          + ", ".join(O.r6(O.parse_number(f"replace({c}, ',', '')")) + f" AS {c}" for c in _COMMA)
          + " FROM applicants")
def clean_comma_numbers(spark, sf_dir):
    r = S.raw(spark, sf_dir)
    return rounded(r.select(ID, *[X.comma_number(c).alias(c) for c in _COMMA]))


@register("age_before_dot", APP + f"SELECT applicant_id, {O.parse_number('split_part(age, ' + chr(39) + '.' + chr(39) + ', 1)')} AS age FROM applicants")
def age_before_dot(spark, sf_dir):
    return S.raw(spark, sf_dir).select(ID, X.before_dot("age").alias("age"))


@register("coerce_salary", APP + f"SELECT applicant_id, {O.r6(O.parse_number('monthly_salary'))} AS monthly_salary FROM applicants")
def coerce_salary(spark, sf_dir):
    return rounded(S.raw(spark, sf_dir).select(ID, X.coerce_number("monthly_salary").alias("monthly_salary")))


@register("round_int_columns", TEXT + "SELECT applicant_id, " + ", ".join(INTEGER) + " FROM _text")
def round_int_columns(spark, sf_dir):
    return S.text(spark, sf_dir).select(ID, *INTEGER)


@register("text_repair", TEXT + f"SELECT {_cols(CLEAN_COLS, DOUBLES_CLEAN)} FROM _text")
def text_repair(spark, sf_dir):
    """Deduplicated table after all per-value repairs (before filling)."""
    return rounded(S.text(spark, sf_dir))


# ---------------------------------------------------------------------------
# Fill, cap, log
# ---------------------------------------------------------------------------


@register("impute_median", FILLED + "SELECT applicant_id, " + ", ".join(
    f"{O.r6(c)} AS {c}" for c in RAW_COLUMNS if c in NUMERIC) + " FROM _filled")
def impute_median(spark, sf_dir):
    return rounded(S.filled(spark, sf_dir).select(ID, *[c for c in RAW_COLUMNS if c in NUMERIC]))


@register("impute_mode", FILLED + "SELECT applicant_id, " + ", ".join(
    c for c in RAW_COLUMNS if c in CATEGORICAL) + " FROM _filled")
def impute_mode(spark, sf_dir):
    return S.filled(spark, sf_dir).select(ID, *[c for c in RAW_COLUMNS if c in CATEGORICAL])


@register("cap_outliers_iqr", CAPPED + f"SELECT {_cols(CLEAN_COLS, DOUBLES_CLEAN)} FROM _capped")
def cap_outliers_iqr(spark, sf_dir):
    return rounded(S.capped(spark, sf_dir))


@register("iqr_bounds", CAPPED + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {O.r6(f'q1_{c}')} AS q1, {O.r6(f'q3_{c}')} AS q3, "
    f"{O.r6(f'lo_{c}')} AS lower, {O.r6(f'hi_{c}')} AS upper FROM _q"
    for c in RAW_COLUMNS if c in NUMERIC))
def iqr_bounds(spark, sf_dir):
    stats = S.clean_stats(spark, sf_dir)
    out = C.stats_table(spark, stats).where(F.col("q1").isNotNull())
    return rounded(out.select("column", "q1", "q3", "lower", "upper"))


@register("log1p_skewed", TEXT + "SELECT applicant_id, " + ", ".join(
    f"{O.r6(f'(CASE WHEN {c} > -1 THEN ln(1 + {c}) END)')} AS {c}" for c in SKEWED)
    + " FROM _text")
def log1p_skewed(spark, sf_dir):
    t = S.text(spark, sf_dir)
    return rounded(t.select(ID, *[M.log1p(c).alias(c) for c in SKEWED]))


@register("clean_applicants", CLEANED + f"SELECT {_cols(CLEAN_COLS, DOUBLES_CLEAN)} FROM cleaned")
def clean_applicants(spark, sf_dir):
    """The full cleaning step: dedupe, repair, fill, cap, log1p."""
    return rounded(S.cleaned(spark, sf_dir))


@register("export_cleaned", CLEANED + f"SELECT {_cols(CLEAN_COLS, DOUBLES_CLEAN)} FROM cleaned")
def export_cleaned(spark, sf_dir):
    """The cleaned table exported as CSV, and read again with its types and names."""
    cleaned = S.cleaned(spark, sf_dir)
    path = scratch_path(spark, "export-cleaned")
    A.write_csv(cleaned, path)
    return rounded(A.read_export(spark, path, cleaned.schema))


@register("column_stats", CAPPED + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {O.r6(f'm_{c}')} AS median, {O.r6(f'q1_{c}')} AS q1, "
    f"{O.r6(f'q3_{c}')} AS q3 FROM _q, _med" for c in RAW_COLUMNS if c in NUMERIC))
def column_stats(spark, sf_dir):
    stats = S.clean_stats(spark, sf_dir)
    out = C.stats_table(spark, stats).where(F.col("median").isNotNull() | F.col("q1").isNotNull())
    return rounded(out.select("column", "median", "q1", "q3"))


# ---------------------------------------------------------------------------
# Profile
# ---------------------------------------------------------------------------

_PROFILE_COLS = [c for c in RAW_COLUMNS if c != ID]


@register("null_counts", TEXT + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM _text"
    for c in _PROFILE_COLS))
def null_counts(spark, sf_dir):
    return P.null_counts(S.text(spark, sf_dir), _PROFILE_COLS)


@register("class_distribution", CLEANED + "SELECT emi_eligibility AS class, "
          "CAST(count(*) AS BIGINT) AS count FROM cleaned GROUP BY emi_eligibility")
def class_distribution(spark, sf_dir):
    return P.class_distribution(S.cleaned(spark, sf_dir))


_CATS = [c for c in RAW_COLUMNS if c in CATEGORICAL] + [TARGET_CLASS]


@register("category_values", CLEANED + " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column, CAST({c} AS VARCHAR) AS value FROM cleaned" for c in _CATS))
def category_values(spark, sf_dir):
    return P.category_values(S.cleaned(spark, sf_dir), _CATS)


@register("row_count", CLEANED + "SELECT CAST(count(*) AS BIGINT) AS rows FROM cleaned")
def row_count(spark, sf_dir):
    return P.row_count(S.cleaned(spark, sf_dir))


_DESC = [c for c in RAW_COLUMNS if c in NUMERIC] + [TARGET_AMOUNT]


@register("describe_numeric", TEXT + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, {O.r6(f'avg({c})')} AS mean, "
    f"{O.r6(f'stddev_samp({c})')} AS std, {O.r6(f'min({c})')} AS min, "
    f"{O.r6(f'quantile_cont({c}, 0.25)')} AS p25, {O.r6(f'quantile_cont({c}, 0.5)')} AS p50, "
    f"{O.r6(f'quantile_cont({c}, 0.75)')} AS p75, {O.r6(f'max({c})')} AS max FROM _text"
    for c in _DESC))
def describe_numeric(spark, sf_dir):
    return rounded(P.describe_numeric(S.text(spark, sf_dir), _DESC))


def _profile_sql():
    types = {f.name: P.type_name(f.dataType) for f in cleaned_schema().fields}
    return CLEANED + " UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c}' AS column, '{types[c]}' AS type, "
        f"CAST(count({c}) AS BIGINT) AS non_null FROM cleaned"
        for i, c in enumerate(RAW_COLUMNS))


@register("column_profile", _profile_sql())
def column_profile(spark, sf_dir):
    return P.column_profile(S.cleaned(spark, sf_dir))


@register("preview_head", CLEANED + f"SELECT {_cols(CLEAN_COLS, DOUBLES_CLEAN)} FROM cleaned "
          "ORDER BY applicant_id LIMIT 10")
def preview_head(spark, sf_dir):
    return rounded(P.preview_head(S.cleaned(spark, sf_dir), 10))


@register("preview_tail", CLEANED + f"SELECT {_cols(CLEAN_COLS, DOUBLES_CLEAN)} FROM cleaned "
          "ORDER BY applicant_id DESC LIMIT 5")
def preview_tail(spark, sf_dir):
    return rounded(P.preview_tail(S.cleaned(spark, sf_dir), 5))


@register("rows_missing", APP + f"SELECT {_cols(CLEAN_COLS, {TARGET_AMOUNT})} FROM applicants "
          f"WHERE {O.parse_number('monthly_salary')} IS NULL")
def rows_missing(spark, sf_dir):
    r = S.raw(spark, sf_dir)
    return rounded(P.rows_missing(r, X.coerce_number("monthly_salary")))


# Row numbers looked up by hand in the original notebook.
LOOKUP_IDS = (844, 1025, 1244, 109660, 238011, 315969)


@register("rows_by_id", APP + f"SELECT {_cols(CLEAN_COLS, {TARGET_AMOUNT})} FROM applicants "
          f"WHERE applicant_id IN ({', '.join(map(str, LOOKUP_IDS))})")
def rows_by_id(spark, sf_dir):
    return rounded(P.rows_by_id(S.raw(spark, sf_dir), LOOKUP_IDS))


# ---------------------------------------------------------------------------
# Projections
# ---------------------------------------------------------------------------


@register("project_features", CLEANED + f"SELECT applicant_id, {_cols(FEATURES, DOUBLES_CLEAN)} FROM cleaned")
def project_features(spark, sf_dir):
    return rounded(S.cleaned(spark, sf_dir).select(ID, *FEATURES))


@register("drop_targets", CLEANED + f"SELECT {_cols([c for c in CLEAN_COLS if c not in (TARGET_CLASS, TARGET_AMOUNT)], DOUBLES_CLEAN)} FROM cleaned")
def drop_targets(spark, sf_dir):
    return rounded(S.cleaned(spark, sf_dir).drop(TARGET_CLASS, TARGET_AMOUNT))


# ---------------------------------------------------------------------------
# Validation of scoring inputs
# ---------------------------------------------------------------------------

def _validate_sql():
    checks = []
    for c in RAW_COLUMNS:
        if c in RANGES:
            lo, hi, _ = RANGES[c]
            checks.append(f"CASE WHEN {c} IS NULL OR NOT ({c} BETWEEN {lo} AND {hi}) THEN '{c}' END")
        elif c in DOMAINS:
            vals = ", ".join(O.q(v) for v in DOMAINS[c])
            checks.append(f"CASE WHEN {c} IS NULL OR {c} NOT IN ({vals}) THEN '{c}' END")
    arr = "list_filter([" + ", ".join(checks) + "], lambda x: x IS NOT NULL)"
    return (TEXT.rstrip("\n") + f",\n_in AS (SELECT {O.typed_inputs()} FROM _dedup)\n"
            f"SELECT applicant_id, array_to_string({arr}, ',') AS violations, "
            f"CAST(len({arr}) AS INTEGER) AS n_violations, len({arr}) = 0 AS valid FROM _in")


@register("validate_applicants", _validate_sql())
def validate_applicants(spark, sf_dir):
    """What was entered, checked before anything is filled or re-cased."""
    from ..operators.validate import validate
    v = validate(C.typed_inputs(C.dedupe(S.raw(spark, sf_dir))))
    return v.select(ID, F.array_join("violations", ",").alias("violations"),
                    F.size("violations").alias("n_violations"), "valid")


@register("valid_applicants", _validate_sql().replace("SELECT applicant_id, array", "SELECT applicant_id FROM (SELECT applicant_id, array")
          + ") WHERE valid")
def valid_applicants(spark, sf_dir):
    """Ids of the applicants without a violation."""
    from ..operators.validate import split_valid
    return split_valid(C.typed_inputs(C.dedupe(S.raw(spark, sf_dir))))[0].select(ID)


# ---------------------------------------------------------------------------
# Flagship: risk summary
# ---------------------------------------------------------------------------

RISK_SQL = (FILLED.rstrip("\n") + O.features_cte("_filled") + """
SELECT emi_eligibility AS class, CAST(count(*) AS BIGINT) AS applicants,
  CAST(count_if(NOT (debt_to_income < 0.4)) AS BIGINT) AS debt_fails,
  CAST(count_if(NOT (expense_to_income < 0.5)) AS BIGINT) AS expense_fails,
  CAST(count_if(NOT (affordability_ratio > 1.0)) AS BIGINT) AS affordability_fails
FROM feat GROUP BY emi_eligibility""")


@register("risk_summary", RISK_SQL)
def risk_summary(spark, sf_dir):
    """How many applicants of each class fail each affordability rule
    (deduplicated, repaired, filled; raw money scale)."""
    return R.risk_summary(FE.derive(S.filled(spark, sf_dir)))


@register("health_flags", FILLED.rstrip("\n") + O.features_cte("_filled") + """
SELECT applicant_id, round(debt_to_income, 6) AS debt_to_income,
  round(expense_to_income, 6) AS expense_to_income, round(affordability_ratio, 6) AS affordability_ratio,
  debt_to_income < 0.4 AS debt_ok, expense_to_income < 0.5 AS expense_ok,
  affordability_ratio > 1.0 AS affordable FROM feat""")
def health_flags(spark, sf_dir):
    f = R.health_flags(FE.derive(S.filled(spark, sf_dir)))
    return rounded(f.select(ID, "debt_to_income", "expense_to_income", "affordability_ratio",
                            "debt_ok", "expense_ok", "affordable"))
