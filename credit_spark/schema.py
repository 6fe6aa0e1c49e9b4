"""Column groups, domains and fixed texts of the applicant data model.

Everything here is a small constant. Every step reads its column lists from
this module, so there is one source of truth for names and order.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = "applicant_id"

# ---------------------------------------------------------------------------
# These must equal the original pipeline's constants for the
# results to match (column names and order, maps, thresholds, domains, texts).
# ---------------------------------------------------------------------------

# Numeric columns cleaned by the numeric-text rule, in the original order.
NUMERIC = (
    "age", "monthly_salary", "years_of_employment", "monthly_rent",
    "family_size", "dependents", "school_fees", "college_fees",
    "travel_expenses", "groceries_utilities", "other_monthly_expenses",
    "current_emi_amount", "credit_score", "bank_balance", "emergency_fund",
    "requested_amount", "requested_tenure",
)

# Columns rounded half-to-even to whole numbers.
INTEGER = ("age", "family_size", "dependents", "requested_tenure")

# Columns put on the log1p scale after outlier capping.
SKEWED = (
    "monthly_salary", "monthly_rent", "college_fees",
    "emergency_fund", "requested_amount", "current_emi_amount",
)

# Categorical columns, in label-encoding order.
CATEGORICAL = (
    "gender", "marital_status", "education", "employment_type",
    "house_type", "company_type", "emi_scenario", "existing_loans",
)

# Categorical columns that are title-cased then stripped, in cleaning order.
TITLE_CASED = (
    "marital_status", "education", "company_type", "house_type",
    "employment_type", "existing_loans",
)

# Gender text (lower-cased and stripped) to label; anything else is missing.
GENDER_MAP = {"m": "Male", "male": "Male", "f": "Female", "female": "Female"}

# Monthly expense columns summed into total_monthly_expenses.
EXPENSES = (
    "school_fees", "college_fees", "travel_expenses", "groceries_utilities",
    "other_monthly_expenses", "monthly_rent",
)

# Derived features, in the order they are created.
DERIVED = (
    "debt_to_income", "total_monthly_expenses", "expense_to_income",
    "monthly_disposable", "instalment_if_approved", "affordability_ratio",
    "employment_stability", "loan_to_income_ratio", "dependents_ratio",
)

# Columns standardised with the feature scaler (total_monthly_expenses and
# the category codes are not scaled).
SCALED = NUMERIC + (
    "debt_to_income", "expense_to_income", "affordability_ratio",
    "monthly_disposable", "instalment_if_approved", "employment_stability",
    "loan_to_income_ratio", "dependents_ratio",
)

TARGET_CLASS = "emi_eligibility"
TARGET_AMOUNT = "max_monthly_emi"
TARGETS = (TARGET_CLASS, TARGET_AMOUNT)
CLASSES = ("Eligible", "High_Risk", "Not_Eligible")

# Feature selection thresholds.
MIN_TARGET_CORRELATION = 0.05
MAX_PAIR_CORRELATION = 0.85

# Outlier fence multiplier and histogram bin count.
IQR_FENCE = 1.5
HISTOGRAM_BINS = 30

# EDA sample size, seed and plotted columns.
SAMPLE_SIZE = 10000
SEED = 42
PAIR_FEATURES = (
    "monthly_salary", "current_emi_amount", "credit_score",
    "requested_amount", "affordability_ratio",
)
SCATTER_FEATURES = ("monthly_salary", "current_emi_amount", "requested_amount", "credit_score")
RATIO_FEATURES = ("debt_to_income", "expense_to_income", "affordability_ratio")

# Input limits of the scoring form: (min, max, default) for numbers ...
RANGES = {
    "age": (18, 75, 30),
    "years_of_employment": (0.0, 50.0, 3.0),
    "monthly_salary": (1000.0, 1_000_000.0, 40000.0),
    "family_size": (1, 20, 4),
    "dependents": (0, 10, 2),
    "current_emi_amount": (0.0, 500_000.0, 5000.0),
    "requested_amount": (10000.0, 5_000_000.0, 100000.0),
    "requested_tenure": (6, 120, 24),
    "credit_score": (300, 900, 650),
    "bank_balance": (0.0, 10_000_000.0, 100000.0),
    "emergency_fund": (0.0, 10_000_000.0, 50000.0),
    "school_fees": (0.0, 100_000.0, 2000.0),
    "college_fees": (0.0, 500_000.0, 3000.0),
    "travel_expenses": (0.0, 50_000.0, 1500.0),
    "groceries_utilities": (0.0, 50_000.0, 5000.0),
    "other_monthly_expenses": (0.0, 50_000.0, 1000.0),
    "monthly_rent": (0.0, 200_000.0, 8000.0),
}
# ... and the allowed values of each choice.
DOMAINS = {
    "gender": ("Male", "Female"),
    "marital_status": ("Single", "Married"),
    "education": ("High School", "Graduate", "Post Graduate", "Professional"),
    "employment_type": ("Government", "Private", "Self-employed"),
    "company_type": ("MNC", "Mid-size", "Startup", "Large Indian", "Small"),
    "house_type": ("Own", "Family", "Rented"),
    "existing_loans": ("Yes", "No"),
    "emi_scenario": (
        "Personal Loan EMI", "E-commerce Shopping EMI", "Education EMI",
        "Vehicle EMI", "Home Appliances EMI",
    ),
}

# Display badge per predicted class; other labels are shown unchanged.
BADGES = {
    "Eligible": "🟢 Eligible",
    "Not_Eligible": "🔴 Not Eligible",
    "High_Risk": "🟠 High Risk",
}

# Affordability health rules: debt-to-income below 40 %, expense-to-income
# below 50 %, affordability ratio above 1.
MAX_DEBT_TO_INCOME = 0.40
MAX_EXPENSE_TO_INCOME = 0.50
MIN_AFFORDABILITY = 1.0

# Personalised advice per predicted class, in display order.
ADVICE = {
    "Eligible": (
        "Try to borrow within your maximum EMI to avoid financial strain",
        "Keep existing EMIs low to maintain affordability",
        "Consider increasing loan tenure to reduce monthly EMI if needed",
    ),
    "High_Risk": (
        "Your financial profile indicates high risk for new loans",
        "Reduce current liabilities and outstanding EMIs",
        "Increase savings and emergency fund",
        "Improve credit score before applying for a new loan",
        "Consider lowering requested loan amount or extending tenure",
    ),
    "Not_Eligible": (
        "Currently not eligible for EMI",
        "Reduce existing liabilities first",
        "Increase monthly savings and emergency fund",
        "Improve credit score",
        "Reassess requested loan amount or tenure to meet affordability",
    ),
}
NO_PREDICTION_NOTICE = "No prediction available. Please check the Prediction page first."

# Text tokens a CSV reader treats as missing (the one-token Spark option
# cannot express the list, so cleaning maps them to NULL).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Label a missing category gets when it is turned into text.
MISSING_LABEL = "Nan"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

# Raw applicant table as it arrives: dirty numbers are text.
RAW_SCHEMA = T.StructType([
    T.StructField(ID, T.LongType()),
    T.StructField("age", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("marital_status", T.StringType()),
    T.StructField("education", T.StringType()),
    T.StructField("monthly_salary", T.StringType()),
    T.StructField("employment_type", T.StringType()),
    T.StructField("years_of_employment", T.DoubleType()),
    T.StructField("company_type", T.StringType()),
    T.StructField("house_type", T.StringType()),
    T.StructField("monthly_rent", T.DoubleType()),
    T.StructField("family_size", T.LongType()),
    T.StructField("dependents", T.LongType()),
    T.StructField("school_fees", T.DoubleType()),
    T.StructField("college_fees", T.DoubleType()),
    T.StructField("travel_expenses", T.DoubleType()),
    T.StructField("groceries_utilities", T.DoubleType()),
    T.StructField("other_monthly_expenses", T.DoubleType()),
    T.StructField("existing_loans", T.StringType()),
    T.StructField("current_emi_amount", T.DoubleType()),
    T.StructField("credit_score", T.DoubleType()),
    T.StructField("bank_balance", T.StringType()),
    T.StructField("emergency_fund", T.DoubleType()),
    T.StructField("emi_scenario", T.StringType()),
    T.StructField("requested_amount", T.DoubleType()),
    T.StructField("requested_tenure", T.LongType()),
    T.StructField(TARGET_CLASS, T.StringType()),
    T.StructField(TARGET_AMOUNT, T.DoubleType()),
])

RAW_COLUMNS = tuple(f.name for f in RAW_SCHEMA.fields)

# Feature columns in table order (everything but the id and the targets).
FEATURES = tuple(c for c in RAW_COLUMNS if c not in TARGETS and c != ID)


def cleaned_schema() -> T.StructType:
    """Schema after cleaning: numeric features DOUBLE, categories STRING."""
    fields = []
    for f in RAW_SCHEMA.fields:
        if f.name in NUMERIC:
            fields.append(T.StructField(f.name, T.DoubleType()))
        else:
            fields.append(f)
    return T.StructType(fields)
