from pyspark.sql import functions as F

from credit_spark.functions import math as M
from credit_spark.functions import text as X


def one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"s {dtype}")
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


def test_title_case(spark):
    got = one(spark, ["self-employed", "MNC", " 3rd x ", None, "mid-size", "e-commerce"],
              X.clean_category)
    assert got == ["Self-Employed", "Mnc", "3Rd X", "Nan", "Mid-Size", "E-Commerce"]


def test_strip_removes_tabs(spark):
    assert one(spark, ["\tMarried \n"], X.strip) == ["Married"]


def test_numeric_text_rule(spark):
    vals = ["303200.0.0", "58.0", "1234.05", "3.00", "1.0d", "1_000", "nan", "inf", "abc", "",
            " 12 ", "1e5", None]
    assert one(spark, vals, X.numeric_text) == [303200.0, 58.0, 12345.0, 30.0, None, None, None,
                                               None, None, None, 12.0, 100000.0, None]


def test_numbers_with_odd_spaces_and_sizes(spark):
    vals = ["\t12\n", "12\u2028", "12\u0085", "1 2", "+.5", "5.", "1e999", "-1e999", ".", "1e", "\n"]
    got = one(spark, vals, lambda c: M.nullify_nonfinite(X.numeric_text(c)))
    assert got == [12.0, None, None, None, 0.5, 5.0, None, None, None, None, None]


def test_nonfinite_is_missing(spark):
    vals = [float("nan"), float("inf"), float("-inf"), -0.5, 0.0, None]
    assert one(spark, vals, M.nullify_nonfinite, "double") == [None, None, None, -0.5, 0.0, None]


def test_repairs_name_their_input_few_times(spark):
    """What a repair names again is compiled, and often run, again for every row."""
    df = spark.createDataFrame([("1",)], "s string")
    for fn, most in ((X.clean_gender, 1), (X.numeric_text, 1), (lambda c: M.nullify_nonfinite(X.numeric_text(c)), 2)):
        top = df.select(fn(F.col("s")).alias("x"))._jdf.queryExecution().analyzed().toString().splitlines()[0]
        assert 1 <= top.count("s#") <= most


def test_numeric_text_strict(spark):
    got = one(spark, ["303200.0.0", "58.0", "1234.05", "3.00"], lambda c: X.numeric_text(c, strict=True))
    assert got == [303200.0, 58.0, 1234.05, 3.0]


def test_na_tokens(spark):
    got = one(spark, ["NA", "null", "None", "nan", "", "Nan", "x"], X.na_to_null)
    assert got == [None, None, None, None, None, "Nan", "x"]


def test_age_text(spark):
    assert one(spark, ["58.0.0", "-5", "abc", None], X.extract_age) == [58.0, 5.0, None, None]


def test_gender(spark):
    got = one(spark, ["M", "male", "Female", "F", "FEMALE", " Male ", "unknown", None], X.clean_gender)
    assert got == ["Male", "Male", "Female", "Female", "Female", "Male", None, None]


def test_comma_and_dot(spark):
    assert one(spark, ["251,599", " 1,000 ", "x"], X.comma_number) == [251599.0, 1000.0, None]
    assert one(spark, ["58.0.0", "31", "abc.0"], X.before_dot) == [58.0, 31.0, None]


def test_badge_and_money(spark):
    assert one(spark, ["Eligible", "High_Risk", "Other"], X.badge) == [
        "🟢 Eligible", "🟠 High Risk", "Other"]
    assert one(spark, [1234.5, 0.0], X.money, "double") == ["₹ 1,234.50", "₹ 0.00"]
