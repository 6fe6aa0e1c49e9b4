from pyspark.sql import functions as F

from credit_spark.operators import encode as E
from credit_spark.operators import split as SP


def test_encode_decode_identity(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["b", "a", "c", "a", None])],
                               "id long, s string")
    codes = E.fit_label_codes(df, ["s"])
    assert codes.classes["s"] == ["a", "b", "c", "nan"]
    enc = E.encode(df, codes)
    back = E.decode(enc, codes, "s").orderBy("id").collect()
    assert [r.s for r in back] == ["b", "a", "c", "a", "nan"]


def test_unseen_gets_code_zero(spark):
    fit = spark.createDataFrame([("Single",), ("Married",)], "s string")
    codes = E.fit_label_codes(fit, ["s"])
    new = spark.createDataFrame([("single",), ("Single",)], "s string")
    assert [r.s for r in E.encode(new, codes, unseen=0).collect()] == [0, 1]


def test_code_table_matches_literal_codes(spark):
    df = spark.range(0, 500).select(F.format_string("v%04d", (F.col("id") * 37) % 500).alias("s"))
    codes = E.fit_label_codes(df, ["s"], max_codes=1000)
    table = {r.value: r.code for r in E.code_table(df.repartition(7), "s").collect()}
    assert table == {v: i for i, v in enumerate(codes.classes["s"])}
    joined = E.encode_by_join(df, "s", E.code_table(df, "s")).agg(F.max("s")).first()[0]
    assert joined == 499



def test_large_distinct_set_falls_back_to_code_table(spark):
    """Past the literal bound a column gets a distributed code table; the
    codes, unseen handling and decoding equal the literal ones."""
    df = spark.range(0, 300).select(
        F.format_string("v%04d", (F.col("id") * 37) % 300).alias("s"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("t"))
    lit = E.fit_label_codes(df, ["s", "t"], max_codes=1000)
    big = E.fit_label_codes(df, ["s", "t"], max_codes=50)
    assert list(big.tables) == ["s"] and big.classes == {"t": ["a", "b"]}
    new = df.union(spark.createDataFrame([("zzz", "c")], "s string, t string"))
    a = {r.k: (r.s, r.t) for r in E.encode(new.withColumn("k", F.col("s")), lit, unseen=0).collect()}
    b = {r.k: (r.s, r.t) for r in E.encode(new.withColumn("k", F.col("s")), big, unseen=0).collect()}
    assert a == b and a["zzz"] == (0, 0)
    back = E.decode(E.encode(df.withColumn("orig", F.col("s")), big), big, "s")
    assert back.where("s <> orig").count() == 0


def test_two_columns_of_many_codes_are_both_returned(spark):
    df = spark.range(0, 10_500).select(F.format_string("u%06d", "id").alias("s"),
                                       F.format_string("v%06d", 10_499 - F.col("id")).alias("t"))
    codes = E.fit_label_codes(df, ["s", "t"])
    got = {r.column: (r.n, r.top) for r in codes.table(spark).groupBy("column").agg(
        F.count("*").alias("n"), F.max("code").alias("top")).collect()}
    assert got == {"s": (10_500, 10_499), "t": (10_500, 10_499)}
    assert E.encode(df, codes).where(F.col("s") + F.col("t") != 10_499).count() == 0


def test_scale_invert(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    st = E.fit_scaler(df, ["x"])
    back = E.unstandardize(E.standardize(df, st), st).collect()
    assert all(abs(a.x - b.x) < 1e-9 for a, b in zip(back, df.collect()) if a.x is not None)


def test_splits_disjoint_complete_repeatable(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("applicant_id"),
                                     (F.col("id") % 3).cast("string").alias("y"))
    a = SP.stratified_split(df, "y")
    b = SP.stratified_split(df.repartition(13), "y")
    assert a.count() == 5000
    assert a.exceptAll(b).count() == 0
    test = a.where("split = 'test'").count()
    assert 850 < test < 1150
    per = {r.y: r["count"] for r in a.where("split = 'test'").groupBy("y").count().collect()}
    assert all(260 < v < 400 for v in per.values())
    r = SP.random_split(df)
    assert r.where("split='test'").count() + r.where("split='train'").count() == 5000


def test_exact_stratified_counts(spark):
    df = spark.range(0, 1001).select(F.col("id").alias("applicant_id"),
                                     (F.col("id") % 3).cast("string").alias("y"))
    s = SP.stratified_split(df, "y")
    per = {r.y: r["count"] for r in s.where("split = 'test'").groupBy("y").count().collect()}
    assert per == {"0": 67, "1": 67, "2": 67}
