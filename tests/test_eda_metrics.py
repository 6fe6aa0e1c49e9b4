import numpy as np
from pyspark.sql import functions as F

from credit_spark.operators import eda as D
from credit_spark.operators import metrics as MT


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]] + [(None,)], "x double")
    h = {r.bin: r["count"] for r in D.histograms(df, ["x"]).collect()}
    assert h[29] == 1 and sum(h.values()) == 5
    const = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    rows = D.histograms(const, ["x"]).collect()
    assert len(rows) == 1 and rows[0]["count"] == 2 and rows[0].bin == 15


def test_auto_bins_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.lognormal(size=2000)
    q1, q3 = np.percentile(x, [25, 75])
    want = len(np.histogram_bin_edges(x, bins="auto")) - 1
    assert D.auto_bins(len(x), float(x.min()), float(x.max()), float(q1), float(q3)) == want


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=3000)], "x double")
    d = sorted((r.x, r.density) for r in D.density_curve(df, ["x"]).collect())
    xs, ys = np.array([a for a, _ in d]), np.array([b for _, b in d])
    area = np.trapezoid(ys, xs)
    assert 0.9 < area < 1.01


def test_density_by_label_shares_the_area(spark):
    rng = np.random.default_rng(2)
    rows = [(float(v), "a") for v in rng.normal(size=2000)] + [(float(v), "b") for v in rng.normal(3, 1, 1000)]
    df = spark.createDataFrame(rows + [(1.0, None), (9.0, "one")], "x double, y string")
    got = {}
    for r in D.density_curve(df, ["x"], by="y").collect():
        got.setdefault(r.y, []).append((r.x, r.density))
    assert set(got) == {"a", "b"}
    area = {k: np.trapezoid(*np.array(sorted(v)).T[::-1]) for k, v in got.items()}
    assert abs(area["a"] - 2000 / 3002) < 0.02 and abs(area["b"] - 1000 / 3002) < 0.02


def test_density_bins_grow_as_the_kernel_narrows():
    assert D.density_bins(0.0, 1.0, 1.0) == D.DENSITY_BINS
    assert D.density_bins(0.0, 1.0, 0.001) == 8000


def test_tables_of_no_values(spark):
    df = spark.createDataFrame([(None, "a")], "x double, y string")
    assert D.histograms(df, ["x"]).count() == 0
    assert D.density_curve(df, ["x"]).count() == 0
    assert D.density_curve(df, ["x"], by="y").columns == ["y", "column", "point", "x", "density"]


def test_correlation_over_common_rows_matches_pandas(spark):
    import pandas as pd
    from credit_spark.operators import correlate as K
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 10, (400, 4))
    x[:, 1] += x[:, 0] * 0.7
    pdf = pd.DataFrame(x, columns=list("abcd"))
    pdf.loc[rng.random(400) < 0.3, "b"] = None
    pdf.loc[rng.random(400) < 0.2, "c"] = None
    pdf["flat"] = 2.0
    # Constant over the rows it shares with b, but not elsewhere.
    pdf["half"] = np.where(pdf.b.isna(), rng.normal(size=400), 5.0)
    df = spark.createDataFrame(pdf).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in pdf.columns])
    want = pdf.corr()
    for r in K.correlation_matrix(df, list(pdf.columns)).collect():
        if "flat" in (r.a, r.b) or {r.a, r.b} == {"b", "half"}:
            assert r.r is None
        else:
            assert abs(r.r - want.loc[r.a, r.b]) < 1e-9


def test_sample_is_repeatable(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "applicant_id")
    a = D.sample_rows(df, 100).collect()
    b = D.sample_rows(df.repartition(5), 100).collect()
    assert sorted(a) == sorted(b) and len(a) == 100
    assert D.sample_rows(df, 10000).count() == 3000


def test_classification_metrics_by_hand(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    m = MT.classification_metrics(spark.createDataFrame(rows, "y string, yhat string")).first()
    # per class (p, r, support): a (0.5, 0.5, 2), b (2/3, 1, 2), c (0, 0, 1)
    assert abs(m.accuracy - 0.6) < 1e-12
    assert abs(m.precision - (0.5 * 2 + 2 / 3 * 2) / 5) < 1e-12
    assert abs(m.recall - 0.6) < 1e-12
    assert abs(m.f1 - (0.5 * 2 + 0.8 * 2) / 5) < 1e-12


def test_regression_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 1.0), (3.0, 3.0)], "y double, yhat double")
    m = MT.regression_metrics(df).first()
    assert abs(m.rmse - (2 / 3) ** 0.5) < 1e-12
    assert abs(m.mae - 2 / 3) < 1e-12
    assert abs(m.mape - (100 + 100 + 0) / 3) < 1e-9
    assert abs(m.r2 - (1 - 2 / (np.var([1, 0, 3]) * 3))) < 1e-12
