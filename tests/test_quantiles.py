import numpy as np
import pytest

from credit_spark.operators import clean as C
from credit_spark.operators import quantiles as Q


@pytest.fixture
def small_limits(monkeypatch):
    monkeypatch.setattr(Q, "BINS", 8)


def test_refinement_is_exact(spark, small_limits):
    rng = np.random.default_rng(7)
    a = rng.lognormal(3, 2, 4000)
    a[:1500] = 42.0                      # a hot value holding over a third of the rows
    b = np.round(rng.normal(size=4000), 1)
    rows = [(float(x), float(y) if i % 9 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = Q.quantiles(df, ["a", "b"], probs)
    bb = np.array([r[1] for r in rows if r[1] is not None])
    for c, arr in (("a", a), ("b", bb)):
        want = np.percentile(arr, [p * 100 for p in probs])
        assert np.allclose(got[c], want, rtol=1e-12, atol=1e-12), c


def test_modes_distributed(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("x",), (None,), ("z",)], "s string")
    assert C.modes(df, ["s"]) == {"s": "x"}


def test_filled_quartiles_from_one_pass(spark, small_limits):
    """Median and the quartiles after filling with it equal numpy on the
    filled column: many missing values (quartile ranks inside the block of
    copies) and a hot value."""
    rng = np.random.default_rng(11)
    n = 3000
    a = np.round(rng.lognormal(2, 1, n), 2)
    a[:900] = 5.0
    rows = []
    for i in range(n):
        x = None if i % 5 == 0 else float(a[i])          # 20 % missing
        y = None if i % 3 else float(a[(i * 7) % n])      # 67 % missing
        rows.append((x, y, None))
    df = spark.createDataFrame(rows, "x double, y double, z double").repartition(4)
    sizes = Q.column_sizes(df, ["x", "y", "z"])
    wanted = {c: (0, 17, sizes[c]["n"] - 1) for c in ("x", "y")}
    stats = Q.order_statistics(df, wanted, sizes)
    assert all(stats[c][j] == sorted(r[i] for r in rows if r[i] is not None)[j]
               for i, c in enumerate(("x", "y")) for j in wanted[c])
    got = Q.median_and_filled_quartiles(df, ["x", "y", "z"], sizes)
    assert "z" not in got
    for i, c in enumerate(("x", "y")):
        vals = np.array([r[i] for r in rows if r[i] is not None])
        m = np.median(vals)
        filled = np.array([r[i] if r[i] is not None else m for r in rows])
        assert got[c][0] == pytest.approx(m, rel=1e-12)
        assert np.allclose(got[c][1], np.percentile(filled, [25, 75]), rtol=1e-12, atol=0)


def test_extreme_ranges_end(spark):
    values = [-1.7e308, 1.7e308, 0.0, 5e-324, 1e-300, 1.0, 1.0 + 2**-52]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    sizes = Q.column_sizes(df, ["x"])
    got = Q.order_statistics(df, {"x": range(len(values))}, sizes)["x"]
    assert [got[j] for j in range(len(values))] == sorted(values)


@pytest.mark.parametrize("few", [1 << 20, 0])
def test_two_scans_in_the_common_case(spark, monkeypatch, few):
    """Sizes with a sketch, then counts; telling values apart by bins, for many rows, may take more."""
    rng = np.random.default_rng(3)
    a, b = rng.lognormal(3, 2, 30_000), np.round(rng.normal(size=30_000), 1)
    a[:9000] = 42.0
    rows = [(float(x), float(y) if i % 9 else None, 5.0) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5).cache()
    scans, cells = [], Q._cells
    monkeypatch.setattr(Q, "FEW_VALUES", few)
    monkeypatch.setattr(Q, "_cells", lambda *args: scans.append(1) or cells(*args))
    probs = [0.0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    got = Q.quantiles(df, ["a", "b", "c"], probs)
    bb = np.array([r[1] for r in rows if r[1] is not None])
    for c, arr in (("a", a), ("b", bb), ("c", np.full(5, 5.0))):
        assert np.allclose(got[c], np.percentile(arr, [p * 100 for p in probs]), rtol=1e-12, atol=1e-12), c
    assert len(scans) == 1 if few else len(scans) <= 3


def test_a_wrong_sketch_costs_rounds_only(spark):
    values = [float(k * k % 977) for k in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    sizes = Q.column_sizes(df, ["x"])
    for grid in ([0.0] * (Q.GRID + 1), [500.0] * (Q.GRID + 1), [976.0] * (Q.GRID + 1)):
        sizes["x"]["grid"] = grid
        got = Q.order_statistics(df, {"x": [0, 3, 700, 1500, 1999]}, sizes)["x"]
        assert got == {r: sorted(values)[r] for r in (0, 3, 700, 1500, 1999)}


def test_rows_outside_the_brackets_are_only_counted(spark, monkeypatch):
    """Ranks are found from the rows inside narrow brackets; a plain aggregate counts those below."""
    a = np.random.default_rng(4).random(30_000)
    df = spark.createDataFrame([(float(v),) for v in a], "a double").repartition(4)
    seen, cells = [], Q._cells
    monkeypatch.setattr(Q, "_cells", lambda rows, brackets, *few: seen.append(brackets) or cells(rows, brackets, *few))
    got = Q.quantiles(df, ["a"], [0.25, 0.5, 0.75])["a"]
    assert np.allclose(got, np.percentile(a, [25, 50, 75]), rtol=1e-12)
    assert len(seen) == 1 and len(seen[0]) == 3
    assert 0 < sum(((a >= lo) & (a <= hi)).sum() for _, lo, hi, _ in seen[0]) < 0.05 * len(a)
