"""Boosting, forests, least squares, rank-sum AUC and exact splits, against plain versions."""
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from credit_spark.operators import least_squares as LS
from credit_spark.operators import metrics as MT
from credit_spark.operators import split as SP
from credit_spark.operators import trees as T
from credit_spark.session import scratch_path


def frame(spark, x, y, parts=3):
    cols = [f"c{k}" for k in range(x.shape[1])]
    pdf = pd.DataFrame(x, columns=cols).assign(label=np.asarray(y, float), applicant_id=np.arange(len(x)))
    df = spark.createDataFrame(pdf).repartition(parts)
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep").transform(df)


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 12, (900, 4)).astype(float)
    y = (x[:, 0] + x[:, 1] > 11).astype(int) + (x[:, 2] > 8)
    x[rng.random(x.shape) < 0.1] = np.nan
    return x, y, frame(spark, x, y)


CUTS = [np.arange(12.0)] * 4


def brute_split(x, g, h, reg=1.0, low=1.0):
    """The best gain over all splits and both sides of the missing rows."""
    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + reg)
    best = 0.0
    for f in range(x.shape[1]):
        gap = np.isnan(x[:, f])
        for v in np.unique(x[~gap, f]):
            for left in ((~gap & (x[:, f] <= v)), (gap | (x[:, f] <= v))):
                if min(h[left].sum(), h[~left].sum()) >= low and left.any() and (~left).any():
                    best = max(best, score(left) + score(~left) - score(np.ones(len(x), bool)))
    return best


@pytest.mark.parametrize("task", ["class", "value"])
def test_boosting_in_levels_and_in_tasks_agree(gappy, monkeypatch, task):
    x, y, df = gappy
    models = []
    for fit_rows, kept in ((10 ** 6, 10), (0, 10), (200, 2)):
        monkeypatch.setattr(T, "FIT_ROWS", fit_rows)
        monkeypatch.setattr(T, "ROUNDS_KEPT", kept)
        models.append(T.BoostedTrees(task, rounds=4, depth=3, cuts=CUTS).fit(df))
    scores = [m.scores(x) for m in models]
    assert np.abs(scores[0] - scores[1]).max() < 1e-9 and np.abs(scores[0] - scores[2]).max() < 1e-9
    if task == "class":
        g, h = (y == 0) - 1 / 3, np.full(len(y), 4 / 9)
    else:
        g, h = y - y.mean(), np.ones(len(y))
    assert models[0].trees[0].gain[0] == pytest.approx(brute_split(x, g, h))
    loss = ((scores[0][:, 0] - y) ** 2).mean() if task == "value" else (scores[0].argmax(1) != y).mean()
    assert loss < (0.5 if task == "value" else 0.2)


def test_side_of_missing_rows_is_learned(spark):
    x = np.array([[float(k % 10)] for k in range(200)] + [[np.nan]] * 100)
    for gap_is_low in (True, False):
        y = np.r_[(x[:200, 0] > 4).astype(float), np.full(100, 0.0 if gap_is_low else 1.0)]
        m = T.BoostedTrees("value", rounds=1, depth=1, cuts=[np.arange(10.0)]).fit(frame(spark, x, y))
        assert m.trees[0].missing_left[0] is gap_is_low and m.trees[0].cut[0] == 4.0
        low, high, gap = m.scores(np.array([[0.0], [9.0], [np.nan]]))[:, 0]
        assert gap == (low if gap_is_low else high)


def test_leaves_are_pure_however_deep(spark):
    """Alternating labels on one column can only be peeled off one by one or so."""
    n = 400
    x, y = np.arange(n, dtype=float)[:, None], np.arange(n) % 2
    for task in ("class", "value"):
        for fit_rows in (10 ** 6, 50):
            m = T.Forest(task, trees=3, seed=5, fit_rows=fit_rows).fit(frame(spark, x, y))
            # With quantile levels the deep part is inside the subtrees.
            assert max(t.depth() for t in m.trees) > (30 if fit_rows > n else 10)
            for k, tree in enumerate(m.trees):
                bag = T.poisson(np.arange(n), k, 5) > 0
                w = T.Walker(tree)
                got = w.value[w.leaves(x)]
                got = got.argmax(1) if task == "class" else got[:, 0]
                assert (got[bag] == y[bag]).all()
    shallow = T.Forest("class", trees=2, depth=3).fit(frame(spark, x, y))
    assert max(t.depth() for t in shallow.trees) == 3


def test_bootstrap_weights_are_poisson():
    w = np.concatenate([T.poisson(np.arange(20_000), t, 1) for t in range(5)])
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    assert (T.poisson(np.arange(10), 1, 1) != T.poisson(np.arange(10), 2, 1)).any()


def test_trees_dont_depend_on_partitions(spark, gappy):
    x, y, df = gappy
    for est in (T.BoostedTrees("class", rounds=2, depth=3, cuts=CUTS), T.Forest("class", trees=3)):
        a, b = est.fit(df), est.fit(df.repartition(7))
        assert [t.feature for t in a.trees] == [t.feature for t in b.trees]
        assert [t.cut for t in a.trees] == [t.cut for t in b.trees]


def test_small_and_large_models_score_alike(spark, gappy, monkeypatch):
    x, y, df = gappy
    for est in (T.BoostedTrees("class", rounds=3, depth=3, cuts=CUTS), T.Forest("class", trees=3),
                T.Forest("value", trees=2), T.BoostedTrees("value", rounds=2, depth=2, cuts=CUTS)):
        m = est.fit(df)
        path = scratch_path(spark, "trees")
        m.save(spark, path)
        loaded = T.TreeModel.load(spark, path)
        got = []
        for limit, model in ((10 ** 9, m), (0, loaded)):
            monkeypatch.setattr(T, "COMPILED_NODES", limit)
            rows = model.transform(df, scores="s").orderBy("applicant_id").collect()
            got.append([(r.prediction, r.s) for r in rows])
        assert got[0] == got[1]
        assert np.abs(np.array([s for _, s in got[0]]) - m.scores(x)).max() == 0
        assert m.featureImportances.sum() == pytest.approx(1) and (m.featureImportances >= 0).all()


def test_constant_and_missing_columns(spark):
    x = np.c_[np.full(50, 3.0), np.full(50, np.nan), np.arange(50.0)]
    y = (x[:, 2] > 20).astype(float)
    m = T.BoostedTrees("class", rounds=2, depth=2).fit(frame(spark, x, y))
    assert (m.scores(x).argmax(1) == y).all()
    flat = T.BoostedTrees("value", rounds=2, depth=2).fit(frame(spark, x, np.ones(50)))
    assert all(len(t.feature) == 1 for t in flat.trees) and np.allclose(flat.scores(x), 1.0)
    with pytest.raises(ValueError):
        T.Forest("class").fit(frame(spark, x, y).where("label > 9"))


# --- least squares --------------------------------------------------------------

def test_least_squares_equals_a_dense_solver(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((700, 5)) * [1, 10, 1e4, 1, 1] + [0, 5, 1e5, 0, 2]
    x[:, 3] = x[:, 1]                      # collinear
    x[:, 4] = 2.0                          # constant
    y = x @ [1.0, 2.0, 3e-3, 4.0, 5.0] + 7 + rng.standard_normal(700)
    monkeypatch.setattr(LS, "FAN_IN", 2)   # several rounds of stacking
    m = LS.LeastSquares().fit(frame(spark, x, y, parts=9))
    xc, yc = x - x.mean(axis=0), y - y.mean()
    scale = np.linalg.lstsq(xc, yc, rcond=None)[0]
    assert np.allclose(m.coefficients, scale, rtol=1e-6, atol=1e-9)
    assert m.coefficients[1] == pytest.approx(m.coefficients[3]) and abs(m.coefficients[4]) < 1e-9
    assert m.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ scale, rel=1e-8)
    df = frame(spark, x, y)
    got = [r.prediction for r in m.transform(df).orderBy("applicant_id").collect()]
    assert np.allclose(got, x @ m.coefficients + m.intercept)


def test_least_squares_with_few_rows(spark):
    x, y = np.array([[1.0, 2.0, 3.0], [2.0, 1.0, 0.0]]), np.array([1.0, 3.0])
    m = LS.LeastSquares().fit(frame(spark, x, y))
    assert np.allclose(x @ m.coefficients + m.intercept, y)
    d = x[1] - x[0]
    assert np.allclose(m.coefficients, 2 * d / (d @ d))        # least norm
    one = LS.LeastSquares().fit(frame(spark, x[:1], y[:1]))
    assert np.allclose(one.coefficients, 0) and one.intercept == 1.0


# --- rank-sum AUC ---------------------------------------------------------------

def test_auc_equals_all_pairs(spark):
    rng = random.Random(4)
    rows = []
    for g in ("a", "b", None):
        for _ in range(150):
            s = rng.choice([rng.random(), rng.randint(0, 3) / 4, 0.0, -0.0, float("inf"), float("nan"), None])
            rows.append((g, rng.randint(0, 1), s, rng.choice([True, False, None])))
    rows += [("only", 0, 1.0, True), ("none", 0, None, True)]
    df = spark.createDataFrame(rows, "m string, k int, score double, positive boolean").repartition(5)
    got = {(r.m, r.k): r.auc for r in MT.rank_sum_auc(df, ["m", "k"]).collect()}
    for key in {(m, k) for m, k, _, _ in rows}:
        mine = [(s, p) for m, k, s, p in rows if (m, k) == key and s is not None and s == s and p is not None]
        pos, neg = [s for s, p in mine if p], [s for s, p in mine if not p]
        if not pos or not neg:
            assert got[key] is None
            continue
        won = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
        assert got[key] == pytest.approx(won / len(pos) / len(neg), abs=1e-12)


# --- exact splits -----------------------------------------------------------------

def sizes(df, *by):
    return {tuple(r[c] for c in by): r["n"] for r in df.where("split = 'test'").groupBy(*by).agg(
        F.count(F.lit(1)).alias("n")).collect()}


def test_split_sizes_are_exact(spark, monkeypatch):
    p = (1 << 31) - 1
    ids = [k * p for k in range(300)] + list(range(1, 700)) + [None] * 7        # the first 300 share a short hash
    rows = [(i, ("x", "y", "z", None)[n % 7 % 4], n) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "applicant_id long, y string, n long")
    for bins, few in ((4096, 1000), (3, 2)):
        monkeypatch.setattr(SP, "BINS", bins)
        monkeypatch.setattr(SP, "FEW", few)
        r = SP.random_split(df)
        assert r.where("split = 'test'").count() == -(-len(rows) // 5)
        s = SP.stratified_split(df, "y")
        counts = {}
        for _, y, _ in rows:
            counts[y] = counts.get(y, 0) + 1
        assert sizes(s, "y") == {(y,): n for y, n in SP.class_sizes(list(counts.items()), 0.2).items()}
        assert s.exceptAll(SP.stratified_split(df.repartition(6), "y")).count() == 0
        assert s.columns == [*df.columns, "split"] and s.count() == len(rows)


def test_class_sizes_add_up():
    rng = random.Random(0)
    for _ in range(200):
        counts = [(k, rng.randint(1, 50)) for k in range(rng.randint(1, 9))]
        n = sum(c for _, c in counts)
        got = SP.class_sizes(counts, 0.2)
        assert sum(got.values()) == -(-n // 5)
        assert all(abs(got[k] - c * -(-n // 5) / n) < 1 for k, c in counts)
    assert SP.test_size(10 ** 10 + 1, 0.2) == 2 * 10 ** 9 + 1


def test_split_of_nothing_and_of_copies(spark):
    empty = spark.createDataFrame([], "applicant_id long, y string")
    assert SP.random_split(empty).count() == SP.stratified_split(empty, "y").count() == 0
    copies = spark.createDataFrame([(1, "a")] * 50, "applicant_id long, y string")
    assert {r.split for r in SP.random_split(copies).collect()} == {"test"}     # equal rows go together


# --- speed and size of large trees --------------------------------------------

def test_packed_trees_score_and_weigh_alike(spark, gappy, monkeypatch):
    x, y, df = gappy
    for est in (T.Forest("class", trees=3), T.Forest("value", trees=3, fit_rows=200)):
        plain = est.fit(df)
        with monkeypatch.context() as m:
            m.setattr(T, "PACKED_NODES", 2)
            packed = est.fit(df)
            assert any(isinstance(t, T.Packed) for t in packed.trees)
            path = scratch_path(spark, "packed")
            packed.save(spark, path)
            loaded = T.TreeModel.load(spark, path)
            for model in (packed, loaded):
                assert np.abs(model.scores(x) - plain.scores(x)).max() == 0
                assert np.allclose(model.featureImportances, plain.featureImportances, rtol=1e-12, atol=0)
                rows = model.transform(df, scores="s").orderBy("applicant_id").collect()
                assert np.abs(np.array([r.s for r in rows]) - plain.scores(x)).max() == 0


def test_histograms_and_sorted_orders_give_the_same_tree():
    """The same bins, added up in a histogram or read in order of their values."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 30, (5000, 4)).astype(float)
    x[rng.random(x.shape) < 0.05] = np.nan
    y = np.nansum(x[:, :2], axis=1) % 7
    stats = np.stack([y, np.ones(5000), np.ones(5000)], axis=1)
    cuts = [np.arange(30.0)] * 4
    grown = [T.grow(x, stats, y, T.Rule("newton", to_purity=False, min_child=1.0), 6, None, c, [1]) for c in (cuts, None)]
    for part in ("feature", "missing_left", "left", "value"):
        assert getattr(grown[0], part) == getattr(grown[1], part)


def test_rows_may_come_as_bins():
    """A task that gets the numbers of bins grows the same tree, bit for bit, as from the values."""
    rng = np.random.default_rng(4)
    x = rng.random((4000, 3))
    x[rng.random(x.shape) < 0.05] = np.nan
    y = np.nansum(x, axis=1)
    stats, rule = np.stack([y, np.ones(4000), np.ones(4000)], axis=1), T.Rule("newton", 1.0, 0.0, 1.0)
    cuts = [np.linspace(0, 1, n) for n in (50, 9, 200)]
    bins = T._bins_of(x, cuts)
    assert bins.dtype == np.int16 and bins.max() == 201
    assert T.grow(bins, stats, y, rule, 6, None, cuts, [1]) == T.grow(x, stats, y, rule, 6, None, cuts, [1])


def test_trees_are_dealt_to_tasks_in_turn(spark, gappy, monkeypatch):
    """No task gets two trees more than another, whatever their numbers hash to."""
    found, write = {}, T.materialize
    monkeypatch.setattr(T, "materialize", lambda df, name: (found.update({name: df}), write(df, name))[1])
    T.Forest("class", trees=2 * spark.sparkContext.defaultParallelism + 3).fit(gappy[2].fillna(0))
    got = [r["count"] for r in found["trees"].groupBy(F.spark_partition_id()).count().collect()]
    assert len(got) == 2 * spark.sparkContext.defaultParallelism and max(got) == 2


def test_a_tree_sorts_each_feature_once(monkeypatch):
    """Values are sorted once a feature, however many levels; later orders come from 16-bit sorts."""
    rng = np.random.default_rng(5)
    x, y = rng.random((3000, 6)), rng.random(3000)
    stats, sort, wide = np.stack([y, np.ones(3000), np.ones(3000)], axis=1), np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda a, *k, **kw: (a.dtype.itemsize > 2 and wide.append(a.size), sort(a, *k, **kw))[1])
    tree = T.grow(x, stats, y, T.Rule("newton", to_purity=True), None, None, None, [1])
    assert len(tree.feature) == 2 * 3000 - 1 and tree.depth() > 10
    assert sum(wide) <= 6 * 3000


# --- no task takes all rows of a group -----------------------------------------

def test_split_brackets_are_broadcast(spark):
    df = spark.range(5000).selectExpr("id AS applicant_id", "IF(id % 3 = 0, 'x', 'y') AS label")
    rows = df.selectExpr("0 AS g", "applicant_id * 7919 AS h", "applicant_id AS i")
    plans = [SP.cut_offs(rows, [(0, 1000)]), SP.stratified_split(df, "label")]
    for plan in plans:
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" in text and "SortMergeJoin" not in text and "CartesianProduct" not in text


def test_scores_are_counted_batch_by_batch(spark):
    """No table of scores grows in a task; ties that lie in many batches are still one."""
    df = spark.range(0, 4000, 1, 3).selectExpr("'m' AS m", "CAST(id % 4 AS DOUBLE) AS score", "id % 3 = 0 AS positive")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = MT.rank_sum_auc(df, ["m"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = out.first().auc
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert "keys=[g#" in plan and ", s#" not in "".join(x for x in plan.splitlines() if "HashAggregate(keys" in x)
    rows = [(float(k % 4), k % 3 == 0) for k in range(4000)]
    pos, neg = [s for s, p in rows if p], [s for s, p in rows if not p]
    won = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    assert got == pytest.approx(won / len(pos) / len(neg), abs=1e-12)


@pytest.mark.parametrize("kind", ["gini", "newton"])
def test_sides_without_a_check_give_the_checked_tree(kind):
    # A row that doesn't count brings the check of both sides back; it must not change the tree.
    rng = np.random.default_rng(5)
    x = np.stack([rng.normal(size=900), rng.integers(0, 6, 900).astype(float), rng.normal(size=900)], axis=1)
    y = (x[:, 0] + 0.5 * x[:, 1] > 1).astype(float) if kind == "gini" else np.round(8 * x[:, 0] * x[:, 1])
    w = 1.0 + rng.integers(0, 3, 900)
    cols = [w * (y == 0), w * (y == 1)] if kind == "gini" else [w * y, w]
    stats = np.stack([*cols, np.ones(900)], axis=1)
    rule = T.Rule(kind, to_purity=True)
    for per_node in (None, 2):
        fast = T.grow(x, stats, y, rule, None, per_node, None, [3])
        more = T.grow(np.vstack([x, x[:1]]), np.vstack([stats, 0 * stats[:1]]), np.r_[y, y[0]], rule, None, per_node,
                      None, [3])
        assert vars(fast) == vars(more)
    assert np.array_equal(rule.score(stats), rule.score(stats[:, :-1], False))


def test_large_trees_stay_out_of_memory(spark, gappy, monkeypatch):
    """The driver maps packed trees from a file, and a model is sent, scored and saved part by part."""
    import mmap

    def origin(a):
        while isinstance(a, np.ndarray):
            a = a.base
        return a.obj if isinstance(a, memoryview) else a
    x, y, df = gappy
    for est in (T.Forest("class", trees=4), T.Forest("value", trees=5, fit_rows=200)):
        plain = est.fit(df)
        with monkeypatch.context() as m:
            m.setattr(T, "PACKED_NODES", 2)
            m.setattr(T, "COMPILED_NODES", 0)
            m.setattr(T, "FETCHED", 1)
            m.setattr(T, "PART_BYTES", 1)
            m.setattr(T, "PART_ROWS", 150)
            large = est.fit(df)
            path = scratch_path(spark, "parts")
            large.save(spark, path)
            for model in (large, T.TreeModel.load(spark, path)):
                packed = [t for t in model.trees if isinstance(t, T.Packed)]
                assert packed and all(isinstance(origin(t.cut), mmap.mmap) for t in packed)
                rows = model.transform(df, scores="s").orderBy("applicant_id").collect()
                assert len(model._on_workers(spark)) == len(model.trees)
                assert np.abs(np.array([r.s for r in rows]) - plain.scores(x)).max() == 0
                assert np.allclose(model.featureImportances, plain.featureImportances, rtol=1e-12, atol=0)
