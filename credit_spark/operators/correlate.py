"""Pearson correlations (pairwise-complete) and correlation-based feature
selection.

Two passes:

1. per column: count, mean, population variance, min, max, one aggregate;
2. one Spark ML ``Correlation`` job over the mean-centred columns: each task
   sums a p×p Gramian, and only the p×p result reaches the driver. When a
   column has missing values, the job runs over 3p columns instead (value or
   0, square or 0, present or not), whose Gramian has the count, the sums and
   the sums of squares over the rows that a pair has in common.

Centring by the column mean is the two-pass covariance algorithm, so the
sums do not cancel catastrophically. A constant column (min = max) gives
NULL, as does a pair with no spread. Selection needs only the pairs with the
targets plus the pairs among candidates, not the whole matrix.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MAX_PAIR_CORRELATION, MIN_TARGET_CORRELATION, TARGET_AMOUNT, TARGET_CLASS

# A column's spread over the rows it shares with another, in variances of
# the whole column; below this it counts as none.
NO_SPREAD = 1e-12


def _column_moments(df: DataFrame, cols) -> dict:
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return {c: {"n": row["n"], "count": row[f"c{i}"], "mean": row[f"m{i}"], "var": row[f"v{i}"],
                "flat": row[f"lo{i}"] is None or row[f"lo{i}"] == row[f"hi{i}"]}
            for i, c in enumerate(cols)}


def _gram_correlations(df: DataFrame, cols, mom) -> dict:
    """Pearson matrix of complete columns in one job: Spark ML's
    ``Correlation`` aggregates a p×p Gramian per task (tree aggregate, no
    generated code); only the p×p result reaches the driver. Columns are
    centred by their mean first, which keeps the Gramian well conditioned."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    cen = df.select(*[(F.col(c).cast("double") - F.lit(float(mom[c]["mean"]))).alias(f"_c{i}")
                      for i, c in enumerate(cols)])
    vec = VectorAssembler(inputCols=[f"_c{i}" for i in range(len(cols))], outputCol="_v").transform(cen)
    mat = Correlation.corr(vec, "_v", "pearson").first()[0].toArray()
    out = {}
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = float(mat[i, j])
            out[(a, b)] = None if (math.isnan(v) or mom[a]["flat"] or mom[b]["flat"]) else v
    return out


def _masked_correlations(df: DataFrame, cols, mom) -> dict:
    """Pearson matrix over the rows that each pair of columns has in common.

    E[xy] of any two of the 3p columns is their correlation times both
    deviations plus the product of their means.
    """
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation, Summarizer
    p, n = len(cols), mom[cols[0]]["n"]
    ext = []
    for i, c in enumerate(cols):
        z = (F.col(c).cast("double") - F.lit(float(mom[c]["mean"]))) / F.lit(math.sqrt(mom[c]["var"]))
        z = F.coalesce(z, F.lit(0.0))
        ext.append((z.alias(f"_v{i}"), (z * z).alias(f"_q{i}"),
                    F.col(c).isNotNull().cast("double").alias(f"_p{i}")))
    flat = [e[k] for k in range(3) for e in ext]
    wide = df.select(*flat)
    vec = VectorAssembler(inputCols=wide.columns, outputCol="_v").transform(wide).select("_v")
    got = vec.select(Summarizer.metrics("mean", "variance").summary(F.col("_v")).alias("m")).first().m
    mean = got.mean.toArray()
    sd = np.sqrt(np.maximum(got.variance.toArray() * (n - 1) / n, 0.0))
    r = np.nan_to_num(Correlation.corr(vec, "_v", "pearson").first()[0].toArray())
    both = r * np.outer(sd, sd) + np.outer(mean, mean)
    v, q, here = slice(0, p), slice(p, 2 * p), slice(2 * p, 3 * p)
    share = both[here, here]
    out = {}
    with np.errstate(divide="ignore", invalid="ignore"):
        mx = both[v, here] / share
        var = both[q, here] / share - mx ** 2
        cov = both[v, v] / share - mx * mx.T
        res = cov / np.sqrt(var * var.T)
    some = (np.rint(share * n) > 0) & (var > NO_SPREAD) & (var.T > NO_SPREAD)
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            out[(a, b)] = float(res[i, j]) if some[i, j] else None
    return out


def pair_values(df: DataFrame, pairs, mom: dict | None = None) -> dict:
    """{(a, b): r} for the pairs (eager: one moments job unless ``mom``
    already holds them, then one Gramian job)."""
    pairs = list(dict.fromkeys(pairs))
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    if mom is None or not all(c in mom for c in cols):
        mom = _column_moments(df, cols)
    usable = [c for c in cols if not mom[c]["flat"] and mom[c]["var"]]
    if len(usable) < 2:
        return {pair: 1.0 if pair[0] == pair[1] and pair[0] in usable else None for pair in pairs}
    complete = all(mom[c]["count"] == mom[c]["n"] for c in usable)
    g = (_gram_correlations if complete else _masked_correlations)(df, usable, mom)
    return {(a, b): g.get((a, b)) for a, b in pairs}


def correlations(df: DataFrame, pairs) -> DataFrame:
    """(a, b, r) for the given column pairs."""
    pairs = list(pairs)
    vals = pair_values(df, pairs) if pairs else {}
    return df.sparkSession.createDataFrame([(a, b, vals.get((a, b))) for a, b in pairs],
                                           "a string, b string, r double")


def upper_pairs(cols):
    cols = list(cols)
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


def correlation_matrix(df: DataFrame, cols) -> DataFrame:
    """Long matrix (a, b, r) over a < b in column order."""
    return correlations(df, upper_pairs(cols))


def target_correlation(df: DataFrame, cols, target: str) -> DataFrame:
    """(feature, r) of every column with the target, descending; the target's own row is 1."""
    c = correlations(df, [(f, target) for f in cols if f != target]).select(F.col("a").alias("feature"), "r")
    own = df.sparkSession.range(1).select(F.lit(target).alias("feature"), F.lit(1.0).alias("r"))
    return c.unionByName(own).orderBy(F.col("r").desc_nulls_last())


# ---------------------------------------------------------------------------
# Selection
# ---------------------------------------------------------------------------

def _collect_pairs(df, pairs, mom: dict | None = None) -> dict:
    out = {}
    for (a, b), r in pair_values(df, pairs, mom).items():
        out[(a, b)] = r
        out[(b, a)] = r
    return out


def candidates(order, target_r: dict, threshold: float = MIN_TARGET_CORRELATION):
    """Columns (in table order) whose |r| with the target exceeds the
    threshold; a NULL r (constant column) is dropped."""
    return [c for c in order if target_r.get(c) is not None and abs(target_r[c]) > threshold]


def prune(features, r: dict, threshold: float = MAX_PAIR_CORRELATION):
    """Greedy: keep f if |r(f, s)| < threshold for every kept s. A NULL r
    does not pass the test (comparisons with NaN are false)."""
    kept = []
    for f in features:
        ok = True
        for s in kept:
            v = r.get((f, s))
            if v is None or not abs(v) < threshold:
                ok = False
                break
        if ok:
            kept.append(f)
    return kept


def select_features(df: DataFrame, cols, exclude=()) -> dict:
    """Feature lists for both tasks, as the original selection computes them.

    classification: |r| > 0.05 with the class code, then pruned at 0.85.
    regression: |r| > 0.05 with the amount; the class code is appended if
    absent; then pruned. Only target pairs and candidate pairs are computed.
    Returns {"classification": [...], "regression": [...], "target_r": {...}}.
    """
    cols = [c for c in cols if c not in exclude]
    feats = [c for c in cols if c not in (TARGET_CLASS, TARGET_AMOUNT)]
    mom = _column_moments(df, cols)
    if all(mom[c]["count"] == mom[c]["n"] for c in cols):
        # Complete columns: one Gramian job gives every pair at the cost of
        # a few, so target and candidate pairs come from the same pass.
        tr = _collect_pairs(df, upper_pairs(cols), mom)
    else:
        tr = _collect_pairs(df, [(c, TARGET_CLASS) for c in cols if c != TARGET_CLASS]
                            + [(c, TARGET_AMOUNT) for c in cols
                               if c not in (TARGET_AMOUNT, TARGET_CLASS)], mom)
    r_cls = {c: tr.get((c, TARGET_CLASS)) for c in cols if c != TARGET_CLASS}
    r_amt = {c: tr.get((c, TARGET_AMOUNT)) for c in cols if c != TARGET_AMOUNT}
    clf = candidates([c for c in cols if c != TARGET_CLASS], r_cls)
    reg = candidates([c for c in cols if c != TARGET_AMOUNT], r_amt)
    if TARGET_CLASS not in reg:
        reg.append(TARGET_CLASS)
    need = sorted(set(clf) | set(reg))
    pr = dict(tr)
    todo = [p for p in upper_pairs(need) if p not in pr]
    if todo:
        pr.update(_collect_pairs(df, todo, mom))
    return {"classification": prune(clf, pr), "regression": prune(reg, pr),
            "classification_candidates": clf, "regression_candidates": reg,
            "r_class": r_cls, "r_amount": r_amt, "features": feats}
