"""Exact quantiles (linear interpolation between order statistics) that
stay distributed on any column.

Spark's exact ``percentile`` keeps a value→count map per column and merges
all maps in one task, which no column of mostly distinct values survives.
Here every wanted rank has a bracket of values that holds it, at first the
column's minimum and maximum. Each round is one aggregate: the rows inside a
bracket are counted in ``BINS`` equal-width bins, with each bin's real
minimum and maximum, and the bracket becomes the bin that holds the rank.
Bins are monotone in the value, so the rows below the new bracket are
exactly the rows of the earlier bins, and the result is exact. A round ends
when every bracket holds one value. The smallest value of a bracket is in
its first bin and the largest in its last one, so every round shrinks every
bracket; there is no limit on rounds, on distinct values or on rows.

The sizing pass also builds a mergeable quantile sketch of each column
(``GRID`` + 1 values whose ranks are known to n / ``ACCURACY``). The first
round then counts a column's rows below the narrow brackets that the sketch
gives for its ranks, by a plain aggregate, and tells the values inside apart,
by value while they are few. So the common case takes three scans: sizes,
rows below, rows inside; only rows inside a bracket are ever exploded.
A wrong sketch would cost rounds, not exactness: every count is of real rows.

A round shuffles at most (tasks × brackets × ``BINS``) small rows. The
running count over a bracket's bins sees ``BINS`` rows, and one row for each
bracket and rank reaches the driver.

The interpolation is the one of Spark's ``percentile`` and DuckDB's
``quantile_cont``: position (n−1)·p between the floor and ceil ranks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 1024
GRID = 1024
ACCURACY = 10_000
# Rows inside all brackets up to which the first round tells single values apart. They are counted by
# map-side aggregates and a window for each bracket, which spill.
FEW_VALUES = 1 << 24


def _bin(x, lo: float, hi: float):
    """Bin number of ``x`` in [lo, hi]; hi is always in the last bin."""
    half = 0.5 if math.isinf(hi - lo) else 1.0      # the difference must not overflow
    step = (x * half - F.lit(lo * half)) / F.lit(hi * half - lo * half) * BINS
    return F.when(x >= F.lit(hi), BINS - 1).otherwise(F.least(F.lit(BINS - 1), F.floor(step))).cast("int")


def sketch_agg(x):
    """The sketch's values of one column, for the aggregate that sizes it."""
    # One text, as a thousand literals for each column would take seconds to plan.
    grid = " ".join(str(k / GRID) for k in range(GRID + 1))
    return F.percentile_approx(x, F.split(F.lit(grid), " ").cast("array<double>"), ACCURACY)


def _brackets(ranks, size: dict) -> list:
    """Disjoint, rising [lo, hi, ranks] from the sketch that hold the values at ``ranks``."""
    n, grid = size["n"], size["grid"]
    slack = n / ACCURACY + 1
    out = []
    for r in sorted(ranks):
        a, b = math.floor((r - slack) / n * GRID) - 1, math.ceil((r + 1 + slack) / n * GRID) + 1
        lo = size["min"] if a < 0 else max(size["min"], grid[a])
        hi = size["max"] if b > GRID else min(size["max"], grid[b])
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
            out[-1][2].append(r)
        else:
            out.append([lo, hi, [r]])
    return out


def _from_sketch(df: DataFrame, targets, sizes: dict) -> dict:
    """{(column, rank): (lo, hi, rows below)}: a scan counts the rows below every bracket, another those inside."""
    ranks: dict = {}
    for c, r in targets:
        ranks.setdefault(c, []).append(r)
    few = sum(len(r) * sizes[c]["n"] * (2 / GRID + 2 / ACCURACY) for c, r in ranks.items()) <= FEW_VALUES
    brackets = [(c, lo, hi, own) for c, r in ranks.items() for lo, hi, own in _brackets(r, sizes[c])]
    below = df.agg(*[F.count_if(F.col(c).cast("double") < F.lit(lo)) for c, lo, _, _ in brackets]).first()
    hits = _cells(df, [(c, lo, hi, [r - n for r in own]) for (c, lo, hi, own), n in zip(brackets, below)], few)
    state = {}
    for h in hits:
        c, _, _, own = brackets[h["g"]]
        first = below[h["g"]] + h["last"] - h["n"]
        for r in own:
            if first <= r < first + h["n"]:
                state[(c, r)] = (h["mn"], h["mx"], first)
    return state


def _cells(df: DataFrame, brackets, by_value: bool = False) -> list:
    """One scan: rows of every bin (or value) inside the brackets (column, lo, hi, wanted ranks in it), and of
    those the cells that hold a wanted rank. Rows outside all brackets make no array.

    That is a condition of the array, not a filter: Spark carries a filter over many computed columns up through
    their projection in every mix of names and expressions, twice as many for each column, and never ends planning."""
    items, wanted, some = [], [], F.lit(False)
    for g, (c, lo, hi, own) in enumerate(brackets):
        x = F.col(c).cast("double")
        within = (x >= F.lit(lo)) & (x <= F.lit(hi))
        key = x if by_value else _bin(x, lo, hi).cast("double") if lo < hi else F.lit(0.0)
        items.append(F.when(within, F.struct(F.lit(g).alias("g"), key.alias("k"), x.alias("x"))))
        wanted.append(F.array(*[F.lit(r).cast("long") for r in own]))
        some = some | F.coalesce(within, F.lit(False))
    inside = F.when(some, F.filter(F.array(*items), lambda e: e.isNotNull()))
    cells = (df.select(F.explode(inside).alias("_e"))
             .groupBy(F.col("_e.g").alias("g"), F.col("_e.k").alias("k"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("_e.x").alias("mn"), F.max("_e.x").alias("mx")))
    upto = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = F.get(F.array(*wanted), F.col("g"))
    return (cells.withColumn("last", F.sum("n").over(upto))
            .where(F.exists(ranks, lambda j: (j >= F.col("last") - F.col("n")) & (j < F.col("last")))).collect())


def _refine(df: DataFrame, targets, sizes: dict) -> dict:
    """(column, rank) targets → {(column, rank): value}."""
    state = {t: (sizes[t[0]]["min"], sizes[t[0]]["max"], 0) for t in targets}     # lo, hi, rows below
    sketched = [t for t in targets if sizes[t[0]].get("grid") and state[t][0] < state[t][1]]
    if sketched:
        state.update(_from_sketch(df, sketched, sizes))
    result = {}
    while True:
        for t, (lo, hi, _) in state.items():
            if lo == hi:
                result[t] = lo
        # Targets with the same bracket share its histogram.
        brackets: dict = {}
        for t, s in state.items():
            if t not in result:
                brackets.setdefault((t[0], *s), []).append(t)
        if not brackets:
            return result
        hits = _cells(df, [(c, lo, hi, [t[1] - below for t in own]) for (c, lo, hi, below), own in brackets.items()])
        owners = list(brackets.items())
        for r in hits:
            (_, _, _, below), own = owners[r["g"]]
            first = r["last"] - r["n"]
            for t in own:
                if first <= t[1] - below < r["last"]:
                    state[t] = (r["mn"], r["mx"], below + first)


def column_sizes(df: DataFrame, cols) -> dict:
    """rows, count, min, max and sketch of each column, in one pass."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 sketch_agg(x).alias(f"q{i}")]
    row = df.agg(*aggs).first()
    return {c: {"n": row[f"n{i}"], "min": row[f"lo{i}"], "max": row[f"hi{i}"], "grid": row[f"q{i}"],
                "rows": row["rows"]} for i, c in enumerate(cols)}


def quantiles(df: DataFrame, cols, probs, sizes: dict | None = None) -> dict:
    """{column: [q(p) for p in probs]} (None for a column without values).
    ``sizes``: the ``column_sizes`` of these columns when already known."""
    cols, probs = list(cols), list(probs)
    if not cols:
        return {}
    stats = sizes if sizes is not None and all(c in sizes for c in cols) else column_sizes(df, cols)
    full = [c for c in cols if stats[c]["n"]]
    got = order_statistics(df, {c: {j for p in probs for j in _ranks_of(p, stats[c]["n"])} for c in full}, stats)
    return {c: [interpolate_like_percentile(p, stats[c]["n"], lambda j, c=c: got[c][j]) for p in probs]
            if c in got else [None] * len(probs) for c in cols}


# ---------------------------------------------------------------------------
# Order statistics at given ranks
# ---------------------------------------------------------------------------

def interpolate_like_percentile(p: float, n: int, value_at) -> float:
    """Linear interpolation between order statistics exactly as Spark's
    ``percentile`` computes it (equal neighbours return the value)."""
    pos = float(n - 1) * p
    lo, hi = math.floor(pos), math.ceil(pos)
    a = float(value_at(lo))
    if lo == hi:
        return a
    b = float(value_at(hi))
    if a == b:
        return a
    return (hi - pos) * a + (pos - lo) * b


def order_statistics(df: DataFrame, ranks: dict, sizes: dict) -> dict:
    """{column: {rank: value}}: exact 0-based order statistics of the
    non-missing values of numeric columns."""
    ranks = {c: set(r) for c, r in ranks.items() if r and sizes[c]["n"]}
    out = {c: {} for c in ranks}
    for (c, j), v in _refine(df, [(c, j) for c in ranks for j in sorted(ranks[c])], sizes).items():
        out[c][j] = float(v)
    return out


def _ranks_of(p: float, n: int):
    pos = float(n - 1) * p
    return [math.floor(pos), math.ceil(pos)]


def median_and_filled_quartiles(df: DataFrame, cols, sizes: dict, probs=(0.25, 0.75)) -> dict:
    """Median of each column and the quartiles the column will have after
    its missing values are filled with that median, from one pass.

    Filling adds k copies of the median m to the n values X. In sorted
    order they sit after every value below m, so the filled column's value
    at rank r is X(r) when X(r) < m, X(r−k) when X(r−k) > m, and m
    otherwise. Only ranks of X are needed, all known from n and k before
    the pass. Returns {column: (median, [q(p) for p in probs])}."""
    cols = [c for c in cols if sizes[c]["n"]]
    want = {}
    for c in cols:
        n, k = sizes[c]["n"], sizes[c]["rows"] - sizes[c]["n"]
        r = set(_ranks_of(0.5, n))
        for p in probs:
            for j in _ranks_of(p, n + k):
                r.update(x for x in (j, j - k) if 0 <= x < n)
        want[c] = r
    stats = order_statistics(df, want, sizes)
    out = {}
    for c in cols:
        n, k = sizes[c]["n"], sizes[c]["rows"] - sizes[c]["n"]
        x = stats[c]
        m = interpolate_like_percentile(0.5, n, lambda j: x[j])

        def filled_at(r, x=x, m=m, n=n, k=k):
            if r < n and x[r] < m:
                return x[r]
            if 0 <= r - k < n and x[r - k] > m:
                return x[r - k]
            return m
        out[c] = (m, [interpolate_like_percentile(p, n + k, filled_at) for p in probs])
    return out
