"""Tables behind the EDA charts: histograms, densities, samples, scatters.

Histograms are two small jobs: one aggregate for the range (and, for the
automatic bin rule, size and quartiles) of every column, then one grouped
count over (column, bin). The long (column, value) form is produced by an
``explode`` that feeds the partial aggregation directly, so only
(#tasks × #columns × #bins) rows are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import HISTOGRAM_BINS, ID, SAMPLE_SIZE, SEED

DENSITY_BINS = 512
DENSITY_GRID = 200


def _ranges(df: DataFrame, cols, with_quartiles: bool = False) -> dict:
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.count(x).alias(f"n{i}"),
                 F.stddev_samp(x).alias(f"sd{i}")]
    row = df.agg(*aggs).first()
    qs = {}
    if with_quartiles:
        # The same aggregate sized the columns for the quantiles.
        from .quantiles import quantiles
        sizes = {c: {"n": row[f"n{i}"], "min": row[f"lo{i}"], "max": row[f"hi{i}"],
                     "rows": row["rows"]} for i, c in enumerate(cols)}
        qs = quantiles(df, cols, [0.25, 0.75], sizes=sizes)
    out = {}
    for i, c in enumerate(cols):
        d = {"lo": row[f"lo{i}"], "hi": row[f"hi{i}"], "n": row[f"n{i}"], "sd": row[f"sd{i}"]}
        if with_quartiles:
            q = qs.get(c)
            d["q1"], d["q3"] = (q[0], q[1]) if q and q[0] is not None else (None, None)
        out[c] = d
    return out


def equal_width_edges(lo: float, hi: float):
    """Range of the bins; a constant column gets [v − 0.5, v + 0.5]."""
    if lo == hi:
        return lo - 0.5, hi + 0.5
    return lo, hi


def auto_bins(n: int, lo: float, hi: float, q1: float, q3: float) -> int:
    """numpy's 'auto' rule: the smaller of the Sturges width and the
    Freedman–Diaconis width, the latter held at least at half the
    square-root-rule width (so a zero IQR cannot create endless bins)."""
    if n == 0 or lo is None:
        return 1
    ptp = hi - lo
    sturges = ptp / (math.log2(n) + 1.0)
    fd = 2.0 * (q3 - q1) * n ** (-1.0 / 3.0)
    width = min(max(fd, ptp / math.sqrt(n) / 2), sturges)
    first, last = equal_width_edges(lo, hi)
    return max(1, int(math.ceil((last - first) / width))) if width else 1


def _binned(df: DataFrame, cols, spec: dict, by=()) -> DataFrame:
    """Grouped counts per (column, bin) for given (lo, hi, bins) per column,
    and per value of the columns ``by``.

    Each column's bin is an expression with its own literals; only (column
    number, bin) is exploded and shuffled, and names and edges are attached
    to the few counted rows.
    """
    cols, by = list(cols), list(by)
    if not cols:
        return df.where(F.lit(False)).select(
            *by, F.lit("").alias("column"), F.lit(0).alias("bins"), F.lit(0).alias("bin"),
            F.lit(0.0).alias("bin_lo"), F.lit(0.0).alias("bin_hi"), F.lit(0).cast("long").alias("count"))
    cells = []
    for i, c in enumerate(cols):
        lo, hi, k = float(spec[c][0]), float(spec[c][1]), int(spec[c][2])
        x = F.col(c).cast("double")
        cells.append(F.struct(F.lit(i).alias("at"), F.least(
            F.lit(k - 1), F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(k)).cast("int"))
            .alias("bin"), x.isNotNull().alias("some")))
    g = (df.select(*by, F.explode(F.array(*cells)).alias("_v")).where("_v.some")
         .groupBy(*by, F.col("_v.at").alias("_at"), F.col("_v.bin").alias("bin"))
         .agg(F.count(F.lit(1)).alias("count")))
    edges = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(float(spec[c][0])).alias("lo"),
                               F.lit(float(spec[c][1])).alias("hi"), F.lit(int(spec[c][2])).alias("k"))
                      for c in cols])
    g = g.withColumn("_e", F.element_at(edges, F.col("_at") + 1))
    lo, k = F.col("_e.lo"), F.col("_e.k")
    width = (F.col("_e.hi") - lo) / k
    return g.select(*by, F.col("_e.column").alias("column"), k.alias("bins"), "bin",
                    (lo + F.col("bin") * width).alias("bin_lo"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "count")


def histograms(df: DataFrame, cols, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(column, bins, bin, bin_lo, bin_hi, count), equal-width bins over
    [min, max]; the maximum falls in the last bin; empty bins omitted."""
    cols = list(cols)
    r = _ranges(df, cols)
    spec = {c: (*equal_width_edges(r[c]["lo"], r[c]["hi"]), bins)
            for c in cols if r[c]["lo"] is not None}
    return _binned(df, [c for c in cols if c in spec], spec)


def auto_histograms(df: DataFrame, cols) -> DataFrame:
    """Histograms with the automatic bin count per column (NULLs dropped)."""
    cols = list(cols)
    r = _ranges(df, cols, with_quartiles=True)
    spec = {}
    for c in cols:
        d = r[c]
        if d["lo"] is None:
            continue
        lo, hi = equal_width_edges(d["lo"], d["hi"])
        spec[c] = (lo, hi, auto_bins(d["n"], d["lo"], d["hi"], d["q1"], d["q3"]))
    return _binned(df, list(spec), spec)


def density_bins(lo: float, hi: float, h: float, least: int = DENSITY_BINS) -> int:
    """Bins of a density: at least ``least``, and at least 8 to a bandwidth,
    so that binning stays finer than the kernel as the bandwidth shrinks."""
    return max(least, int(math.ceil(8 * (hi - lo) / h)))


def density_curve(df: DataFrame, cols, grid: int = DENSITY_GRID,
                  bins: int = DENSITY_BINS, by: str | None = None) -> DataFrame:
    """Gaussian kernel density on a grid over [min, max], bandwidth
    std·n^(-1/5) (Scott), evaluated over binned counts: the rows are first
    reduced to weighted centres of ``density_bins`` per column, then each
    centre is spread over the grid by ``explode(sequence)``. Work is
    bins × grid per column; the bins grow with n^(1/5).
    Output (column, point, x, density).

    ``by``: a label column; one curve per label and column, on the column's
    common grid and bins, each with the label's own bandwidth, weighted by
    the label's share of the rows (output has ``by`` too). Labels with one
    value or no spread have no curve, and rows without a label none.
    """
    cols = list(cols)
    r = _ranges(df, cols)
    cols = [c for c in cols if r[c]["lo"] is not None and r[c]["n"] > 1 and r[c]["sd"]]
    keys = [by] if by else []
    src = df.where(F.col(by).isNotNull()) if by else df
    # Size and spread of every curve: one row per label.
    sizes = src.groupBy(*keys).agg(*[a for i, c in enumerate(cols) for a in (
        F.count(F.col(c)).alias(f"n{i}"), F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}"))]) \
        if by and cols else None
    spec, all_n = {}, {}
    for c in cols:
        lo, hi = equal_width_edges(r[c]["lo"], r[c]["hi"])
        h = r[c]["sd"] * r[c]["n"] ** (-1.0 / 5.0)
        spec[c], all_n[c] = (lo, hi, density_bins(lo, hi, h, bins)), (r[c]["n"], h)
    cnt = _binned(src, cols, spec, keys)
    if not cols:
        return cnt.select(*keys, "column", F.lit(0).alias("point"), F.lit(0.0).alias("x"),
                          F.lit(0.0).alias("density"))
    if by:
        per = sizes.select(by, F.explode(F.array(*[F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").cast("double").alias("n"),
            (F.col(f"s{i}") * F.pow(F.col(f"n{i}").cast("double"), F.lit(-0.2))).alias("h"))
            for i, c in enumerate(cols)])).alias("_s")).select(by, "_s.*") \
            .where((F.col("n") > 1) & (F.col("h") > 0))
        cnt = cnt.join(per, [by, "column"])
        total = F.create_map(*[F.lit(x) for c in cols for x in (c, float(all_n[c][0]))])
        n = F.element_at(total, F.col("column"))
        hh = F.col("h")
    else:
        m_h = F.create_map(*[F.lit(x) for c in cols for x in (c, float(all_n[c][1]))])
        m_n = F.create_map(*[F.lit(x) for c in cols for x in (c, float(all_n[c][0]))])
        hh, n = F.element_at(m_h, F.col("column")), F.element_at(m_n, F.col("column"))
    m_lo = F.create_map(*[F.lit(x) for c in cols for x in (c, float(r[c]["lo"]))])
    m_hi = F.create_map(*[F.lit(x) for c in cols for x in (c, float(r[c]["hi"]))])
    lo, hi = F.element_at(m_lo, F.col("column")), F.element_at(m_hi, F.col("column"))
    centre = (F.col("bin_lo") + F.col("bin_hi")) / 2
    # The lookups are made per counted bin, before the grid multiplies the rows.
    pts = cnt.select(*keys, "column", "count", centre.alias("c"), hh.alias("h"), n.alias("n"),
                     lo.alias("lo"), hi.alias("hi"),
                     F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    x = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / F.lit(grid - 1)
    z = (x - F.col("c")) / F.col("h")
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return (pts.groupBy(*keys, "column", "point", x.alias("x"))
               .agg(F.sum(F.col("count") * F.exp(-0.5 * z * z) / norm).alias("density"))
               .select(*keys, "column", "point", "x", "density"))


# ---------------------------------------------------------------------------
# Deterministic samples and splits
# ---------------------------------------------------------------------------

# Integer mixing constants of the sampling key (modulus 2^31 - 1, a prime).
MIX_P = 2147483647
MIX_STEPS = ((48271, 0), (1, 1013904223), (69621, 12345), (1, 2654435761))


def _mix(x, seed: int):
    p = F.lit(MIX_P)
    h = F.pmod(F.pmod(x, p) + F.lit(seed), p)
    h = F.pmod(h * F.lit(MIX_STEPS[0][0]), p)
    h = F.pmod(h * h + F.lit(MIX_STEPS[1][1]), p)
    h = F.pmod(h * F.lit(MIX_STEPS[2][0]) + F.lit(MIX_STEPS[2][1]), p)
    return F.pmod(h * h + F.lit(MIX_STEPS[3][1]), p)


def hash_key(key: str = ID, seed: int = SEED):
    """A per-row pseudo-random key that depends only on the id and seed,
    so samples and splits are identical on re-execution (e.g. after an
    executor is lost) and under any partitioning.

    Multiplications and squarings modulo 2^31 − 1 on BIGINT: every
    intermediate stays below 2^63, so it cannot overflow, runs inside
    whole-stage codegen and gives the same value in any SQL engine."""
    return _mix(F.col(key).cast("long"), seed)


def long_hash_key(key: str = ID, seed: int = SEED):
    """A 62-bit key of the same kind: two mixed 31-bit halves. The second also
    takes the id's upper half, so ids that agree in the first differ in it."""
    first = hash_key(key, seed)
    second = _mix(first + F.shiftright(F.col(key).cast("long"), 31), seed + 1)
    return first * F.lit(1 << 31) + second


def hash_key_sql(key: str = ID, seed: int = SEED) -> str:
    """The same key as SQL text."""
    p = MIX_P
    h = f"((({key} % {p}) + {seed}) % {p})"
    h = f"(({h} * {MIX_STEPS[0][0]}) % {p})"
    h = f"(({h} * {h} + {MIX_STEPS[1][1]}) % {p})"
    h = f"(({h} * {MIX_STEPS[2][0]} + {MIX_STEPS[2][1]}) % {p})"
    return f"(({h} * {h} + {MIX_STEPS[3][1]}) % {p})"


def long_hash_key_sql(first: str, key: str = ID, seed: int = SEED) -> str:
    """The 62-bit key as SQL text, given a column that holds ``hash_key_sql``."""
    return f"({first} * {1 << 31} + {hash_key_sql(f'({first} + ({key} >> 31))', seed + 1)})"


def sample_rows(df: DataFrame, n: int = SAMPLE_SIZE, key: str = ID, seed: int = SEED) -> DataFrame:
    """min(n, rows) rows without replacement: the n smallest hash keys
    (top-k per task, then a merge of k rows per task). A hash threshold that
    about n rows pass goes first, so that the merge reads about n rows,
    however many tasks there are; it is widened if fewer pass."""
    h = hash_key(key, seed)
    rows = df.count()
    share = min(1.0, (n + 10 * math.sqrt(n)) / max(rows, 1))
    while share < 1.0 and df.where(h < int(share * MIX_P)).count() < min(n, rows):
        share = min(1.0, 2 * share)
    near = df if share >= 1.0 else df.where(h < int(share * MIX_P))
    return near.orderBy(h, F.col(key)).limit(n)


def pair_data(df: DataFrame, cols, label: str, n: int = SAMPLE_SIZE) -> DataFrame:
    return sample_rows(df.select(ID, *cols, label), n)


def scatter_data(df: DataFrame, xs, ys, label: str, n: int = SAMPLE_SIZE) -> DataFrame:
    """(feature, ratio, x, y, class) for every feature × ratio on the sample."""
    s = sample_rows(df.select(ID, *set(xs) | set(ys), label), n)
    arr = F.array(*[F.struct(F.lit(a).alias("feature"), F.lit(b).alias("ratio"),
                             F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
                    for a in xs for b in ys])
    return s.select(ID, F.col(label).alias("class"), F.explode(arr).alias("_p")).select(
        ID, "_p.feature", "_p.ratio", "_p.x", "_p.y", "class")
