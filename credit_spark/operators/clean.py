"""Cleaning: deduplicate, repair text, fill, cap outliers, log-scale.

Plan shape (see ``clean``): one shuffle for the exact full-row dedupe
(hash aggregate with map-side combine, so a hot group of copies collapses
before the exchange), then narrow projections. The fitted statistics
(medians and modes; then quartiles of the filled columns) come from
aggregates whose results are bounded by the number of columns (exact
quantiles stay distributed, see ``quantiles``); they are inlined into the
final projection as literals, so the big table is never joined or
re-shuffled for them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import math as M
from ..functions import text as X
from ..schema import (CATEGORICAL, ID, INTEGER, IQR_FENCE, NUMERIC, SKEWED, TARGETS,
                      TITLE_CASED)


# ---------------------------------------------------------------------------
# D1, D2: deduplication
# ---------------------------------------------------------------------------

def dedupe(df: DataFrame, subset=None) -> DataFrame:
    """Drop exact duplicate rows (NULL, NaN and ±0.0 each compare equal).

    The id is a row key that copies share, so it takes part like any other
    column."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def dedupe_report(df: DataFrame) -> DataFrame:
    """rows_before, rows_after, rows_removed in one grouped pass."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").cast("long").alias("rows_before"),
        F.count(F.lit(1)).cast("long").alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


# ---------------------------------------------------------------------------
# Text repair (stateless)
# ---------------------------------------------------------------------------

def clean_text(df: DataFrame) -> DataFrame:
    """Text and number repair, one projection, no aggregates.

    age: first digit run; gender: mapped; six categories: title-cased and
    stripped (missing → ``Nan``); 17 numeric columns: numeric-text rule;
    age, family_size, dependents, requested_tenure rounded half-to-even.
    Columns that are absent are skipped. Numeric results are DOUBLE.
    """
    cols = set(df.columns)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in df.columns:
        e = F.col(c)
        if isinstance(dtypes[c], T.StringType):
            e = X.na_to_null(e)
        if c == "age":
            e = X.extract_age(e)
        elif c == "gender":
            e = X.clean_gender(e)
        elif c in TITLE_CASED:
            e = X.clean_category(e)
        if c in NUMERIC:
            if c == "age":
                e = e.cast("double")  # digits only: the text rule is a no-op
            else:
                e = X.numeric_value(e, dtypes[c])
            e = M.nullify_nonfinite(e)      # NaN and infinities count as missing
            if c in INTEGER:
                e = M.round_half_even(e)
        out[c] = e.alias(c)
    missing = {"age", "gender", "marital_status", "education", "existing_loans"} - cols
    if missing:
        raise ValueError(f"required columns absent: {sorted(missing)}")
    return df.select(*[out[c] for c in df.columns])


def typed_inputs(df: DataFrame) -> DataFrame:
    """Inputs as they were entered, with numbers parsed: nothing filled,
    rounded, mapped or re-cased; missing stays missing."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}

    def typed(c):
        e = X.na_to_null(F.col(c)) if isinstance(dtypes[c], T.StringType) else F.col(c)
        if c not in NUMERIC:
            return e
        return M.nullify_nonfinite(X.extract_age(e).cast("double") if c == "age" else X.numeric_value(e, dtypes[c]))
    return df.select(*[typed(c).alias(c) for c in df.columns])


def numeric_columns(df: DataFrame, exclude=(ID,) + TARGETS):
    """Numeric feature columns present (ids and targets excluded by name)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def category_columns(df: DataFrame, exclude=(ID,) + TARGETS):
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, T.NumericType) and f.name not in exclude]


# ---------------------------------------------------------------------------
# Fitted statistics
# ---------------------------------------------------------------------------

@dataclass
class CleaningStats:
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    q1: dict = field(default_factory=dict)
    q3: dict = field(default_factory=dict)
    sizes: dict = field(default_factory=dict, repr=False)

    def bounds(self, c):
        q1, q3 = self.q1.get(c), self.q3.get(c)
        if q1 is None or q3 is None:
            return None, None
        iqr = q3 - q1
        return q1 - IQR_FENCE * iqr, q3 + IQR_FENCE * iqr


def modes(df: DataFrame, cols) -> dict:
    """Most frequent non-missing value per column, ties → smallest value.

    Distributed: (column, value) counts with partial aggregation, then one
    ``min_by`` per column over (−count, value); only one row per column
    reaches the driver, however many distinct values there are."""
    cols = list(cols)
    if not cols:
        return {}
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in cols])
    counts = (df.select(F.explode(arr).alias("_e")).select("_e.*")
                .where(F.col("value").isNotNull())
                .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("neg"), F.col("value"))).alias("mode"))
    out = {c: None for c in cols}
    out.update({r["column"]: r["mode"] for r in best.collect()})
    return out


def fit_fill(df: DataFrame, approx: bool = False) -> CleaningStats:
    """Medians of every numeric feature (exact, distributed; see
    ``quantiles``) and modes of every categorical feature that can still be
    missing."""
    nums = numeric_columns(df)
    # Title-cased columns can no longer be missing: no mode needed.
    cats = [c for c in category_columns(df) if c not in TITLE_CASED]
    if approx:
        row = df.agg(*[F.percentile_approx(c, 0.5, 10000).alias(f"m{i}")
                       for i, c in enumerate(nums)]).first() if nums else {}
        med = {c: row[f"m{i}"] for i, c in enumerate(nums)}
        sizes = {}
        return CleaningStats(medians=med, modes=modes(df, cats), sizes=sizes)
    # Exact: a sizing pass, the rounds for the medians, and a pass for the modes.
    from .quantiles import _ranks_of, column_sizes, interpolate_like_percentile, order_statistics
    sizes = column_sizes(df, nums) if nums else {}
    want = {c: _ranks_of(0.5, sizes[c]["n"]) for c in nums if sizes[c]["n"]}
    stats, mode = order_statistics(df, want, sizes), modes(df, cats)
    med = {c: interpolate_like_percentile(0.5, sizes[c]["n"], lambda j, c=c: stats[c][j])
           if c in stats else None for c in nums}
    return CleaningStats(medians=med, modes=mode, sizes=sizes)


def filled_sizes(stats: CleaningStats) -> dict:
    """Sizes of the columns after filling, derived without a scan: every
    row has a value, and the median lies within [min, max]."""
    out = {}
    for c, s in stats.sizes.items():
        if stats.medians.get(c) is None:
            continue
        out[c] = {"n": s["rows"], "min": s["min"], "max": s["max"],
                  "rows": s["rows"]}
    return out


def fill(df: DataFrame, stats: CleaningStats) -> DataFrame:
    """Numeric NULL → median, categorical NULL → mode."""
    rep = {}
    for c, v in stats.medians.items():
        if v is not None and c in df.columns:
            rep[c] = F.coalesce(F.col(c), F.lit(float(v)))
    for c, v in stats.modes.items():
        if v is not None and c in df.columns:
            rep[c] = F.coalesce(F.col(c), F.lit(v))
    return df.withColumns(rep) if rep else df


def fit_quartiles(df: DataFrame, cols, approx: bool = False, sizes: dict | None = None
                  ) -> tuple[dict, dict]:
    """Q1 and Q3 (linear interpolation) of each column."""
    from .quantiles import quantiles
    cols = list(cols)
    if not cols:
        return {}, {}
    if approx:
        row = df.agg(*[F.percentile_approx(c, [0.25, 0.75], 10000).alias(f"q{i}")
                       for i, c in enumerate(cols)]).first()
        qs = {c: row[f"q{i}"] for i, c in enumerate(cols)}
    else:
        qs = quantiles(df, cols, [0.25, 0.75], sizes=sizes)
    q1, q3 = {}, {}
    for c in cols:
        v = qs.get(c)
        q1[c], q3[c] = (float(v[0]), float(v[1])) if v and v[0] is not None else (None, None)
    return q1, q3


def cap(df: DataFrame, stats: CleaningStats) -> DataFrame:
    """Clip each column to [Q1 − 1.5·IQR, Q3 + 1.5·IQR]."""
    rep = {}
    for c in stats.q1:
        lo, hi = stats.bounds(c)
        if lo is not None and c in df.columns:
            rep[c] = M.clip(F.col(c), float(lo), float(hi))
    return df.withColumns(rep) if rep else df


def log_scale(df: DataFrame, cols=SKEWED) -> DataFrame:
    return df.withColumns({c: M.log1p(F.col(c)) for c in cols if c in df.columns})


def fit_cleaner(text_df: DataFrame, approx: bool = False, with_quartiles: bool = True
                ) -> CleaningStats:
    """Fill values and the quartiles of the filled numeric columns.

    Exact (default): one sizing aggregate, the rounds of the order
    statistics (``median_and_filled_quartiles``: filling only adds copies of
    the median, so no pass over the filled table is needed), and a count
    for the modes. ``approx=True``: fill, then approximate quartiles of the
    filled columns."""
    if approx or not with_quartiles:
        stats = fit_fill(text_df, approx)
        if with_quartiles:
            nums = numeric_columns(text_df)
            stats.q1, stats.q3 = fit_quartiles(fill(text_df, stats), nums, approx,
                                               filled_sizes(stats) or None)
        return stats
    from .quantiles import column_sizes, median_and_filled_quartiles
    nums = numeric_columns(text_df)
    cats = [c for c in category_columns(text_df) if c not in TITLE_CASED]
    sizes = column_sizes(text_df, nums) if nums else {}
    mq, mode = median_and_filled_quartiles(text_df, nums, sizes), modes(text_df, cats)
    med, q1, q3 = {}, {}, {}
    for c in nums:
        m, (a, b) = mq.get(c, (None, (None, None)))
        med[c], q1[c], q3[c] = m, a, b
    return CleaningStats(medians=med, modes=mode, q1=q1, q3=q3, sizes=sizes)


def apply_cleaner(text_df: DataFrame, stats: CleaningStats, do_cap: bool = True,
                  do_log: bool = True) -> DataFrame:
    out = fill(text_df, stats)
    if do_cap:
        out = cap(out, stats)
    if do_log:
        out = log_scale(out)
    return out


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder as Parquet and read it back.

    Cuts the lineage (the dedupe shuffle is not re-run by each later
    aggregate) and gives later scans column pruning and pushdown. Survives
    executor loss because the folder is shared storage."""
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_text(raw: DataFrame, persist: bool = True) -> DataFrame:
    """Deduplicated and text-repaired table, optionally materialised."""
    text = clean_text(dedupe(raw))
    return materialize(text, "clean-text") if persist else text


def clean(raw: DataFrame, approx: bool = False, do_cap: bool = True, do_log: bool = True,
          persist: bool = True, return_stats: bool = False):
    """Full cleaning: dedupe → text repair → fill → cap → log1p."""
    text = stage_text(raw, persist)
    stats = fit_cleaner(text, approx, with_quartiles=do_cap)
    out = apply_cleaner(text, stats, do_cap, do_log)
    return (out, stats) if return_stats else out


def stats_table(spark, stats: CleaningStats) -> DataFrame:
    """column, median, q1, q3, lower, upper, mode (one row per column)."""
    rows = []
    for c in list(stats.medians) + [c for c in stats.modes if c not in stats.medians]:
        lo, hi = stats.bounds(c)
        rows.append((c, stats.medians.get(c), stats.q1.get(c), stats.q3.get(c), lo, hi,
                     stats.modes.get(c)))
    schema = ("column string, median double, q1 double, q3 double, lower double, "
              "upper double, mode string")
    return spark.createDataFrame(rows, schema)


__all__ = [
    "CATEGORICAL", "CleaningStats", "apply_cleaner", "cap", "clean", "clean_text",
    "dedupe", "dedupe_report", "fill", "fit_cleaner", "fit_fill", "fit_quartiles",
    "log_scale", "materialize", "stage_text", "stats_table",
]
