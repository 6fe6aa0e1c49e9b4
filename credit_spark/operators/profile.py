"""Profiling: missing counts, class counts, distinct values, summaries,
structure, previews and row lookups.

Per-column statistics are computed for all columns in ONE aggregate (one
scan, partial aggregation per task) and then unpivoted with
``explode(array(struct...))`` on the single result row, so the number of
jobs does not grow with the number of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ID


def long_agg(df: DataFrame, cols, stats: dict, key: str = "column") -> DataFrame:
    """One aggregate of ``stats`` (name → fn(Column) → Column) over each
    column, returned long: one row per column."""
    cols = list(cols)
    aggs = [fn(F.col(c)).alias(f"{s}__{i}") for i, c in enumerate(cols)
            for s, fn in stats.items()]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias(key), *[F.col(f"{s}__{i}").alias(s) for s in stats])
            for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """(column, nulls): missing values per column."""
    cols = cols or [c for c in df.columns if c != ID]
    return long_agg(df, cols, {"nulls": lambda c: F.count_if(c.isNull()).cast("long")})


def class_distribution(df: DataFrame, label: str = "emi_eligibility") -> DataFrame:
    return df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("count"))


def category_values(df: DataFrame, cols) -> DataFrame:
    """(column, value) distinct pairs in one scan and one shuffle: the long
    (column, value) form feeds a partial (map-side) distinct before any
    rows move, so a hot value costs one row per task."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in cols])
    return df.select(F.explode(arr).alias("_e")).select("_e.*").distinct()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def describe_numeric(df: DataFrame, cols) -> DataFrame:
    """count, mean, sample std, min, exact 25/50/75 % and max per column.

    One aggregate gives the moments together with the sizes and the sketch
    that the exact quantiles need, then mostly one more scan counts them; the result (one row per column) is built from both."""
    from .quantiles import quantiles, sketch_agg
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], DESCRIBE_SCHEMA)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mu{i}"),
                 F.stddev_samp(x).alias(f"sd{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}"), sketch_agg(x).alias(f"q{i}")]
    r = df.agg(*aggs).first()
    sizes = {c: {"n": r[f"n{i}"], "min": r[f"lo{i}"], "max": r[f"hi{i}"], "grid": r[f"q{i}"],
                 "rows": r["rows"]} for i, c in enumerate(cols)}
    qs = quantiles(df, cols, [0.25, 0.5, 0.75], sizes=sizes)
    rows = []
    for i, c in enumerate(cols):
        q = qs.get(c) or [None] * 3
        rows.append((c, r[f"n{i}"], r[f"mu{i}"], r[f"sd{i}"], r[f"lo{i}"], *q, r[f"hi{i}"]))
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


DESCRIBE_SCHEMA = ("column string, count bigint, mean double, std double, min double, "
                   "p25 double, p50 double, p75 double, max double")


def type_name(dt: T.DataType) -> str:
    return {T.DoubleType: "double", T.LongType: "bigint", T.IntegerType: "int",
            T.StringType: "string", T.BooleanType: "boolean"}.get(type(dt), dt.simpleString())


def column_profile(df: DataFrame, cols=None) -> DataFrame:
    """(position, column, type, non_null): the structure of a table."""
    cols = cols or df.columns
    types = {f.name: type_name(f.dataType) for f in df.schema.fields}
    counts = long_agg(df, cols, {"non_null": lambda c: F.count(c).cast("long")})
    pos = F.create_map(*[F.lit(x) for i, c in enumerate(cols) for x in (c, i + 1)])
    typ = F.create_map(*[F.lit(x) for c in cols for x in (c, types[c])])
    return counts.select(F.element_at(pos, F.col("column")).alias("position"), "column",
                         F.element_at(typ, F.col("column")).alias("type"), "non_null")


def preview_head(df: DataFrame, n: int = 10, key: str = ID) -> DataFrame:
    """First n rows by id (top-k: no full sort)."""
    return df.orderBy(F.col(key)).limit(n)


def preview_tail(df: DataFrame, n: int = 5, key: str = ID) -> DataFrame:
    return df.orderBy(F.col(key).desc()).limit(n)


def rows_missing(df: DataFrame, col: str | Column) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    return df.where(c.isNull())


def rows_by_id(df: DataFrame, ids, key: str = ID) -> DataFrame:
    """Rows whose id is in a short literal list (pushed down to the scan
    as an IN filter when the id column is stored)."""
    return df.where(F.col(key).isin(*ids))
