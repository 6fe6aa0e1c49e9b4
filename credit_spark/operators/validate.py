"""Range and domain checks of scoring inputs, as a batch validation job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DOMAINS, RANGES


def violations(df: DataFrame) -> F.Column:
    """ARRAY<STRING> of the columns whose value is missing, out of its
    [min, max] range or outside its allowed choices (table order)."""
    checks = []
    for c in df.columns:
        col = F.col(c)
        if c in RANGES:
            lo, hi, _ = RANGES[c]
            bad = col.isNull() | ~col.between(F.lit(lo), F.lit(hi))
        elif c in DOMAINS:
            bad = col.isNull() | ~col.isin(*DOMAINS[c])
        else:
            continue
        checks.append(F.when(bad, F.lit(c)))
    if not checks:
        return F.array().cast("array<string>")
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def validate(df: DataFrame) -> DataFrame:
    """Adds ``violations`` and ``valid``; a narrow projection."""
    return (df.withColumn("violations", violations(df))
              .withColumn("valid", F.size("violations") == 0))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their violations)."""
    v = validate(df)
    return v.where("valid").drop("violations", "valid"), v.where(~F.col("valid"))
