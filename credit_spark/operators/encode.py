"""Label codes, standardisation and their inverses.

Codes are the rank of a value among the column's distinct values in
ascending (binary) order. The distinct sets of categorical columns are
small; their size is checked, and when it is within ``MAX_LITERAL_CODES``
the codes become a literal map inside the projection (no join, no
shuffle). Beyond it, where searching a literal for every row would cost more
than a join, the codes are a table built by a distributed sort and joined on
the value; the size of the written table decides how Spark joins it. Both
give the same codes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CATEGORICAL, SCALED, TARGET_AMOUNT, TARGET_CLASS

MAX_LITERAL_CODES = 256
MISSING_TEXT = "nan"


def _as_text(c):
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TEXT))


@dataclass
class LabelCodes:
    """column → sorted distinct values (code = position). A column with more
    distinct values than fit a literal has a (value, code) Parquet table in
    the shared folder instead (``tables``: column → path)."""
    classes: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)

    def columns(self):
        return list(self.classes) + [c for c in self.tables if c not in self.classes]

    def code_map(self, c):
        return F.create_map(*[F.lit(x) for i, v in enumerate(self.classes[c]) for x in (v, i)])

    def value_map(self, c):
        return F.create_map(*[F.lit(x) for i, v in enumerate(self.classes[c]) for x in (i, v)])

    def table(self, spark) -> DataFrame:
        rows = [(c, v, i) for c, vs in self.classes.items() for i, v in enumerate(vs)]
        out = spark.createDataFrame(rows, "column string, value string, code int")
        for c, path in self.tables.items():
            if c not in self.classes:
                out = out.unionByName(spark.read.parquet(path).select(F.lit(c).alias("column"), "value", "code"))
        return out

    def renamed(self, col: str, name: str) -> "LabelCodes":
        """The codes of one column under another name."""
        return LabelCodes({name: self.classes[col]} if col in self.classes else {},
                          {name: self.tables[col]} if col in self.tables else {})


def fit_label_codes(df: DataFrame, cols, as_text: bool = True,
                    max_codes: int = MAX_LITERAL_CODES) -> LabelCodes:
    """Distinct values of each column (partial aggregation per task), sized
    per column before anything is collected: a column with at most
    ``max_codes`` values gets literal codes, a larger one a distributed
    code table written to the shared folder (``code_table``)."""
    from ..session import scratch_path
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return LabelCodes()
    # One scan and one shuffle for all columns: the long (column, value)
    # form feeds the partial aggregation of the distinct directly.
    arr = F.array(*[F.struct(F.lit(c).alias("column"),
                             (_as_text(c) if as_text else F.col(c).cast("string")).alias("value"))
                    for c in cols])
    u = df.select(F.explode(arr).alias("_e")).select("_e.*").distinct()
    # Common case, one job: every distinct value fits under the bound, so
    # the bounded fetch returns all of them. Otherwise size each column
    # first and fetch only the columns that fit.
    cap = max_codes * len(cols)
    rows = u.limit(cap + 1).collect()
    if len(rows) <= cap:
        sizes = {}
        for r in rows:
            sizes[r["column"]] = sizes.get(r["column"], 0) + 1
    else:
        sizes = {r["column"]: r["n"] for r in u.groupBy("column").agg(
            F.count(F.lit(1)).alias("n")).collect()}
    small = [c for c in cols if sizes.get(c, 0) <= max_codes]
    large = [c for c in cols if c not in small]
    if len(rows) > cap and small:
        rows = u.where(F.col("column").isin(*small)).collect()
    classes = {c: [] for c in small}
    for r in rows:
        if r["column"] in classes:
            classes[r["column"]].append(r["value"])
    for c in classes:
        classes[c] = sorted(v for v in classes[c] if v is not None)
    tables = {}
    for c in large:
        path = scratch_path(df.sparkSession, f"codes-{c}")
        code_table(df, c, as_text=as_text).write.mode("overwrite").parquet(path)
        tables[c] = path
    return LabelCodes(classes, tables)


def encode(df: DataFrame, codes: LabelCodes, unseen: int | None = None,
           as_text: bool = True) -> DataFrame:
    """Replace each coded column by its INT code. ``unseen``: code for
    values absent at fit time (NULL when None)."""
    rep = {}
    for c in codes.classes:
        if c not in df.columns:
            continue
        v = _as_text(c) if as_text else F.col(c)
        e = F.element_at(codes.code_map(c), v) if codes.classes[c] else F.lit(None)
        if unseen is not None:
            e = F.coalesce(e, F.lit(unseen))
        rep[c] = e.cast("int")
    out = df.withColumns(rep) if rep else df
    for c, path in codes.tables.items():
        if c in out.columns:
            out = encode_by_join(out, c, df.sparkSession.read.parquet(path), unseen, as_text)
    return out


def decode(df: DataFrame, codes: LabelCodes, col: str, out: str | None = None) -> DataFrame:
    """Code → value; an unknown code becomes its own text."""
    if col in codes.tables:
        t = (df.sparkSession.read.parquet(codes.tables[col])
               .select(F.col("code").alias("_dc"), F.col("value").alias("_dv")))
        j = df.join(t, F.col(col).cast("int") == F.col("_dc"), "left")
        return j.withColumn(out or col, F.coalesce(F.col("_dv"), F.col(col).cast("string"))
                            ).drop("_dc", "_dv")
    e = F.coalesce(F.element_at(codes.value_map(col), F.col(col).cast("int")),
                   F.col(col).cast("string"))
    return df.withColumn(out or col, e)


def code_table(df: DataFrame, col: str, as_text: bool = True) -> DataFrame:
    """(value, code) for a column with many distinct values, without a
    single-partition window: distinct values are range-partitioned, ranked
    inside each partition, written to the shared folder, and offset by the
    sizes of the earlier partitions, one joined row per partition. A column
    of more than 2^31 values is an error, as codes are INT."""
    from .clean import materialize
    w = Window.partitionBy("_p").orderBy("value")
    v = _as_text(col) if as_text else F.col(col).cast("string")
    ranked = (df.select(v.alias("value")).distinct()
                .where(F.col("value").isNotNull())
                .repartitionByRange("value")
                .withColumn("_p", F.spark_partition_id())
                .withColumn("_r", F.row_number().over(w)))
    ranked = materialize(ranked, f"codes-{col}")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranked.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
               .select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    # Broadcast: one row per shuffle partition, a count that the session's settings bound.
    return (ranked.join(F.broadcast(offsets), "_p")
            .select("value", (F.col("_before") + F.col("_r") - 1).cast("int").alias("code")))


def encode_by_join(df: DataFrame, col: str, codes: DataFrame, unseen: int | None = None,
                   as_text: bool = True) -> DataFrame:
    """Encode through a (value, code) table with a shuffle join; used when
    the distinct set is too large to inline. AQE splits a hot value."""
    c = codes.withColumnRenamed("value", "_v").withColumnRenamed("code", "_code")
    v = _as_text(col) if as_text else F.col(col).cast("string")
    j = df.join(c, v == F.col("_v"), "left")
    e = F.col("_code") if unseen is None else F.coalesce(F.col("_code"), F.lit(unseen))
    return j.withColumn(col, e.cast("int")).drop("_v", "_code")


# ---------------------------------------------------------------------------
# Standardisation (population std, NULLs ignored, zero spread → 1)
# ---------------------------------------------------------------------------

@dataclass
class ScalerStats:
    mean: dict = field(default_factory=dict)
    std: dict = field(default_factory=dict)

    def scale(self, c):
        s = self.std.get(c)
        return 1.0 if s is None or s == 0.0 else s

    def table(self, spark) -> DataFrame:
        rows = [(c, self.mean[c], self.std[c], self.scale(c)) for c in self.mean]
        return spark.createDataFrame(rows, "column string, mean double, std_pop double, scale double")


def fit_scaler(df: DataFrame, cols) -> ScalerStats:
    """Mean and population standard deviation of each column, one job.
    A column whose min equals its max gets std 0 (floating merges can
    leave a tiny non-zero spread)."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return ScalerStats()
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"mu_{i}"), F.stddev_pop(c).alias(f"sd_{i}"),
                 (F.min(c) == F.max(c)).alias(f"k_{i}")]
    row = df.agg(*aggs).first()
    mean, std = {}, {}
    for i, c in enumerate(cols):
        mean[c] = row[f"mu_{i}"]
        std[c] = 0.0 if row[f"k_{i}"] else row[f"sd_{i}"]
    return ScalerStats(mean, std)


def standardize(df: DataFrame, stats: ScalerStats, cols=None) -> DataFrame:
    cols = [c for c in (cols or stats.mean) if c in df.columns and stats.mean.get(c) is not None]
    return df.withColumns({c: (F.col(c) - F.lit(float(stats.mean[c]))) / F.lit(float(stats.scale(c)))
                           for c in cols})


def unstandardize(df: DataFrame, stats: ScalerStats, cols=None) -> DataFrame:
    cols = [c for c in (cols or stats.mean) if c in df.columns and stats.mean.get(c) is not None]
    return df.withColumns({c: F.col(c) * F.lit(float(stats.scale(c))) + F.lit(float(stats.mean[c]))
                           for c in cols})


# ---------------------------------------------------------------------------
# Fitted featurizer
# ---------------------------------------------------------------------------

@dataclass
class Featurizer:
    codes: LabelCodes
    target_codes: LabelCodes
    scaler: ScalerStats
    target_scaler: ScalerStats

    def transform(self, feats: DataFrame, with_targets: bool = True) -> DataFrame:
        """Derived-feature table → encoded, scaled model table."""
        out = encode(feats, self.codes)
        out = standardize(out, self.scaler, SCALED)
        if with_targets and TARGET_CLASS in out.columns:
            out = encode(out, self.target_codes, as_text=False)
        if with_targets and TARGET_AMOUNT in out.columns:
            out = standardize(out, self.target_scaler, [TARGET_AMOUNT])
        return out


def fit_featurizer(feats: DataFrame) -> Featurizer:
    """Codes of the 8 categories and the class target, scaler statistics of
    the 25 scaled features and of the amount target: three small jobs."""
    codes = fit_label_codes(feats, CATEGORICAL)
    tcodes = fit_label_codes(feats, [TARGET_CLASS], as_text=False)
    stats = fit_scaler(feats, list(SCALED) + [TARGET_AMOUNT])
    scaler = ScalerStats({c: stats.mean[c] for c in SCALED if c in stats.mean},
                         {c: stats.std[c] for c in SCALED if c in stats.std})
    tscaler = ScalerStats({TARGET_AMOUNT: stats.mean.get(TARGET_AMOUNT)},
                          {TARGET_AMOUNT: stats.std.get(TARGET_AMOUNT)})
    return Featurizer(codes, tcodes, scaler, tscaler)


def model_table(feats: DataFrame, fz: Featurizer) -> DataFrame:
    """Feature table in the original column order: features (codes in
    place), derived features, then the encoded/scaled targets last."""
    out = fz.transform(feats)
    cols = [c for c in out.columns if c not in (TARGET_CLASS, TARGET_AMOUNT)]
    return out.select(*cols, TARGET_CLASS, TARGET_AMOUNT)
