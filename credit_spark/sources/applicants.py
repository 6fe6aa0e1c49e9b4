"""The applicant table: derived from ``orders``, or read from CSV/Parquet.

The derivation is one narrow projection of ``orders`` (no shuffle): every
column is an integer-arithmetic expression of the order key, customer key
and total price, so the same expression text runs in Spark and in DuckDB.
A deterministic 2 % of the applicants appears twice as exact duplicates
(an ``explode`` in the same projection), so deduplication has work to do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ID, RAW_COLUMNS, RAW_SCHEMA, TARGET_AMOUNT
from ..session import file_listing, sf_table

# Level 1: the order columns used.
BASE = (
    ("k", "o_orderkey"),
    ("c", "o_custkey"),
    ("tp", "cast(floor(o_totalprice) AS bigint)"),
)

# Level 2: integer building blocks of one applicant.
LEVEL2 = (
    ("a", "22+(k*7)%40"),
    ("sal", "15000+(c*137+k*31)%185000"),
    ("rent", "CASE WHEN k%3=2 THEN 3000+(k*17)%25000 ELSE 0 END"),
    ("emi", "CASE WHEN k%2=0 THEN (k*37)%30000 ELSE 0 END"),
    ("sf", "(k*11)%8000"),
    ("cf", "CASE WHEN k%3<>0 THEN (k*19)%20000 ELSE 0 END"),
    ("tr", "500+(k*23)%9000"),
    ("gr", "2000+(k*29)%18000"),
    ("ot", "500+(k*31)%9000"),
    ("req", "10000+(k*53)%1490000"),
    ("ten", "6+(k*5)%79"),
)

# Level 3: monthly capacity used by both targets.
LEVEL3 = (
    ("cap", "4e-1*sal-emi-2e-1*(rent+sf+cf+tr+gr+ot)"),
)

# Level 4: the raw applicant columns, in table order.
LEVEL4 = (
    ("applicant_id", "k"),
    ("age", "CASE WHEN k%97=0 THEN NULL WHEN k%89=0 THEN concat(cast(a AS string),'.0.0') "
            "WHEN k%2=0 THEN concat(cast(a AS string),'.0') ELSE cast(a AS string) END"),
    ("gender", "CASE k%7 WHEN 0 THEN 'M' WHEN 1 THEN 'male' WHEN 2 THEN 'Female' WHEN 3 THEN 'F' "
               "WHEN 4 THEN 'FEMALE' WHEN 5 THEN ' Male ' ELSE 'unknown' END"),
    ("marital_status", "CASE k%3 WHEN 0 THEN 'single' WHEN 1 THEN 'Married' ELSE ' MARRIED' END"),
    ("education", "CASE WHEN k%79=0 THEN NULL ELSE CASE k%4 WHEN 0 THEN 'high school' "
                  "WHEN 1 THEN 'Graduate' WHEN 2 THEN 'Post Graduate' ELSE 'professional' END END"),
    ("monthly_salary", "CASE WHEN k%73=0 THEN 'abc' WHEN k%89=0 THEN concat(cast(sal AS string),'.0.0') "
                       "WHEN k%2=1 THEN concat(cast(sal AS string),'.0') ELSE cast(sal AS string) END"),
    ("employment_type", "CASE (k+1)%3 WHEN 0 THEN 'Government' WHEN 1 THEN 'private' "
                        "ELSE 'Self-employed' END"),
    ("years_of_employment", "cast((k*13)%300 AS double)/10e0"),
    ("company_type", "CASE k%5 WHEN 0 THEN 'MNC' WHEN 1 THEN 'Mid-size' WHEN 2 THEN 'Startup' "
                     "WHEN 3 THEN 'Large Indian' ELSE 'Small' END"),
    ("house_type", "CASE k%3 WHEN 0 THEN 'Own' WHEN 1 THEN 'Family' ELSE 'Rented' END"),
    ("monthly_rent", "cast(rent AS double)"),
    ("family_size", "1+k%6"),
    ("dependents", "k%(1+k%6)"),
    ("school_fees", "cast(sf AS double)"),
    ("college_fees", "cast(cf AS double)"),
    ("travel_expenses", "cast(tr AS double)"),
    ("groceries_utilities", "cast(gr AS double)"),
    ("other_monthly_expenses", "cast(ot AS double)"),
    ("existing_loans", "CASE WHEN k%2=0 THEN 'Yes' ELSE 'no' END"),
    ("current_emi_amount", "cast(emi AS double)"),
    ("credit_score", "CASE WHEN k%71=0 THEN NULL ELSE cast(300+(k*41)%601 AS double) END"),
    ("bank_balance", "CASE WHEN k%61=0 THEN concat(cast(cast(floor(tp/1000) AS bigint) AS string),',',"
                     "lpad(cast(tp%1000 AS string),3,'0')) WHEN k%89=0 THEN concat(cast(tp AS string),'.0.0') "
                     "ELSE concat(cast(tp AS string),'.0') END"),
    ("emergency_fund", "cast((k*43)%300000 AS double)"),
    ("emi_scenario", "CASE WHEN k%83=0 THEN NULL ELSE CASE k%5 WHEN 0 THEN 'Personal Loan EMI' "
                     "WHEN 1 THEN 'E-commerce Shopping EMI' WHEN 2 THEN 'Education EMI' "
                     "WHEN 3 THEN 'Vehicle EMI' ELSE 'Home Appliances EMI' END END"),
    ("requested_amount", "cast(req AS double)"),
    ("requested_tenure", "ten"),
    ("emi_eligibility", "CASE WHEN cap >= 1e0*req/ten THEN 'Eligible' WHEN cap >= 5e-1*req/ten "
                        "THEN 'High_Risk' ELSE 'Not_Eligible' END"),
    ("max_monthly_emi", "greatest(500e0, cap)"),
)

# Every 50th applicant appears twice in the raw table.
DUPLICATE_EVERY = 50

assert tuple(n for n, _ in LEVEL4) == RAW_COLUMNS


def _level(df: DataFrame, level) -> DataFrame:
    return df.selectExpr("*", *[f"{expr} AS {name}" for name, expr in level])


def applicants_from_orders(orders: DataFrame) -> DataFrame:
    """Raw applicants (with planted duplicates) as a narrow plan over orders.

    The copies come from one ``explode`` of a 1- or 2-element array, so
    orders is scanned once (a UNION ALL of two filtered branches would scan
    it twice)."""
    b = orders.selectExpr(*[f"{expr} AS {name}" for name, expr in BASE])
    copies = F.when(F.col("k") % DUPLICATE_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    b = b.select("*", F.explode(copies).alias("_copy")).drop("_copy")
    t = _level(_level(b, LEVEL2), LEVEL3)
    raw = t.selectExpr(*[f"{expr} AS {name}" for name, expr in LEVEL4])
    return raw.select([F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA.fields])


# Input that a round-robin may spread, in bytes on disk.
SPREAD_BYTES = 1 << 30


def spread(df: DataFrame, size: int) -> DataFrame:
    """Round-robin a small source that arrives in fewer partitions than
    cores (e.g. one Parquet row group). ``size``: its bytes on disk; more
    than ``SPREAD_BYTES`` is never moved, and the scan's own splits
    (``spark.sql.files.maxPartitionBytes``) set the parallelism."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if size <= SPREAD_BYTES and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def load_applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw applicants derived from ``{sf_dir}/orders.parquet``."""
    orders = spark.read.parquet(sf_table(sf_dir, "orders")).select(
        "o_orderkey", "o_custkey", "o_totalprice")
    size = sum(f[1] for f in file_listing(spark, sf_table(sf_dir, "orders")))
    return applicants_from_orders(spread(orders, size))


def applicants_sql(orders: str = "orders") -> str:
    """The same derivation as SQL (for DuckDB or spark.sql): a CTE prefix
    that defines ``applicants``; append a query that reads it."""
    def sel(level):
        return ", ".join(f"{expr} AS {name}" for name, expr in level)

    return (
        f"WITH _b AS (SELECT {sel(BASE)} FROM {orders}),\n"
        f"_n AS (SELECT *, {sel(LEVEL2)} FROM _b),\n"
        f"_t AS (SELECT *, {sel(LEVEL3)} FROM _n),\n"
        f"_raw AS (SELECT {sel(LEVEL4)} FROM _t),\n"
        f"applicants AS (SELECT * FROM _raw UNION ALL SELECT * FROM _raw "
        f"WHERE applicant_id % {DUPLICATE_EVERY} = 0)\n"
    )


# ---------------------------------------------------------------------------
# Files
# ---------------------------------------------------------------------------

def read_applicants_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, bound by column name, in any order; no inference.

    Every column stays STRING, as written, but the id (BIGINT) and the
    amount target (DOUBLE): dirty numbers reach the cleaning rules.
    Without an ``applicant_id`` column the id is a hash of the whole row,
    so exact copies share it and are still found as duplicates. A column
    that the file lacks isn't added; one that isn't known is left out.
    """
    raw = (spark.read.option("header", True).option("inferSchema", False)
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    ident = (F.col(ID).try_cast("bigint") if ID in raw.columns
             else F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]))
    target = {TARGET_AMOUNT: F.col(TARGET_AMOUNT).try_cast("double")} if TARGET_AMOUNT in raw.columns else {}
    return raw.select(ident.alias(ID), *[target.get(c, F.col(c)).alias(c) for c in RAW_COLUMNS
                                         if c != ID and c in raw.columns])


@dataclass
class Ingested:
    """An applicant CSV taken in: rows that fit, rows set aside, and how many of each."""

    kept: DataFrame         # ``read_applicants_csv``'s columns, then the file's unknown ones as STRING
    rejected: DataFrame     # ``record`` as it stood in the file, ``reason``, ``file``
    counts: dict[str, int]


REJECT_REASONS = ("columns", "id")


def ingest_applicants_csv(spark: SparkSession, path: str, dest: str, columns: Sequence[str] | None = None,
                          multiline: bool = True) -> Ingested:
    """Read a CSV once, losing nothing, and write it as Parquet under ``dest``.

    Rows go to ``dest/kept`` or ``dest/rejected`` in one job, which counts
    them as well. A row is set aside if it has more or fewer fields than the
    header (``columns``) or, where the file has an id column, an id that is
    no whole number (``id``); every other dirty value is kept as text for
    the cleaning rules.

    - ``columns``: the names, for files without a header; else every file
      has the same header line, and one that differs is an error
    - ``multiline``: quoted line breaks belong to the value; a file is then
      read by one task, so large inputs should come as many files. Without
      it files are split, and each part of such a row is set aside.
    - unknown columns are kept as STRING, behind the known ones
    - an empty field, quoted or not, is missing
    - empty lines are skipped; a file of the header alone gives no rows;
      repeated rows are kept as often as they come
    - no id column: the id is a hash of the whole row, as in
      ``read_applicants_csv``
    """
    options = {"header": str(columns is None).lower(), "inferSchema": "false", "quote": '"', "escape": '"',
               "multiLine": str(multiline).lower(), "enforceSchema": str(columns is not None).lower(),
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    names = list(columns) if columns else spark.read.options(**options).csv(path).columns
    low = {n.lower() for n in names}
    own = "_record"
    while own in low:
        own += "_"
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, own)])
    raw = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=own).schema(schema).csv(path)
    field = {n: F.col(f"`{n}`") for n in names}
    bad_id = field[ID].try_cast("bigint").isNull() if ID in names else F.lit(False)
    reason = F.when(F.col(own).isNotNull(), REJECT_REASONS[0]).when(bad_id, REJECT_REASONS[1])
    # All columns are read together: a row's fields are only counted when none is pruned.
    tagged = raw.select(F.struct(*field.values()).alias("row"), F.col(own).alias("record"), reason.alias("reason"),
                        F.col("_metadata.file_path").alias("file"))
    record = F.coalesce("record", F.to_csv("row", {"quoteAll": "true", "escape": '"', "nullValue": ""}))
    seen = Observation()
    counted = tagged.observe(seen, F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.col("reason") == r).alias(r) for r in REJECT_REASONS])
    # The file's own names are kept apart, in the struct, from the folder's name.
    (counted.select(F.when(F.col("reason").isNull(), F.col("row")).alias("row"),
                    F.when(F.col("reason").isNotNull(), record).alias("record"), "reason", "file",
                    F.when(F.col("reason").isNull(), "kept").otherwise("rejected").alias("part"))
     .write.mode("overwrite").partitionBy("part").parquet(dest))
    found = seen.get
    counts = {"rows": found["rows"], "kept": found["rows"] - sum(found[r] for r in REJECT_REASONS)}
    counts |= {f"rejected_{r}": found[r] for r in REJECT_REASONS}
    stored = spark.read.schema(T.StructType([tagged.schema["row"], *[T.StructField(c, T.StringType()) for c in (
        "record", "reason", "file", "part")]])).parquet(dest)
    good = stored.where("part = 'kept'").select("row.*")
    field = {n: F.col(f"`{n}`") for n in names}
    ident = field[ID].try_cast("bigint") if ID in names else F.xxhash64(*field.values())
    target = {TARGET_AMOUNT: F.col(TARGET_AMOUNT).try_cast("double")} if TARGET_AMOUNT in names else {}
    kept = good.select(ident.alias(ID), *[target.get(c, F.col(c)).alias(c) for c in RAW_COLUMNS if c != ID and c in names],
                       *[field[n] for n in names if n not in RAW_COLUMNS])
    return Ingested(kept, stored.where("part = 'rejected'").select("record", "reason", "file"), counts)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; values are written as they are (no trimming)."""
    (df.write.mode("overwrite")
       .option("header", True)
       .option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``write_csv`` wrote, with the types of ``schema``; a header that
    names other columns or another order is an error, as is a value that
    isn't of its type. White space stays, doubles come back bit for bit.
    Empty text and NULL are written alike and both come back as NULL."""
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
