"""Stage builders shared by the registered queries and the benchmark.

The deduplicated, repaired table is written once per session and state of
the source files to the shared checkpoint folder, and its fitted cleaning
statistics are kept with it, so every query of a session reads the same
materialised stage instead of re-running the dedupe shuffle and the fit
jobs (as a reporting workload reads a cleaned table written once). If the
files are gone, the stage is rebuilt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from ..operators import clean as C
from ..operators import features as FE
from ..session import AFTER_SCOPE, file_listing, scratch_path, sf_table
from ..sources.applicants import load_applicants

_STAGES: dict = {}
AFTER_SCOPE.append(_STAGES.clear)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_applicants(spark, sf_dir)


def source_key(spark: SparkSession, sf_dir: str):
    """Session, folder, and the source files' names, lengths and times: a
    changed source is another key, so nothing stale is ever read."""
    return (spark.sparkContext.applicationId, sf_dir, file_listing(spark, sf_table(sf_dir, "orders")))


def _stage(spark: SparkSession, sf_dir: str) -> dict:
    key = source_key(spark, sf_dir)
    st = _STAGES.get(key)
    if st is not None:
        try:
            st["text"] = spark.read.parquet(st["path"])
            return st
        except AnalysisException:
            _STAGES.pop(key, None)
    path = scratch_path(spark, "clean-text")
    C.clean_text(C.dedupe(raw(spark, sf_dir))).write.mode("overwrite").parquet(path)
    st = {"path": path, "text": spark.read.parquet(path), "fill": None, "full": None}
    _STAGES[key] = st
    return st


def text(spark: SparkSession, sf_dir: str, persist: bool = True) -> DataFrame:
    if not persist:
        return C.clean_text(C.dedupe(raw(spark, sf_dir)))
    return _stage(spark, sf_dir)["text"]


def fill_stats(spark: SparkSession, sf_dir: str) -> C.CleaningStats:
    st = _stage(spark, sf_dir)
    if st["fill"] is None:
        st["fill"] = C.fit_fill(st["text"])
    return st["fill"]


def clean_stats(spark: SparkSession, sf_dir: str) -> C.CleaningStats:
    st = _stage(spark, sf_dir)
    if st["full"] is None:
        st["full"] = C.fit_cleaner(st["text"])
    return st["full"]


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated, repaired and filled; raw scale, no capping."""
    return C.fill(text(spark, sf_dir), fill_stats(spark, sf_dir))


def capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.apply_cleaner(text(spark, sf_dir), clean_stats(spark, sf_dir), do_log=False)


def cleaned(spark: SparkSession, sf_dir: str, return_stats: bool = False):
    stats = clean_stats(spark, sf_dir)
    out = C.apply_cleaner(text(spark, sf_dir), stats)
    return (out, stats) if return_stats else out


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned table plus the nine derived features (training form)."""
    return FE.derive(cleaned(spark, sf_dir))
