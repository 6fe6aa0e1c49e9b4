"""The batch pipeline as steps with Parquet between them.

Each step reads the previous step's table from the shared folder and
writes its own, so a failed or restarted step never recomputes earlier
ones, and later steps scan only the columns they use.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean as C
from ..operators import correlate as K
from ..operators import encode as E
from ..operators import features as FE
from ..schema import ID
from ..session import scratch_path
from ..sources.applicants import load_applicants
from . import score as SC
from . import train as TR


@dataclass
class Paths:
    cleaned: str
    model_table: str
    scores: str
    text: str = ""          # deduplicated, repaired (unfilled) applicants


def paths(spark: SparkSession) -> Paths:
    return Paths(scratch_path(spark, "cleaned"), scratch_path(spark, "model-table"),
                 scratch_path(spark, "scores"), scratch_path(spark, "clean-text"))


def step_clean(spark: SparkSession, sf_dir: str, p: Paths):
    """Dedupe and repair once into ``p.text``, fit on it, write the cleaned
    table; returns the fitted statistics (reused by ``step_score``)."""
    C.clean_text(C.dedupe(load_applicants(spark, sf_dir))).write.mode("overwrite").parquet(p.text)
    text = spark.read.parquet(p.text)
    stats = C.fit_cleaner(text)
    C.apply_cleaner(text, stats).write.mode("overwrite").parquet(p.cleaned)
    return stats


def step_featurize(spark: SparkSession, p: Paths) -> E.Featurizer:
    feats = FE.derive(spark.read.parquet(p.cleaned))
    fz = E.fit_featurizer(feats)
    E.model_table(feats, fz).select(ID, *SC.MODEL_COLS).write.mode("overwrite").parquet(p.model_table)
    return fz


def step_correlate(spark: SparkSession, p: Paths) -> DataFrame:
    return K.correlation_matrix(spark.read.parquet(p.model_table), SC.MODEL_COLS)


def step_select(spark: SparkSession, p: Paths) -> dict:
    return K.select_features(spark.read.parquet(p.model_table), SC.MODEL_COLS)


def step_fit(spark: SparkSession, p: Paths, fz: E.Featurizer, sel: dict,
             settings: TR.TrainSettings | None = None) -> SC.ScoringModel:
    res = TR.train(spark.read.parquet(p.model_table), sel["classification"], sel["regression"],
                   settings)
    return SC.ScoringModel(fz, res.clf_features, res.reg_features, res.best_classifier,
                           res.best_regressor)


def step_score(spark: SparkSession, sf_dir: str, model: SC.ScoringModel, p: Paths,
               stats: C.CleaningStats | None = None) -> None:
    """Scores the repaired, filled applicants (raw money scale). With the
    statistics of ``step_clean`` the repaired table it wrote is read back
    and filled with the same medians and modes (the fill values of the
    cleaning fit are those of ``fit_fill`` on the same table), so nothing
    is deduplicated or fitted twice."""
    if stats is not None and p.text:
        text = spark.read.parquet(p.text)
        fill_stats = C.CleaningStats(medians=stats.medians, modes=stats.modes)
    else:
        text = C.stage_text(load_applicants(spark, sf_dir))
        fill_stats = C.fit_fill(text)
    inp = SC.score_input(C.fill(text, fill_stats))
    model.transform(inp).write.mode("overwrite").parquet(p.scores)
