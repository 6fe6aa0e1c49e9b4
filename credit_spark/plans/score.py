"""End-to-end fit and batch scoring.

``fit(raw)`` runs cleaning, feature derivation, encoding/scaling,
correlation-based selection and training, and returns a ``ScoringModel``.
``ScoringModel.transform(df)`` scores any number of applicants (batch or
streaming DataFrame) with one narrow plan: encode (unseen → code 0) →
log1p → derive (denominators floored at 1) → scale → classify → decode →
feed the predicted class code to the regressor → invert the target scaling
→ floor at 0 and round to 2 places. Fitted state is a handful of literals
and two models: nothing is joined or shuffled at scoring time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import math as M
from ..functions import text as X
from ..operators import clean as C
from ..operators import correlate as K
from ..operators import encode as E
from ..operators import features as FE
from ..operators.least_squares import LinearModel
from ..operators.trees import TreeModel
from ..schema import (CATEGORICAL, DERIVED, FEATURES, ID, SCALED, SKEWED, TARGET_AMOUNT,
                      TARGET_CLASS, TITLE_CASED)
from . import train as TR

OWN_MODELS = (TreeModel, LinearModel)
MODEL_COLS = list(FEATURES) + list(DERIVED) + [TARGET_CLASS, TARGET_AMOUNT]


def derived_inputs(df: DataFrame) -> DataFrame:
    """Logarithms of the skewed columns, then the derived features in their scoring form."""
    out = df.withColumns({c: M.log1p(F.col(c).cast("double")) for c in SKEWED if c in df.columns})
    return FE.derive(out, form="scoring")


def classify(df: DataFrame, model, cols, target_codes: E.LabelCodes) -> DataFrame:
    """``df`` with the predicted class number in the class column and its name as ``eligibility``."""
    v = TR.assemble(df, cols, getattr(model, "learns_missing", False))
    p = TR.predict_class(model, v, out="_cls_code").drop("features")
    return E.decode(p.withColumn(TARGET_CLASS, F.col("_cls_code")), target_codes, TARGET_CLASS, "eligibility")


def amounts(df: DataFrame, model, cols, mean: float, scale: float) -> DataFrame:
    """(applicant_id, eligibility, max_monthly_emi): the predicted amount with its scaling undone."""
    r = TR.assemble(df, cols, getattr(model, "learns_missing", False))
    r = model.transform(r).withColumnRenamed("prediction", "_amt_scaled")
    amt = F.col("_amt_scaled") * F.lit(float(scale)) + F.lit(float(mean))
    return r.select(ID, "eligibility", M.clamp_amount(amt).alias("max_monthly_emi"))


@dataclass
class ScoringModel:
    featurizer: E.Featurizer
    clf_features: list
    reg_features: list
    classifier: object
    regressor: object
    normalize_inputs: bool = False
    metrics: list = field(default_factory=list)  # (task, model, metric, value) of all models compared

    # -- pieces -------------------------------------------------------------
    def features(self, df: DataFrame) -> DataFrame:
        """Scaled model inputs of raw-scale, typed applicant rows."""
        out = df
        if self.normalize_inputs:
            out = out.withColumns({c: X.clean_category(c) for c in TITLE_CASED if c in out.columns})
        out = derived_inputs(E.encode(out, self.featurizer.codes, unseen=0))
        return E.standardize(out, self.featurizer.scaler, SCALED)

    def transform(self, df: DataFrame) -> DataFrame:
        """(applicant_id, eligibility, max_monthly_emi)."""
        keep = [c for c in df.columns if c not in (TARGET_CLASS, TARGET_AMOUNT)]
        p = classify(self.features(df.select(*keep)), self.classifier, self.clf_features, self.featurizer.target_codes)
        ts = self.featurizer.target_scaler
        return amounts(p, self.regressor, self.reg_features, ts.mean[TARGET_AMOUNT], ts.scale(TARGET_AMOUNT))

    # -- persistence ----------------------------------------------------------
    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        meta = {
            "codes": self.featurizer.codes.classes,
            "code_tables": sorted(self.featurizer.codes.tables),
            "target_codes": self.featurizer.target_codes.classes,
            "target_code_tables": sorted(self.featurizer.target_codes.tables), "metrics": self.metrics,
            "scaler": [self.featurizer.scaler.mean, self.featurizer.scaler.std],
            "target_scaler": [self.featurizer.target_scaler.mean, self.featurizer.target_scaler.std],
            "clf_features": self.clf_features, "reg_features": self.reg_features,
            "normalize_inputs": self.normalize_inputs,
            "classifier": type(self.classifier).__name__, "regressor": type(self.regressor).__name__,
        }
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/meta")
        for c, src in (self.featurizer.codes.tables | self.featurizer.target_codes.tables).items():
            spark.read.parquet(src).write.mode("overwrite").parquet(f"{path}/codes/{c}")
        for model, name in ((self.classifier, "classifier"), (self.regressor, "regressor")):
            if isinstance(model, OWN_MODELS):
                model.save(spark, f"{path}/{name}")
            else:
                model.write().overwrite().save(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ScoringModel":
        from pyspark.ml import classification as MC
        own = {m.__name__: m for m in OWN_MODELS}
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        def codes(classes, tables):
            return E.LabelCodes(meta[classes], {c: f"{path}/codes/{c}" for c in meta.get(tables, [])})
        fz = E.Featurizer(codes("codes", "code_tables"), codes("target_codes", "target_code_tables"),
                          E.ScalerStats(*meta["scaler"]), E.ScalerStats(*meta["target_scaler"]))
        def model(kind):
            name = meta[kind]
            return own[name].load(spark, f"{path}/{kind}") if name in own else getattr(MC, name).load(f"{path}/{kind}")
        clf, reg = model("classifier"), model("regressor")
        return ScoringModel(fz, meta["clf_features"], meta["reg_features"], clf, reg,
                            meta["normalize_inputs"], [tuple(m) for m in meta.get("metrics", [])])


@dataclass
class FitResult:
    model: ScoringModel
    training: TR.TrainResult
    selection: dict
    cleaning: C.CleaningStats
    table: DataFrame  # the written model table


def prepare(raw: DataFrame):
    """Clean → derive → fit codes/scalers → model table."""
    cleaned, cstats = C.clean(raw, return_stats=True)
    feats = FE.derive(cleaned)
    fz = E.fit_featurizer(feats)
    table = E.model_table(feats, fz).select(ID, *MODEL_COLS)
    return table, fz, cstats


def fit(raw: DataFrame, settings: TR.TrainSettings | None = None, exclude=(),
        normalize_inputs: bool = False, log: bool = True) -> FitResult:
    """The whole training pipeline on a raw applicant table.

    ``exclude=("max_monthly_emi",)`` removes the amount target from the
    classification candidates (the compatible default keeps it, as the
    original selection does; at scoring it is absent and becomes 0)."""
    table, fz, cstats = prepare(raw)
    table = C.materialize(table, "model-table")
    sel = K.select_features(table, MODEL_COLS, exclude=exclude)
    res = TR.train(table, sel["classification"], sel["regression"], settings, log)
    model = ScoringModel(fz, res.clf_features, res.reg_features, res.best_classifier,
                         res.best_regressor, normalize_inputs, res.metrics)
    return FitResult(model, res, sel, cstats, table)


def score_input(cleaned_filled: DataFrame) -> DataFrame:
    """The 25 typed features and the id (what a scoring request carries)."""
    return cleaned_filled.select(ID, *[c for c in FEATURES if c in cleaned_filled.columns])


__all__ = ["CATEGORICAL", "FitResult", "ScoringModel", "fit", "prepare", "score_input"]
