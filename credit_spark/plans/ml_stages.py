"""The scoring chain as Spark ML stages, kept in one ``PipelineModel``.

``ApplicantPipeline().fit(raw)`` trains as ``score.fit`` does and returns a
``PipelineModel`` that takes raw applicants (numbers may be text, values may
be missing) and gives (applicant_id, eligibility, max_monthly_emi):

repair and fill → codes → logarithms and derived features → scaling →
eligibility → amount

Every stage is a projection with fitted values as literals; only a code
table of a column with very many values is joined. So the model works alike
on a batch and on a stream, whose rows are scored one by one: equal rows
are not removed. Fitted values are Params, bounded by the number of columns;
models and code tables lie in the stage's own folder, so a saved pipeline
can be moved. ``PipelineModel.load`` needs no code of this module beside
that it can be imported.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml import classification as MC
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession

from ..operators import clean as C
from ..operators import encode as E
from ..schema import SCALED, TARGET_AMOUNT
from . import score as SC
from . import train as TR


def _param(name: str, doc: str, convert=None) -> Param:
    return Param(Params._dummy(), name, doc, convert)


class _StageWriter(MLWriter):
    def __init__(self, stage: "FittedStage"):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:  # noqa: N802 (the name of Spark's method)
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.save_parts(self.sparkSession, path)


class _StageReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(stage, meta)
        stage.load_parts(self.sparkSession, path)
        return stage


class FittedStage(Transformer, MLReadable, MLWritable):
    """A transformer whose fitted values are Params; what is larger than those is a part of its folder."""

    def __init__(self, **values):
        super().__init__()
        self._set(**values)

    def write(self) -> MLWriter:
        return _StageWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StageReader(cls)

    def save_parts(self, spark: SparkSession, path: str) -> None:
        """Write what isn't a Param below ``path``."""

    def load_parts(self, spark: SparkSession, path: str) -> None:
        """Read it again."""


class RepairApplicants(FittedStage):
    """Text and numbers repaired, gaps filled with the medians and modes of the fit.

    Columns other than the id and the features are left out, so none clashes
    with a later stage's. A feature column that isn't there stays away (the
    models take it as 0), but for those that ``clean_text`` asks for.
    """

    medians = _param("medians", "numeric column: median of the fit")
    modes = _param("modes", "category column: mode of the fit")

    def _transform(self, df: DataFrame) -> DataFrame:
        stats = C.CleaningStats(self.getOrDefault(self.medians), self.getOrDefault(self.modes))
        return C.fill(C.clean_text(SC.score_input(df)), stats)


class _Coded(FittedStage):
    """A stage with label codes: small ones are a Param, tables lie in the stage's folder."""

    codes = _param("codes", "column: its values in the order of their codes")
    tableColumns = _param("tableColumns", "columns whose codes are tables", TypeConverters.toListString)

    def __init__(self, label_codes: E.LabelCodes | None = None, **values):
        found = label_codes or E.LabelCodes()
        super().__init__(codes=found.classes, tableColumns=sorted(found.tables), **values)
        self.tables = dict(found.tables)

    def label_codes(self) -> E.LabelCodes:
        return E.LabelCodes(self.getOrDefault(self.codes), self.tables)

    def save_parts(self, spark: SparkSession, path: str) -> None:
        for c, source in self.tables.items():
            spark.read.parquet(source).write.parquet(f"{path}/codes/{c}")

    def load_parts(self, spark: SparkSession, path: str) -> None:
        self.tables = {c: f"{path}/codes/{c}" for c in self.getOrDefault(self.tableColumns)}


class CodeCategories(_Coded):
    """Categories as the codes of the fit; a value that it didn't see is 0."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return E.encode(df, self.label_codes(), unseen=0)


class DeriveInputs(FittedStage):
    """Logarithms of the skewed columns and the derived features in their scoring form; nothing is fitted."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return SC.derived_inputs(df)


class ScaleInputs(FittedStage):
    """Features less their mean, over their standard deviation."""

    mean = _param("mean", "column: mean of the fit")
    std = _param("std", "column: population standard deviation of the fit")

    def _transform(self, df: DataFrame) -> DataFrame:
        return E.standardize(df, E.ScalerStats(self.getOrDefault(self.mean), self.getOrDefault(self.std)), SCALED)


class _Modelled:
    """The part of a stage that holds a fitted model, Spark ML's or the package's own."""

    modelClass = _param("modelClass", "class of the fitted model", TypeConverters.toString)
    features = _param("features", "columns that the model reads, in order", TypeConverters.toListString)
    comparison = _param("comparison", "metrics of all models that were compared: model, metric, value")

    def save_model(self, spark: SparkSession, path: str) -> None:
        if isinstance(self.model, SC.OWN_MODELS):
            self.model.save(spark, f"{path}/model")
        else:
            self.model.write().session(spark).save(f"{path}/model")

    def load_model(self, spark: SparkSession, path: str) -> None:
        name = self.getOrDefault(self.modelClass)
        own = {m.__name__: m for m in SC.OWN_MODELS}
        self.model = own[name].load(spark, f"{path}/model") if name in own else getattr(MC, name).load(f"{path}/model")


class PredictEligibility(_Modelled, _Coded):
    """Adds the predicted class number (in the class column) and its name, ``eligibility``."""

    def __init__(self, model=None, label_codes: E.LabelCodes | None = None, **values):
        super().__init__(label_codes, **values)
        self.model = model
        if model is not None:
            self._set(modelClass=type(model).__name__)

    def _transform(self, df: DataFrame) -> DataFrame:
        return SC.classify(df, self.model, self.getOrDefault(self.features), self.label_codes())

    def save_parts(self, spark: SparkSession, path: str) -> None:
        super().save_parts(spark, path)
        self.save_model(spark, path)

    def load_parts(self, spark: SparkSession, path: str) -> None:
        super().load_parts(spark, path)
        self.load_model(spark, path)


class PredictAmount(_Modelled, FittedStage):
    """The result: id, eligibility and the amount in money, not below 0, rounded to 2 places."""

    mean = _param("mean", "mean of the amount in the fit", TypeConverters.toFloat)
    scale = _param("scale", "standard deviation of the amount in the fit", TypeConverters.toFloat)

    def __init__(self, model=None, **values):
        super().__init__(**values)
        self.model = model
        if model is not None:
            self._set(modelClass=type(model).__name__)

    def _transform(self, df: DataFrame) -> DataFrame:
        return SC.amounts(df, self.model, self.getOrDefault(self.features),
                          self.getOrDefault(self.mean), self.getOrDefault(self.scale))

    def save_parts(self, spark: SparkSession, path: str) -> None:
        self.save_model(spark, path)

    def load_parts(self, spark: SparkSession, path: str) -> None:
        self.load_model(spark, path)


def to_pipeline(model: SC.ScoringModel, cleaning: C.CleaningStats) -> PipelineModel:
    """A scoring model and the cleaning fit before it as one pipeline."""
    fz = model.featurizer

    def compared(task):
        return [list(m[1:]) for m in model.metrics if m[0] == task]
    return PipelineModel([
        RepairApplicants(medians=cleaning.medians, modes=cleaning.modes),
        CodeCategories(fz.codes),
        DeriveInputs(),
        ScaleInputs(mean=fz.scaler.mean, std=fz.scaler.std),
        PredictEligibility(model.classifier, fz.target_codes, features=list(model.clf_features),
                           comparison=compared("classification")),
        PredictAmount(model.regressor, features=list(model.reg_features), comparison=compared("regression"),
                      mean=float(fz.target_scaler.mean[TARGET_AMOUNT]),
                      scale=float(fz.target_scaler.scale(TARGET_AMOUNT)))])


class ApplicantPipeline(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the whole chain on raw applicants with both targets: clean, derive, select, train, compare."""

    settings = _param("settings", "fields of TrainSettings that differ from the full ones")
    exclude = _param("exclude", "columns that the classifier must not read", TypeConverters.toListString)
    log = _param("log", "whether the run goes to the run table", TypeConverters.toBoolean)

    def __init__(self, settings: TR.TrainSettings | None = None, exclude=(), log: bool = True):
        super().__init__()
        self._set(settings=asdict(settings or TR.TrainSettings()), exclude=list(exclude), log=log)

    def _fit(self, raw: DataFrame) -> PipelineModel:
        fitted = SC.fit(raw, TR.TrainSettings(**self.getOrDefault(self.settings)),
                        tuple(self.getOrDefault(self.exclude)), log=self.getOrDefault(self.log))
        return to_pipeline(fitted.model, fitted.cleaning)


__all__ = ["ApplicantPipeline", "CodeCategories", "DeriveInputs", "PredictAmount", "PredictEligibility",
           "RepairApplicants", "ScaleInputs", "to_pipeline"]
