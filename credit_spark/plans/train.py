"""Model training, comparison and the run log (Spark ML).

Three classifiers for the eligibility class and three regressors for the
maximum instalment are fitted on one persisted training frame each; the
best classifier has the highest weighted F1, the best regressor the lowest
RMSE (the first fitted wins ties). A run's parameters, metrics, input
signatures and example rows are committed together to the run table
(``run_table.py``).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as MT
from ..operators import split as SP
from ..operators.least_squares import LeastSquares, LinearModel
from ..operators.trees import BoostedTrees, Forest, TreeModel
from ..schema import ID, SEED, TARGET_AMOUNT, TARGET_CLASS
from ..session import side_by_side
from .run_table import runs_path, write_run  # noqa: F401


@dataclass
class TrainSettings:
    """Full settings mirror the original models; ``quick()`` is for tests."""
    lr_max_iter: int = 2000
    trees: int = 200
    forest_depth: int | None = None      # None: until the leaves are pure
    boost_rounds: int = 100
    boost_depth: int = 6
    boost_step: float = 0.3
    seed: int = SEED

    @staticmethod
    def quick() -> "TrainSettings":
        return TrainSettings(lr_max_iter=100, trees=10, forest_depth=5, boost_rounds=10,
                             boost_depth=3)

    def boosted(self, task: str) -> BoostedTrees:
        return BoostedTrees(task, self.boost_rounds, self.boost_depth, self.boost_step, seed=self.seed, id_col=ID)

    def forest(self, task: str, per_node: str) -> Forest:
        return Forest(task, self.trees, self.forest_depth, per_node, seed=self.seed, id_col=ID)


def classifiers(s: TrainSettings, n_train: int) -> dict:
    return {
        # sklearn's default C=1 penalises the summed loss; Spark's regParam
        # penalises the mean loss, hence 1/n.
        "logistic": LogisticRegression(family="multinomial", maxIter=s.lr_max_iter,
                                       regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                                       standardization=False),
        "random_forest": s.forest("class", "sqrt"),
        "boosted_trees": s.boosted("class"),
    }


def regressors(s: TrainSettings) -> dict:
    return {
        "linear": LeastSquares(),
        "random_forest": s.forest("value", "all"),
        "boosted_trees": s.boosted("value"),
    }


@dataclass
class TrainResult:
    clf_features: list
    reg_features: list
    best_classifier: object
    best_classifier_name: str
    best_regressor: object
    best_regressor_name: str
    metrics: list = field(default_factory=list)  # (task, model, metric, value)
    models: dict = field(default_factory=dict)   # (task, name) -> fitted model
    run_id: str = ""

    def metrics_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.metrics, "task string, model string, metric string, value double")


def predict_class(model, df: DataFrame, out: str = "prediction") -> DataFrame:
    """``df`` with the predicted class number; Spark ML's other output columns are left out."""
    if isinstance(model, TreeModel):
        return model.transform(df, prediction=out)
    res = model.transform(df)
    drop = [c for c in ("rawPrediction", "probability") if c in res.columns and c not in df.columns]
    return res.drop(*drop).withColumnRenamed("prediction", out) if out != "prediction" else res.drop(*drop)


def class_probabilities(model, df: DataFrame, out: str) -> DataFrame:
    """``df`` with an array of class probabilities."""
    if isinstance(model, TreeModel):
        return (model.transform(df, prediction="_pred", scores="_scores")
                .withColumn(out, model.probabilities(F.col("_scores"))).drop("_pred", "_scores"))
    return model.transform(df).withColumn(out, vector_to_array("probability")) \
        .drop("rawPrediction", "probability", "prediction")


def assemble(df: DataFrame, cols, learns_missing: bool = False, out: str = "features") -> DataFrame:
    """A vector of ``cols``; a column that isn't there is 0, and no row is left out.

    A missing value is 0 as well (the mean of a scaled column), or NaN for a
    model that learns a side for missing values at every split.
    """
    gap = F.lit(float("nan") if learns_missing else 0.0)
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), gap) if c in df.columns else F.lit(0.0)
                             for c in cols})
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid="keep" if learns_missing else "error").transform(filled)


def row_counts(df: DataFrame, cols) -> dict:
    """Rows of each side of a split, and those with a missing feature; for the run log."""
    gap = F.lit(False)
    for c in cols:
        gap = gap | F.col(c).isNull()
    got = {r["split"]: r for r in df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(gap).alias("gaps")).collect()}
    return {f"{side}_{k}": got[side][c] if side in got else 0 for side in ("train", "test")
            for k, c in (("rows", "n"), ("rows_with_missing", "gaps"))}


def run_rows(task: str, model: str, params: dict, metrics: dict, train: DataFrame, cols,
             example: str | None = None) -> list[tuple]:
    """One fit as rows of the run table: params, metrics, signature, example (JSON of a row)."""
    types = dict(train.dtypes)
    sig = json.dumps({"inputs": [{"name": c, "type": types[c]} for c in cols],
                      "output": {"type": "long" if task == "classification" else "double"}})
    rows = [(task, model, "param", k, str(v)) for k, v in params.items()]
    rows += [(task, model, "metric", k, repr(float(v))) for k, v in metrics.items()]
    return rows + [(task, model, "signature", "schema", sig),
                   (task, model, "signature", "input_example", example or "{}")]


def example_row(train: DataFrame, cols) -> str | None:
    """Any row's columns as JSON."""
    found = train.select(*cols).limit(1).toJSON().collect()
    return found[0] if found else None


def _params(est) -> dict:
    name = {"model_name": type(est).__name__}
    if isinstance(est, LogisticRegression):
        keep = ("maxIter", "regParam", "family")
        return {p.name: est.getOrDefault(p) for p in est.params if p.name in keep and est.isDefined(p)} | name
    return {k: v for k, v in vars(est).items() if k not in ("cuts", "id_col", "fit_rows")} | name


def _sides(split: DataFrame, cols) -> tuple[DataFrame, DataFrame]:
    """Training and hold-out rows with missing values kept."""
    out = assemble(split, cols, learns_missing=True)
    return out.where(F.col("split") == "train"), out.where(F.col("split") == "test")


def train(model_table: DataFrame, clf_features, reg_features,
          settings: TrainSettings | None = None, log: bool = True) -> TrainResult:
    """Fit, evaluate on a 20 % hold-out and pick the best of each task.

    The two tasks run side by side: a boosting round alone doesn't fill a cluster."""
    s = settings or TrainSettings()
    spark = model_table.sparkSession
    run_id = uuid.uuid4().hex[:12]
    c, r = side_by_side(lambda: _train_classifiers(model_table, clf_features, s, log),
                        lambda: _train_regressors(model_table, reg_features, s, log))
    if log:
        write_run(spark, run_id, c.logged + r.logged)
    return TrainResult(list(clf_features), list(reg_features), c.best, c.name, r.best, r.name,
                       c.metrics + r.metrics, c.models | r.models, run_id)


@dataclass
class _Fitted:
    """The models of a task and the best of them."""
    best: object = None
    name: str = ""
    metrics: list = field(default_factory=list)
    models: dict = field(default_factory=dict)
    logged: list = field(default_factory=list)


def _train_classifiers(model_table: DataFrame, clf_features, s: TrainSettings, log: bool) -> _Fitted:
    out, best_f1 = _Fitted(), float("-inf")
    # Classification: stratified hash split, one persisted training frame.
    csplit = SP.stratified_split(model_table.select(ID, *clf_features, TARGET_CLASS), TARGET_CLASS)
    ccounts = row_counts(csplit, clf_features)
    cexample = example_row(csplit, clf_features) if log else None
    csplit = csplit.withColumn("label", F.col(TARGET_CLASS).cast("double"))
    c = assemble(csplit, clf_features)
    ctrain = c.where(F.col("split") == "train").persist(StorageLevel.MEMORY_AND_DISK)
    ctest = c.where(F.col("split") == "test").persist(StorageLevel.MEMORY_AND_DISK)
    n_train = ctrain.count()
    for name, est in classifiers(s, n_train).items():
        ctr, cte = _sides(csplit, clf_features) if isinstance(est, BoostedTrees) else (ctrain, ctest)
        m = est.fit(ctr)
        pred = predict_class(m, cte).select(F.col("label").alias("y"), F.col("prediction").alias("yhat"))
        row = MT.classification_metrics(pred).first().asDict()
        out.metrics += [("classification", name, k, float(v or 0.0)) for k, v in row.items()]
        out.models[("classification", name)] = m
        if log:
            out.logged += run_rows("classification", name, _params(est) | ccounts, row, csplit, clf_features, cexample)
        if (row["f1"] or 0.0) > best_f1:
            out.best, best_f1, out.name = m, row["f1"] or 0.0, name
    ctrain.unpersist()
    ctest.unpersist()
    return out


def _train_regressors(model_table: DataFrame, reg_features, s: TrainSettings, log: bool) -> _Fitted:
    out, best_rmse = _Fitted(), float("inf")
    # Regression: plain hash split.
    rsplit = SP.random_split(model_table.select(ID, *reg_features, TARGET_AMOUNT))
    rcounts = row_counts(rsplit, reg_features)
    rexample = example_row(rsplit, reg_features) if log else None
    rsplit = rsplit.withColumn("label", F.col(TARGET_AMOUNT).cast("double"))
    r = assemble(rsplit, reg_features)
    rtrain = r.where(F.col("split") == "train").persist(StorageLevel.MEMORY_AND_DISK)
    rtest = r.where(F.col("split") == "test").persist(StorageLevel.MEMORY_AND_DISK)
    for name, est in regressors(s).items():
        rtr, rte = _sides(rsplit, reg_features) if isinstance(est, BoostedTrees) else (rtrain, rtest)
        m = est.fit(rtr)
        pred = m.transform(rte).select(F.col("label").alias("y"), F.col("prediction").alias("yhat"))
        row = MT.regression_metrics(pred).first().asDict()
        out.metrics += [("regression", name, k, float(v) if v is not None else float("nan"))
                        for k, v in row.items()]
        out.models[("regression", name)] = m
        if log:
            out.logged += run_rows("regression", name, _params(est) | rcounts, row, rsplit, reg_features, rexample)
        if row["rmse"] is not None and row["rmse"] < best_rmse:
            out.best, best_rmse, out.name = m, row["rmse"], name
    rtrain.unpersist()
    rtest.unpersist()
    return out


def best_models(result: TrainResult, spark: SparkSession) -> DataFrame:
    """The chosen model per task with *its own* metrics."""
    rows = [(t, n, k, v) for (t, n, k, v) in result.metrics
            if (t, n) in (("classification", result.best_classifier_name),
                          ("regression", result.best_regressor_name))]
    return spark.createDataFrame(rows, "task string, model string, metric string, value double")


def importances(model, features) -> list:
    """Per-feature importance: of trees, or |coefficients| (mean over classes for a multinomial model)."""
    if isinstance(model, TreeModel):
        return [float(v) for v in model.featureImportances]
    if isinstance(model, LinearModel):
        return [abs(float(v)) for v in model.coefficients]
    mat = model.coefficientMatrix.toArray()
    return [float(abs(mat[:, i]).mean()) for i in range(len(features))]


def feature_importance(result: TrainResult, spark: SparkSession, top: int = 20) -> DataFrame:
    """Top-``top`` features per best model, descending."""
    rows = []
    for task, name, model, feats in (
            ("classification", result.best_classifier_name, result.best_classifier, result.clf_features),
            ("regression", result.best_regressor_name, result.best_regressor, result.reg_features)):
        imp = importances(model, feats)
        ranked = sorted(zip(feats, imp), key=lambda t: -t[1])[:top]
        rows += [(task, name, i + 1, f, float(v)) for i, (f, v) in enumerate(ranked)]
    return spark.createDataFrame(rows, "task string, model string, rank int, feature string, "
                                       "importance double")


def roc_auc_ovr(result: TrainResult, model_table: DataFrame) -> DataFrame:
    """One-vs-rest ROC-AUC of every classifier and class on the hold-out: each model is evaluated once."""
    feats = result.clf_features
    split = SP.stratified_split(model_table.select(ID, *feats, TARGET_CLASS), TARGET_CLASS)
    test = split.where((F.col("split") == "test") & F.col(TARGET_CLASS).isNotNull())
    scored = None
    for (task, name), m in result.models.items():
        if task != "classification":
            continue
        p = class_probabilities(m, assemble(test, feats, getattr(m, "learns_missing", False)), "_p")
        p = p.select(F.lit(name).alias("model"), F.col(TARGET_CLASS).alias("y"), F.posexplode("_p").alias("class", "score"))
        scored = p if scored is None else scored.unionByName(p)
    return MT.rank_sum_auc(scored.select("model", "class", "score", (F.col("y") == F.col("class")).alias("positive")),
                           ["model", "class"])
