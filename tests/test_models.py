"""Fit, score, persist and stream on the smallest scale."""
import pytest
from pyspark.sql import functions as F

from credit_spark.operators import metrics as MT
from credit_spark.plans import score as SC
from credit_spark.plans import stages as S
from credit_spark.plans import train as TR
from credit_spark.schema import ID, TARGET_AMOUNT, TARGET_CLASS
from credit_spark.session import scratch_path
from credit_spark.streaming.score_stream import start_scoring
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def fitted(spark):
    return SC.fit(S.raw(spark, SF_SMALL), TR.TrainSettings.quick())


def test_models_beat_trivial_baselines(spark, fitted):
    m = {(t, n, k): v for t, n, k, v in fitted.training.metrics}
    table, _, _ = SC.prepare(S.raw(spark, SF_SMALL))
    counts = [r["count"] for r in table.groupBy(TARGET_CLASS).count().collect()]
    majority = max(counts) / sum(counts)
    best_f1 = max(v for (t, n, k), v in m.items() if t == "classification" and k == "f1")
    assert best_f1 > 2 * majority ** 2 / (1 + majority)  # weighted F1 of always predicting the majority
    best_rmse = min(v for (t, n, k), v in m.items() if t == "regression" and k == "rmse")
    assert best_rmse < 1.0  # the target is standardised: the mean predictor has RMSE ~1


def test_selection_lists(fitted):
    sel = fitted.selection
    assert TARGET_CLASS not in sel["classification"]
    assert TARGET_AMOUNT not in sel["regression"]
    assert set(sel["classification"]) <= set(sel["classification_candidates"])


def test_best_models_report_own_metrics(spark, fitted):
    rows = TR.best_models(fitted.training, spark).collect()
    names = {(r.task, r.model) for r in rows}
    assert ("classification", fitted.training.best_classifier_name) in names
    assert len(names) == 2


def test_scoring_batch_stream_and_reload_agree(spark, fitted):
    inp = SC.score_input(S.filled(spark, SF_SMALL))
    batch = fitted.model.transform(inp)
    assert set(r.eligibility for r in batch.select("eligibility").distinct().collect()) <= {
        "Eligible", "High_Risk", "Not_Eligible"}
    assert batch.count() == inp.count()
    assert batch.where(F.col("max_monthly_emi") < 0).count() == 0
    # Streaming over the same rows written as files gives the same result.
    src, out, ck = (scratch_path(spark, n) for n in ("t-in", "t-out", "t-ck"))
    inp.repartition(3).write.parquet(src)
    start_scoring(spark, fitted.model, src, out, ck, inp.schema).awaitTermination()
    streamed = spark.read.parquet(out)
    assert batch.exceptAll(streamed.select(*batch.columns)).count() == 0
    # Save and load.
    path = scratch_path(spark, "model")
    fitted.model.save(path)
    loaded = SC.ScoringModel.load(spark, path)
    assert loaded.metrics == fitted.training.metrics
    again = loaded.transform(inp)
    assert batch.exceptAll(again).count() == 0


def test_scoring_plan_has_no_python_udf(spark, fitted):
    inp = SC.score_input(S.filled(spark, SF_SMALL))
    plan = fitted.model.transform(inp)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_feature_importance_and_auc(spark, fitted):
    fi = TR.feature_importance(fitted.training, spark).collect()
    assert 0 < len(fi) <= 40
    auc = TR.roc_auc_ovr(fitted.training, fitted.table).collect()
    assert all(0.0 <= r.auc <= 1.0 for r in auc)


def test_run_log_written(spark, fitted):
    runs = spark.read.parquet(TR.runs_path(spark)).where(F.col("run_id") == fitted.training.run_id)
    kinds = {r.kind for r in runs.select("kind").distinct().collect()}
    assert kinds == {"param", "metric", "signature"}
    assert runs.where("kind = 'metric'").count() == 3 * 4 + 3 * 4


def test_target_codes_from_a_table_score_alike(spark, fitted):
    """Class codes kept as a table, as for very many classes, decode like literal ones."""
    from dataclasses import replace
    from credit_spark.operators import encode as E
    literal = fitted.model.featurizer.target_codes
    path = scratch_path(spark, "target-codes")
    literal.table(spark).select("value", "code").write.parquet(path)
    fz = replace(fitted.model.featurizer, target_codes=E.LabelCodes({}, {TARGET_CLASS: path}))
    tabled = replace(fitted.model, featurizer=fz)
    inp = SC.score_input(S.filled(spark, SF_SMALL))
    want = fitted.model.transform(inp)
    assert tabled.transform(inp).exceptAll(want).count() == 0
    at = scratch_path(spark, "model-tabled")
    tabled.save(at)
    assert SC.ScoringModel.load(spark, at).transform(inp).exceptAll(want).count() == 0
