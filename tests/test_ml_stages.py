"""The scoring chain as one Spark ML pipeline: same rows as the scoring model, saved, moved, on a stream."""
import shutil
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from credit_spark.operators import clean as C
from credit_spark.operators import encode as E
from credit_spark.plans import ml_stages as MS
from credit_spark.plans import score as SC
from credit_spark.plans import stages as S
from credit_spark.plans import train as TR
from credit_spark.schema import FEATURES, ID, TARGET_CLASS
from credit_spark.session import scratch_path
from credit_spark.streaming.score_stream import start_scoring
from tests.conftest import SF_SMALL

TINY = TR.TrainSettings(lr_max_iter=20, trees=3, forest_depth=3, boost_rounds=2, boost_depth=2)


@pytest.fixture(scope="module")
def fitted(spark):
    return SC.fit(S.raw(spark, SF_SMALL), TINY, log=False)


@pytest.fixture(scope="module")
def raw(spark):
    return C.dedupe(S.raw(spark, SF_SMALL))


@pytest.fixture(scope="module")
def want(spark, fitted):
    return sorted(map(tuple, fitted.model.transform(SC.score_input(S.filled(spark, SF_SMALL))).collect()))


def rows(df):
    return sorted(map(tuple, df.collect()))


def saved(spark, model):
    path = scratch_path(spark, "pipeline")
    model.write().save(path)
    return path


def test_saved_and_moved_pipeline_equals_the_scoring_model(spark, fitted, raw, want, tmp_path):
    path = saved(spark, MS.to_pipeline(fitted.model, fitted.cleaning))
    shutil.copytree(path.removeprefix("file:"), tmp_path / "moved")
    for at in (path, str(tmp_path / "moved")):
        loaded = PipelineModel.load(at)
        assert rows(loaded.transform(raw)) == want
    assert loaded.stages[4].getOrDefault("comparison") == [list(m[1:]) for m in fitted.training.metrics if m[0] == "classification"]
    again = saved(spark, loaded)
    assert rows(PipelineModel.load(again).transform(raw)) == want


def test_every_kind_of_model(spark, fitted, raw):
    """Spark ML's own model and the package's go through the same stage."""
    inp = SC.score_input(S.filled(spark, SF_SMALL))
    for (_, a), (_, b) in zip([k for k in fitted.training.models if k[0] == "classification"],
                              [k for k in fitted.training.models if k[0] == "regression"]):
        model = replace(fitted.model, classifier=fitted.training.models["classification", a],
                        regressor=fitted.training.models["regression", b])
        loaded = PipelineModel.load(saved(spark, MS.to_pipeline(model, fitted.cleaning)))
        assert rows(loaded.transform(raw)) == rows(model.transform(inp)), (a, b)


def test_stream_equals_batch(spark, fitted, raw, want):
    loaded = PipelineModel.load(saved(spark, MS.to_pipeline(fitted.model, fitted.cleaning)))
    src, out, ck = (scratch_path(spark, n) for n in ("p-in", "p-out", "p-ck"))
    raw.repartition(3).write.parquet(src)
    start_scoring(spark, loaded, src, out, ck, raw.schema).awaitTermination()
    assert rows(spark.read.parquet(out)) == want


def test_code_tables_lie_in_the_pipeline(spark, fitted, raw, want, tmp_path):
    fz = fitted.model.featurizer

    def tabled(codes, col):
        path = scratch_path(spark, "codes")
        codes.table(spark).where(F.col("column") == col).select("value", "code").write.parquet(path)
        return E.LabelCodes({c: v for c, v in codes.classes.items() if c != col}, {col: path})
    model = replace(fitted.model, featurizer=replace(
        fz, codes=tabled(fz.codes, "education"), target_codes=tabled(fz.target_codes, TARGET_CLASS)))
    path = saved(spark, MS.to_pipeline(model, fitted.cleaning))
    shutil.copytree(path.removeprefix("file:"), tmp_path / "moved")
    loaded = PipelineModel.load(str(tmp_path / "moved"))
    assert all(str(tmp_path) in p for s in (loaded.stages[1], loaded.stages[4]) for p in s.tables.values())
    assert rows(loaded.transform(raw)) == want


def test_awkward_inputs(spark, fitted, raw):
    model = MS.to_pipeline(fitted.model, fitted.cleaning)
    # Empty table.
    assert model.transform(raw.limit(0)).count() == 0
    # Numbers as text, extra columns with the names that stages use.
    texts = raw.select(*[F.col(c).cast("string").alias(c) if c in FEATURES else F.col(c) for c in raw.columns])
    clash = texts.withColumns({c: F.lit("x") for c in ("features", "_cls_code", "eligibility", "prediction", "_x")})
    assert rows(model.transform(clash)) == rows(model.transform(raw))
    # Nothing but an id, twice: a score from the medians and modes, a row each.
    bare = raw.limit(1).select(*[F.lit(7).cast("long").alias(c) if c == ID else F.lit(None).cast(t).alias(c)
                                 for c, t in raw.dtypes])
    got = rows(model.transform(bare.union(bare)))
    assert len(got) == 2 and got[0] == got[1] and got[0][1] is not None and got[0][2] >= 0
    # A category that the fit didn't see, and a null id.
    odd = raw.limit(1).withColumn("education", F.lit("unheard of")).withColumn(ID, F.lit(None).cast("long"))
    assert len(rows(model.transform(odd))) == 1


def test_estimator_fits_and_is_saved(spark, fitted, want, raw):
    est = MS.ApplicantPipeline(TINY, log=False)
    path = scratch_path(spark, "estimator")
    est.write().save(path)
    loaded = MS.ApplicantPipeline.load(path)
    assert loaded.uid == est.uid
    assert {p.name: v for p, v in loaded.extractParamMap().items()} == {p.name: v for p, v in est.extractParamMap().items()}
    assert rows(loaded.fit(S.raw(spark, SF_SMALL)).transform(raw)) == want


def test_plan_moves_no_rows(spark, fitted, raw):
    plan = MS.to_pipeline(fitted.model, fitted.cleaning).transform(S.raw(spark, SF_SMALL))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and "BatchEvalPython" not in text
