"""Registered queries: models, scoring, streaming, recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import math as M
from ..functions import text as X
from ..operators import recommend as R
from ..operators.least_squares import LinearModel
from ..operators.trees import Tree, TreeModel
from ..schema import (ADVICE, BADGES, CATEGORICAL, DERIVED, FEATURES, ID, NO_PREDICTION_NOTICE,
                      SCALED, SKEWED, TARGET_AMOUNT, TARGET_CLASS)
from ..session import AFTER_SCOPE, scratch_path
from ..streaming.score_stream import start_scoring
from . import oracle as O
from . import score as SC
from . import stages as S
from . import train as TR
from .run_table import read_runs
from .catalog import register, rounded
from .queries_features import (MODEL, RULE_AMOUNT_SQL, RULE_CLASS_SQL, rule_predictions,
                               SIDES)

FILLED = O.filled_prefix()
_FITS: dict = {}
AFTER_SCOPE.append(_FITS.clear)


def _fit(spark, sf_dir) -> SC.FitResult:
    """One fit per session and state of the source files, reused by the model queries."""
    key = S.source_key(spark, sf_dir)
    if key not in _FITS:
        _FITS[key] = SC.fit(S.raw(spark, sf_dir), TR.TrainSettings())
    return _FITS[key]


def _score_input(spark, sf_dir):
    return SC.score_input(S.filled(spark, sf_dir))


@register("train_classifiers")
def train_classifiers(spark, sf_dir):
    """Hold-out accuracy / weighted precision, recall, F1 of 3 classifiers."""
    r = _fit(spark, sf_dir).training
    return rounded(r.metrics_df(spark).where(F.col("task") == "classification"))


@register("train_regressors")
def train_regressors(spark, sf_dir):
    """Hold-out RMSE / MAE / R² / MAPE of 3 regressors (scaled target)."""
    r = _fit(spark, sf_dir).training
    return rounded(r.metrics_df(spark).where(F.col("task") == "regression"))


@register("best_models")
def best_models(spark, sf_dir):
    """The best model per task with its own metrics."""
    return rounded(TR.best_models(_fit(spark, sf_dir).training, spark))


@register("feature_importance")
def feature_importance(spark, sf_dir):
    return rounded(TR.feature_importance(_fit(spark, sf_dir).training, spark))


@register("roc_auc_ovr")
def roc_auc_ovr(spark, sf_dir):
    fr = _fit(spark, sf_dir)
    return rounded(TR.roc_auc_ovr(fr.training, fr.table))


@register("run_log")
def run_log(spark, sf_dir):
    """The runs table rows of this fit: params, metrics, signature, example."""
    fr = _fit(spark, sf_dir)
    return read_runs(spark).where(F.col("run_id") == fr.training.run_id).select(
        "task", "model", "kind", "name", "value")


def _run_log_sizes_sql():
    """Sizes of both splits by their rules, for the three models of each task."""
    models = (("classification", ("logistic", "random_forest", "boosted_trees")),
              ("regression", ("linear", "random_forest", "boosted_trees")))
    names = ", ".join(f"('{t}', '{m}')" for t, ms in models for m in ms)
    return SIDES + f""",
_tasks AS (SELECT 'classification' AS task, strata AS side FROM _sides UNION ALL SELECT 'regression', side FROM _sides)
SELECT m.task, m.model, side || '_rows' AS name, CAST(count(*) AS VARCHAR) AS value
FROM _tasks JOIN (VALUES {names}) AS m(task, model) USING (task) GROUP BY m.task, m.model, side"""


@register("run_log_sizes", _run_log_sizes_sql())
def run_log_sizes(spark, sf_dir):
    """The logged sizes of the training and hold-out sides of every model."""
    return run_log(spark, sf_dir).where(F.col("name").isin("train_rows", "test_rows")).drop("kind")


def _score_features_sql():
    sel, joins = [], []
    for c in [ID] + list(FEATURES) + list(DERIVED):
        if c in CATEGORICAL:
            sel.append(f"coalesce(_k_{c}.code, 0) AS {c}")
            joins.append(f"LEFT JOIN _k_{c} ON coalesce(CAST(sfeat.{c} AS VARCHAR), 'nan') = _k_{c}.v")
        elif c in SCALED:
            sel.append(f"round((sfeat.{c} - mu_{c}) / (CASE WHEN sd_{c} = 0 OR sd_{c} IS NULL "
                       f"THEN 1.0 ELSE sd_{c} END), 6) AS {c}")
        elif c == ID:
            sel.append(f"sfeat.{c} AS {c}")
        else:
            sel.append(f"round(sfeat.{c}, 6) AS {c}")
    logged = O.log_cte("_filled", "_slog")
    return (MODEL.rstrip("\n") + logged.rstrip("\n") + O.features_cte("_slog", "sfeat", "scoring")
            + f"SELECT {', '.join(sel)} FROM sfeat CROSS JOIN _sc " + " ".join(joins))


@register("score_features", _score_features_sql())
def score_features(spark, sf_dir):
    """Scoring inputs encoded (unseen → 0), log-scaled, derived with
    denominators floored at 1 and standardised with the training scaler."""
    from . import stages
    from ..operators import encode as E
    from ..operators import features as FE
    feats = FE.derive(stages.cleaned(spark, sf_dir))
    fz = E.fit_featurizer(feats)
    model = SC.ScoringModel(fz, [], [], None, None)
    return rounded(model.features(_score_input(spark, sf_dir)).select(ID, *FEATURES, *DERIVED))


def _fixed_tree(*splits) -> Tree:
    """A tree of (node, feature, cut, missing left, value left, value right), children numbered as they come."""
    t = Tree()
    for node, feature, cut, missing_left, low, high in splits:
        a, b = t.split(node, feature, cut, missing_left, 1.0)
        t.value[a], t.value[b] = [low], [high]
    return t


# A fixed model, so that the whole scoring chain can be checked by SQL.
FIXED_CLF_COLS = ["monthly_salary", "affordability_ratio", "debt_to_income", "employment_type", "total_monthly_expenses"]
FIXED_REG_COLS = ["monthly_salary", "monthly_disposable", TARGET_CLASS, "credit_score", "gender"]
FIXED_CLASSIFIER = TreeModel("softmax", 3, len(FIXED_CLF_COLS), [0.5, 0.25, 0.5], [
    _fixed_tree((0, 1, 0.0173, False, -0.4, 0.6), (2, 2, -0.3139, True, 0.9, 0.2)),
    _fixed_tree((0, 2, 0.4271, True, 0.1, 0.5), (1, 3, 0.5, False, 0.3, -0.1)),
    _fixed_tree((0, 0, -0.1937, False, 0.7, -0.3), (1, 4, 20.7311, True, 0.15, 0.75)),
    _fixed_tree((0, 0, 0.8713, True, -0.05, 0.4)),
    _fixed_tree((0, 1, -0.5519, False, -0.2, 0.25), (2, 0, 0.3377, True, 0.3, 0.05)),
    _fixed_tree((0, 3, 1.5, False, 0.02, 0.11))])
FIXED_REGRESSOR = LinearModel([0.37, 0.211, -0.458, 0.052, 0.013], 0.091)


def _score_fixed_sql():
    feats = _score_features_sql()
    at = feats.rindex("SELECT ")
    # The same features, not rounded.
    plain = feats[at:].replace("round(", "(").replace(", 6)", ")")
    s = FIXED_CLASSIFIER.sql([f"f.{c}" for c in FIXED_CLF_COLS])
    reg = FIXED_REGRESSOR.sql([f"CAST({c} AS DOUBLE)" for c in FIXED_REG_COLS])
    return feats[:at].rstrip() + f""",
_f AS ({plain}),
_m AS (SELECT f.*, {', '.join(f'{e} AS m{k}' for k, e in enumerate(s))} FROM _f f),
_c AS (SELECT *, CASE WHEN m0 >= m1 AND m0 >= m2 THEN 0 WHEN m1 >= m2 THEN 1 ELSE 2 END AS {TARGET_CLASS} FROM _m)
SELECT applicant_id, coalesce(k.v, CAST(_c.{TARGET_CLASS} AS VARCHAR)) AS eligibility,
  greatest(0.0, round_even(({reg.replace(f'CAST({TARGET_CLASS}', f'CAST(_c.{TARGET_CLASS}')}) * CASE WHEN sd_{TARGET_AMOUNT} = 0 THEN 1.0
    ELSE sd_{TARGET_AMOUNT} END + mu_{TARGET_AMOUNT}, 2)) AS max_monthly_emi
FROM _c CROSS JOIN _sc LEFT JOIN _k_{TARGET_CLASS} k ON k.code = _c.{TARGET_CLASS}"""


@register("score_fixed_model", _score_fixed_sql())
def score_fixed_model(spark, sf_dir):
    """The scoring chain with a fixed model: features, class, decoding, the class into the regressor,
    inverted scaling, floor and rounding."""
    from ..operators import encode as E
    from ..operators import features as FE
    fz = E.fit_featurizer(FE.derive(S.cleaned(spark, sf_dir)))
    model = SC.ScoringModel(fz, FIXED_CLF_COLS, FIXED_REG_COLS, FIXED_CLASSIFIER, FIXED_REGRESSOR)
    return rounded(model.transform(_score_input(spark, sf_dir)))


@register("pipeline_model_scores", _score_fixed_sql())
def pipeline_model_scores(spark, sf_dir):
    """The same chain from raw applicants, as one Spark ML ``PipelineModel``: built, saved, loaded, applied."""
    from pyspark.ml import PipelineModel

    from ..operators import clean as C
    from ..operators import encode as E
    from ..operators import features as FE
    from .ml_stages import to_pipeline
    fz = E.fit_featurizer(FE.derive(S.cleaned(spark, sf_dir)))
    model = SC.ScoringModel(fz, FIXED_CLF_COLS, FIXED_REG_COLS, FIXED_CLASSIFIER, FIXED_REGRESSOR)
    path = scratch_path(spark, "pipeline-model")
    to_pipeline(model, S.fill_stats(spark, sf_dir)).write().save(path)
    return rounded(PipelineModel.load(path).transform(C.dedupe(S.raw(spark, sf_dir))))


@register("score_eligibility")
def score_eligibility(spark, sf_dir):
    """Predicted class of every applicant (best classifier)."""
    fr = _fit(spark, sf_dir)
    return fr.model.transform(_score_input(spark, sf_dir)).select(ID, "eligibility")


@register("score_applicants")
def score_applicants(spark, sf_dir):
    """(applicant_id, eligibility, max_monthly_emi) for every applicant."""
    fr = _fit(spark, sf_dir)
    return rounded(fr.model.transform(_score_input(spark, sf_dir)))


@register("stream_score")
def stream_score(spark, sf_dir):
    """The scoring plan as a Structured Streaming job: score inputs written
    as files to a folder, scored with an available-now trigger, read back."""
    fr = _fit(spark, sf_dir)
    inp = _score_input(spark, sf_dir)
    src, out, ck = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-ck"))
    inp.write.mode("overwrite").parquet(src)
    q = start_scoring(spark, fr.model, src, out, ck, inp.schema)
    q.awaitTermination()
    return rounded(spark.read.parquet(out))


# ---------------------------------------------------------------------------
# The first boosting round and least squares, against SQL
# ---------------------------------------------------------------------------

BOOST_COLS = ("age", "family_size", "dependents", "requested_tenure", "credit_score")
_CLASSES = ("Eligible", "High_Risk", "Not_Eligible")
LSQ_COLS = ("monthly_salary", "credit_score", "requested_tenure")


def _boost_sql():
    """Two levels of the first round: every split of every node and class, by gain, then column, then value."""
    code = f"CASE {TARGET_CLASS} " + " ".join(f"WHEN '{c}' THEN {k}" for k, c in enumerate(_CLASSES)) + " END"
    long = " UNION ALL ".join(f"SELECT applicant_id, y, {k} AS f, {c} AS v FROM _rows" for k, c in enumerate(BOOST_COLS))

    def level(src, out):
        score = "pow({g}, 2) / ({h} + 1)"
        gain = " + ".join(score.format(g=g, h=h) for g, h in (("gl", "hl"), ("gt - gl", "ht - hl")))
        return f""",
_{out}a AS (SELECT cls, node, f, v, sum(g) AS g, sum(h) AS h FROM {src} JOIN _long USING (applicant_id) GROUP BY ALL),
_{out}b AS (SELECT cls, node, f, v, sum(g) OVER up AS gl, sum(h) OVER up AS hl, sum(g) OVER every AS gt, sum(h) OVER every AS ht
  FROM _{out}a WINDOW up AS (PARTITION BY cls, node, f ORDER BY v ROWS UNBOUNDED PRECEDING),
  every AS (PARTITION BY cls, node, f)),
_{out} AS (SELECT * FROM (
  SELECT *, {gain} - {score.format(g='gt', h='ht')} AS gain FROM _{out}b WHERE hl >= 1 - 1e-9 AND ht - hl >= 1 - 1e-9)
  WHERE gain > 1e-6 QUALIFY row_number() OVER (PARTITION BY cls, node ORDER BY round(gain, 7) DESC, f, v) = 1)"""

    return (FILLED.rstrip("\n") + f""",
_rows AS (SELECT applicant_id, {code} AS y, {', '.join(BOOST_COLS)} FROM _filled WHERE {TARGET_CLASS} IS NOT NULL),
_long AS ({long}),
_n0 AS (SELECT applicant_id, cls, 0 AS node, CASE WHEN y = cls THEN 1.0::DOUBLE ELSE 0.0 END - 1.0::DOUBLE / 3 AS g,
  CAST(4 AS DOUBLE) / 9 AS h FROM _rows, (SELECT unnest([0, 1, 2]) AS cls))""" + level("_n0", "s0") + f""",
_n1 AS (SELECT n.applicant_id, n.cls, CASE WHEN l.v <= s.v THEN 1 ELSE 2 END AS node, n.g, n.h
  FROM _n0 n JOIN _s0 s USING (cls) JOIN _long l ON l.applicant_id = n.applicant_id AND l.f = s.f)""" + level("_n1", "s1") + f"""
SELECT CAST(cls AS INTEGER) AS class, CAST(node AS INTEGER) AS node, [{', '.join(O.q(c) for c in BOOST_COLS)}][f + 1] AS feature,
  round(v, 6) AS cut, round(gain, 5) AS gain, round(0.3 * gl / (hl + 1), 6) AS weight_left,
  round(0.3 * (gt - gl) / (ht - hl + 1), 6) AS weight_right
FROM (SELECT * FROM _s0 UNION ALL SELECT * FROM _s1)""")


@register("boost_first_round", _boost_sql())
def boost_first_round(spark, sf_dir):
    """The splits of the first boosting round, two levels deep, with gains and the weights of both sides."""
    from ..operators.trees import BoostedTrees
    rows = S.filled(spark, sf_dir).where(F.col(TARGET_CLASS).isNotNull())
    code = F.array_position(F.array(*[F.lit(c) for c in _CLASSES]), F.col(TARGET_CLASS)) - 1
    rows = TR.assemble(rows.select(ID, *BOOST_COLS, code.cast("double").alias("label")), BOOST_COLS)
    # Every value is a bin: these columns have few, and the bound is checked.
    values = rows.agg(*[F.array_sort(F.collect_set(F.col(c).cast("double"))).alias(c) for c in BOOST_COLS]).first()
    import numpy as np
    cuts = [np.array(v) for v in values]
    model = BoostedTrees("class", rounds=1, depth=2, cuts=cuts, id_col=ID).fit(rows)
    out = [(k, n, BOOST_COLS[t.feature[n]], t.cut[n], t.gain[n], _side(t, t.left[n]), _side(t, t.right[n]))
           for k, t in enumerate(model.trees) for n in range(len(t.feature)) if t.feature[n] >= 0]
    df = spark.createDataFrame(out, "class int, node int, feature string, cut double, gain double, "
                                    "weight_left double, weight_right double")
    # Rounded once: to six places first, a gain near a half would go the other way.
    return rounded(df.withColumn("gain", F.round("gain", 5)))


def _side(tree, node):
    return float(tree.value[node][0])


def _lsq_sql():
    """Slopes by Cramer's rule on the covariances."""
    x = LSQ_COLS
    s = lambda i, j: f"s{min(i, j)}{max(i, j)}"
    cov = [f"covar_pop({x[i]}, {x[j]}) AS s{i}{j}" for i in range(3) for j in range(i, 3)]
    cov += [f"covar_pop({x[i]}, {TARGET_AMOUNT}) AS t{i}, avg({x[i]}) AS m{i}" for i in range(3)]

    def det(cols):
        m = [[cols[j](i) for j in range(3)] for i in range(3)]
        return (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - "
                f"{m[1][2]} * {m[2][0]}) + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")
    plain = [lambda i, j=j: s(i, j) for j in range(3)]
    slopes = [f"{det([(lambda i: f't{i}') if j == k else plain[j] for j in range(3)])} / {det(plain)} AS b{k}"
              for k in range(3)]
    rows = " UNION ALL ".join([f"SELECT '{x[k]}' AS term, round(b{k}, 6) AS coefficient FROM _slopes" for k in range(3)]
                              + ["SELECT 'intercept', round(my - b0 * m0 - b1 * m1 - b2 * m2, 6) FROM _slopes"])
    return (FILLED.rstrip("\n") + f""",
_covs AS (SELECT {', '.join(cov)}, avg({TARGET_AMOUNT}) AS my FROM _filled WHERE {TARGET_AMOUNT} IS NOT NULL),
_slopes AS (SELECT *, {', '.join(slopes)} FROM _covs)
{rows}""")


@register("least_squares", _lsq_sql())
def least_squares(spark, sf_dir):
    """The amount on three inputs by ordinary least squares."""
    from ..operators.least_squares import LeastSquares
    rows = S.filled(spark, sf_dir).select(ID, *LSQ_COLS, F.col(TARGET_AMOUNT).alias("label"))
    m = LeastSquares().fit(TR.assemble(rows, LSQ_COLS))
    return rounded(spark.createDataFrame([*zip(LSQ_COLS, m.coefficients), ("intercept", m.intercept)],
                                         "term string, coefficient double"))


# ---------------------------------------------------------------------------
# Recommendations and display, on rule-baseline predictions
# ---------------------------------------------------------------------------

_PRED_SQL = (FILLED.rstrip("\n") + O.features_cte("_filled") +
             f",\n_pred AS (SELECT applicant_id, {RULE_CLASS_SQL} AS eligibility, "
             f"round_even({RULE_AMOUNT_SQL}, 2) AS amount FROM feat)\n")


def _rule_pred(spark, sf_dir):
    from ..operators import features as FE
    p = rule_predictions(FE.derive(S.filled(spark, sf_dir)))
    return p.select(ID, F.col("yhat").alias("eligibility"),
                    M.clamp_amount("yhat_amount").alias("amount"))


def _advice_values():
    rows = [f"({O.q(k)}, {i + 1}, {O.q(t)})" for k, tips in ADVICE.items() for i, t in enumerate(tips)]
    return "(VALUES " + ", ".join(rows) + ") AS a(class, seq, tip)"


@register("recommendations", _PRED_SQL + f"""SELECT p.applicant_id, p.eligibility AS class,
  CAST(coalesce(a.seq, 1) AS INTEGER) AS seq, coalesce(a.tip, {O.q(NO_PREDICTION_NOTICE)}) AS tip
FROM _pred p LEFT JOIN {_advice_values()} ON p.eligibility = a.class""")
def recommendations(spark, sf_dir):
    """Advice lines for each applicant's predicted class (rule baseline)."""
    return R.recommendations(_rule_pred(spark, sf_dir), label="eligibility")


@register("score_advice")
def score_advice(spark, sf_dir):
    """Advice lines for the class that the best classifier predicts."""
    fr = _fit(spark, sf_dir)
    return R.recommendations(fr.model.transform(_score_input(spark, sf_dir)), label="eligibility")


def _badge_sql(e):
    whens = " ".join(f"WHEN {O.q(k)} THEN {O.q(v)}" for k, v in BADGES.items())
    return f"(CASE {e} {whens} ELSE {e} END)"


@register("format_predictions", _PRED_SQL + f"SELECT applicant_id, {_badge_sql('eligibility')} AS label, "
          "'₹ ' || format('{:,.2f}', greatest(amount, 0.0)) AS amount_text FROM _pred")
def format_predictions(spark, sf_dir):
    """Display texts: class badge and ``₹ 1,234.56``."""
    p = _rule_pred(spark, sf_dir)
    return p.select(ID, X.badge("eligibility").alias("label"), X.money("amount").alias("amount_text"))


@register("default_missing_features", FILLED + "SELECT applicant_id, " + ", ".join(
    f"{O.r6(c)} AS {c}" if c not in CATEGORICAL else c for c in FEATURES) + ", "
    + ", ".join(f"0.0 AS {c}" for c in DERIVED) + " FROM _filled")
def default_missing_features(spark, sf_dir):
    """Model inputs a request lacks are added as 0 (here: the derived
    features missing from a raw request)."""
    inp = _score_input(spark, sf_dir)
    need = list(FEATURES) + list(DERIVED)
    out = inp.withColumns({c: F.lit(0.0) for c in need if c not in inp.columns})
    return rounded(out.select(ID, *need))
