"""Registered queries: derived features, codes, scaling, correlation,
selection, EDA tables, splits and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import correlate as K
from ..operators import eda as D
from ..operators import encode as E
from ..operators import features as FE
from ..operators import metrics as MT
from ..operators import recommend as R
from ..operators import split as SP
from ..schema import (CATEGORICAL, DERIVED, FEATURES, ID, NUMERIC, PAIR_FEATURES, RATIO_FEATURES,
                      RAW_COLUMNS, SCALED, SCATTER_FEATURES, SKEWED, TARGET_AMOUNT, TARGET_CLASS)
from . import oracle as O
from . import stages as S
from .catalog import register, rounded

CLEANED = O.cleaned_prefix()
FEAT = CLEANED.rstrip("\n") + O.features_cte("cleaned", "feat")
FILLED = O.filled_prefix()
FEAT_COLS = [ID] + list(FEATURES) + list(DERIVED) + [TARGET_CLASS, TARGET_AMOUNT]
MODEL_COLS = [c for c in FEAT_COLS if c != ID]


# ---------------------------------------------------------------------------
# SQL: codes, scaler and model table
# ---------------------------------------------------------------------------

def _codes_ctes(src="feat"):
    parts = []
    for c in CATEGORICAL:
        parts.append(f"_k_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
                     f"FROM (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'nan') AS v FROM {src}))")
    parts.append(f"_k_{TARGET_CLASS} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) "
                 f"AS code FROM (SELECT DISTINCT {TARGET_CLASS} AS v FROM {src} "
                 f"WHERE {TARGET_CLASS} IS NOT NULL))")
    return ",\n" + ",\n".join(parts) + "\n"


def _scaler_cte(src="feat"):
    cols = list(SCALED) + [TARGET_AMOUNT]
    sel = ", ".join(f"avg({c}) AS mu_{c}, CASE WHEN min({c}) = max({c}) THEN 0.0 "
                    f"ELSE stddev_pop({c}) END AS sd_{c}" for c in cols)
    return f",\n_sc AS (SELECT {sel} FROM {src})\n"


def _model_cte(src="feat", name="model"):
    sel, joins = [], []
    for c in FEAT_COLS:
        if c in CATEGORICAL:
            sel.append(f"_k_{c}.code AS {c}")
            joins.append(f"LEFT JOIN _k_{c} ON coalesce(CAST({src}.{c} AS VARCHAR), 'nan') = _k_{c}.v")
        elif c == TARGET_CLASS:
            sel.append(f"_k_{c}.code AS {c}")
            joins.append(f"LEFT JOIN _k_{c} ON {src}.{c} = _k_{c}.v")
        elif c in SCALED or c == TARGET_AMOUNT:
            sel.append(f"({src}.{c} - mu_{c}) / (CASE WHEN sd_{c} = 0 OR sd_{c} IS NULL "
                       f"THEN 1.0 ELSE sd_{c} END) AS {c}")
        else:
            sel.append(f"{src}.{c} AS {c}")
    return (f",\n{name} AS (SELECT {', '.join(sel)} FROM {src} CROSS JOIN _sc "
            + " ".join(joins) + ")\n")


MODEL = FEAT.rstrip("\n") + _codes_ctes() + _scaler_cte() + _model_cte()


def _feat_df(spark, sf_dir):
    return S.features(spark, sf_dir)


def _written(m):
    """The model table for correlations. Moments and Gramian each read every column: it is filled, capped,
    derived and scaled once, not for each pass."""
    return C.materialize(m.select(*MODEL_COLS), "model-table")


def _model_df(spark, sf_dir):
    feats = _feat_df(spark, sf_dir)
    fz = E.fit_featurizer(feats)
    return E.model_table(feats, fz).select(*FEAT_COLS), fz


# ---------------------------------------------------------------------------
# Derived features
# ---------------------------------------------------------------------------

def _derive_query(name):
    def q(spark, sf_dir):
        return rounded(_feat_df(spark, sf_dir).select(ID, name))
    q.__name__ = f"derive_{name}"
    q.__doc__ = f"applicant_id and {name} (training form, on the cleaned table)"
    return q


_DERIVE_KEYS = {
    "derive_debt_to_income": "debt_to_income",
    "derive_expenses": "total_monthly_expenses",
    "derive_expense_to_income": "expense_to_income",
    "derive_disposable": "monthly_disposable",
    "derive_instalment": "instalment_if_approved",
    "derive_affordability": "affordability_ratio",
    "derive_stability": "employment_stability",
    "derive_loan_to_income": "loan_to_income_ratio",
    "derive_dependents_ratio": "dependents_ratio",
}
for _k, _c in _DERIVE_KEYS.items():
    register(_k, FEAT + f"SELECT applicant_id, round({_c}, 6) AS {_c} FROM feat")(_derive_query(_c))


@register("derive_features", FEAT + "SELECT applicant_id, "
          + ", ".join(f"round({c}, 6) AS {c}" for c in DERIVED) + " FROM feat")
def derive_features(spark, sf_dir):
    return rounded(_feat_df(spark, sf_dir).select(ID, *DERIVED))


def _scoring_input_sql():
    logged = O.log_cte("_filled", "_slog")
    return (FILLED.rstrip("\n") + logged.rstrip("\n")
            + O.features_cte("_slog", "sfeat", form="scoring"))


@register("derive_scoring_features", _scoring_input_sql() + "SELECT applicant_id, "
          + ", ".join(f"round({c}, 6) AS {c}" for c in DERIVED) + " FROM sfeat")
def derive_scoring_features(spark, sf_dir):
    """Scoring form (denominators floored at 1) on log-scaled inputs."""
    from ..operators.clean import log_scale
    s = FE.derive(log_scale(S.filled(spark, sf_dir)), form="scoring")
    return rounded(s.select(ID, *DERIVED))


@register("nullify_infinities", FEAT + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM feat"
    for c in DERIVED))
def nullify_infinities(spark, sf_dir):
    """Missing values per derived feature once NaN/±inf are NULL."""
    from ..operators.profile import null_counts
    f = FE.nullify_infinities(_feat_df(spark, sf_dir), list(DERIVED))
    return null_counts(f, list(DERIVED))


# ---------------------------------------------------------------------------
# Codes and scaling
# ---------------------------------------------------------------------------


@register("label_codes", FEAT.rstrip("\n") + _codes_ctes() + " UNION ALL ".join(
    f"SELECT '{c}' AS column, v AS value, code FROM _k_{c}" for c in CATEGORICAL))
def label_codes(spark, sf_dir):
    codes = E.fit_label_codes(_feat_df(spark, sf_dir), CATEGORICAL)
    return codes.table(spark)


@register("label_encode", MODEL + "SELECT applicant_id, " + ", ".join(CATEGORICAL) + " FROM model")
def label_encode(spark, sf_dir):
    feats = _feat_df(spark, sf_dir)
    codes = E.fit_label_codes(feats, CATEGORICAL)
    return E.encode(feats, codes).select(ID, *CATEGORICAL)


@register("encode_target", MODEL + f"SELECT applicant_id, {TARGET_CLASS} FROM model")
def encode_target(spark, sf_dir):
    feats = _feat_df(spark, sf_dir)
    codes = E.fit_label_codes(feats, [TARGET_CLASS], as_text=False)
    return E.encode(feats, codes, as_text=False).select(ID, TARGET_CLASS)


def _unseen_sql():
    raw = (",\n_rawd AS (SELECT DISTINCT * FROM applicants)\n")
    sel, joins = [], []
    for c in CATEGORICAL:
        sel.append(f"coalesce(_k_{c}.code, 0) AS {c}")
        joins.append(f"LEFT JOIN _k_{c} ON coalesce(CAST(_rawd.{c} AS VARCHAR), 'nan') = _k_{c}.v")
    return (FEAT.rstrip("\n") + _codes_ctes().rstrip("\n") + raw
            + f"SELECT _rawd.applicant_id, {', '.join(sel)} FROM _rawd " + " ".join(joins))


@register("encode_unseen", _unseen_sql())
def encode_unseen(spark, sf_dir):
    """Scoring-time codes of the raw, un-normalised categories: a value not
    seen in training (e.g. ``single`` vs trained ``Single``) gets code 0."""
    feats = _feat_df(spark, sf_dir)
    codes = E.fit_label_codes(feats, CATEGORICAL)
    raw = S.raw(spark, sf_dir).dropDuplicates()
    return E.encode(raw, codes, unseen=0).select(ID, *CATEGORICAL)


@register("scaler_stats", FEAT + " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(avg({c}), 6) AS mean, round(CASE WHEN min({c}) = max({c}) "
    f"THEN 0.0 ELSE stddev_pop({c}) END, 6) AS std_pop FROM feat"
    for c in list(SCALED) + [TARGET_AMOUNT]))
def scaler_stats(spark, sf_dir):
    st = E.fit_scaler(_feat_df(spark, sf_dir), list(SCALED) + [TARGET_AMOUNT])
    return rounded(st.table(spark).select("column", "mean", "std_pop"))


@register("standardize_features", MODEL + "SELECT applicant_id, "
          + ", ".join(f"round({c}, 6) AS {c}" for c in SCALED) + " FROM model")
def standardize_features(spark, sf_dir):
    m, _ = _model_df(spark, sf_dir)
    return rounded(m.select(ID, *SCALED))


@register("standardize_target", MODEL + f"SELECT applicant_id, round({TARGET_AMOUNT}, 6) AS "
          f"{TARGET_AMOUNT} FROM model")
def standardize_target(spark, sf_dir):
    m, _ = _model_df(spark, sf_dir)
    return rounded(m.select(ID, TARGET_AMOUNT))


@register("inverse_target", MODEL + f"SELECT model.applicant_id, round({TARGET_AMOUNT} * (CASE WHEN "
          f"sd_{TARGET_AMOUNT} = 0 THEN 1.0 ELSE sd_{TARGET_AMOUNT} END) + mu_{TARGET_AMOUNT}, 6) "
          f"AS {TARGET_AMOUNT} FROM model CROSS JOIN _sc")
def inverse_target(spark, sf_dir):
    m, fz = _model_df(spark, sf_dir)
    back = E.unstandardize(m.select(ID, TARGET_AMOUNT), fz.target_scaler, [TARGET_AMOUNT])
    return rounded(back)


@register("featurize", MODEL + "SELECT " + ", ".join(
    f"round({c}, 6) AS {c}" if (c in SCALED or c in (TARGET_AMOUNT, "total_monthly_expenses")) else c
    for c in FEAT_COLS) + " FROM model")
def featurize(spark, sf_dir):
    """The model table: codes, derived features, scaled columns, encoded
    and scaled targets (applicant_id first, targets last)."""
    m, _ = _model_df(spark, sf_dir)
    return rounded(m)


# ---------------------------------------------------------------------------
# Correlation and selection
# ---------------------------------------------------------------------------

def _pairs_inner(src, pairs):
    """SELECT a, b, r (unrounded; NULL for a constant column) for the pairs:
    one row of ``corr`` aggregates over src, unpivoted."""
    items = ", ".join(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS "{a}|{b}"' for a, b in pairs)
    return (f"SELECT split_part(k, '|', 1) AS a, split_part(k, '|', 2) AS b, "
            f"CASE WHEN isnan(v) THEN NULL ELSE v END AS r FROM "
            f"(UNPIVOT (SELECT {items} FROM {src}) ON COLUMNS(*) INTO NAME k VALUE v)")


def _pairs_sql(prefix, src, pairs):
    return prefix + f"SELECT a, b, round(r, 6) AS r FROM ({_pairs_inner(src, pairs)})"


@register("correlation_matrix", _pairs_sql(MODEL, "model", K.upper_pairs(MODEL_COLS)))
def correlation_matrix(spark, sf_dir):
    """Pearson r for every pair a < b of the model table's 36 columns."""
    m, _ = _model_df(spark, sf_dir)
    return rounded(K.correlation_matrix(_written(m), MODEL_COLS))


_EDA_NUM = [c for c in RAW_COLUMNS if c in NUMERIC] + [TARGET_AMOUNT]
_CLS_NUM = "emi_eligibility_num"


@register("cleaned_correlation", _pairs_sql(CLEANED, "cleaned", K.upper_pairs(_EDA_NUM)))
def cleaned_correlation(spark, sf_dir):
    """Pearson r of every pair of numeric columns of the cleaned table."""
    return rounded(K.correlation_matrix(S.cleaned(spark, sf_dir), _EDA_NUM))


def _target_corr_sql():
    pre = (CLEANED.rstrip("\n") + ",\n_kc AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS "
           f"INTEGER) AS code FROM (SELECT DISTINCT {TARGET_CLASS} AS v FROM cleaned)),\n"
           f"_ce AS (SELECT cleaned.*, _kc.code AS {_CLS_NUM} FROM cleaned LEFT JOIN _kc "
           f"ON cleaned.{TARGET_CLASS} = _kc.v)\n")
    inner = _pairs_inner("_ce", [(c, _CLS_NUM) for c in _EDA_NUM])
    return (pre + f"SELECT a AS feature, round(r, 6) AS r FROM ({inner}) "
            f"UNION ALL SELECT '{_CLS_NUM}', 1.0")


@register("target_correlation", _target_corr_sql())
def target_correlation(spark, sf_dir):
    """r of each numeric column of the cleaned table with the class code,
    descending."""
    c = S.cleaned(spark, sf_dir)
    codes = E.fit_label_codes(c, [TARGET_CLASS], as_text=False)
    num = codes.renamed(TARGET_CLASS, _CLS_NUM)
    ce = E.encode(c.withColumn(_CLS_NUM, F.col(TARGET_CLASS)), num, as_text=False)
    return rounded(K.target_correlation(ce, _EDA_NUM, _CLS_NUM))


def _selection_sql():
    cls_pairs = [(c, TARGET_CLASS) for c in MODEL_COLS if c != TARGET_CLASS]
    amt_pairs = [(c, TARGET_AMOUNT) for c in MODEL_COLS if c != TARGET_AMOUNT]
    pos = "CASE a " + " ".join(f"WHEN '{c}' THEN {i + 1}" for i, c in enumerate(MODEL_COLS)) + " END"
    return (MODEL.rstrip("\n") + f",\n_r AS ({_pairs_inner('model', cls_pairs + amt_pairs)})\n"
            f"SELECT CASE WHEN b = '{TARGET_CLASS}' THEN 'classification' ELSE 'regression' END AS task, "
            f"CAST({pos} AS INTEGER) AS position, a AS feature, round(r, 6) AS r FROM _r WHERE abs(r) > 0.05")


@register("select_by_correlation", _selection_sql())
def select_by_correlation(spark, sf_dir):
    """Candidates per task: |r| with the task's target > 0.05, table order."""
    m, _ = _model_df(spark, sf_dir)
    sel = K.select_features(_written(m), MODEL_COLS)
    rows = [("classification", MODEL_COLS.index(f) + 1, f, sel["r_class"][f])
            for f in sel["classification_candidates"]]
    rows += [("regression", MODEL_COLS.index(f) + 1, f, sel["r_amount"][f])
             for f in sel["regression_candidates"]
             if sel["r_amount"].get(f) is not None and abs(sel["r_amount"][f]) > 0.05]
    out = spark.createDataFrame(rows, "task string, position int, feature string, r double")
    return rounded(out)


def _prune_sql():
    """The greedy prune as a recursive query: one step per candidate, with the list kept so far."""
    pos = "CASE a " + " ".join(f"WHEN '{c}' THEN {i + 1}" for i, c in enumerate(MODEL_COLS)) + " END"
    pairs = K.upper_pairs(MODEL_COLS)
    return (MODEL.rstrip("\n").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
_r AS ({_pairs_inner('model', pairs)}),
_rr AS (SELECT a, b, r FROM _r UNION ALL SELECT b, a, r FROM _r),
_cand AS (SELECT 'classification' AS task, a AS feature, {pos} AS seat FROM _rr
    WHERE b = '{TARGET_CLASS}' AND abs(r) > 0.05
  UNION ALL SELECT 'regression', a, {pos} FROM _rr
    WHERE b = '{TARGET_AMOUNT}' AND a <> '{TARGET_CLASS}' AND abs(r) > 0.05
  UNION ALL SELECT 'regression', '{TARGET_CLASS}', coalesce((SELECT {pos} FROM _rr
    WHERE b = '{TARGET_AMOUNT}' AND a = '{TARGET_CLASS}' AND abs(r) > 0.05), 1000)),
_step AS (SELECT task, feature, row_number() OVER (PARTITION BY task ORDER BY seat) AS k FROM _cand),
_bad AS (SELECT a, list(b) AS bad FROM _rr WHERE r IS NULL OR abs(r) >= 0.85 GROUP BY a),
_todo AS (SELECT task, feature, k, coalesce(bad, CAST([] AS VARCHAR[])) AS bad FROM _step LEFT JOIN _bad ON feature = a),
_walk AS (SELECT task, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS kept FROM (SELECT DISTINCT task FROM _todo)
  UNION ALL SELECT w.task, t.k, CASE WHEN list_has_any(w.kept, t.bad) THEN w.kept ELSE list_append(w.kept, t.feature) END
  FROM _walk w JOIN _todo t ON t.task = w.task AND t.k = w.k + 1),
_end AS (SELECT task, kept FROM _walk w WHERE k = (SELECT max(k) FROM _todo t WHERE t.task = w.task))
SELECT task, CAST(i AS INTEGER) AS position, kept[i] AS feature
FROM (SELECT task, kept, unnest(range(1, len(kept) + 1)) AS i FROM _end)""")


@register("prune_correlated", _prune_sql())
def prune_correlated(spark, sf_dir):
    """Selected features per task after the greedy 0.85 prune (the class
    code is appended to the regression list before pruning)."""
    m, _ = _model_df(spark, sf_dir)
    sel = K.select_features(_written(m), MODEL_COLS)
    rows = [(task, i + 1, f) for task in ("classification", "regression")
            for i, f in enumerate(sel[task])]
    return spark.createDataFrame(rows, "task string, position int, feature string")


# ---------------------------------------------------------------------------
# EDA tables
# ---------------------------------------------------------------------------

def _hist_sql(prefix, src, cols, bins_expr):
    """bins_expr(c) → SQL for the bin count of column c given _rng."""
    rng = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}, count({c}) AS n_{c}, "
                    f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
                    for c in cols)
    lv = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value, "
        f"CASE WHEN lo_{c} = hi_{c} THEN lo_{c} - 0.5 ELSE lo_{c} END AS lo, "
        f"CASE WHEN lo_{c} = hi_{c} THEN hi_{c} + 0.5 ELSE hi_{c} END AS hi, "
        f"{bins_expr(c)} AS k FROM {src}, _rng WHERE {c} IS NOT NULL" for c in cols)
    return (prefix.rstrip("\n") + f",\n_rng AS (SELECT {rng} FROM {src}),\n_lv AS ({lv}),\n"
            "_hb AS (SELECT \"column\", lo, hi, k, CAST(least(k - 1, floor((value - lo) / (hi - lo) * k)) "
            "AS INTEGER) AS bin FROM _lv)\n"
            "SELECT \"column\", k AS bins, bin, round(lo + bin * ((hi - lo) / k), 6) AS bin_lo, "
            "round(lo + (bin + 1) * ((hi - lo) / k), 6) AS bin_hi, CAST(count(*) AS BIGINT) AS count "
            "FROM _hb GROUP BY \"column\", lo, hi, k, bin")


def _auto_bins_sql(c):
    sturges = f"((hi_{c} - lo_{c}) / (log2(n_{c}) + 1.0))"
    fd = f"(2.0 * (q3_{c} - q1_{c}) * pow(n_{c}, -1.0 / 3.0))"
    sqrt_half = f"((hi_{c} - lo_{c}) / sqrt(n_{c}) / 2)"
    width = f"least(greatest({fd}, {sqrt_half}), {sturges})"
    span = f"(CASE WHEN lo_{c} = hi_{c} THEN 1.0 ELSE hi_{c} - lo_{c} END)"
    return (f"(CASE WHEN {width} > 0 THEN greatest(1, CAST(ceil({span} / {width}) AS INTEGER)) "
            f"ELSE 1 END)")


@register("histograms", _hist_sql(CLEANED, "cleaned", _EDA_NUM, lambda c: "30"))
def histograms(spark, sf_dir):
    """30 equal-width bins per numeric column of the cleaned table."""
    return rounded(D.histograms(S.cleaned(spark, sf_dir), _EDA_NUM).withColumn("bins", F.col("bins").cast("int")))


@register("ratio_histograms", _hist_sql(FEAT, "feat", RATIO_FEATURES, _auto_bins_sql))
def ratio_histograms(spark, sf_dir):
    """Debt-, expense-to-income and affordability histograms, automatic
    bin count, missing values dropped."""
    return rounded(D.auto_histograms(_feat_df(spark, sf_dir), RATIO_FEATURES)
                   .withColumn("bins", F.col("bins").cast("int")))


def _density_sql(prefix=FEAT, src="feat", cols=tuple(RATIO_FEATURES), by=None):
    """Binned Gaussian densities; ``by``: one curve per label on the column's grid."""
    nb, grid = D.DENSITY_BINS, D.DENSITY_GRID
    lab = "label" if by else "'' AS label"
    lv0 = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value, "
                             f"{by or chr(39) * 2} AS label FROM {src} WHERE {c} IS NOT NULL" for c in cols)
    out = f"label AS {by}, " if by else ""
    return (prefix.rstrip("\n") + f""",
_v AS ({lv0}),
_rg AS (SELECT "column", min(value) AS lo0, max(value) AS hi0, count(*) AS n, stddev_samp(value) AS sd FROM _v GROUP BY "column"),
_rs AS (SELECT *, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi,
  greatest({nb}, CAST(ceil(8 * (hi0 - lo0) / (sd * pow(n, -0.2))) AS BIGINT)) AS nb FROM _rg WHERE n > 1 AND sd > 0),
_pl AS (SELECT "column", label, stddev_samp(value) * pow(count(*), -0.2) AS h FROM _v WHERE label IS NOT NULL
  GROUP BY "column", label HAVING count(*) > 1),
_hb AS (SELECT "column", label, lo, hi, nb, lo0, hi0, n, CAST(least(nb - 1, floor((value - lo) / (hi - lo) * nb)) AS BIGINT) AS bin
  FROM _v JOIN _rs USING ("column") WHERE label IS NOT NULL),
_hc AS (SELECT "column", label, lo0, hi0, n, (lo + bin * ((hi - lo) / nb) + lo + (bin + 1) * ((hi - lo) / nb)) / 2 AS c,
  count(*) AS cnt FROM _hb GROUP BY "column", label, lo, hi, nb, lo0, hi0, n, bin),
_hg AS (SELECT range AS point FROM range({grid}))
SELECT {out}"column", CAST(point AS INTEGER) AS point, round(lo0 + point * (hi0 - lo0) / {grid - 1}, 6) AS x,
  round(sum(cnt * exp(-0.5 * pow((lo0 + point * (hi0 - lo0) / {grid - 1} - c) / h, 2)) / (n * h * sqrt(2 * pi()))), 6) AS density
FROM _hc JOIN _pl USING ("column", label), _hg WHERE h > 0 GROUP BY "column", label, point, lo0, hi0""")


@register("density_curve", _density_sql())
def density_curve(spark, sf_dir):
    """Gaussian KDE (Scott bandwidth, binned) of the three ratios."""
    return rounded(D.density_curve(_feat_df(spark, sf_dir), RATIO_FEATURES))


@register("density_numeric", _density_sql(CLEANED, "cleaned", tuple(_EDA_NUM)))
def density_numeric(spark, sf_dir):
    """The densities of all numeric columns of the cleaned table."""
    return rounded(D.density_curve(S.cleaned(spark, sf_dir), _EDA_NUM))


@register("density_by_class", _density_sql(by=TARGET_CLASS, cols=tuple(PAIR_FEATURES)))
def density_by_class(spark, sf_dir):
    """Densities of the pair-plot features for each eligibility class, over all rows."""
    return rounded(D.density_curve(_feat_df(spark, sf_dir), PAIR_FEATURES, by=TARGET_CLASS))


_H = D.hash_key_sql("applicant_id")
_FEAT_OUT = list(RAW_COLUMNS) + list(DERIVED)
_FEAT_DOUBLES = set(NUMERIC) | {TARGET_AMOUNT} | set(DERIVED)


def _sel(cols, doubles):
    return ", ".join(f"round({c}, 6) AS {c}" if c in doubles else c for c in cols)


_SAMPLE = (FEAT.rstrip("\n") + f",\n_sample AS (SELECT * FROM feat ORDER BY {_H}, applicant_id "
           f"LIMIT {D.SAMPLE_SIZE})\n")


@register("sample_rows", _SAMPLE + f"SELECT {_sel(_FEAT_OUT, _FEAT_DOUBLES)} FROM _sample")
def sample_rows(spark, sf_dir):
    """min(10000, n) applicants, seeded, without replacement."""
    return rounded(D.sample_rows(_feat_df(spark, sf_dir)))


@register("pair_data", _SAMPLE + f"SELECT {_sel([ID, *PAIR_FEATURES, TARGET_CLASS], _FEAT_DOUBLES)} "
          "FROM _sample")
def pair_data(spark, sf_dir):
    return rounded(D.pair_data(_feat_df(spark, sf_dir), PAIR_FEATURES, TARGET_CLASS))


@register("scatter_data", _SAMPLE + " UNION ALL ".join(
    f"SELECT applicant_id, '{a}' AS feature, '{b}' AS ratio, round(CAST({a} AS DOUBLE), 6) AS x, "
    f"round(CAST({b} AS DOUBLE), 6) AS y, {TARGET_CLASS} AS class FROM _sample"
    for a in SCATTER_FEATURES for b in RATIO_FEATURES))
def scatter_data(spark, sf_dir):
    return rounded(D.scatter_data(_feat_df(spark, sf_dir), SCATTER_FEATURES, RATIO_FEATURES,
                                  TARGET_CLASS))


# The test rows of each class are those of least (hash, id); sizes by largest remainder.
_H62 = D.long_hash_key_sql("h1", "applicant_id")
_SPLIT_CTES = f"""_h AS (SELECT applicant_id, class, {_H62} AS h
  FROM (SELECT applicant_id, {TARGET_CLASS} AS class, {_H} AS h1 FROM model)),
_all AS (SELECT (count(*) + 4) // 5 AS want, count(*) AS n FROM _h),
_want AS (SELECT class, want * c // n + CASE WHEN row_number() OVER (ORDER BY want * c % n DESC, class NULLS FIRST)
    <= want - sum(want * c // n) OVER () THEN 1 ELSE 0 END AS want
  FROM (SELECT class, count(*) AS c FROM _h GROUP BY class), _all),
_sides AS (SELECT applicant_id, _h.class AS class,
  CASE WHEN row_number() OVER (PARTITION BY _h.class ORDER BY h, applicant_id) <= _want.want THEN 'test' ELSE 'train' END AS strata,
  CASE WHEN row_number() OVER (ORDER BY h, applicant_id) <= (SELECT want FROM _all) THEN 'test' ELSE 'train' END AS side
  FROM _h JOIN _want ON _h.class IS NOT DISTINCT FROM _want.class)"""
SIDES = MODEL.rstrip("\n") + ",\n" + _SPLIT_CTES


@register("stratified_split", SIDES + " SELECT applicant_id, class, strata AS split FROM _sides")
def stratified_split(spark, sf_dir):
    """ceil(n / 5) test rows, dealt to the classes by largest remainder."""
    m, _ = _model_df(spark, sf_dir)
    return SP.stratified_split(m.select(ID, TARGET_CLASS), TARGET_CLASS).select(
        ID, F.col(TARGET_CLASS).alias("class"), "split")


@register("random_split", SIDES + " SELECT applicant_id, side AS split FROM _sides")
def random_split(spark, sf_dir):
    """Exactly ceil(n / 5) test rows."""
    return SP.random_split(S.text(spark, sf_dir).select(ID)).select(ID, "split")


# ---------------------------------------------------------------------------
# Metrics on rule-based predictions (no model needed)
# ---------------------------------------------------------------------------

RULE_CLASS_SQL = ("CASE WHEN coalesce(affordability_ratio > 1.0, false) AND coalesce(debt_to_income < 0.4, false) "
                  "AND coalesce(expense_to_income < 0.5, false) THEN 'Eligible' "
                  "WHEN coalesce(affordability_ratio > 1.0, false) THEN 'High_Risk' ELSE 'Not_Eligible' END")
RULE_AMOUNT_SQL = "greatest(0.0, 0.5 * monthly_disposable)"


def rule_predictions(df):
    """A rule baseline: y = true class / amount, yhat from the health flags
    and half of the disposable income."""
    f = R.health_flags(df)
    ok = lambda c: F.coalesce(F.col(c), F.lit(False))
    cls = (F.when(ok("affordable") & ok("debt_ok") & ok("expense_ok"), "Eligible")
            .when(ok("affordable"), "High_Risk").otherwise("Not_Eligible"))
    amt = F.greatest(F.lit(0.0), 0.5 * F.col("monthly_disposable"))
    return f.select(ID, F.col(TARGET_CLASS).alias("y"), cls.alias("yhat"),
                    F.col(TARGET_AMOUNT).alias("y_amount"), amt.alias("yhat_amount"))


_RULE_PRED = (FILLED.rstrip("\n") + O.features_cte("_filled") +
              f",\n_pred AS (SELECT applicant_id, {TARGET_CLASS} AS y, {RULE_CLASS_SQL} AS yhat, "
              f"{TARGET_AMOUNT} AS y_amount, {RULE_AMOUNT_SQL} AS yhat_amount FROM feat)\n")

CLS_METRICS_SQL = _RULE_PRED.rstrip("\n") + """,
_cm AS (SELECT y, yhat, count(*) AS n FROM _pred GROUP BY y, yhat),
_cls AS (SELECT y AS c FROM _cm UNION SELECT yhat FROM _cm),
_per AS (SELECT _cls.c,
   coalesce((SELECT sum(n) FROM _cm WHERE _cm.y = _cls.c), 0) AS support,
   coalesce((SELECT sum(n) FROM _cm WHERE _cm.yhat = _cls.c), 0) AS predicted,
   coalesce((SELECT sum(n) FROM _cm WHERE _cm.y = _cls.c AND _cm.yhat = _cls.c), 0) AS tp FROM _cls),
_prf AS (SELECT support, tp,
   CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
   CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM _per)
SELECT round(sum(tp) / sum(support), 6) AS accuracy,
  round(sum(p * support) / sum(support), 6) AS precision,
  round(sum(r * support) / sum(support), 6) AS recall,
  round(sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END * support) / sum(support), 6) AS f1
FROM _prf"""


@register("classification_metrics", CLS_METRICS_SQL)
def classification_metrics(spark, sf_dir):
    """Accuracy and weighted precision/recall/F1 of the rule baseline."""
    p = rule_predictions(FE.derive(S.filled(spark, sf_dir)))
    return rounded(MT.classification_metrics(p))


REG_METRICS_SQL = _RULE_PRED + """SELECT round(sqrt(avg((y_amount - yhat_amount) * (y_amount - yhat_amount))), 6) AS rmse,
  round(avg(abs(y_amount - yhat_amount)), 6) AS mae,
  round(CASE WHEN var_pop(y_amount) * count(y_amount) > 0 THEN 1 - sum((y_amount - yhat_amount) * (y_amount - yhat_amount))
        / (var_pop(y_amount) * count(y_amount)) ELSE 0.0 END, 6) AS r2,
  round(avg(abs((y_amount - yhat_amount) / CASE WHEN y_amount = 0 THEN 1.0 ELSE y_amount END)) * 100, 6) AS mape
FROM _pred"""


@register("regression_metrics", REG_METRICS_SQL)
def regression_metrics(spark, sf_dir):
    """RMSE, MAE, R², MAPE of the rule baseline amount."""
    p = rule_predictions(FE.derive(S.filled(spark, sf_dir)))
    return rounded(MT.regression_metrics(p, "y_amount", "yhat_amount"))


# One-vs-rest: every health ratio as a score for every class.
_AUC_CLASSES = ("Eligible", "High_Risk", "Not_Eligible")
_AUC_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS class, '{k}' AS score, {k} AS s, {TARGET_CLASS} = '{c}' AS p FROM feat WHERE {k} IS NOT NULL "
    f"AND {TARGET_CLASS} IS NOT NULL" for c in _AUC_CLASSES for k in RATIO_FEATURES)


@register("rank_sum_auc", FILLED.rstrip("\n") + O.features_cte("_filled") + f""",
_r AS ({_AUC_ROWS}),
_c AS (SELECT class, score, s, count(*) FILTER (WHERE p) AS pos, count(*) FILTER (WHERE NOT p) AS neg FROM _r GROUP BY ALL),
_w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY class, score ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS below FROM _c)
SELECT class, score, round(sum(pos * (below + neg / 2)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0), 6) AS auc
FROM _w GROUP BY class, score""")
def rank_sum_auc(spark, sf_dir):
    """ROC-AUC of each health ratio for each class against the rest, all in one pass."""
    f = FE.derive(S.filled(spark, sf_dir)).where(F.col(TARGET_CLASS).isNotNull())
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.lit(k).alias("score"), F.col(k).alias("s"),
                                        (F.col(TARGET_CLASS) == c).alias("p"))
                               for c in _AUC_CLASSES for k in RATIO_FEATURES])).alias("e")
    return rounded(MT.rank_sum_auc(f.select(each).select("e.*"), ["class", "score"], "s", "p"))
