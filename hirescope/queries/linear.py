"""Queries for one-hot, Gram matrix, least squares, K-fold CV, what-if.

The oracle uses the closed form of the one-category case: predictions are the
level means m_g; the minimum-norm coefficients are b0 = sum(m_g) / (G + 1),
b_g = m_g - b0. Money columns are rounded to 2 places, ratios to 6, in both.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.operators import linear as LN
from hirescope.operators.sampling import seeded_sample
from hirescope.plans import regression as RG
from hirescope.sources import fixtures as fx

CAT = ["company_name"]
K = 3
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _train(spark, sf):
    return RG.training_set(fx.postings(spark, sf))


def _model(spark, sf, k=K):
    return RG.train_regression(fx.postings(spark, sf), None, CAT, [], k_folds=k)


def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    df = LN.one_hot(fx.postings(spark, sf).select("posting_id", "company_name"), "company_name", SEGMENTS)
    return df.drop("company_name")


def q_gram_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return LN.gram_table(_train(spark, sf), None, CAT, [])


def q_ols_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    m = _model(spark, sf, 0)
    return m.coefs.select(F.ltrim("key", F.lit(LN.SKILL_KEY)).alias("feature"), F.bround("beta", 2).alias("coefficient"))


def q_ols_predictions(spark: SparkSession, sf: str) -> DataFrame:
    m = _model(spark, sf, 0)
    p = RG.parity_table(m, _train(spark, sf), None)
    return p.select("posting_id", "actual", F.bround("predicted", 2).alias("predicted"))


def q_regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    m = _model(spark, sf, 0)
    met = LN.regression_metrics(RG.parity_table(m, _train(spark, sf), None))
    return met.select("n", F.bround("r2", 6).alias("r2"), F.bround(F.sqrt("mse"), 2).alias("rmse"),
                      F.bround("explained_variance", 6).alias("explained_variance"),
                      F.bround("max_error", 2).alias("max_error"))


def q_kfold_cv(spark: SparkSession, sf: str) -> DataFrame:
    m = _model(spark, sf)
    rows = [(f["fold"], f["n_train"], f["n_test"], round(f["r2"], 6), round(float(np.sqrt(f["mse"])), 2))
            for f in m.folds]
    return spark.createDataFrame(rows, "fold int, n_train bigint, n_test bigint, r2 double, rmse double")


def q_kfold_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and population std of the fold scores (MSE to the nearest hundred)."""
    c = _model(spark, sf).cv_summary()
    return spark.createDataFrame(
        [(round(c["r2"], 6), round(c["r2_std"], 6), float(np.round(c["mse"], -2)), float(np.round(c["mse_std"], -2)))],
        "r2 double, r2_std double, mse double, mse_std double")


def q_kfold_assign(spark: SparkSession, sf: str) -> DataFrame:
    from hirescope.operators.sampling import kfold_assign
    return kfold_assign(_train(spark, sf).select("posting_id"), K)


def q_scenario_predict(spark: SparkSession, sf: str) -> DataFrame:
    m = _model(spark, sf, 0)
    p = fx.postings(spark, sf)
    scen = (p.select("company_name").union(p.select(F.col("work_type").alias("company_name"))).distinct())
    out = LN.predict(m, LN.scenario_vectors(scen))
    return out.select("company_name", F.bround("predicted", 2).alias("predicted"))


def q_top_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    m = _model(spark, sf, 0)
    t = LN.top_coefficients(m.coefficients(), 3)
    return t.select("feature", F.bround("coefficient", 2).alias("coefficient"))


def q_parity_range(spark: SparkSession, sf: str) -> DataFrame:
    m = _model(spark, sf, 0)
    r = LN.parity_range(RG.parity_table(m, _train(spark, sf), None))
    return r.select(F.bround("min_val", 2).alias("min_val"), F.bround("max_val", 2).alias("max_val"))


def q_ols_wide_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Company + location + title one-hot (wide: one level per customer). Titles
    refine the other two categories here, so the fit equals the title means; past
    2,000 features the titles are eliminated before the solve."""
    p = fx.postings(spark, sf)
    m = RG.train_regression(p, None, ["company_name", "location", "title"], [], k_folds=0)
    met = LN.regression_metrics(RG.parity_table(m, _train(spark, sf), None))
    return met.select("n", F.bround("r2", 6).alias("r2"), F.bround(F.sqrt("mse"), 2).alias("rmse"))


def q_seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return seeded_sample(fx.postings(spark, sf).select("posting_id", "company_name"), 500)


def q_scenario_skills(spark: SparkSession, sf: str) -> DataFrame:
    """What-if with a skill only: the model is intercept + one flag, so the prediction
    is the mean salary with or without the skill."""
    p = fx.postings(spark, sf)
    m = RG.train_regression(p, fx.posting_skills(spark, sf), [], ["SMALL"], k_folds=0)
    scen = spark.createDataFrame([("with", ["SMALL", "OTHER"]), ("without", [])], "scenario string, skills array<string>")
    return LN.predict(m, LN.scenario_vectors(scen)).select("scenario", F.bround("predicted", 2).alias("predicted"))


def q_regression_from_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """A user sets a title only; the model has that category, the prediction is the title's mean."""
    p = fx.postings(spark, sf)
    title = p.agg(F.min("title")).first()[0]
    _, out = RG.regression_from_inputs(p, None, {"company_name": None, "title": title}, k_folds=0)
    return out.select("title", F.bround("predicted", 2).alias("predicted"))


def q_ols_multi_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Company + location + two skills, 3-fold CV: fold scores."""
    m = RG.train_regression(fx.postings(spark, sf), fx.posting_skills(spark, sf),
                            ["company_name", "location"], ["SMALL", "PROMO"], k_folds=K)
    return _fold_rows(spark, m)


def q_kfold_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Company + location + title (one level per customer), 3-fold CV."""
    return _fold_rows(spark, RG.train_regression(fx.postings(spark, sf), None, ["company_name", "location", "title"], [], k_folds=K))


def q_kfold_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Title one-hot, 3-fold CV, by conjugate gradients at every size."""
    return _fold_rows(spark, RG.train_regression(fx.postings(spark, sf), None, ["title"], [], k_folds=K, dense_max=0))


def _fold_rows(spark: SparkSession, m: LN.LinearModel) -> DataFrame:
    rows = [(f["fold"], f["n_test"], round(f["r2"], 6), round(float(np.sqrt(f["mse"])), 2)) for f in m.folds]
    return spark.createDataFrame(rows, "fold int, n_test bigint, r2 double, rmse double")


# --------------------------------------------------------------------------- oracle SQL

TRAIN = """tr AS (SELECT posting_id, company_name, normalized_salary AS y FROM P
        WHERE company_name IS NOT NULL AND location IS NOT NULL AND title IS NOT NULL AND normalized_salary IS NOT NULL),
m AS (SELECT company_name, avg(y) AS m FROM tr GROUP BY company_name),
b0 AS (SELECT sum(m) / (count(*) + 1) AS b0 FROM m),
pred AS (SELECT tr.posting_id, tr.y AS actual, m.m AS predicted FROM tr JOIN m USING (company_name))"""

FOLDS = f"""ft AS (SELECT *, ('0x' || substr(md5('42:' || posting_id), 1, 8))::BIGINT % {K} AS fold FROM tr),
fm AS (SELECT f.fold, t.company_name, avg(t.y) AS m FROM (SELECT DISTINCT fold FROM ft) f
       JOIN ft t ON t.fold <> f.fold GROUP BY f.fold, t.company_name),
fb AS (SELECT fold, sum(m) / (count(*) + 1) AS b0 FROM fm GROUP BY fold),
fp AS (SELECT t.fold, t.y, coalesce(fm.m, fb.b0) AS p FROM ft t JOIN fb ON fb.fold = t.fold
       LEFT JOIN fm ON fm.fold = t.fold AND fm.company_name = t.company_name),
fs AS (SELECT fold, count(*) AS n_test, sum((y - p) * (y - p)) AS sse, var_pop(y) * count(*) AS sst FROM fp GROUP BY fold)"""

# Solves each fold's normal equations ``eqs`` (fold, m: rows of the augmented matrix, of
# ``size`` unknowns) by elimination; ``sol`` (fold, i, b).
def _solve_sql(size: int) -> str:
    return f"""el AS (
  SELECT fold, 0 AS k, m FROM eqs
  UNION ALL SELECT fold, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda v: v / r[k + 1])
    ELSE list_transform(r, lambda v, j: v - r[k + 1] / m[k + 1][k + 1] * m[k + 1][j]) END)
  FROM el WHERE k < {size}),
sol AS (SELECT fold, i, m[i][{size} + 1] AS b FROM el, (SELECT unnest(range(1, {size} + 1)) AS i) WHERE k = {size})"""


# ``zs`` (fold, id, i, y): the features of each training row of each fold's fit.
_EQS = """gr AS (SELECT a.fold, a.i, b.i AS j, count(*)::DOUBLE AS g FROM zs a JOIN zs b USING (fold, id) GROUP BY ALL),
rhs AS (SELECT fold, i, sum(y) AS g FROM zs GROUP BY ALL),
eqs AS (SELECT fold, list(r ORDER BY i) AS m FROM (
  SELECT f.fold, a.i, list(coalesce(gr.g, 0) {ridge} ORDER BY b.i) || [coalesce(any_value(rhs.g), 0)] AS r
  FROM (SELECT DISTINCT fold FROM zs) f CROSS JOIN fe a CROSS JOIN fe b
  LEFT JOIN gr ON gr.fold = f.fold AND gr.i = a.i AND gr.j = b.i LEFT JOIN rhs ON rhs.fold = f.fold AND rhs.i = a.i
  GROUP BY f.fold, a.i) GROUP BY fold)"""

# One level of each category left out: the fit is the same, the equations are regular.
MULTI = f"""rows0 AS (SELECT posting_id AS id, company_name, location, normalized_salary AS y,
         ('0x' || substr(md5('42:' || posting_id), 1, 8))::BIGINT % {K} AS fold FROM P
       WHERE company_name IS NOT NULL AND location IS NOT NULL AND title IS NOT NULL AND normalized_salary IS NOT NULL),
fnames AS (SELECT DISTINCT 'c:' || company_name AS f FROM rows0 WHERE company_name > (SELECT min(company_name) FROM rows0)
  UNION ALL SELECT DISTINCT 'l:' || location FROM rows0 WHERE location > (SELECT min(location) FROM rows0)
  UNION ALL SELECT unnest(['', 's:SMALL', 's:PROMO'])),
fe AS (SELECT f, row_number() OVER (ORDER BY f) AS i FROM fnames),
z AS (SELECT r.id, r.fold, r.y, fe.i FROM (
    SELECT id, fold, y, unnest(['', 'c:' || company_name, 'l:' || location]) AS f FROM rows0
    UNION ALL SELECT r.id, r.fold, r.y, 's:' || S.skill FROM rows0 r JOIN S ON S.posting_id = r.id WHERE S.skill IN ('SMALL', 'PROMO')) r
  JOIN fe USING (f)),
zs AS (SELECT t.fold, z.id, z.i, z.y FROM z, (SELECT unnest(range({K})) AS fold) t WHERE z.fold <> t.fold),
{_EQS.format(ridge='')},
{_solve_sql(31)},
pr AS (SELECT z.fold, z.id, any_value(z.y) AS y, sum(sol.b) AS p FROM z JOIN sol ON sol.fold = z.fold AND sol.i = z.i GROUP BY z.fold, z.id)"""

# Titles refine the other two categories. Every title seen in training gets its mean; of
# the coefficients that do so the least norm minimises |g|^2 + sum over titles (m_t - z_t g)^2
# for the g of intercept, companies and locations, which predict the titles not seen.
NESTED = f"""rows0 AS (SELECT posting_id, company_name, location, title, normalized_salary AS y,
         ('0x' || substr(md5('42:' || posting_id), 1, 8))::BIGINT % {K} AS fold FROM P
       WHERE company_name IS NOT NULL AND location IS NOT NULL AND title IS NOT NULL AND normalized_salary IS NOT NULL),
tm AS (SELECT t.fold, r.title, any_value(r.company_name) AS company_name, any_value(r.location) AS location, avg(r.y) AS m
       FROM rows0 r, (SELECT unnest(range({K})) AS fold) t WHERE r.fold <> t.fold GROUP BY t.fold, r.title),
fe AS (SELECT f, row_number() OVER (ORDER BY f) AS i FROM (
  SELECT '' AS f UNION SELECT 'c:' || company_name FROM rows0 UNION SELECT 'l:' || location FROM rows0)),
zs AS (SELECT fold, title AS id, fe.i, m AS y FROM (SELECT fold, title, m, unnest(['', 'c:' || company_name, 'l:' || location]) AS f FROM tm) JOIN fe USING (f)),
{_EQS.format(ridge='+ (a.i = b.i)::INT')},
{_solve_sql(31)},
un AS (SELECT r.posting_id, sum(sol.b) AS p FROM (SELECT posting_id, fold, unnest(['', 'c:' || company_name, 'l:' || location]) AS f FROM rows0) r
       JOIN fe USING (f) JOIN sol ON sol.fold = r.fold AND sol.i = fe.i GROUP BY r.posting_id),
pr AS (SELECT r.fold, r.y, coalesce(tm.m, un.p) AS p FROM rows0 r JOIN un USING (posting_id) LEFT JOIN tm ON tm.fold = r.fold AND tm.title = r.title)"""

FOLD_SCORES = """SELECT fold::INT AS fold, count(*) AS n_test, round_even(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
       round_even(sqrt(avg((y - p) * (y - p))), 2) AS rmse FROM pr GROUP BY fold"""

SQL = {
    "one_hot": fx.with_views("SELECT posting_id, " + ", ".join(
        f"CAST(coalesce(company_name = '{v}', false) AS INTEGER) AS \"company_name_{v}\"" for v in SEGMENTS) + " FROM P", "P"),
    "gram_matrix": fx.with_views("""
SELECT '__intercept__' AS feature_i, '__intercept__' AS feature_j, CAST(count(*) AS DOUBLE) AS value FROM tr
UNION ALL SELECT '__intercept__', 'company_name_' || company_name, CAST(count(*) AS DOUBLE) FROM tr GROUP BY company_name
UNION ALL SELECT 'company_name_' || company_name, '__intercept__', CAST(count(*) AS DOUBLE) FROM tr GROUP BY company_name
UNION ALL SELECT 'company_name_' || company_name, 'company_name_' || company_name, CAST(count(*) AS DOUBLE) FROM tr GROUP BY company_name""",
        "P", extra=TRAIN),
    "ols_coefficients": fx.with_views("""
SELECT '__intercept__' AS feature, round_even(b0, 2) AS coefficient FROM b0
UNION ALL SELECT 'company_name_' || company_name, round_even(m - b0, 2) FROM m, b0""", "P", extra=TRAIN),
    "ols_predictions": fx.with_views("SELECT posting_id, actual, round_even(predicted, 2) AS predicted FROM pred", "P", extra=TRAIN),
    "regression_metrics": fx.with_views("""
SELECT count(*) AS n, round_even(1 - sum((actual - predicted) ^ 2) / (var_pop(actual) * count(*)), 6) AS r2,
       round_even(sqrt(avg((actual - predicted) ^ 2)), 2) AS rmse,
       round_even(1 - var_pop(actual - predicted) / var_pop(actual), 6) AS explained_variance,
       round_even(max(abs(actual - predicted)), 2) AS max_error
FROM pred""", "P", extra=TRAIN),
    "kfold_cv": fx.with_views(f"""
SELECT CAST(fold AS INTEGER) AS fold, (SELECT count(*) FROM tr) - n_test AS n_train, n_test,
       round_even(CASE WHEN sst = 0 THEN (CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - sse / sst END, 6) AS r2,
       round_even(sqrt(sse / n_test), 2) AS rmse
FROM fs""", "P", extra=TRAIN + ",\n" + FOLDS),
    "kfold_summary": fx.with_views("""
SELECT round_even(avg(r2), 6) AS r2, round_even(stddev_pop(r2), 6) AS r2_std,
       round_even(avg(mse), -2) AS mse, round_even(stddev_pop(mse), -2) AS mse_std
FROM (SELECT CASE WHEN sst = 0 THEN (CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - sse / sst END AS r2,
             sse / n_test AS mse FROM fs)""", "P", extra=TRAIN + ",\n" + FOLDS),
    "kfold_assign": fx.with_views(
        f"SELECT posting_id, CAST(('0x' || substr(md5('42:' || posting_id), 1, 8))::BIGINT % {K} AS INTEGER) AS fold FROM tr",
        "P", extra=TRAIN),
    "scenario_predict": fx.with_views("""
SELECT s.company_name, round_even(coalesce(m.m, b0.b0), 2) AS predicted
FROM (SELECT company_name FROM P UNION SELECT work_type FROM P) s
LEFT JOIN m ON m.company_name = s.company_name CROSS JOIN b0""", "P", extra=TRAIN),
    "top_coefficients": fx.with_views("""
SELECT feature, round_even(coefficient, 2) AS coefficient FROM (
  SELECT 'company_name_' || company_name AS feature, m - b0 AS coefficient FROM m, b0
  ORDER BY abs(m - b0) DESC, feature LIMIT 3)""", "P", extra=TRAIN),
    "ols_wide_metrics": fx.with_views("""
SELECT count(*) AS n, round_even(1 - sum((y - m) * (y - m)) / (var_pop(y) * count(*)), 6) AS r2,
       round_even(sqrt(avg((y - m) * (y - m))), 2) AS rmse
FROM (SELECT y, avg(y) OVER (PARTITION BY title) AS m FROM (
        SELECT title, normalized_salary AS y FROM P
        WHERE company_name IS NOT NULL AND location IS NOT NULL AND title IS NOT NULL
          AND normalized_salary IS NOT NULL))""", "P"),
    "regression_from_inputs": fx.with_views(
        "SELECT title, round_even(avg(normalized_salary), 2) AS predicted FROM P WHERE title = (SELECT min(title) FROM P) GROUP BY title", "P"),
    "ols_multi_fit": fx.with_views(FOLD_SCORES, "P", "S", extra=MULTI, recursive=True),
    "kfold_nested": fx.with_views(FOLD_SCORES, "P", extra=NESTED, recursive=True),
    "kfold_wide": fx.with_views("""
SELECT CAST(fold AS INTEGER) AS fold, n_test, round_even(1 - sse / sst, 6) AS r2, round_even(sqrt(sse / n_test), 2) AS rmse FROM fs""",
        "P", extra=(TRAIN + ",\n" + FOLDS).replace("company_name", "title")),
    "seeded_sample": fx.with_views(
        "SELECT posting_id, company_name FROM P ORDER BY md5('42:' || posting_id), posting_id LIMIT 500", "P"),
    "scenario_skills": fx.with_views("""
SELECT CASE WHEN held THEN 'with' ELSE 'without' END AS scenario, round_even(avg(y), 2) AS predicted
FROM (SELECT tr.y, EXISTS (SELECT 1 FROM S WHERE S.posting_id = tr.posting_id AND S.skill = 'SMALL') AS held FROM tr)
GROUP BY held""", "P", "S", extra=TRAIN),
    "parity_range": fx.with_views("""
SELECT round_even(least(min(actual), min(predicted)), 2) AS min_val,
       round_even(greatest(max(actual), max(predicted)), 2) AS max_val FROM pred""", "P", extra=TRAIN),
}

QUERIES = {
    "one_hot": (q_one_hot, SQL["one_hot"]),
    "gram_matrix": (q_gram_matrix, SQL["gram_matrix"]),
    "ols_one_hot_coefficients": (q_ols_coefficients, SQL["ols_coefficients"]),
    "ols_predictions": (q_ols_predictions, SQL["ols_predictions"]),
    "regression_metrics": (q_regression_metrics, SQL["regression_metrics"]),
    "kfold_cv": (q_kfold_cv, SQL["kfold_cv"]),
    "kfold_summary": (q_kfold_summary, SQL["kfold_summary"]),
    "kfold_assign": (q_kfold_assign, SQL["kfold_assign"]),
    "scenario_predict": (q_scenario_predict, SQL["scenario_predict"]),
    "top_coefficients": (q_top_coefficients, SQL["top_coefficients"]),
    "parity_range": (q_parity_range, SQL["parity_range"]),
    "ols_wide_metrics": (q_ols_wide_metrics, SQL["ols_wide_metrics"]),
    "ols_multi_fit": (q_ols_multi_fit, SQL["ols_multi_fit"]),
    "regression_from_inputs": (q_regression_from_inputs, SQL["regression_from_inputs"]),
    "kfold_nested": (q_kfold_nested, SQL["kfold_nested"]),
    "kfold_wide": (q_kfold_wide, SQL["kfold_wide"]),
    "seeded_sample": (q_seeded_sample, SQL["seeded_sample"]),
    "scenario_skills": (q_scenario_skills, SQL["scenario_skills"]),
}
