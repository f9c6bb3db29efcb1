"""Queries for counts, histogram and salary box data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirescope.operators import explore as X
from hirescope.sources import fixtures as fx

BINS = 10


def q_category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return X.category_counts(fx.postings_with_gaps(spark, sf), "company_name", 6)


def q_skill_counts(spark: SparkSession, sf: str) -> DataFrame:
    return X.skill_counts(fx.posting_brands(spark, sf), 10)


def q_salary_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return X.salary_histogram(fx.postings(spark, sf), BINS)


def q_salary_box_rows(spark: SparkSession, sf: str) -> DataFrame:
    return X.salary_box_rows(fx.postings_with_gaps(spark, sf), "company_name", 3)


def q_salary_box_stats(spark: SparkSession, sf: str) -> DataFrame:
    return X.box_stats(X.salary_box_rows(fx.postings_with_gaps(spark, sf), "company_name", 3))


def q_salary_box_by_skill(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.salary_box_by_skill_rows(fx.postings_with_gaps(spark, sf), fx.posting_skills(spark, sf), 3)
    return X.box_stats(rows)


# --------------------------------------------------------------------------- oracle SQL

def _stats_sql(rows: str) -> str:
    return f"""
q AS (SELECT label, count(*) AS n, quantile_cont(normalized_salary, 0.25) AS q1,
             quantile_cont(normalized_salary, 0.5) AS median, quantile_cont(normalized_salary, 0.75) AS q3,
             min(normalized_salary) AS min, max(normalized_salary) AS max FROM {rows} GROUP BY label),
qf AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)"""


STATS_BODY = """
SELECT qf.label, qf.n, qf.q1, qf.median, qf.q3, qf.min, qf.max, qf.lo_fence, qf.hi_fence,
       min(CASE WHEN r.normalized_salary >= qf.lo_fence THEN r.normalized_salary END) AS whisker_low,
       max(CASE WHEN r.normalized_salary <= qf.hi_fence THEN r.normalized_salary END) AS whisker_high,
       count(CASE WHEN r.normalized_salary < qf.lo_fence OR r.normalized_salary > qf.hi_fence THEN 1 END) AS n_outliers
FROM qf JOIN {rows} r ON r.label = qf.label
GROUP BY ALL"""

BOX_ROWS = """
data AS (SELECT CAST(company_name AS VARCHAR) AS label, normalized_salary FROM PN
         WHERE company_name IS NOT NULL AND normalized_salary IS NOT NULL),
top AS (SELECT label FROM data GROUP BY label ORDER BY count(*) DESC, label LIMIT 3),
boxrows AS (SELECT * FROM data WHERE label IN (SELECT label FROM top))"""

SKILL_ROWS = """
held AS (SELECT p.posting_id, p.normalized_salary, s.skill FROM PN p JOIN (SELECT DISTINCT posting_id, skill FROM S) s
         ON s.posting_id = p.posting_id),
top AS (SELECT skill FROM held GROUP BY skill ORDER BY count(*) DESC, skill LIMIT 3),
boxrows AS (SELECT skill AS label, normalized_salary FROM held
            WHERE skill IN (SELECT skill FROM top) AND normalized_salary IS NOT NULL)"""

HIST = f"""
v AS (SELECT CAST(normalized_salary AS DOUBLE) AS x FROM P WHERE normalized_salary IS NOT NULL AND NOT isnan(normalized_salary)),
mm AS (SELECT min(x) AS mn, max(x) AS mx FROM v),
e AS (SELECT list_transform(range(0, {BINS} + 1),
        lambda i: CASE WHEN i = {BINS} THEN mx WHEN i = 0 THEN (i * ((mx - mn) / {BINS}) + mn) - (mx - mn) * 0.001
                  ELSE i * ((mx - mn) / {BINS}) + mn END) AS edges FROM mm),
b AS (SELECT len(list_filter(e.edges[2:{BINS}], lambda t: v.x > t)) AS bin FROM v, e),
c AS (SELECT bin, count(*) AS cnt FROM b GROUP BY bin),
fr AS (SELECT i AS bin, e.edges[i + 1] AS lo_raw, e.edges[i + 2] AS hi_raw FROM range(0, {BINS}) r(i), e),
rr AS (SELECT bin,
         CASE WHEN abs(lo_raw) < 1 THEN lo_raw ELSE round_even(lo_raw, 3) END AS lo,
         CASE WHEN abs(hi_raw) < 1 THEN hi_raw ELSE round_even(hi_raw, 3) END AS hi FROM fr)"""

SQL = {
    "category_counts": fx.with_views("""
SELECT coalesce(CAST(company_name AS VARCHAR), 'nan') AS label, count(*) AS count FROM PN
GROUP BY 1 ORDER BY count DESC, label LIMIT 6""", "PN"),
    "skill_counts": fx.with_views("""
SELECT skill, count(*) AS count FROM (SELECT DISTINCT posting_id, skill FROM SB)
GROUP BY skill ORDER BY count DESC, skill LIMIT 10""", "SB"),
    "salary_histogram": fx.with_views("""
SELECT CAST(rr.bin AS INTEGER) AS bin, rr.lo, rr.hi, format('{:,.0f}', rr.lo) || '–' || format('{:,.0f}', rr.hi) AS label,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM rr LEFT JOIN c ON c.bin = rr.bin""", "P", extra=HIST),
    "salary_box_rows": fx.with_views("SELECT label, normalized_salary FROM boxrows", "PN", extra=BOX_ROWS),
    "salary_box_stats": fx.with_views(STATS_BODY.format(rows="boxrows"), "PN",
                                      extra=BOX_ROWS + "," + _stats_sql("boxrows")),
    "salary_box_by_skill": fx.with_views(STATS_BODY.format(rows="boxrows"), "PN", "S",
                                         extra=SKILL_ROWS + "," + _stats_sql("boxrows")),
}

QUERIES = {
    "category_counts": (q_category_counts, SQL["category_counts"]),
    "skill_counts": (q_skill_counts, SQL["skill_counts"]),
    "salary_histogram": (q_salary_histogram, SQL["salary_histogram"]),
    "salary_box_rows": (q_salary_box_rows, SQL["salary_box_rows"]),
    "salary_box_stats": (q_salary_box_stats, SQL["salary_box_stats"]),
    "salary_box_by_skill": (q_salary_box_by_skill, SQL["salary_box_by_skill"]),
}
