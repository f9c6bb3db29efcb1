"""Queries for cleaning, filters, options and the market view."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions.salary import PAY_PERIOD_FACTORS, epoch_ms_to_timestamp, normalize_salary, \
    timestamp_to_epoch_ms
from hirescope.operators import explore as X
from hirescope.operators import filters as FL
from hirescope.plans.market import market_view
from hirescope.plans.prepare import prepare, with_skill_list, write_prepared
from hirescope.queries.text import extract_cte, lex_cte
from hirescope.sources import fixtures as fx
from hirescope.session import ensure_checkpoint_dir
from hirescope.sources.tables import load_table

IN_FILTERS = {"work_type": ["1-URGENT", "2-HIGH"], "formatted_experience_level": ["F", "P"], "company_name": []}
CHOSEN_SKILLS = ["SMALL", "PROMO"]
NATIONS = ["NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4"]
MARKET_FILTERS = {"location": NATIONS, "skills": ["ECONOMY", "LARGE"]}
MARKET_CAP = 250_000.0


def q_posting_key_rename(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.customer_postings(spark, sf).withColumnRenamed("posting_id", "postingId")
    return FL.standardize_posting_id(c)


def q_posting_table(spark: SparkSession, sf: str) -> DataFrame:
    return FL.posting_table(fx.postings(spark, sf))


def q_filter_in_lists(spark: SparkSession, sf: str) -> DataFrame:
    return FL.filter_in_lists(fx.postings(spark, sf), IN_FILTERS)


def q_filter_any_skill(spark: SparkSession, sf: str) -> DataFrame:
    return FL.filter_any_skill(fx.postings(spark, sf), fx.posting_skills(spark, sf), CHOSEN_SKILLS)


def q_salary_ceiling(spark: SparkSession, sf: str) -> DataFrame:
    return FL.salary_ceiling(fx.customer_postings(spark, sf), 9000.0)


def q_negative_zero_row(spark: SparkSession, sf: str) -> DataFrame:
    return FL.negative_salary(fx.customer_postings(spark, sf), "zero_row")


def q_negative_drop(spark: SparkSession, sf: str) -> DataFrame:
    return FL.negative_salary(fx.customer_postings(spark, sf), "drop")


def q_filter_company_title(spark: SparkSession, sf: str) -> DataFrame:
    return FL.filter_company_title(fx.postings(spark, sf), "BUILDING", "ER#00000012")


def q_dropna_subset(spark: SparkSession, sf: str) -> DataFrame:
    return FL.dropna_subset(fx.postings_with_gaps(spark, sf), ["company_name", "normalized_salary"])


def q_filter_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return FL.filter_with_fallback(fx.postings(spark, sf), fx.posting_skills(spark, sf),
                                   {"work_type": ["NONE"]}, {"work_type": ["1-URGENT"], "skills": ["SMALL"]})


def q_market_view(spark: SparkSession, sf: str) -> DataFrame:
    return market_view(fx.postings(spark, sf), fx.posting_skills(spark, sf), MARKET_FILTERS, None, MARKET_CAP)


def q_normalize_salary(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_salary(fx.raw_wages(spark, sf)).select("posting_id", "salary")


def q_epoch_ms_to_ts(spark: SparkSession, sf: str) -> DataFrame:
    ev = load_table(spark, sf, "events").select("event_id", timestamp_to_epoch_ms("ts").alias("ms"))
    return ev.select("event_id", "ms", epoch_ms_to_timestamp("ms").alias("ts_back"))


def _prepare_input(spark, sf):
    d = fx.posting_texts(spark, sf)
    c = fx.customer_postings(spark, sf).select("posting_id", "normalized_salary")
    return d.join(c, "posting_id", "left")


def q_prepare_batch(spark: SparkSession, sf: str) -> DataFrame:
    """J33 end to end: an aliased key, epoch-ms times, negative salaries, extraction, and
    both tables written by the parquet sink and read back."""
    given = _prepare_input(spark, sf).withColumnRenamed("posting_id", "job_id").withColumn(
        "listed_time", F.col("job_id") * F.lit(3_600_000.0))
    clean, skills = prepare(given, fx.raw_lexicon(spark, sf), negative="zero_row", max_len=4)
    out = f"{ensure_checkpoint_dir(spark)}/prepared-{uuid.uuid4().hex}"
    write_prepared(clean, skills, out)
    clean, skills = (spark.read.parquet(f"{out}/{name}") for name in ("postings", "posting_skill"))
    return with_skill_list(clean, skills)


def q_filter_options(spark: SparkSession, sf: str) -> DataFrame:
    return X.filter_options(fx.postings_with_gaps(spark, sf), fx.posting_skills(spark, sf)) \
            .select(F.col("column").alias("option_column"), F.col("value").alias("option_value"))


def q_sorted_options(spark: SparkSession, sf: str) -> DataFrame:
    return X.sorted_options(fx.postings_with_gaps(spark, sf)) \
            .select(F.col("column").alias("option_column"), F.col("value").alias("option_value"))


def q_posting_count(spark: SparkSession, sf: str) -> DataFrame:
    mv = market_view(fx.postings(spark, sf), fx.posting_skills(spark, sf), MARKET_FILTERS, None, MARKET_CAP)
    return X.posting_count(mv)


# --------------------------------------------------------------------------- oracle SQL

def _in(vals):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


_period = " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in PAY_PERIOD_FACTORS.items())
P_COLS = "posting_id, company_id, company_name, title, formatted_experience_level, normalized_salary, location, work_type, listed_time"

SQL = {
    "posting_key_rename": fx.with_views("SELECT posting_id, title, company_name, normalized_salary FROM C", "C"),
    "posting_table": fx.with_views(f"SELECT {P_COLS} FROM P", "P"),
    "filter_in_lists": fx.with_views(
        f"SELECT * FROM P WHERE work_type IN ({_in(IN_FILTERS['work_type'])}) "
        f"AND formatted_experience_level IN ({_in(IN_FILTERS['formatted_experience_level'])})", "P"),
    "filter_any_skill": fx.with_views(
        f"SELECT * FROM P WHERE posting_id IN (SELECT posting_id FROM S WHERE skill IN ({_in(CHOSEN_SKILLS)}))", "P", "S"),
    "salary_ceiling": fx.with_views("SELECT * FROM C WHERE normalized_salary <= 9000.0", "C"),
    "negative_zero_row": fx.with_views("""
SELECT CASE WHEN normalized_salary < 0 THEN 0 ELSE posting_id END AS posting_id,
       CASE WHEN normalized_salary < 0 THEN '0' ELSE title END AS title,
       CASE WHEN normalized_salary < 0 THEN '0' ELSE company_name END AS company_name,
       CASE WHEN normalized_salary < 0 THEN 0.0 ELSE normalized_salary END AS normalized_salary
FROM C""", "C"),
    "negative_drop": fx.with_views("SELECT * FROM C WHERE NOT coalesce(normalized_salary < 0, false)", "C"),
    "filter_company_title": fx.with_views(
        "SELECT * FROM P WHERE company_name = 'BUILDING' AND coalesce(contains(lower(title), lower('ER#00000012')), false)", "P"),
    "dropna_subset": fx.with_views("SELECT * FROM PN WHERE company_name IS NOT NULL AND normalized_salary IS NOT NULL", "PN"),
    "filter_fallback": fx.with_views(
        "SELECT * FROM P WHERE work_type IN ('1-URGENT') AND posting_id IN (SELECT posting_id FROM S WHERE skill IN ('SMALL'))",
        "P", "S"),
    "market_view": fx.with_views(
        f"SELECT * FROM P WHERE location IN ({_in(NATIONS)}) "
        f"AND posting_id IN (SELECT posting_id FROM S WHERE skill IN ('ECONOMY', 'LARGE')) "
        f"AND normalized_salary <= {MARKET_CAP}", "P", "S"),
    "normalize_salary": fx.with_views(f"""
SELECT posting_id, coalesce(base * f, base) AS salary FROM (
  SELECT posting_id,
         coalesce(TRY_CAST(med_salary AS DOUBLE), (TRY_CAST(min_salary AS DOUBLE) + TRY_CAST(max_salary AS DOUBLE)) / 2.0) AS base,
         CASE lower(pay_period) {_period} ELSE NULL END AS f
  FROM W)""", "W"),
    "epoch_ms_to_ts": "SELECT event_id, epoch_us(ts) / 1000.0 AS ms, ts AS ts_back FROM events",
    "prepare_batch": fx.with_views("""
SELECT c.*, CAST(coalesce(len(per.s), 0) AS BIGINT) AS n_skills, coalesce(array_to_string(per.s, ', '), '') AS skills
FROM cleanp c LEFT JOIN per USING (posting_id)""", "D", "C", "L", extra="""
base AS (SELECT d.posting_id, d.company_name, d.work_type, d.description, c.normalized_salary
         FROM D d LEFT JOIN C c ON c.posting_id = d.posting_id),
cleanp AS (SELECT CASE WHEN normalized_salary < 0 THEN 0 ELSE posting_id END AS posting_id,
                  CASE WHEN normalized_salary < 0 THEN '0' ELSE company_name END AS company_name,
                  CASE WHEN normalized_salary < 0 THEN '0' ELSE work_type END AS work_type,
                  CASE WHEN normalized_salary < 0 THEN '0' ELSE description END AS description,
                  CASE WHEN normalized_salary < 0 THEN 0.0 ELSE normalized_salary END AS normalized_salary,
                  TIMESTAMP '1970-01-01' + to_hours(CASE WHEN normalized_salary < 0 THEN 0 ELSE posting_id END) AS listed_time
           FROM base),
""" + lex_cte(4) + ",\n" + extract_cte("cleanp", 4) + """,
per AS (SELECT posting_id, list_sort(list(DISTINCT skill)) AS s FROM found GROUP BY posting_id)"""),
    "filter_options": fx.with_views("""
SELECT 'company_name' AS option_column, CAST(company_name AS VARCHAR) AS option_value FROM PN
UNION SELECT 'title', CAST(title AS VARCHAR) FROM PN
UNION SELECT 'location', CAST(location AS VARCHAR) FROM PN
UNION SELECT 'work_type', CAST(work_type AS VARCHAR) FROM PN
UNION SELECT 'skills', skill FROM S""", "PN", "S"),
    "sorted_options": fx.with_views("""
SELECT * FROM (
SELECT 'company_name' AS option_column, company_name AS option_value FROM PN WHERE company_name IS NOT NULL
UNION SELECT 'location', location FROM PN WHERE location IS NOT NULL
UNION SELECT 'title', title FROM PN WHERE title IS NOT NULL) ORDER BY 1, 2""", "PN"),
    "posting_count": fx.with_views(
        f"SELECT count(*) AS n_postings FROM P WHERE location IN ({_in(NATIONS)}) "
        f"AND posting_id IN (SELECT posting_id FROM S WHERE skill IN ('ECONOMY', 'LARGE')) "
        f"AND normalized_salary <= {MARKET_CAP}", "P", "S"),
}

QUERIES = {
    "posting_key_rename": (q_posting_key_rename, SQL["posting_key_rename"]),
    "posting_table": (q_posting_table, SQL["posting_table"]),
    "filter_in_lists": (q_filter_in_lists, SQL["filter_in_lists"]),
    "filter_any_skill": (q_filter_any_skill, SQL["filter_any_skill"]),
    "salary_ceiling": (q_salary_ceiling, SQL["salary_ceiling"]),
    "negative_zero_row": (q_negative_zero_row, SQL["negative_zero_row"]),
    "negative_drop": (q_negative_drop, SQL["negative_drop"]),
    "filter_company_title": (q_filter_company_title, SQL["filter_company_title"]),
    "dropna_subset": (q_dropna_subset, SQL["dropna_subset"]),
    "filter_fallback": (q_filter_fallback, SQL["filter_fallback"]),
    "market_view": (q_market_view, SQL["market_view"]),
    "normalize_salary": (q_normalize_salary, SQL["normalize_salary"]),
    "epoch_ms_to_ts": (q_epoch_ms_to_ts, SQL["epoch_ms_to_ts"]),
    "prepare_batch": (q_prepare_batch, SQL["prepare_batch"]),
    "filter_options": (q_filter_options, SQL["filter_options"]),
    "sorted_options": (q_sorted_options, SQL["sorted_options"]),
    "posting_count": (q_posting_count, SQL["posting_count"]),
}
