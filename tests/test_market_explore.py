"""B, D, J1 hand-made cases."""

import pandas as pd
from pyspark.sql import functions as F

from hirescope.functions.salary import normalize_salary
from hirescope.operators import explore as X
from hirescope.operators import filters as FL


def test_histogram_cases(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "normalized_salary double")
    h = X.salary_histogram(df, 3).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 1, 1]
    assert abs(h[0]["lo"] - (-0.01)) < 1e-12 and abs(h[2]["hi"] - 10) < 1e-12
    pd_edges = pd.cut(pd.Series([0.0, 5.0, 10.0]), 3, retbins=True)[1]
    assert all(abs(a - b) < 1e-12 for a, b in zip(X.histogram_edges(0.0, 10.0, 3), pd_edges))
    c = X.histogram_edges(7.0, 7.0, 2)
    assert [round(x, 3) for x in c] == [6.993, 7.0, 7.007]


def test_negative_zero_row_and_drop(spark):
    df = spark.createDataFrame([(1, "x", -5.0), (2, "y", 3.0)], "posting_id long, title string, normalized_salary double")
    z = {r.posting_id: r for r in FL.negative_salary(df, "zero_row").collect()}
    assert z[0].title == "0" and z[0].normalized_salary == 0.0
    assert FL.negative_salary(df, "drop").count() == 1


def test_fallback_and_ceiling(spark):
    df = spark.createDataFrame([(1, "A", 10.0), (2, "B", None), (3, "B", 3e6)],
                               "posting_id long, company_name string, normalized_salary double")
    out = FL.filter_with_fallback(df, None, {"company_name": ["Z"]}, {"company_name": ["B"]})
    assert sorted(r.posting_id for r in out.collect()) == [2, 3]
    assert FL.salary_ceiling(out).count() == 0


def test_normalize_salary_rules(spark):
    df = spark.createDataFrame(
        [(1, "10", 20.0, None, "Hourly"), (2, "n/a", 20.0, None, "weekly"), (3, "10", 20.0, 12.0, "MONTHLY"),
         (4, "10", 20.0, None, None), (5, "10", 20.0, None, "contract")],
        "posting_id long, min_salary string, max_salary double, med_salary double, pay_period string")
    got = {r.posting_id: r.salary for r in normalize_salary(df).collect()}
    assert got == {1: 15.0 * 2080, 2: None, 3: 144.0, 4: 15.0, 5: 15.0}
    ann = df.withColumn("annual_salary", F.lit("99"))
    assert {r.salary for r in normalize_salary(ann).collect()} == {99.0}


def test_category_counts_nan_label(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), (None,)], "c string")
    r = X.category_counts(df, "c", 1).collect()
    assert r[0]["label"] == "nan" and r[0]["count"] == 3


def test_standardize_posting_id_exact_case(spark):
    df = spark.createDataFrame([(1, 2)], "ID long, job_id long")
    assert FL.standardize_posting_id(df).columns == ["ID", "posting_id"]


def test_empty_filters_keep_everything(spark):
    from hirescope.plans.market import empty_filters, market_view
    df = spark.createDataFrame([(1, "A", 10.0), (2, None, 5.0)], "posting_id long, company_name string, normalized_salary double")
    f = empty_filters()
    assert set(f) == {"company_name", "title", "location", "work_type", "formatted_experience_level", "skills"}
    assert market_view(df, None, f).count() == 2
