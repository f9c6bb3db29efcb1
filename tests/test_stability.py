"""Behaviour that green oracle rows do not show: folds, numeric stability, rejects, caps, caches."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirescope.operators import linear as LN
from hirescope.operators.cluster import compactness_ttest, covariance_table, kmeans, t_two_sided_p
from hirescope.operators.explore import edge_label_value, histogram_edges
from hirescope.operators.sampling import fold_of, seeded_sample
from hirescope.operators.skills import skill_wide
from hirescope.sources.csv_io import read_postings_checked, read_postings_csv


def test_folds_do_not_follow_the_id(spark):
    df = spark.range(6000).select(F.col("id").alias("posting_id"))
    got = df.select((F.col("posting_id") % 3).alias("r"), fold_of(k=3).alias("f")).groupBy("r", "f").count().collect()
    assert len(got) == 9 and all(550 < r["count"] < 800 for r in got)


def test_sample_of_any_size(spark):
    df = spark.range(5000).select(F.col("id").alias("posting_id"))
    for n in (0, 1, 700, 4999, 5000, 9000):
        s = seeded_sample(df, n)
        assert s.count() == s.distinct().count() == min(n, 5000)
    small = {r[0] for r in seeded_sample(df, 50).collect()}
    assert small <= {r[0] for r in seeded_sample(df, 700).collect()}


def test_fold_scores_of_large_targets(spark):
    rng = np.random.default_rng(1)
    y = 1e9 + rng.normal(size=300)
    rows = [(i, f"c{i % 4}", float(v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "posting_id long, company_name string, normalized_salary double")
    m = LN.fit_least_squares(df, None, ["company_name"], [], k_folds=3)
    fold = {r[0]: r[1] for r in df.select("posting_id", fold_of(k=3)).collect()}
    for f in m.folds:
        test = [i for i in range(300) if fold[i] == f["fold"]]
        mean = {c: np.mean([y[i] for i in range(300) if i % 4 == c and fold[i] != f["fold"]]) for c in range(4)}
        sse = sum((y[i] - mean[i % 4]) ** 2 for i in test)
        sst = sum((y[i] - np.mean(y[test])) ** 2 for i in test)
        assert f["r2"] == pytest.approx(1 - sse / sst, abs=1e-4) and f["mse"] == pytest.approx(sse / len(test), rel=1e-4)


def test_wide_fit_reports_all_coefficients_and_convergence(spark):
    rows = [(i, f"t{i % 150}", float(i % 150)) for i in range(900)]
    df = spark.createDataFrame(rows, "posting_id long, title string, normalized_salary double")
    m = LN.fit_least_squares(df, None, ["title"], [], dense_max=10)
    assert LN.top_coefficients(m.coefficients(), 100).count() == 100
    dense = LN.fit_least_squares(df, None, ["title"], [])
    assert np.allclose(dict(zip(m.names, m.beta, strict=True))["title_t7"], dict(zip(dense.names, dense.beta, strict=True))["title_t7"], atol=1e-6)
    with pytest.raises(RuntimeError, match="converge"):
        LN.fit_least_squares(df, None, ["title"], [], dense_max=10, cg_max_iter=1)


def test_skill_named_like_a_level(spark):
    df = spark.createDataFrame([(i, "A" if i % 2 else "B", 10.0 + (i % 2) + 5 * (i % 3 == 0)) for i in range(60)],
                               "posting_id long, title string, normalized_salary double")
    skills = spark.createDataFrame([(i, "title_A") for i in range(0, 60, 3)], "posting_id long, skill string")
    m = LN.fit_least_squares(df, skills, ["title"], ["title_A"])
    scen = spark.createDataFrame([("A", ["title_A"]), ("B", [])], "title string, skills array<string>")
    assert [round(r.predicted, 6) for r in LN.predict(m, scen).orderBy("title").collect()] == [16.0, 10.0]


def test_ttest_of_close_distances(spark):
    rng = np.random.default_rng(2)
    a, b = 1e7 + 0.01 * rng.normal(size=40), 1e7 + 0.003 + 0.01 * rng.normal(size=60)
    rows = [(0, float(x)) for x in a] + [(1, float(x)) for x in b]
    got = compactness_ttest(spark.createDataFrame(rows, "cluster int, dist double")).collect()
    va, vb = a.var(ddof=1) / 40, b.var(ddof=1) / 60
    assert got[0].t_statistic == pytest.approx((a.mean() - b.mean()) / math.sqrt(va + vb), abs=2e-3)


@pytest.mark.parametrize("t,df,p", [(0.0, 5, 1.0), (12.706204736, 1, 0.05), (2.570581836, 5, 0.05), (1.959963985, 1e12, 0.05),
                                    (3.290526731, 1e10, 0.001), (2.0, 2, 0.18350341907227397), (63.656741162, 1, 0.01)])
def test_p_values(t, df, p):
    assert t_two_sided_p(t, df) == pytest.approx(p, rel=1e-6)


def test_covariance_and_kmeans_against_numpy(spark):
    x = np.random.default_rng(3).normal(size=(200, 7))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, x array<double>")
    got = {(r.i, r.j): r["cov"] for r in covariance_table(df).collect()}
    assert np.allclose([[got[i, j] for j in range(7)] for i in range(7)], np.cov(x.T))
    for metric, power in (("euclidean", 2), ("manhattan", 1), ("minkowski", 3)):
        c = x[:3].copy()
        for _ in range(100):
            near = (np.abs(x[:, None] - c) ** power).sum(axis=2).argmin(axis=1)
            new = np.array([x[near == k].mean(axis=0) for k in range(3)])
            if np.allclose(new, c, atol=1e-6, rtol=1e-5):
                break
            c = new
        assert np.allclose(kmeans(df, 3, metric=metric, init=x[:3]).centres, new, atol=1e-6)


def test_histogram_rule():
    assert histogram_edges(0, 10, 4) == [-0.01, 2.5, 5.0, 7.5, 10]
    lo, hi = histogram_edges(5, 5, 2)[::2]
    assert lo == pytest.approx(4.995) and hi == pytest.approx(5.005)
    assert [edge_label_value(v) for v in (1234.56789, 0.00123456, 0.0, -2.5)] == [1234.568, 0.00123, 0.0, -2.5]


def test_csv_columns_by_name_and_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text("posting_id,company_name,title\n1,ACME,dev\n2,BETA,ops\n")
    (tmp_path / "b.csv").write_text("title,posting_id,company_name\nqa,3,GAMMA\nba,x4,DELTA\n")
    good, bad = read_postings_checked(spark, str(tmp_path))
    assert {(r.posting_id, r.company_name, r.title) for r in good.collect()} == {(1, "ACME", "dev"), (2, "BETA", "ops"), (3, "GAMMA", "qa")}
    assert [r._rejected_line for r in bad.collect()] == ["ba,x4,DELTA"]
    with pytest.raises(ValueError, match="schema"):
        read_postings_csv(spark, str(tmp_path))


def test_wide_export_names(spark):
    p = spark.createDataFrame([(1, "x"), (2, "y")], "posting_id long, title string")
    s = spark.createDataFrame([(1, "title"), (1, "a`b.c")], "posting_id long, skill string")
    got = skill_wide(p, s)
    assert got.columns == ["posting_id", "title", "skill_a`b.c", "skill_title"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "x", 1, 1), (2, "y", 0, 0)]


@pytest.mark.parametrize("name", ["salary_box_stats", "lift_heatmap", "kmeans_fit", "cluster_salary"])
def test_queries_leave_nothing_cached(spark, name):
    import __spark_entry__ as E
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    E.queries()[name](spark, "/root/testdata/sf0.001").collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_mining_shuffles_no_baskets_per_level(spark):
    from hirescope.operators.baskets import frequent_itemsets
    rows = [(b, f"i{k}") for b in range(50) for k in range(6) if (b + k) % 3]
    got = frequent_itemsets(spark.createDataFrame(rows, "posting_id long, skill string"), 50, 0.1, 3)
    sets = {}
    for b in range(50):
        items = sorted(i for x, i in rows if x == b)
        import itertools
        for k in (1, 2, 3):
            for c in itertools.combinations(items, k):
                sets[c] = sets.get(c, 0) + 1
    assert {tuple(r["items"]): r["count"] for r in got.collect()} == {c: n for c, n in sets.items() if n >= 5}
