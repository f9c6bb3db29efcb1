"""Queries for moments, PCA, k-means and cluster scores.

Oracle recipes: a k-means step starts from the rows ``vec_id < k``; the scores
use the given ``embeddings.label`` (or the order priority of P) so no fit is
involved. PCA and full fits are rows-only here and checked against numpy in tests.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirescope.operators import cluster as CL
from hirescope.plans import clustering as CP
from hirescope.sources import fixtures as fx

K = 5
COL, ID, LAB = "embedding", "vec_id", "label"


def _e(spark, sf):
    return fx.embeddings(spark, sf)


def _start(spark, sf):
    rows = _e(spark, sf).where(F.col(ID) < K).orderBy(ID).select(COL).collect()
    return np.array([r[0] for r in rows], dtype=float)


def _assign(metric):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        c = _start(spark, sf)
        return CL.assign(_e(spark, sf), c.tolist(), COL, metric, 3.0).select(ID, "cluster")
    return q


def q_kmeans_update(spark: SparkSession, sf: str) -> DataFrame:
    c = _start(spark, sf)
    lab = CL.assign(_e(spark, sf), c.tolist(), COL, "euclidean")
    new = CL.update(lab, c, COL)
    rows = [(i, j, round(float(new[i, j]), 6)) for i in range(new.shape[0]) for j in range(new.shape[1])]
    return spark.createDataFrame(rows, "cluster int, dim int, value double")


def q_kmeans_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Lloyd to the end from the first K rows."""
    r = CL.kmeans(_e(spark, sf), K, COL, ID, "euclidean", init=_start(spark, sf))
    return r.labels.select(ID, "cluster")


def q_cluster_fit(spark: SparkSession, sf: str) -> DataFrame:
    labels, _, _ = CP.cluster_fit(_e(spark, sf), K, 3, COL, ID)
    return CP.cluster_map(labels, ID)


def q_skill_cluster_fit(spark: SparkSession, sf: str) -> DataFrame:
    """J9 on skill features: I3 skill matrix of the texts -> sparse PCA(3) -> k-means(5)."""
    from hirescope.operators.skills import skill_matrix
    docs = fx.posting_texts(spark, sf)
    m, vocab = skill_matrix(docs, fx.raw_lexicon(spark, sf), max_phrase_len=3, min_skill_df=10)
    labels, _, _ = CP.skill_cluster_fit(docs, m, vocab.count(), K, 3)
    return CP.cluster_map(labels, "posting_id")


def q_skill_pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    """J6/J7 on the 0/1 skills of the postings: share of each component in the variance."""
    skills = fx.posting_skills(spark, sf)
    vocab = skills.select("skill").distinct().select("skill", (F.row_number().over(Window.orderBy("skill")) - 1).alias("col"))
    matrix = skills.join(vocab, "skill").groupBy("posting_id").agg(F.collect_list("col").alias("cols"))
    points = fx.postings(spark, sf).select("posting_id").join(matrix, "posting_id", "left")
    pr = CL.pca_sparse(points.withColumn("cols", F.coalesce("cols", F.array().cast("array<int>"))), 3, vocab.count())
    rows = [(f"PC{i + 1}", round(100 * float(x), 4)) for i, x in enumerate(pr.explained_ratio)]
    return spark.createDataFrame(rows, "component string, pct_variance double")


def q_pca_scores(spark: SparkSession, sf: str) -> DataFrame:
    pr = CL.pca(_e(spark, sf), 3, COL)
    s = F.col("scores")
    return pr.scores.select(ID, *[F.bround(s[i], 5).alias(f"pc{i + 1}") for i in range(3)])


def q_pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    e = _e(spark, sf)
    pr = CL.pca(e, 3, COL)
    return CL.pca_variance(pr.scores, e, 3, "scores", COL)


def q_kmeans_k_sweep(spark: SparkSession, sf: str) -> DataFrame:
    rows = CP.k_sweep(_e(spark, sf), (3, 5, 7), 3, COL, ID)
    return spark.createDataFrame(rows, "k int, silhouette_sq double, davies_bouldin double, calinski_harabasz double")


def q_silhouette_sq(spark: SparkSession, sf: str) -> DataFrame:
    v = CL.silhouette_sq(_e(spark, sf), COL, LAB)
    return spark.createDataFrame([(round(v, 4),)], "silhouette double")


def q_silhouette_exact(spark: SparkSession, sf: str) -> DataFrame:
    v = CL.silhouette_exact(_e(spark, sf), COL, LAB, ID)
    return spark.createDataFrame([(round(v, 6),)], "silhouette double")


def q_silhouette_estimate(spark: SparkSession, sf: str) -> DataFrame:
    mean, error = CL.silhouette_estimate(_e(spark, sf), 200, COL, LAB, ID)
    return spark.createDataFrame([(round(mean, 6), round(error, 6))], "silhouette double, standard_error double")


def q_davies_bouldin(spark: SparkSession, sf: str) -> DataFrame:
    v = CL.davies_bouldin(_e(spark, sf), COL, LAB)
    return spark.createDataFrame([(round(v, 6),)], "davies_bouldin double")


def q_calinski_harabasz(spark: SparkSession, sf: str) -> DataFrame:
    v = CL.calinski_harabasz(_e(spark, sf), COL, LAB)
    return spark.createDataFrame([(round(v, 4),)], "calinski_harabasz double")


def q_similarity_matrix(spark: SparkSession, sf: str) -> DataFrame:
    s = CL.similarity_matrix(_e(spark, sf), 25, COL, ID, "euclidean")
    return s.select("id_a", "id_b", F.bround("similarity", 6).alias("similarity"))


def q_zscore(spark: SparkSession, sf: str) -> DataFrame:
    z = CL.zscore(_e(spark, sf), COL, "z")
    return z.select(ID, F.posexplode("z").alias("dim", "z")).select(ID, "dim", F.bround("z", 6).alias("z"))


def q_embedding_moments(spark: SparkSession, sf: str) -> DataFrame:
    m = CL.moments_table(_e(spark, sf), COL)
    return m.select("dim", *[F.bround(c, 6).alias(c) for c in ("mean", "var_pop", "std_pop")])


def q_embedding_covariance(spark: SparkSession, sf: str) -> DataFrame:
    c = CL.covariance_table(_e(spark, sf), COL)
    return c.select("i", "j", F.bround("cov", 6).alias("cov"))


def q_cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return CL.cluster_sizes(_e(spark, sf), LAB).select(F.col(LAB).alias("cluster"), "size")


def _ttest(spark, sf, with_p):
    e = _e(spark, sf)
    d = CL.distances_to_own_centre(e, None, COL, LAB)
    return CL.compactness_ttest(d, LAB, "dist", with_p=with_p)


def q_compactness_ttest(spark: SparkSession, sf: str) -> DataFrame:
    return _ttest(spark, sf, False)


def q_compactness_ttest_p(spark: SparkSession, sf: str) -> DataFrame:
    return _ttest(spark, sf, True)


def q_compactness_long(spark: SparkSession, sf: str) -> DataFrame:
    return CL.compactness_long(_ttest(spark, sf, False))


def q_cluster_salary(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.postings(spark, sf).withColumnRenamed("work_type", "cluster")
    return CL.cluster_salary(p, "cluster")


def q_cluster_skill_labels(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.postings(spark, sf).withColumnRenamed("work_type", "cluster")
    return CL.cluster_skill_labels(p, fx.posting_skills(spark, sf), 3, "cluster")


def q_cluster_map(spark: SparkSession, sf: str) -> DataFrame:
    """Scores, label, profile text and the distance to the cluster's centroid, for
    postings placed by salary and day, clustered by work type."""
    p = fx.postings(spark, sf)
    points = p.select("posting_id", F.array(F.col("normalized_salary"), (F.col("posting_id") % 100).cast("double")).alias("scores"),
                      F.substring("work_type", 1, 1).cast("int").alias("cluster"))
    shown = CP.cluster_map_profiles(points, p, fx.posting_skills(spark, sf), id_col="posting_id")
    return shown.select("posting_id", "cluster", *[F.bround(c, 2).alias(c) for c in ("pc1", "pc2", "centre1", "centre2")], "pc3", "profile")


def q_posting_profile(spark: SparkSession, sf: str) -> DataFrame:
    return CL.posting_profile(fx.postings(spark, sf), fx.posting_skills(spark, sf))


# --------------------------------------------------------------------------- oracle SQL

def _dist(a: str, c: str, metric: str) -> str:
    if metric == "euclidean":
        return f"sqrt(list_sum(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {c}[i]) * ({a}[i] - {c}[i]))))"
    if metric == "manhattan":
        return f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: abs({a}[i] - {c}[i])))"
    return (f"pow(list_sum(list_transform(range(1, len({a}) + 1), lambda i: pow(abs({a}[i] - {c}[i]), 3.0))), "
            f"1.0 / 3.0)")


CENTRES = f"""cen AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, embedding AS c
        FROM E WHERE vec_id < {K})"""


def _assign_sql(metric: str) -> str:
    return fx.with_views(f"""
SELECT vec_id, cluster FROM (
  SELECT e.vec_id, c.cluster,
         row_number() OVER (PARTITION BY e.vec_id ORDER BY {_dist('e.embedding', 'c.c', metric)}, c.cluster) AS rk
  FROM E e CROSS JOIN cen c) WHERE rk = 1""", "E", extra=CENTRES)


LONG_E = """el AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM E)"""

OWN = """lm AS (SELECT label, dim, avg(v) AS m FROM el GROUP BY label, dim),
dd AS (SELECT el.vec_id, el.label, sqrt(sum((el.v - lm.m) * (el.v - lm.m))) AS dist
       FROM el JOIN lm ON lm.label = el.label AND lm.dim = el.dim GROUP BY el.vec_id, el.label)"""

TTEST = """tt AS (
  SELECT c.label AS cluster, count(*) FILTER (WHERE d.label = c.label) AS n1, count(*) FILTER (WHERE d.label <> c.label) AS n2,
         avg(d.dist) FILTER (WHERE d.label = c.label) AS m1, avg(d.dist) FILTER (WHERE d.label <> c.label) AS m2,
         var_samp(d.dist) FILTER (WHERE d.label = c.label) AS v1, var_samp(d.dist) FILTER (WHERE d.label <> c.label) AS v2
  FROM (SELECT DISTINCT label FROM dd) c CROSS JOIN dd d GROUP BY c.label),
tres AS (SELECT CAST(cluster AS INTEGER) AS cluster,
         CASE WHEN n1 >= 2 AND n2 >= 2 THEN round_even(m1, 4) END AS mean_distance,
         CASE WHEN n1 >= 2 AND n2 >= 2 THEN round_even(m2, 4) END AS rest_mean_distance,
         CASE WHEN n1 >= 2 AND n2 >= 2 THEN round_even((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 4) END AS t_statistic
  FROM tt)"""

SIL = f"""pp AS (SELECT a.vec_id, a.label AS la, b.label AS lb,
             list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: (a.embedding[i] - b.embedding[i]) * (a.embedding[i] - b.embedding[i]))) AS d
      FROM E a JOIN E b ON a.vec_id <> b.vec_id),
sz AS (SELECT label, count(*) AS n FROM E GROUP BY label),
per AS (SELECT pp.vec_id, pp.la, pp.lb, sum(d) AS s FROM pp GROUP BY ALL),
ab AS (SELECT p.vec_id, p.la,
         max(CASE WHEN p.lb = p.la THEN p.s / (sz.n - 1) END) AS a,
         min(CASE WHEN p.lb <> p.la THEN p.s / sz.n END) AS b
       FROM per p JOIN sz ON sz.label = p.lb GROUP BY p.vec_id, p.la),
sv AS (SELECT e.vec_id, CASE WHEN s1.n = 1 THEN 0.0 ELSE (ab.b - ab.a) / greatest(ab.a, ab.b) END AS s
       FROM E e JOIN sz s1 ON s1.label = e.label LEFT JOIN ab ON ab.vec_id = e.vec_id)"""

SIL_EXACT = SIL.replace(")) AS d", "))) AS d").replace("list_sum(", "sqrt(list_sum(")

# The three leading eigenvectors of the covariance: a matrix squared 16 times over (and
# scaled) leaves its leading one, which is then taken out of the covariance.
_SQUARE = """s{n} AS (
  SELECT 0 AS t, m FROM c{n}
  UNION ALL SELECT t + 1, list_transform(q, lambda r: list_transform(r, lambda v: v / mx)) FROM (
    SELECT t, q, list_max(list_transform(q, lambda r: list_max(list_transform(r, lambda v: abs(v))))) AS mx FROM (
      SELECT t, list_transform(m, lambda r: list_transform(m, lambda o: list_dot_product(r, o))) AS q FROM s{n} WHERE t < 16))),
r{n} AS (SELECT list_extract(m, list_position(dg, list_max(dg))::BIGINT) AS v FROM (
  SELECT m, list_transform(m, lambda r, i: r[i]) AS dg FROM s{n} WHERE t = 16)),
v{n} AS (SELECT list_transform(v, lambda x: x * sg / nm) AS v FROM (
  SELECT v, sqrt(list_dot_product(v, v)) AS nm,
         sign(v[list_position(list_transform(v, lambda x: abs(x)), list_max(list_transform(v, lambda x: abs(x))))]) AS sg FROM r{n})),
e{n} AS (SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS ev FROM v{n}, c{n}),
c{next} AS (SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - ev * v[i] * v[j])) AS m FROM c{n}, e{n})"""

PCA3 = """ex AS (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS dim, unnest(embedding)::DOUBLE AS x FROM E),
mu AS (SELECT dim, avg(x) AS mu, var_pop(x) AS vp FROM ex GROUP BY dim),
zx AS (SELECT vec_id, list(x - mu ORDER BY dim) AS z FROM ex JOIN mu USING (dim) GROUP BY vec_id),
zl AS (SELECT vec_id, dim, x - mu AS z FROM ex JOIN mu USING (dim)),
cv AS (SELECT a.dim AS i, b.dim AS j, sum(a.z * b.z) / ((SELECT count(*) FROM E) - 1) AS c FROM zl a JOIN zl b USING (vec_id) GROUP BY ALL),
c1 AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM cv GROUP BY i)),
""" + ",\n".join(_SQUARE.format(n=n, next=n + 1) for n in (1, 2, 3)) + """,
pc AS (SELECT vec_id, list_dot_product(z, (SELECT v FROM v1)) AS pc1, list_dot_product(z, (SELECT v FROM v2)) AS pc2,
              list_dot_product(z, (SELECT v FROM v3)) AS pc3 FROM zx)"""

CENT = """cm AS (SELECT label, list(m ORDER BY dim) AS c FROM lm GROUP BY label),
sc AS (SELECT label, avg(dist) AS s FROM dd GROUP BY label),
pairc AS (SELECT a.label AS i, b.label AS j, (sa.s + sb.s) / """ + _dist("a.c", "b.c", "euclidean") + """ AS r
          FROM cm a JOIN cm b ON a.label <> b.label JOIN sc sa ON sa.label = a.label JOIN sc sb ON sb.label = b.label)"""

CH = """gm AS (SELECT dim, avg(v) AS m FROM el GROUP BY dim),
szc AS (SELECT label, count(*) AS n FROM E GROUP BY label),
btw AS (SELECT sum(szc.n * (lm.m - gm.m) * (lm.m - gm.m)) AS b FROM lm JOIN gm USING (dim) JOIN szc USING (label)),
wth AS (SELECT sum(dist * dist) AS w FROM dd)"""

def _lloyd_sql(steps: int) -> str:
    """Lloyd's iterations unrolled: assignment a<i> to centres c<i>, means c<i+1>."""
    parts = ["c0 AS MATERIALIZED (SELECT cluster, c FROM cen)"]
    for i in range(steps + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, cluster FROM (
  SELECT e.vec_id, c.cluster, row_number() OVER (PARTITION BY e.vec_id ORDER BY {_dist('e.embedding', 'c.c', 'euclidean')}, c.cluster) AS rk
  FROM E e CROSS JOIN c{i} c) WHERE rk = 1)""")
        if i < steps:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN (
    SELECT cluster, list(v ORDER BY dim) AS c FROM (
      SELECT a.cluster, el.dim, avg(el.v) AS v FROM a{i} a JOIN el ON el.vec_id = a.vec_id GROUP BY ALL) GROUP BY cluster) m
  ON m.cluster = c.cluster)""")
    return fx.with_views(f"SELECT vec_id, cluster FROM a{steps}", "E", extra=CENTRES + ",\n" + LONG_E + ",\n" + ",\n".join(parts))


# The two-sided p value: the density of t integrated by the midpoint rule over the
# angle u with tan(u) = x / sqrt(df), from the observed t on.
TTEST_P = """raw AS (SELECT CAST(cluster AS INTEGER) AS cluster, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
    pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df
  FROM tt WHERE n1 >= 2 AND n2 >= 2),
arc AS (SELECT *, atan(abs(t) / sqrt(df)) AS low FROM raw),
wide AS (SELECT *, least(pi() / 2, low + 40 / sqrt(df)) - low AS span FROM arc),
pv AS (SELECT cluster, 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi()) *
         sum(pow(cos(low + span * (i + 0.5) / 20000), df - 1)) * span / 20000 AS p
  FROM wide CROSS JOIN range(20000) r(i) GROUP BY cluster, t, df, low, span)"""

# The covariance of the 0/1 skills, from counts.
SKILL_COV = """sk AS (SELECT skill, row_number() OVER (ORDER BY skill) AS j FROM (SELECT DISTINCT skill FROM S)),
ps AS (SELECT S.posting_id, sk.j FROM S JOIN sk USING (skill) JOIN P USING (posting_id)),
np AS (SELECT count(*)::DOUBLE AS n FROM P),
one AS (SELECT j, count(*)::DOUBLE AS c FROM ps GROUP BY j),
two AS (SELECT a.j AS i, b.j AS j, count(*)::DOUBLE AS c FROM ps a JOIN ps b USING (posting_id) GROUP BY ALL),
c1 AS (SELECT list(r ORDER BY i) AS m FROM (
  SELECT a.j AS i, list((coalesce(two.c, 0) - a.c * b.c / n) / (n - 1) ORDER BY b.j) AS r
  FROM np, one a CROSS JOIN one b LEFT JOIN two ON two.i = a.j AND two.j = b.j GROUP BY a.j)),
""" + ",\n".join(_SQUARE.format(n=n, next=n + 1) for n in (1, 2, 3)) + """,
tv AS (SELECT list_sum(list_transform(m, lambda r, i: r[i])) AS tot FROM c1)"""

SQL = {
    "compactness_ttest_p": fx.with_views(
        "SELECT tres.*, round_even(pv.p, 6) AS p_value FROM tres LEFT JOIN pv USING (cluster)", "E",
        extra=LONG_E + ",\n" + OWN + ",\n" + TTEST + ",\n" + TTEST_P),
    "kmeans_fit": _lloyd_sql(45),
    "cluster_map": fx.with_views("""
SELECT posting_id, cluster, round_even(pc1, 2) AS pc1, round_even(pc2, 2) AS pc2,
       round_even(avg(pc1) OVER w, 2) AS centre1, round_even(avg(pc2) OVER w, 2) AS centre2, CAST(NULL AS DOUBLE) AS pc3,
       'Company: ' || coalesce(company_name, 'nan') || ' | Title: ' || coalesce(title, 'nan') ||
       ' | Top Skills: ' || coalesce(array_to_string(s.s[1:5], ', '), '') AS profile
FROM (SELECT *, normalized_salary AS pc1, CAST(posting_id % 100 AS DOUBLE) AS pc2, CAST(work_type[1] AS INTEGER) AS cluster FROM P) p
LEFT JOIN (SELECT posting_id, list_sort(list(DISTINCT skill)) AS s FROM S GROUP BY posting_id) s USING (posting_id)
WINDOW w AS (PARTITION BY cluster)""", "P", "S"),
    "kmeans_assign_euclidean": _assign_sql("euclidean"),
    "kmeans_assign_manhattan": _assign_sql("manhattan"),
    "kmeans_assign_minkowski": _assign_sql("minkowski"),
    "kmeans_update": fx.with_views(f"""
SELECT CAST(c.cluster AS INTEGER) AS cluster, CAST(d.dim AS INTEGER) AS dim,
       round_even(coalesce(m.v, c.c[d.dim + 1]), 6) AS value
FROM cen c CROSS JOIN (SELECT DISTINCT dim FROM el) d
LEFT JOIN (SELECT a.cluster, el.dim, avg(el.v) AS v FROM asg a JOIN el ON el.vec_id = a.vec_id GROUP BY ALL) m
  ON m.cluster = c.cluster AND m.dim = d.dim""", "E", extra=CENTRES + ",\n" + LONG_E + f""",
asg AS (SELECT vec_id, cluster FROM (
  SELECT e.vec_id, c.cluster,
         row_number() OVER (PARTITION BY e.vec_id ORDER BY {_dist('e.embedding', 'c.c', 'euclidean')}, c.cluster) AS rk
  FROM E e CROSS JOIN cen c) WHERE rk = 1)"""),
    "skill_pca_variance": fx.with_views(" UNION ALL ".join(
        f"SELECT 'PC{i}' AS component, round_even(100 * ev / tot, 4) AS pct_variance FROM e{i}, tv" for i in (1, 2, 3)),
        "P", "S", extra=SKILL_COV, recursive=True),
    "silhouette_exact": fx.with_views("SELECT round_even(avg(s), 6) AS silhouette FROM sv", "E", extra=SIL_EXACT),
    "silhouette_estimate": fx.with_views("""
SELECT round_even(avg(s), 6) AS silhouette, round_even(sqrt(var_samp(s) / count(*) * (1 - count(*) / (SELECT count(*) FROM E))), 6) AS standard_error
FROM (SELECT s FROM sv ORDER BY md5('42:' || vec_id), vec_id LIMIT 200)""", "E", extra=SIL_EXACT),
    "pca_scores": fx.with_views(
        "SELECT vec_id, round_even(pc1, 5) AS pc1, round_even(pc2, 5) AS pc2, round_even(pc3, 5) AS pc3 FROM pc", "E", extra=PCA3, recursive=True),
    "pca_variance": fx.with_views("""
SELECT component, round_even(ev, 3) AS eigenvalue, round_even(100 * ev / tot, 3) AS pct_variance,
       round_even(sum(100 * ev / tot) OVER (ORDER BY component), 3) AS cumulative_pct
FROM (SELECT unnest(['PC1', 'PC2', 'PC3']) AS component, unnest([var_pop(pc1), var_pop(pc2), var_pop(pc3)]) AS ev FROM pc),
     (SELECT sum(vp) AS tot FROM mu)""", "E", extra=PCA3, recursive=True),
    "silhouette_sq": fx.with_views("SELECT round_even(avg(s), 4) AS silhouette FROM sv", "E", extra=SIL),
    "davies_bouldin": fx.with_views(
        "SELECT round_even(avg(mx), 6) AS davies_bouldin FROM (SELECT i, max(r) AS mx FROM pairc GROUP BY i)",
        "E", extra=LONG_E + ",\n" + OWN + ",\n" + CENT),
    "calinski_harabasz": fx.with_views(
        "SELECT round_even(btw.b * ((SELECT count(*) FROM E) - (SELECT count(*) FROM szc)) / "
        "(wth.w * ((SELECT count(*) FROM szc) - 1)), 4) AS calinski_harabasz FROM btw, wth",
        "E", extra=LONG_E + ",\n" + OWN + ",\n" + CH),
    "similarity_matrix": fx.with_views(f"""
SELECT a.vec_id AS id_a, b.vec_id AS id_b, round_even(1.0 - {_dist('a.embedding', 'b.embedding', 'euclidean')}, 6) AS similarity
FROM f a CROSS JOIN f b""", "E", extra="f AS (SELECT * FROM E ORDER BY vec_id LIMIT 25)"),
    "zscore": fx.with_views("""
SELECT el.vec_id, CAST(el.dim AS INTEGER) AS dim,
       round_even((el.v - s.m) / CASE WHEN s.sd = 0 THEN 1.0 ELSE s.sd END, 6) AS z
FROM el JOIN (SELECT dim, avg(v) AS m, stddev_pop(v) AS sd FROM el GROUP BY dim) s USING (dim)""", "E", extra=LONG_E),
    "embedding_moments": fx.with_views("""
SELECT CAST(dim AS INTEGER) AS dim, round_even(avg(v), 6) AS mean, round_even(var_pop(v), 6) AS var_pop,
       round_even(stddev_pop(v), 6) AS std_pop FROM el GROUP BY dim""", "E", extra=LONG_E),
    "embedding_covariance": fx.with_views("""
SELECT CAST(a.dim AS INTEGER) AS i, CAST(b.dim AS INTEGER) AS j, round_even(covar_samp(a.v, b.v), 6) AS cov
FROM el a JOIN el b ON a.vec_id = b.vec_id GROUP BY a.dim, b.dim""", "E", extra=LONG_E),
    "cluster_sizes": fx.with_views("SELECT label AS cluster, count(*) AS size FROM E GROUP BY label ORDER BY label", "E"),
    "compactness_ttest": fx.with_views("SELECT * FROM tres", "E", extra=LONG_E + ",\n" + OWN + ",\n" + TTEST),
    "compactness_long": fx.with_views("""
SELECT cluster, 'Mean Distance' AS "group", mean_distance AS avg_distance FROM tres
UNION ALL SELECT cluster, 'Rest Mean Distance', rest_mean_distance FROM tres""", "E",
        extra=LONG_E + ",\n" + OWN + ",\n" + TTEST),
    "cluster_salary": fx.with_views("""
SELECT cluster, mean, median, min, max, size,
       greatest(max - mean, 0.0) AS err_plus, greatest(mean - min, 0.0) AS err_minus FROM (
  SELECT work_type AS cluster, round_even(avg(normalized_salary), 2) AS mean,
         round_even(quantile_cont(normalized_salary, 0.5), 2) AS median,
         round_even(min(normalized_salary), 2) AS min, round_even(max(normalized_salary), 2) AS max,
         count(*) AS size
  FROM P WHERE normalized_salary > 0 GROUP BY work_type)""", "P"),
    "cluster_skill_labels": fx.with_views("""
SELECT c.cluster, coalesce(t.lbl, 'N/A') AS skills_label
FROM (SELECT DISTINCT work_type AS cluster FROM P) c LEFT JOIN (
  SELECT cluster, string_agg(skill, ', ' ORDER BY rk) AS lbl FROM (
    SELECT cluster, skill, row_number() OVER (PARTITION BY cluster ORDER BY freq DESC, skill) AS rk FROM (
      SELECT p.work_type AS cluster, s.skill, count(*) AS freq
      FROM P p JOIN (SELECT DISTINCT posting_id, skill FROM S) s ON s.posting_id = p.posting_id GROUP BY ALL))
  WHERE rk <= 3 GROUP BY cluster) t ON t.cluster = c.cluster""", "P", "S"),
    "posting_profile": fx.with_views("""
SELECT p.posting_id,
       concat_ws(' — ', p.company_name, p.title, CAST(p.posting_id AS VARCHAR)) AS job_label,
       'Company: ' || coalesce(p.company_name, 'nan') || ' | Title: ' || coalesce(p.title, 'nan') ||
       ' | Top Skills: ' || coalesce(array_to_string(s.s[1:5], ', '), '') AS profile
FROM P p LEFT JOIN (SELECT posting_id, list_sort(list(DISTINCT skill)) AS s FROM S GROUP BY posting_id) s
  ON s.posting_id = p.posting_id""", "P", "S"),
}

QUERIES = {
    "kmeans_assign_euclidean": (_assign("euclidean"), SQL["kmeans_assign_euclidean"]),
    "kmeans_assign_manhattan": (_assign("manhattan"), SQL["kmeans_assign_manhattan"]),
    "kmeans_assign_minkowski": (_assign("minkowski"), SQL["kmeans_assign_minkowski"]),
    "kmeans_update": (q_kmeans_update, SQL["kmeans_update"]),
    "kmeans_fit": (q_kmeans_fit, SQL["kmeans_fit"]),
    "cluster_map": (q_cluster_map, SQL["cluster_map"]),
    "cluster_fit": (q_cluster_fit, None),
    "skill_cluster_fit": (q_skill_cluster_fit, None),
    "skill_pca_variance": (q_skill_pca_variance, SQL["skill_pca_variance"]),
    "pca_scores": (q_pca_scores, SQL["pca_scores"]),
    "pca_variance": (q_pca_variance, SQL["pca_variance"]),
    "kmeans_k_sweep": (q_kmeans_k_sweep, None),
    "silhouette_exact": (q_silhouette_exact, SQL["silhouette_exact"]),
    "silhouette_estimate": (q_silhouette_estimate, SQL["silhouette_estimate"]),
    "silhouette_sq": (q_silhouette_sq, SQL["silhouette_sq"]),
    "davies_bouldin": (q_davies_bouldin, SQL["davies_bouldin"]),
    "calinski_harabasz": (q_calinski_harabasz, SQL["calinski_harabasz"]),
    "similarity_matrix": (q_similarity_matrix, SQL["similarity_matrix"]),
    "zscore": (q_zscore, SQL["zscore"]),
    "embedding_moments": (q_embedding_moments, SQL["embedding_moments"]),
    "embedding_covariance": (q_embedding_covariance, SQL["embedding_covariance"]),
    "cluster_sizes": (q_cluster_sizes, SQL["cluster_sizes"]),
    "compactness_ttest": (q_compactness_ttest, SQL["compactness_ttest"]),
    "compactness_ttest_p": (q_compactness_ttest_p, SQL["compactness_ttest_p"]),
    "compactness_long": (q_compactness_long, SQL["compactness_long"]),
    "cluster_salary": (q_cluster_salary, SQL["cluster_salary"]),
    "cluster_skill_labels": (q_cluster_skill_labels, SQL["cluster_skill_labels"]),
    "posting_profile": (q_posting_profile, SQL["posting_profile"]),
}
