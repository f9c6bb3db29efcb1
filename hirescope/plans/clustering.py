"""PCA -> k-means, the cluster map data, and a sweep over k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.execution import broadcast_if_small
from hirescope.operators import cluster as CL


def skill_vectors(postings: DataFrame, matrix: DataFrame, vocab_size: int, id_col: str = "posting_id",
                  out: str = "x") -> DataFrame:
    """Dense 0/1 skill vectors (B2/I3 -> feature matrix): one entry per vocabulary
    column, zeros for postings without a kept skill. A posting's skill list is
    bounded by the vocabulary, so ``collect_list`` per posting is safe."""
    per = matrix.groupBy(id_col).agg(F.collect_list("col").alias("__cols"))
    d = int(vocab_size)
    vec = F.transform(F.sequence(F.lit(0), F.lit(d - 1)),
                      lambda j: F.when(F.array_contains(F.col("__cols"), j), F.lit(1.0)).otherwise(F.lit(0.0)))
    return (postings.join(per, id_col, "left")
                    .withColumn("__cols", F.coalesce("__cols", F.array().cast("array<int>")))
                    .withColumn(out, vec).drop("__cols"))


def cluster_fit(df: DataFrame, k: int = 5, n_components: int = 3, col: str = "x", id_col: str = "id",
                metric: str = "euclidean", p: float = 3.0, max_iters: int = 100, normalize: bool = False,
                tol: float = 1e-6, seed: int = 42, sample_n: int | None = None):
    """Optionally a seeded sample (F7), z-score (X5), PCA to ``n_components``,
    then k-means in PCA space.

    Returns (labels with ``scores`` and ``cluster``, PCAResult, KMeansResult).
    """
    from hirescope.execution import cut_lineage
    from hirescope.operators.sampling import seeded_sample

    src = seeded_sample(df, sample_n, id_col, seed) if sample_n else df
    # Moments, the PCA fit, the projection and every Lloyd step read these points:
    # compute them once and cut the lineage (reliable checkpoint).
    src = cut_lineage(src.select(id_col, col))
    if normalize:
        src = CL.zscore(src, col, "__z").drop(col).withColumnRenamed("__z", col)
    pr = CL.pca(src, n_components, col)
    km = CL.kmeans(pr.scores, k, "scores", id_col, metric, p, max_iters, atol=tol, seed=seed)
    return km.labels, pr, km


def skill_cluster_fit(postings: DataFrame, matrix: DataFrame, vocab_size: int, k: int = 5, n_components: int = 3,
                      id_col: str = "posting_id", metric: str = "euclidean", p: float = 3.0, max_iters: int = 100,
                      tol: float = 1e-6, seed: int = 42):
    """J9 on a skill matrix (id, col): PCA of the sparse 0/1 rows, then k-means in PCA
    space. Postings without a kept skill are points too. Returns as ``cluster_fit``."""
    from hirescope.execution import cut_lineage

    per = matrix.groupBy(id_col).agg(F.collect_list(F.col("col").cast("int")).alias("cols"))  # at most the vocabulary
    points = cut_lineage(postings.select(id_col).join(per, id_col, "left").select(
        id_col, F.coalesce("cols", F.array().cast("array<int>")).alias("cols")))
    pr = CL.pca_sparse(points, n_components, vocab_size, seed=seed)
    pr.scores = cut_lineage(pr.scores.select(id_col, "scores"))
    km = CL.kmeans(pr.scores, k, "scores", id_col, metric, p, max_iters, atol=tol, seed=seed)
    return km.labels, pr, km


def cluster_map(labels: DataFrame, id_col: str = "id") -> DataFrame:
    """J14 data: first three scores (missing when fewer components) and the label per point."""
    s = F.col("scores")
    return labels.select(id_col, *[F.get(s, i).alias(f"pc{i + 1}") for i in range(3)], "cluster")


def cluster_map_profiles(labels: DataFrame, postings: DataFrame, skills: DataFrame, id_col: str = "id",
                         label: str = "cluster") -> DataFrame:
    """J14 in full: the map's points with each posting's profile text, and the centroid
    of its cluster in the first three scores (``centre1`` to ``centre3``)."""
    points = cluster_map(labels, id_col)
    centres = points.groupBy(label).agg(*[F.avg(f"pc{i}").alias(f"centre{i}") for i in (1, 2, 3)])  # one row per cluster
    profiles = CL.posting_profile(postings, skills, id_col)
    return points.join(broadcast_if_small(centres), label).join(profiles, id_col, "left")


def k_sweep(df: DataFrame, ks: Sequence[int] = (3, 5, 7), n_components: int = 3, col: str = "x",
            id_col: str = "id", metric: str = "euclidean") -> list[tuple]:
    """One score row per k (scores on the raw features, clusters in PCA space)."""
    from hirescope.execution import cut_lineage

    pr = CL.pca(cut_lineage(df.select(id_col, col)), n_components, col)
    base = pr.scores.persist()
    out = []
    try:
        for k in ks:
            km = CL.kmeans(base, k, "scores", id_col, metric)
            lab = km.labels
            out.append((int(k), CL.silhouette_sq(lab, col), CL.davies_bouldin(lab, col), CL.calinski_harabasz(lab, col)))
    finally:
        base.unpersist()
    return out
