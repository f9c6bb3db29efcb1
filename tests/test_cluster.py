"""PCA, k-means, scores and t-test checks."""

import math

import numpy as np

from hirescope.operators import cluster as CL


def test_pca_centred_scores_and_numpy(spark):
    X = np.array([[1, 2, 0], [2, 1, 1], [3, 5, 2], [9, 1, 1]], float)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(X)], "id long, x array<double>")
    pr = CL.pca(df, 2, "x")
    s = np.array([r.scores for r in pr.scores.orderBy("id").collect()])
    assert np.allclose(s.mean(axis=0), 0, atol=1e-9)
    vals, vecs = np.linalg.eigh(np.cov(X - X.mean(0), rowvar=False))
    ref = (X - X.mean(0)) @ vecs[:, np.argsort(vals)[::-1]][:, :2]
    assert np.allclose(np.abs(s), np.abs(ref), atol=1e-8)


def test_kmeans_empty_cluster_keeps_centre_and_ties(spark):
    df = spark.createDataFrame([(0, [0.0]), (1, [0.1]), (2, [10.0])], "id long, x array<double>")
    lab = CL.assign(df, [[0.0], [0.0], [100.0]], "x")
    assert {r.id: r.cluster for r in lab.collect()} == {0: 0, 1: 0, 2: 0}
    new = CL.update(lab, np.array([[0.0], [0.0], [100.0]]), "x")
    assert new[1, 0] == 0.0 and new[2, 0] == 100.0


def test_kmeans_converges_and_sizes(spark):
    pts = [(i, [float(i % 2) * 10 + i * 0.01, 0.0]) for i in range(40)]
    df = spark.createDataFrame(pts, "id long, x array<double>")
    r = CL.kmeans(df, 2, "x", "id")
    assert r.converged
    assert sum(x["size"] for x in CL.cluster_sizes(r.labels).collect()) == 40


def test_t_p_value_cauchy():
    # df = 1 is the Cauchy distribution: p = 1 - 2/pi * atan(|t|)
    for t in (0.5, 1.0, 3.0):
        assert abs(CL.t_two_sided_p(t, 1.0) - (1 - 2 / math.pi * math.atan(t))) < 1e-10


def test_ttest_single_member_is_missing(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.5), (1, 2.0), (1, 2.5)], "cluster int, dist double")
    r = {x.cluster: x for x in CL.compactness_ttest(df, "cluster", "dist").collect()}
    assert r[0].t_statistic is None and r[1].t_statistic is None


def test_zscore_zero_std(spark):
    df = spark.createDataFrame([(0, [1.0, 5.0]), (1, [3.0, 5.0])], "id long, x array<double>")
    z = {r.id: r.z for r in CL.zscore(df, "x").collect()}
    assert z[0] == [-1.0, 0.0] and z[1] == [1.0, 0.0]


def test_cluster_fit_normalize_and_tol(spark):
    from hirescope.plans.clustering import cluster_fit, cluster_map
    rng = np.random.default_rng(2)
    pts = [(i, (rng.normal(0, 1, 4) + (5 if i % 2 else 0)).tolist()) for i in range(60)]
    df = spark.createDataFrame(pts, "id long, x array<double>")
    labels, pr, km = cluster_fit(df, k=2, n_components=2, col="x", id_col="id", normalize=True, tol=1e-4)
    rows = cluster_map(labels, "id").collect()
    assert all(r.pc3 is None for r in rows)  # two components only
    m = {r.id: r.cluster for r in rows}
    # the two well-separated groups end up in different clusters
    assert len({m[i] for i in range(0, 60, 2)}) == 1 and len({m[i] for i in range(1, 60, 2)}) == 1
    assert m[0] != m[1]


def test_skill_vectors_zero_rows(spark):
    from hirescope.plans.clustering import skill_vectors
    posts = spark.createDataFrame([(1,), (2,)], "posting_id long")
    m = spark.createDataFrame([(1, "sql", 1), (1, "py", 0)], "posting_id long, skill string, col int")
    v = {r.posting_id: r.x for r in skill_vectors(posts, m, 3).collect()}
    assert v == {1: [1.0, 1.0, 0.0], 2: [0.0, 0.0, 0.0]}


def _binary_points(spark, x):
    import numpy as np
    return spark.createDataFrame([(i, [int(j) for j in np.flatnonzero(r)]) for i, r in enumerate(x)], "id long, cols array<int>")


def test_sparse_pca_against_numpy(spark):
    import numpy as np

    from hirescope.operators import cluster as CL
    rng = np.random.default_rng(0)
    x = (rng.random((200, 15)) < (rng.random((3, 15)) * 0.6)[rng.integers(0, 3, 200)]).astype(float)
    x[5] = 0  # a point without any column
    pr = CL.pca_sparse(_binary_points(spark, x), 2, 15, oversample=10)
    w, v = np.linalg.eigh(np.cov(x.T))
    v = CL._signed(v[:, ::-1][:, :2])
    got = np.array([r.scores for r in pr.scores.orderBy("id").collect()])
    assert np.allclose(got, (x - x.mean(0)) @ v, atol=1e-6)
    assert np.allclose(pr.explained_ratio, w[::-1][:2] / w.sum())


def test_sparse_pca_of_thirty_thousand_columns(spark):
    """A d x d matrix would take 7 GB; three planted groups of columns are found."""
    import numpy as np

    from hirescope.operators import cluster as CL
    rng, d = np.random.default_rng(1), 30_000
    rows = []
    for i in range(900):
        own = set((10_000 * (i % 3) + rng.choice(300, 150, replace=False)).tolist())
        rows.append((i, sorted(own | set(rng.integers(0, d, 20).tolist()))))
    pr = CL.pca_sparse(spark.createDataFrame(rows, "id long, cols array<int>"), 2, d, tol=1e-5)
    got = np.array([r.scores for r in pr.scores.orderBy("id").collect()])
    centre = np.array([got[np.arange(900) % 3 == g].mean(axis=0) for g in range(3)])
    nearest = ((got[:, None, :] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == np.arange(900) % 3).all()


def test_exact_silhouette_in_small_blocks(spark):
    """Blocks of about 20 points; a cluster of one; a query subset; points that coincide."""
    import numpy as np

    from hirescope.operators import cluster as CL
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, (60, 3)), rng.normal(4, 1, (50, 3)), [[1e4, 1e4, 1e4]], np.full((9, 3), 2.5)])
    lab = [0] * 60 + [1] * 50 + [7] + [3] * 9
    df = spark.createDataFrame([(i, x[i].tolist(), lab[i]) for i in range(120)], "id long, x array<double>, cluster int")
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    want = {}
    for i in range(120):
        mean = {c: dist[i, [j for j in range(120) if lab[j] == c and j != i]].mean() if lab.count(c) > (c == lab[i]) else None for c in set(lab)}
        if mean[lab[i]] is None:
            want[i] = 0.0
            continue
        a, b = mean[lab[i]], min(m for c, m in mean.items() if c != lab[i])
        want[i] = (b - a) / max(a, b)
    got = {r.id: r.silhouette for r in CL.silhouette_points(df, block_points=20).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    some = {r.id: r.silhouette for r in CL.silhouette_points(df, queries=df.where("id % 7 = 0"), block_points=20).collect()}
    assert some.keys() == {i for i in want if i % 7 == 0} and all(abs(some[i] - want[i]) < 1e-9 for i in some)
    mean, error = CL.silhouette_estimate(df, 120)
    assert abs(mean - np.mean(list(want.values()))) < 1e-9 and error == 0


def test_silhouette_hands_python_one_pair_of_blocks_at_a_time(spark):
    """A batch of rows would hold as many blocks as there are rows in it."""
    from hirescope.operators import cluster as CL
    df = spark.createDataFrame([(i, [float(i), 1.0], i % 2) for i in range(40)], "id long, x array<double>, cluster int")
    plan = CL.silhouette_points(df, block_points=10)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" not in plan and "FlatMapGroupsInArrow" not in plan


def test_silhouette_in_rounds_shuffles_one_block_of_queries_against_all(spark, monkeypatch):
    """All pairs of blocks at once would shuffle the points once for every block."""
    from hirescope.operators import cluster as CL
    points = [(i, [float(i % 17), float(i * i % 23)], i % 3) for i in range(200)]
    df = spark.createDataFrame(points, "id long, x array<double>, cluster int")
    want = {r.id: r.silhouette for r in CL.silhouette_points(df).collect()}
    written, cut = [], CL.cut_lineage
    monkeypatch.setattr(CL, "cut_lineage", lambda t: written.append(t) or cut(t))
    monkeypatch.setattr(CL, "ROUND_BYTES", 8 * 2 * 2 * 450)  # two blocks of about 20 against all
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    got = {r.id: r.silhouette for r in CL.silhouette_points(df, block_points=20).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    rounds = [t for t in written if t.columns == ["block", "sums"]]
    assert len(rounds) == 5 and all("FlatMapCoGroupsInArrow" in t._jdf.queryExecution().executedPlan().toString() for t in rounds)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
