"""PCA, k-means and cluster scores.

Points are ``array<double>`` columns. Everything per point runs on executors
as column expressions; the driver holds only k centres, d-long moment vectors,
a d x d covariance (d is the feature count) and k-row score tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirescope.execution import cut_lineage
from hirescope.functions.vectors import block, block_distances, distance, dot, lit_mat, lit_vec, sq_distance
from hirescope.operators.filters import positive_salary
from hirescope.operators.quantiles import exact_quantiles
from hirescope.operators.sampling import seeded_sample

def _dim(df: DataFrame, col: str) -> int:
    r = df.select(F.size(col).alias("d")).where(F.col("d") >= 0).first()
    if r is None:
        raise ValueError("no points")
    return int(r["d"])


# --------------------------------------------------------------------------- moments

def column_moments(df: DataFrame, col: str = "x") -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, population variance) per dimension in one pass (Summarizer)."""
    s = df.select(array_to_vector(col).alias("v")).agg(
        Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")).first()["s"]
    n = int(s["count"])
    mean = np.asarray(s["mean"].toArray(), dtype=float)
    var_s = np.asarray(s["variance"].toArray(), dtype=float)
    var_pop = var_s * (n - 1) / n if n > 0 else var_s
    return n, mean, var_pop


def moments_table(df: DataFrame, col: str = "x") -> DataFrame:
    """(dim, mean, var_pop, std_pop) per dimension, as one aggregation."""
    d = _dim(df, col)
    x = F.col(col)
    aggs = []
    for j in range(d):
        aggs += [F.avg(x[j]).alias(f"m{j}"), F.var_pop(x[j]).alias(f"v{j}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(j).alias("dim"), F.col(f"m{j}").alias("mean"), F.col(f"v{j}").alias("var_pop"))
                     for j in range(d)])
    return (wide.select(F.explode(rows).alias("r"))
                .select("r.dim", "r.mean", "r.var_pop", F.sqrt("r.var_pop").alias("std_pop")))


def covariance_table(df: DataFrame, col: str = "x") -> DataFrame:
    """Sample covariance in long form (i, j, cov), for any number of dimensions.

    Two passes: the mean (Summarizer), then centred products as numpy blocks over
    Arrow batches. A task sends one row of sums per dimension; the rows of a
    dimension are summed by themselves, so no d x d matrix meets in one place.
    """
    n, mean, _ = column_moments(df, col)
    d = len(mean)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = block(batch.column(0), d) - mean
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.sum([r.values.to_numpy() for r in rows.column("sums")], axis=0) / max(n - 1, 1)
        return pa.table({"i": pa.array([rows.column("i")[0].as_py()] * d, pa.int32()), "j": pa.array(range(d), pa.int32()), "cov": pa.array(total)})

    points = df.where(F.col(col).isNotNull()).select(F.col(col).cast("array<double>"))
    return points.mapInArrow(products, "i int, sums array<double>").groupBy("i").applyInArrow(add, "i int, j int, cov double")


def zscore(df: DataFrame, col: str = "x", out: str = "z") -> DataFrame:
    """(x - mean) / population std per dimension; zero std -> 1."""
    n, mean, var = column_moments(df, col)
    sd = np.sqrt(var)
    sd[sd == 0] = 1.0
    return df.withColumn(out, F.zip_with(F.zip_with(F.col(col), lit_vec(mean), lambda a, m: a - m),
                                         lit_vec(sd), lambda a, s: a / s))


# --------------------------------------------------------------------------- PCA

@dataclass
class PCAResult:
    scores: DataFrame          # input columns + ``scores`` array<double>
    components: np.ndarray     # d x k, columns by falling eigenvalue, sign-fixed
    mean: np.ndarray
    explained_ratio: np.ndarray  # share of the total variance, per component (k)


def pca(df: DataFrame, k: int, col: str = "x", out: str = "scores", center: bool = True) -> PCAResult:
    """Scores of the centred data on the top-k eigenvectors of the sample covariance.

    MLlib's PCA finds the components (distributed covariance); it does not
    centre what it projects, so the projection is our own expression on the
    centred vector. Signs: the largest-magnitude loading of each component is
    made positive.
    """
    from pyspark.ml.feature import PCA as MLPCA

    n, mean, _ = column_moments(df, col)
    if not center:
        mean = np.zeros_like(mean)
    vec = df.select(array_to_vector(col).alias("v"))
    model = MLPCA(k=int(k), inputCol="v", outputCol="p").fit(vec)
    comps = _signed(np.array(model.pc.toArray(), dtype=float, copy=True))
    ev = np.array(model.explainedVariance.toArray(), dtype=float, copy=True)
    xc = F.zip_with(F.col(col), lit_vec(mean), lambda a, m: a - m)
    scores = df.withColumn("__xc", xc).withColumn(
        out, F.array(*[dot(F.col("__xc"), lit_vec(comps[:, j])) for j in range(comps.shape[1])])).drop("__xc")
    return PCAResult(scores=scores, components=comps, mean=mean, explained_ratio=ev)


def _signed(comps: np.ndarray) -> np.ndarray:
    """Components (columns) with their loading of largest magnitude made positive."""
    top = np.abs(comps).argmax(axis=0)
    return comps * np.where(comps[top, np.arange(comps.shape[1])] < 0, -1.0, 1.0)


def _gathered(cols: pa.Array, table: np.ndarray) -> np.ndarray:
    """Per list of column numbers the sum of those rows of ``table``."""
    sums = np.concatenate([np.zeros((1, table.shape[1])), np.cumsum(table[cols.flatten().to_numpy(zero_copy_only=False)], axis=0)])
    ends = np.cumsum(np.concatenate([[0], pa.compute.list_value_length(cols).to_numpy(zero_copy_only=False)]))
    return sums[ends[1:]] - sums[ends[:-1]]


def pca_sparse(df: DataFrame, k: int, d: int, cols: str = "cols", out: str = "scores", oversample: int = 8,
               tol: float = 1e-9, max_iter: int = 300, seed: int = 42) -> PCAResult:
    """J6 for wide 0/1 data: ``cols`` holds the numbers (0 to d - 1) of a point's columns that are 1.

    Randomised subspace iteration: a block of k + ``oversample`` directions is multiplied
    with the covariance in one pass over the sparse rows (numpy over Arrow batches, one
    partial sum per task and column) and made orthonormal again, until every wanted
    Ritz pair's residual is below ``tol`` of the first eigenvalue. The mean enters as a
    correction, so rows stay sparse, and no d x d matrix exists anywhere; the driver holds
    the block, d x (k + oversample) numbers.
    """
    wide = min(int(k) + oversample, d)
    k = min(int(k), d)
    n = df.count()
    ones = df.select(F.explode(cols).alias("j")).groupBy("j").agg(F.count(F.lit(1)).alias("n")).toPandas()
    mean = np.zeros(d)
    mean[ones["j"].to_numpy(int)] = ones["n"].to_numpy(float) / max(n, 1)
    total = float((mean * (1 - mean)).sum()) * n / max(n - 1, 1)
    context = df.sparkSession.sparkContext
    points = df.select(F.coalesce(F.col(cols).cast("array<int>"), F.array().cast("array<int>")).alias(cols))
    kind = "j int, " + ", ".join(f"s{i} double" for i in range(wide))

    def product(v: np.ndarray) -> np.ndarray:
        """The covariance times ``v``."""
        shared = context.broadcast((v, mean @ v))

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, shift = shared.value
            back = np.zeros(table.shape[::-1])
            for batch in batches:
                given = batch.column(0)
                y = (_gathered(given, table) - shift).T
                at, times = given.flatten().to_numpy(zero_copy_only=False), pa.compute.list_value_length(given).to_numpy(zero_copy_only=False)
                for i in range(wide):  # numpy adds by a list of places fast in one dimension only
                    np.add.at(back[i], at, np.repeat(y[i], times))
            j = np.flatnonzero(back.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(j, pa.int32()), *[pa.array(back[i, j]) for i in range(wide)]],
                                             ["j", *[f"s{i}" for i in range(wide)]])

        got = points.mapInArrow(sums, kind).groupBy("j").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(wide)]).toPandas()
        shared.unpersist()
        result = np.zeros_like(v)
        result[got["j"].to_numpy(int)] = got.drop(columns="j").to_numpy(float)
        return result / max(n - 1, 1)

    v = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, wide)))[0]
    for _ in range(max_iter):
        w = product(v)
        ritz, turn = np.linalg.eigh((v.T @ w + w.T @ v) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        rest = np.linalg.norm(w @ turn[:, :k] - (v @ turn[:, :k]) * ritz[:k], axis=0)
        if (rest <= tol * max(ritz[0], 1e-300)).all():
            break
        v = np.linalg.qr(w)[0]
    else:
        raise RuntimeError(f"subspace iteration did not converge in {max_iter} passes: residual {rest.max():.3g}")
    comps = _signed(v @ turn[:, :k])
    shared = context.broadcast((comps, mean @ comps))

    @F.arrow_udf("array<double>")
    def project(given: pa.Array) -> pa.Array:
        table, shift = shared.value
        y = _gathered(given, table) - shift
        return pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), y.shape[1]).cast(pa.list_(pa.float64()))

    scores = df.withColumn(out, project(F.coalesce(F.col(cols).cast("array<int>"), F.array().cast("array<int>"))))
    return PCAResult(scores=scores, components=comps, mean=mean, explained_ratio=ritz[:k] / total if total else np.zeros(k))


def pca_variance(scores: DataFrame, raw: DataFrame, k: int, score_col: str = "scores", col: str = "x") -> DataFrame:
    """Population variance of each score, its % of the total raw variance, cumulative %."""
    _, _, var_raw = column_moments(raw, col)
    total = float(var_raw.sum())
    s = F.col(score_col)
    wide = scores.agg(*[F.var_pop(s[j]).alias(f"v{j}") for j in range(k)])
    rows = F.array(*[F.struct(F.lit(j + 1).alias("pc"), F.col(f"v{j}").alias("eigenvalue")) for j in range(k)])
    t = wide.select(F.explode(rows).alias("r")).select("r.pc", "r.eigenvalue")
    t = t.withColumn("pct_variance", F.col("eigenvalue") / F.lit(total) * 100.0)
    w = Window.orderBy("pc").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # <= k rows
    return t.withColumn("cumulative_pct", F.sum("pct_variance").over(w)).select(
        F.concat(F.lit("PC"), F.col("pc").cast("string")).alias("component"),
        F.bround("eigenvalue", 3).alias("eigenvalue"), F.bround("pct_variance", 3).alias("pct_variance"),
        F.bround("cumulative_pct", 3).alias("cumulative_pct"))


# --------------------------------------------------------------------------- k-means

def assign(df: DataFrame, centres: Sequence[Sequence[float]], col: str = "x", metric: str = "euclidean",
           p: float = 3.0, out: str = "cluster") -> DataFrame:
    """Nearest centre per point, as numpy blocks over Arrow batches; a tie
    goes to the lower index."""
    c = np.asarray(centres, dtype=float)

    @F.arrow_udf("int")
    def nearest_centre(x: pa.Array) -> pa.Array:
        return pa.array(block_distances(block(x, c.shape[1]), c, metric, p).argmin(axis=1), pa.int32())

    return df.withColumn(out, nearest_centre(F.col(col).cast("array<double>")))


def cluster_means(df: DataFrame, k: int, col: str = "x", label: str = "cluster") -> dict[int, np.ndarray]:
    """Per-cluster mean vector (Summarizer, partial aggregation); only k rows come back."""
    rows = (df.select(label, array_to_vector(col).alias("v")).groupBy(label)
              .agg(Summarizer.mean(F.col("v")).alias("m")).collect())
    return {int(r[label]): np.asarray(r["m"].toArray(), dtype=float) for r in rows}


def update(df: DataFrame, centres: np.ndarray, col: str = "x", label: str = "cluster") -> np.ndarray:
    """New centre = mean of its points, for every metric; an empty cluster keeps its centre."""
    means = cluster_means(df, len(centres), col, label)
    new = np.array(centres, dtype=float, copy=True)
    for i, m in means.items():
        new[i] = m
    return new


def lloyd_step(points: DataFrame, centres: np.ndarray, col: str, metric: str, p: float) -> np.ndarray:
    """One assignment and update: every task sends a count and a sum per centre."""
    c = np.asarray(centres, dtype=float)
    k, d = c.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, d + 1))
        for batch in batches:
            x = block(batch.column(0), d)
            near = block_distances(x, c, metric, p).argmin(axis=1)
            total[:, 0] += np.bincount(near, minlength=k)
            for j in range(d):
                total[:, j + 1] += np.bincount(near, x[:, j], k)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["c", "s"])

    parts = points.select(F.col(col).cast("array<double>")).mapInArrow(sums, "c int, s array<double>")
    rows = parts.groupBy("c").agg(Summarizer.sum(array_to_vector("s")).alias("s")).collect()  # k rows
    new = c.copy()
    for r in rows:
        s = r["s"].toArray()
        if s[0] > 0:
            new[r["c"]] = s[1:] / s[0]
    return new


def initial_centres(df: DataFrame, k: int, col: str = "x", id_col: str = "id", seed: int = 42) -> np.ndarray:
    """k distinct rows, chosen by the md5 order of ``seed:id``."""
    rows = seeded_sample(df.select(id_col, col), k, id_col, seed).collect()
    if len(rows) < k:
        raise ValueError(f"fewer than {k} points")
    return np.array([r[col] for r in rows], dtype=float)


@dataclass
class KMeansResult:
    labels: DataFrame
    centres: np.ndarray
    iterations: int
    converged: bool


def kmeans(df: DataFrame, k: int, col: str = "x", id_col: str = "id", metric: str = "euclidean",
           p: float = 3.0, max_iters: int = 100, atol: float = 1e-6, rtol: float = 1e-5,
           seed: int = 42, init: np.ndarray | None = None) -> KMeansResult:
    """Lloyd iterations with a chosen metric; centres are means for every metric.

    Each step is one Spark job over Arrow batches of the cached points; k vectors
    return. The plan does not grow with the iterations. After the loop one more
    assignment makes the labels agree with the final centres.
    """
    pts = df.select(id_col, col).persist()
    try:
        c = np.array(init, dtype=float) if init is not None else initial_centres(pts, k, col, id_col, seed)
        converged, it = False, 0
        for it in range(1, int(max_iters) + 1):
            new = lloyd_step(pts, c, col, metric, p)
            if np.allclose(c, new, atol=atol, rtol=rtol):
                converged = True
                c = new
                break
            c = new
        labels = assign(df, c.tolist(), col, metric, p)
        return KMeansResult(labels=labels, centres=c, iterations=it, converged=converged)
    finally:
        pts.unpersist()


# --------------------------------------------------------------------------- scores

def cluster_sizes(labels: DataFrame, label: str = "cluster") -> DataFrame:
    """Points per cluster, in label order."""
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias("size")).orderBy(label)


def silhouette_sq(labels: DataFrame, col: str = "x", label: str = "cluster") -> float:
    """J10 (scalable form): mean silhouette with squared euclidean distance.

    Decomposes into per-cluster sums, so no pair of points is formed
    (MLlib's ClusteringEvaluator).
    """
    ev = ClusteringEvaluator(featuresCol="__v", predictionCol="__l", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    data = labels.select(array_to_vector(col).alias("__v"), F.col(label).cast("double").alias("__l"))
    return float(ev.evaluate(data))


# Coordinates, of both sides of all pairs of blocks, that a round of the exact silhouette shuffles.
ROUND_BYTES = 256 << 20


def _packed(points: DataFrame, col: str, label: str, id_col: str, size: int) -> DataFrame:
    """(block, ids, labels, xs): the points dealt by a hash of their id into blocks of
    about ``size``, each one row with its coordinates end to end."""
    blocks = max(1, math.ceil(points.count() / size))
    return cut_lineage(
        points.groupBy(F.pmod(F.xxhash64(F.col(id_col)), F.lit(blocks)).cast("int").alias("block"))
              .agg(F.collect_list(F.struct(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(col).cast("array<double>").alias("x"))).alias("p"))
              .select("block", F.col("p.id").alias("ids"), F.col("p.label").alias("labels"), F.flatten("p.x").alias("xs")))


def _each_written(tables: Iterable[DataFrame]) -> DataFrame:
    """The rows of all ``tables``, each written before the next is made, and its shuffle
    files removed at once: else they stay until the driver collects its garbage."""
    written = []
    for table in tables:
        conf, held = table.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = conf.get(held, "false")
        conf.set(held, "true")
        try:
            written.append(cut_lineage(table))
        finally:
            conf.set(held, before)
    return reduce(DataFrame.unionByName, written)


def silhouette_points(labels: DataFrame, col: str = "x", label: str = "cluster", id_col: str = "id",
                      queries: DataFrame | None = None, block_points: int = 8192) -> DataFrame:
    """(id, label, silhouette) under euclidean distance, for the points of
    ``queries`` (a subset of ``labels``; default: all) against all points.

    Points are packed into blocks; a block of queries meets every block of points, one
    pair of blocks at a time, and leaves one row: for each query the sum of its
    distances to each cluster, added up by Spark. So work grows with queries x points, but
    no pair of points is ever a row, and a task holds two blocks. A block of queries is
    shuffled once for every block of points and the points once for it, so blocks of queries
    are taken in rounds of about ``ROUND_BYTES`` (of one block at least, which is twice the
    points), and a round leaves its sums alone. A point alone in its cluster has
    silhouette 0, as has one with no distance to anything.
    """
    sizes = {r[label]: r["n"] for r in labels.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # k rows
    names = sorted(sizes)
    if len(names) < 2:
        raise ValueError("need at least 2 clusters")
    place, n = {name: i for i, name in enumerate(names)}, np.array([sizes[name] for name in names], float)
    d = _dim(labels, col)
    packed = _packed(labels, col, label, id_col, block_points)
    asked = packed if queries is None else _packed(queries, col, label, id_col, block_points)
    # n / block_points numbers each
    everywhere, asking = ([r["block"] for r in t.select("block").collect()] for t in (packed, asked))

    def against(mine_of: pa.Table, other_of: pa.Table) -> pa.Table:
        mine, other = (t.column("xs").chunk(0)[0].values.to_numpy(zero_copy_only=False).reshape(-1, d) for t in (mine_of, other_of))
        where = np.array([place[v] for v in other_of.column("labels")[0].as_py()])
        member = np.zeros((len(other), len(n)))
        member[np.arange(len(other)), where] = 1.0
        sums, sizes = [], (other * other).sum(axis=1)
        for at in range(0, len(mine), 256):
            part = mine[at:at + 256]
            own = (part * part).sum(axis=1)[:, None]
            squares = own + sizes - 2 * part @ other.T
            # The short form loses digits for points close to each other: those are taken again.
            rows, cols = np.nonzero(squares <= 1e-6 * (own + 1e-300))
            squares[rows, cols] = ((part[rows] - other[cols]) ** 2).sum(axis=1)
            sums.append(np.sqrt(np.maximum(squares, 0.0)) @ member)
        return pa.table({"block": mine_of.column("block"), "sums": pa.array([np.concatenate(sums).ravel()], pa.list_(pa.float64()))})

    # A pair of blocks is a group by itself: batches of them would hold many blocks at once.
    pair, spread = ["block", "other"], lambda blocks: F.explode(F.array(*map(F.lit, blocks)))

    def sums_of(blocks: list[int]) -> DataFrame:
        mine = asked.where(F.col("block").isin(blocks)).select("block", spread(everywhere).alias("other"), "xs").groupBy(*pair)
        other = packed.select(spread(blocks).alias("block"), F.col("block").alias("other"), "xs", "labels").groupBy(*pair)
        partial = mine.cogroup(other).applyInArrow(against, "block int, sums array<double>")
        return partial.groupBy("block").agg(Summarizer.sum(array_to_vector("sums")).alias("s")).select("block", vector_to_array("s").alias("sums"))

    at_once = max(1, int(ROUND_BYTES // (8 * d * (n.sum() + block_points * len(everywhere)))))
    rounds = [asking[i:i + at_once] for i in range(0, len(asking), at_once)] or [[]]
    summed = sums_of(rounds[0]) if len(rounds) == 1 else _each_written(map(sums_of, rounds))
    point = (asked.select("block", F.posexplode(F.arrays_zip("ids", "labels")).alias("at", "p"))
                  .join(summed, "block")
                  .select(F.col("p.ids").alias(id_col), F.col("p.labels").alias(label),
                          F.slice("sums", F.col("at") * len(n) + 1, F.lit(len(n))).alias("sums")))
    total, counts = F.col("sums"), lit_vec(n)
    own = F.create_map(*[x for name, i in place.items() for x in (F.lit(name), F.lit(i))])[F.col(label)]
    inside = F.get(total, own) / (F.get(counts, own) - 1)
    means = F.zip_with(total, counts, lambda s, c: s / c)
    outside = F.array_min(F.transform(means, lambda m, i: F.when(i != own, m)))
    width = F.greatest(inside, outside)
    return point.select(id_col, label, F.when((F.get(counts, own) == 1) | (width == 0), 0.0).otherwise((outside - inside) / width).alias("silhouette"))


def silhouette_exact(labels: DataFrame, col: str = "x", label: str = "cluster", id_col: str = "id") -> float:
    """The mean euclidean silhouette of all points. Distances grow with the square
    of n; for many points use ``silhouette_estimate``."""
    return float(silhouette_points(labels, col, label, id_col).agg(F.avg("silhouette")).first()[0])


def silhouette_estimate(labels: DataFrame, n_sample: int, col: str = "x", label: str = "cluster", id_col: str = "id",
                        seed: int = 42) -> tuple[float, float]:
    """J10 for many points: the mean silhouette of a seeded sample, each against all
    points, and its standard error. Unbiased, since each sampled value is exact; the
    error falls with the part not sampled."""
    total = labels.count()
    sample = seeded_sample(labels.select(id_col, col, label), n_sample, id_col, seed)
    r = silhouette_points(labels, col, label, id_col, sample).agg(
        F.avg("silhouette").alias("mean"), F.var_samp("silhouette").alias("var"), F.count(F.lit(1)).alias("m")).first()
    return float(r["mean"]), float(math.sqrt((r["var"] or 0.0) / r["m"] * (1 - r["m"] / total)))


def _centres_by_label(labels: DataFrame, col: str, label: str) -> tuple[list[int], np.ndarray]:
    means = cluster_means(labels, 0, col, label)
    ks = sorted(means)
    return ks, np.array([means[i] for i in ks])


def _own_centre_distance(labels: DataFrame, ks: list[int], cents: np.ndarray, col: str, label: str,
                         metric: str = "euclidean", sq: bool = False) -> DataFrame:
    """Distance of each point to the centre of its own label (k literal centres)."""
    pos = {k_: i for i, k_ in enumerate(ks)}
    cen = lit_mat(cents)
    idx = F.create_map(*[x for k_, i in pos.items() for x in (F.lit(k_), F.lit(i + 1))])
    own = F.element_at(cen, idx[F.col(label)])
    dist = sq_distance(F.col(col), own) if sq else distance(F.col(col), own, metric)
    return labels.withColumn("__dist", dist)


def davies_bouldin(labels: DataFrame, col: str = "x", label: str = "cluster") -> float:
    """Mean over clusters of max_j (s_i + s_j) / d(c_i, c_j), euclidean."""
    ks, cents = _centres_by_label(labels, col, label)
    d = _own_centre_distance(labels, ks, cents, col, label)
    s_rows = dict(d.groupBy(label).agg(F.avg("__dist").alias("s")).select(label, "s").collect())
    s = np.array([s_rows[k_] for k_ in ks], dtype=float)
    if len(ks) < 2:
        return 0.0
    cd = np.sqrt(((cents[:, None, :] - cents[None, :, :]) ** 2).sum(axis=2))
    if np.allclose(s, 0) or np.allclose(cd, 0):
        return 0.0
    cd[cd == 0] = np.inf
    comb = (s[:, None] + s[None, :]) / cd
    return float(np.mean(comb.max(axis=1)))


def calinski_harabasz(labels: DataFrame, col: str = "x", label: str = "cluster") -> float:
    """Between * (n - k) / (within * (k - 1))."""
    ks, cents = _centres_by_label(labels, col, label)
    n, mean, _ = column_moments(labels, col)
    sizes = dict(labels.groupBy(label).count().collect())
    k = len(ks)
    between = float(sum(sizes[k_] * ((cents[i] - mean) ** 2).sum() for i, k_ in enumerate(ks)))
    within = _own_centre_distance(labels, ks, cents, col, label, sq=True).agg(F.sum("__dist")).first()[0]
    within = float(within or 0.0)
    if k < 2:
        raise ValueError("need at least 2 clusters")
    return 1.0 if within == 0 else between * (n - k) / (within * (k - 1))


def similarity_matrix(df: DataFrame, n: int = 25, col: str = "x", id_col: str = "id",
                      metric: str = "euclidean", p: float = 3.0) -> DataFrame:
    """1 - distance between each pair of the first ``n`` points (by id).

    ``n`` is the display size (at most 100): those n vectors are the only thing
    brought to the driver, and every point of the first n gets its n
    similarities as literals, so no join of points with points is planned.
    """
    if n > 100:
        raise ValueError("n is a display size: at most 100")
    first = df.select(id_col, col).orderBy(id_col).limit(int(n))
    rows = first.collect()
    ids = [r[id_col] for r in rows]
    sims = F.array(*[F.struct(F.lit(i).alias("id_b"), (F.lit(1.0) - distance(F.col(col), lit_vec(r[col]), metric, p))
                              .alias("similarity")) for i, r in zip(ids, rows)])
    return (first.select(F.col(id_col).alias("id_a"), F.explode(sims).alias("s"))
                 .select("id_a", "s.id_b", "s.similarity"))


# --------------------------------------------------------------------------- t-test

def _log_gamma_step(a: float) -> float:
    """ln Gamma(a + 1/2) - ln Gamma(a); by its expansion in 1/a where the difference
    of two large logarithms would lose its digits."""
    if a < 1e4:
        return math.lgamma(a + 0.5) - math.lgamma(a)
    return 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a ** 3)


def t_two_sided_p(t: float, df: float) -> float:
    """Two-sided p of Student's t with ``df`` degrees of freedom.

    With x = sqrt(df) tan(u) the density becomes cos(u)^(df - 1) times a constant, so
    the tail is an integral over u from atan(t / sqrt(df)) to pi / 2. It is taken by
    Gauss-Legendre panels over the part where the power has not vanished.
    """
    if math.isnan(t) or math.isnan(df):
        return float("nan")
    if math.isinf(t):
        return 0.0
    low = math.atan(abs(t) / math.sqrt(df))
    high = min(math.pi / 2, low + 40 / math.sqrt(df))
    nodes, weights = np.polynomial.legendre.leggauss(24)
    ends = low + (high - low) * np.linspace(0, 1, 65) ** 2
    u = (ends[:-1, None] + ends[1:, None]) / 2 + np.diff(ends)[:, None] / 2 * nodes
    height = np.exp((df - 1) * np.log1p(-2 * np.sin(u / 2) ** 2))
    area = float((height * weights * np.diff(ends)[:, None] / 2).sum())
    return min(1.0, 2 * math.exp(_log_gamma_step(df / 2)) / math.sqrt(math.pi) * area)


def compactness_ttest(dists: DataFrame, label: str = "cluster", dist: str = "dist",
                      with_p: bool = True) -> DataFrame:
    """Per cluster, own distances vs everyone else's distance to *their own*
    centre; Welch's t. One grouped aggregation of counts, means and squared
    deviations; the rest group merges the moments of the other clusters, so nothing
    is subtracted from a large sum. Fewer than 2 on a side -> missing."""
    g = dists.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.avg(dist).alias("m"),
                                 (F.var_pop(dist) * F.count(F.lit(1))).alias("dev"))
    # k rows only
    g = g.withColumn("parts", F.collect_list(F.struct(F.col(label).alias("c"), "n", "m", "dev")).over(Window.partitionBy()))
    others = F.filter("parts", lambda x: x["c"] != F.col(label))
    add = lambda f: F.aggregate("others", F.lit(0.0), lambda s, x: s + f(x))
    g = g.withColumn("others", others).withColumn("n2", add(lambda x: x["n"]))
    g = g.withColumn("m2", F.when(F.col("n2") > 0, add(lambda x: x["n"] * (x["m"] - F.col("m"))) / F.col("n2") + F.col("m")))
    g = g.withColumn("dev2", add(lambda x: x["dev"] + x["n"] * (x["m"] - F.col("m2")) * (x["m"] - F.col("m2"))))
    n1, n2, m1, m2 = F.col("n"), F.col("n2"), F.col("m"), F.col("m2")
    v1, v2 = F.col("dev") / F.nullif(n1 - 1, F.lit(0)), F.col("dev2") / F.nullif(n2 - 1, F.lit(0.0))
    a, b = v1 / n1, v2 / n2
    t = (m1 - m2) / F.sqrt(a + b)
    dof = (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1))
    ok = (n1 >= 2) & (n2 >= 2)
    out = g.select(F.col(label).alias("cluster"),
                   F.when(ok, F.bround(m1, 4)).alias("mean_distance"),
                   F.when(ok, F.bround(m2, 4)).alias("rest_mean_distance"),
                   F.when(ok, F.bround(t, 4)).alias("t_statistic"),
                   F.when(ok, t).alias("__t"), F.when(ok, dof).alias("__df"))
    if not with_p:
        return out.drop("__t", "__df").orderBy("cluster")
    rows = out.orderBy("cluster").collect()  # k rows
    spark = dists.sparkSession
    res = [(r["cluster"], r["mean_distance"], r["rest_mean_distance"], r["t_statistic"],
            None if r["__t"] is None else round(t_two_sided_p(r["__t"], r["__df"]), 6)) for r in rows]
    return spark.createDataFrame(res, "cluster int, mean_distance double, rest_mean_distance double, "
                                      "t_statistic double, p_value double")


def compactness_long(ttest: DataFrame) -> DataFrame:
    """(cluster, group, avg_distance) from the two mean columns."""
    t = ttest.select("cluster", F.col("mean_distance").alias("Mean Distance"),
                     F.col("rest_mean_distance").alias("Rest Mean Distance"))
    return t.unpivot("cluster", ["Mean Distance", "Rest Mean Distance"], "group", "avg_distance")


def distances_to_own_centre(labels: DataFrame, centres: np.ndarray | None = None, col: str = "x",
                            label: str = "cluster") -> DataFrame:
    """Euclidean distance of every point to its own centre (given or label means)."""
    if centres is None:
        ks, cents = _centres_by_label(labels, col, label)
    else:
        ks, cents = list(range(len(centres))), np.asarray(centres, dtype=float)
    return _own_centre_distance(labels, ks, cents, col, label).withColumnRenamed("__dist", "dist")


# --------------------------------------------------------------------------- salary / labels

def cluster_salary(labels: DataFrame, label: str = "cluster", salary: str = "normalized_salary") -> DataFrame:
    """B10 + D13 + F4: mean, median, min, max, size (2 decimals) and error bars."""
    pos = positive_salary(labels, salary)
    agg = exact_quantiles(pos, label, salary, (0.5,), names=("median",),
                          extra_aggs=[F.avg(salary).alias("mean"), F.min(salary).alias("min"),
                                      F.max(salary).alias("max")]).withColumnRenamed("n", "size")
    r = agg.select(F.col(label).alias("cluster"), *[F.bround(c, 2).alias(c) for c in ("mean", "median", "min", "max")],
                   "size")
    return (r.withColumn("err_plus", F.greatest(F.col("max") - F.col("mean"), F.lit(0.0)))
             .withColumn("err_minus", F.greatest(F.col("mean") - F.col("min"), F.lit(0.0)))
             .orderBy("mean", "cluster"))


def cluster_skill_labels(labels: DataFrame, skills: DataFrame, top_n: int = 3, label: str = "cluster",
                         id_col: str = "posting_id") -> DataFrame:
    """The most frequent skills per cluster joined by ', ' (zero counts skipped), else 'N/A'."""
    counts = (labels.select(id_col, label).join(skills.select(id_col, "skill").distinct(), id_col)
                    .groupBy(label, "skill").agg(F.count(F.lit(1)).alias("freq")))
    w = Window.partitionBy(label).orderBy(F.col("freq").desc(), "skill")
    top = counts.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= top_n)
    names = (top.groupBy(label)
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rk", "skill"))),
                                              lambda s: s["skill"]), ", ").alias("skills_label")))
    all_labels = labels.select(label).distinct()
    return (all_labels.join(names, label, "left")
                      .select(F.col(label).alias("cluster"), F.coalesce("skills_label", F.lit("N/A")).alias("skills_label")))


def posting_profile(postings: DataFrame, skills: DataFrame, id_col: str = "posting_id", n_skills: int = 5) -> DataFrame:
    """Job label (company — title — id) and profile text (company, title, first 5 skills A-Z)."""
    per = skills.groupBy(id_col).agg(F.array_sort(F.collect_set("skill")).alias("s"))
    p = postings.join(per, id_col, "left")
    top = F.coalesce(F.array_join(F.slice(F.col("s"), 1, n_skills), ", "), F.lit(""))
    return p.select(id_col,
                    F.concat_ws(" — ", F.col("company_name"), F.col("title"), F.col(id_col).cast("string")).alias("job_label"),
                    F.concat(F.lit("Company: "), F.coalesce(F.col("company_name"), F.lit("nan")),
                             F.lit(" | Title: "), F.coalesce(F.col("title"), F.lit("nan")),
                             F.lit(" | Top Skills: "), top).alias("profile"))
