"""Least squares on binary design matrices.

Every feature of the source model is 0/1: an intercept, one-hot levels of the
chosen categories (all levels kept) and the chosen skill flags. So X'X is a
table of co-occurrence counts and X'y a table of sums of y:

1. each row becomes its sorted list of active feature names (its *pattern*);
2. rows are pre-aggregated by (fold, pattern) -> n, sum y, sum y^2, which
   collapses the data to the number of distinct patterns before any pair is
   formed;
3. pattern pairs are exploded and summed per (fold, i, j).

One aggregation pass gives the Gram sums of every fold; the training Gram of
fold f is total - fold f. Up to ``MAX_DENSE_FEATURES`` these d x d sufficient
statistics reach the driver, where the minimum-norm solution pinv(X'X) X'y is taken
with a Hermitian eigen-decomposition. Wider designs bring nothing of length d to the
driver. A row has one level of each category, so the levels of the widest category
are eliminated exactly, by sums per level, which leaves a small system of the other
features (``_fit_eliminated``). Where those are many too, or the caller sets
``dense_max``, conjugate gradients run on tables keyed by feature, all folds and the
final fit at once (``_fit_cg``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirescope.execution import broadcast_if_small, cut_lineage

INTERCEPT = "__intercept__"
SKILL_KEY = "\x01"  # leads the internal name of a skill feature; not shown
CATEGORY_COLUMNS = ("company_name", "location", "title")
# Up to this many features the (sparse) d x d Gram sums come to the driver.
MAX_DENSE_FEATURES = 2000
# Beyond, the widest category is eliminated if the other features' sums, for each system
# a matrix, have at most this many entries; else conjugate gradients run.
ELIMINATED_ENTRIES = 8_000_000
LEVEL_BROADCAST_ROWS = 1_000_000


def one_hot_name(col: str, value: Column) -> Column:
    """``column_value``."""
    return F.concat_ws("_", F.lit(col), value.cast("string"))


def one_hot(df: DataFrame, col: str, levels: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 int column per level (no level dropped), named ``col_value``.

    A wide export: the caller may name the ``levels`` to show; otherwise every
    level becomes a column. Fitting never uses it, it works on long features.
    """
    if levels is None:
        levels = [r[0] for r in df.select(F.col(col).cast("string")).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()]
    c = F.col(col).cast("string")
    return df.select(*df.columns, *[F.when(c == v, 1).otherwise(0).alias(f"{col}_{v}") for v in levels])


def choose_features(cat_inputs: dict[str, str | None], skill_inputs: Sequence[str]) -> tuple[list[str], list[str]]:
    """Categories the user set, plus the chosen skills; nothing chosen -> no model."""
    cats = [c for c in CATEGORY_COLUMNS if cat_inputs.get(c) is not None]
    skills = list(dict.fromkeys(skill_inputs or []))
    if not cats and not skills:
        raise ValueError("choose at least one of company, location, title or a skill")
    return cats, skills


def with_skill_array(df: DataFrame, skills_long: DataFrame | None, skills_used: Sequence[str],
                     id_col: str = "posting_id") -> DataFrame:
    """Attach ``skills`` = the chosen skills a posting holds (at most len(skills_used))."""
    if not skills_used or skills_long is None:
        return df.withColumn("skills", F.array().cast("array<string>"))
    held = (skills_long.where(F.col("skill").isin(list(skills_used)))
                       .groupBy(id_col).agg(F.array_sort(F.collect_set("skill")).alias("skills")))
    return (df.join(held, id_col, "left")
              .withColumn("skills", F.coalesce("skills", F.array().cast("array<string>"))))


def design_rows(df: DataFrame, cat_features: Sequence[str], target: str = "normalized_salary",
                id_col: str = "posting_id", fold: Column | None = None) -> DataFrame:
    """(id, fold, y, feats) with feats = intercept + one-hot names + held skills
    (keyed apart, so that a skill named like a level stays a feature of its own)."""
    held = F.transform("skills", lambda x: F.concat(F.lit(SKILL_KEY), x))
    feats = F.concat(F.array(F.lit(INTERCEPT), *[one_hot_name(c, F.col(c)) for c in cat_features]), held)
    return df.select(F.col(id_col), (fold if fold is not None else F.lit(0)).alias("fold"),
                     F.col(target).cast("double").alias("y"), F.array_sort(feats).alias("feats"))


def gram_sums(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per fold: pair counts (fold, i, j, g) and target sums (fold, i, xty, n)."""
    return _gram_of(_patterns(rows))


def _patterns(rows: DataFrame) -> DataFrame:
    """Rows collapsed by (fold, feats): n, the sum of y, its mean, and the squared
    deviations from that mean (Spark's central moments, which do not cancel)."""
    return rows.groupBy("fold", "feats").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"), F.avg("y").alias("ybar"),
        (F.var_pop("y") * F.count(F.lit(1))).alias("within"))


def _gram_of(pat: DataFrame) -> tuple[DataFrame, DataFrame]:
    pairs = (pat.select("fold", "n", F.explode("feats").alias("i"), "feats")
                .select("fold", "n", "i", F.explode("feats").alias("j"))
                .groupBy("fold", "i", "j").agg(F.sum("n").alias("g")))
    xty = (pat.select("fold", "sy", "n", F.explode("feats").alias("i"))
              .groupBy("fold", "i").agg(F.sum("sy").alias("xty"), F.sum("n").alias("n")))
    return pairs, xty


def min_norm_solve(g: np.ndarray, b: np.ndarray) -> np.ndarray:
    """pinv(G) b for symmetric PSD G, cutting eigenvalues below d * eps * max."""
    if g.size == 0:
        return np.zeros(0)
    w, v = np.linalg.eigh(g)
    cut = max(w.max(initial=0.0), 0.0) * g.shape[0] * np.finfo(float).eps
    inv = np.where(w > cut, 1.0 / np.where(w > cut, w, 1.0), 0.0)

    def apply(r):
        return v @ (inv * (v.T @ r))

    x = apply(b)
    # Two steps of iterative refinement; corrections stay in the row space.
    for _ in range(2):
        x = x + apply(b - g @ x)
    return x


@dataclass
class FoldStats:
    g: np.ndarray
    xty: np.ndarray
    n: int


@dataclass
class LinearModel:
    """The refit model, plus cross-validation results."""
    coefs: DataFrame                 # (key, beta): a row per feature, the intercept included
    intercept: float
    n_features: int
    cat_features: list[str]
    skills_used: list[str]
    folds: list[dict] = field(default_factory=list)

    @cached_property
    def _collected(self) -> list:
        """All coefficients, intercept first: for models small enough to look at."""
        return self.coefs.orderBy(F.col("key") != INTERCEPT, "key").collect()

    @property
    def names(self) -> list[str]:
        """Feature names as shown, in the order of ``beta``."""
        return [r["key"].removeprefix(SKILL_KEY) for r in self._collected]

    @property
    def beta(self) -> np.ndarray:
        return np.array([r["beta"] for r in self._collected])

    def coefficients(self) -> DataFrame:
        """(feature, coefficient, abs_coeff) without the intercept."""
        return self.coefs.where(F.col("key") != INTERCEPT).select(
            F.regexp_replace("key", f"^{SKILL_KEY}", "").alias("feature"), F.col("beta").alias("coefficient"), F.abs("beta").alias("abs_coeff"))

    def cv_summary(self) -> dict:
        r2 = np.array([f["r2"] for f in self.folds], dtype=float)
        mse = np.array([f["mse"] for f in self.folds], dtype=float)
        return {"r2": float(r2.mean()), "mse": float(mse.mean()),
                "r2_std": float(r2.std()), "mse_std": float(mse.std())}


def _collect_stats(pairs: DataFrame, xty: DataFrame, index: dict[str, int], k: int) -> list[FoldStats]:
    d = len(index)
    stats = [FoldStats(np.zeros((d, d)), np.zeros(d), 0) for _ in range(k)]
    for f, i, j, g in pairs.collect():
        stats[f].g[index[i], index[j]] = g
    for f, i, s, n in xty.select("fold", "i", "xty", "n").collect():
        stats[f].xty[index[i]] = s
        if i == INTERCEPT:
            stats[f].n = int(n)
    return stats


def _r2(sse: float, sst: float) -> float:
    if sst == 0:
        return 1.0 if sse == 0 else 0.0
    return 1.0 - sse / sst


def fit_least_squares(df: DataFrame, skills_long: DataFrame | None, cat_features: Sequence[str],
                      skills_used: Sequence[str], k_folds: int = 0, target: str = "normalized_salary",
                      id_col: str = "posting_id", seed: int = 42,
                      dense_max: int | None = None, cg_tol: float = 1e-12,
                      cg_max_iter: int = 2000) -> LinearModel:
    """J23 + J27 + J28.

    ``df`` must already be the training set (J22). Rows are pre-aggregated by
    (fold, feature pattern). Up to ``MAX_DENSE_FEATURES`` features, one pass gives every
    fold's X'X and X'y and the driver solves d x d systems (train = total -
    fold). Of wider designs (e.g. one-hot titles) the widest category is eliminated. Where
    the other features are too many for that, or beyond a given ``dense_max``, conjugate
    gradients start from zero, stay in the row space and so reach the minimum-norm
    solution; a solve that has not converged raises. Each fold is scored on its patterns: squared
    deviations within a pattern plus n (mean - prediction)^2, a sum of squares that
    holds for targets of any size.
    """
    from hirescope.operators.sampling import fold_of

    cat_features, skills_used = list(cat_features), list(skills_used)
    k = int(k_folds) if k_folds and k_folds >= 2 else 1
    base = with_skill_array(df.select(id_col, target, *cat_features), skills_long, skills_used, id_col)
    fold = fold_of(id_col, k, seed) if k > 1 else None
    pat = cut_lineage(_patterns(design_rows(base, cat_features, target, id_col, fold)).withColumn("pid", F.monotonically_increasing_id()))
    sizes = _feature_counts(pat, cat_features)
    d = sum(sizes.values())
    if d == 0:
        raise ValueError("no training rows")
    wide = _separable(sizes, cat_features)
    if d <= (MAX_DENSE_FEATURES if dense_max is None else dense_max):
        coefs, per_fold = _fit_dense(pat, k)
    elif dense_max is None and wide is not None and (d - sizes[wide]) ** 2 * (k + 1) <= ELIMINATED_ENTRIES:
        coefs, per_fold = _fit_eliminated(pat, k, wide)
    else:
        coefs, per_fold = _fit_cg(pat, k, d, cg_tol, cg_max_iter)
    intercept = coefs.where(F.col("key") == INTERCEPT).first()["beta"]
    folds = fold_scores(pat, per_fold, d * k, wide) if k > 1 else []
    return LinearModel(coefs, float(intercept), d, cat_features, skills_used, folds)


def _level_of(feature: Column, cat: str) -> Column:
    """Whether a feature is a level of ``cat`` (a missing one has the category's bare name)."""
    return feature.startswith(f"{cat}_") | (feature == cat)


def _feature_counts(pat: DataFrame, cat_features: Sequence[str]) -> dict[str | None, int]:
    """Distinct features by category; under None the intercept and the skills."""
    kind = F.lit(None).cast("string")
    for c in cat_features:
        kind = F.when(_level_of(F.col("i"), c), c).otherwise(kind)
    names = pat.select(F.explode("feats").alias("i")).distinct()
    return {r["kind"]: r["n"] for r in names.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).collect()}


def _separable(sizes: dict[str | None, int], cat_features: Sequence[str]) -> str | None:
    """The category of most levels, if no other one's features can be taken for its own."""
    wide = max(cat_features, key=lambda c: sizes.get(c, 0), default=None)
    alike = any(c != wide and (c.startswith(f"{wide}_") or wide.startswith(f"{c}_")) for c in cat_features)
    return None if wide is None or alike else wide


def _fit_dense(pat: DataFrame, k: int) -> tuple[DataFrame, DataFrame | None]:
    """(key, beta) of the fit to all rows, and (fold, i, b) of the fits without a fold."""
    import pandas as pd

    spark = pat.sparkSession
    pairs, xty = _gram_of(pat)
    names = [r[0] for r in xty.select("i").distinct().orderBy("i").collect()]
    index = {n: i for i, n in enumerate(names)}
    stats = _collect_stats(pairs, xty, index, k)
    total_g = sum(s.g for s in stats)
    total_b = sum(s.xty for s in stats)
    coefs = spark.createDataFrame(pd.DataFrame({"key": names, "beta": min_norm_solve(total_g, total_b)}))
    if k == 1:
        return coefs, None
    betas = {f: min_norm_solve(total_g - s.g, total_b - s.xty) for f, s in enumerate(stats) if s.n}
    return coefs, spark.createDataFrame(pd.DataFrame({
        "fold": np.repeat(np.array(list(betas), np.int32), len(names)), "i": names * len(betas), "b": np.concatenate(list(betas.values()))}))


def _fit_eliminated(pat: DataFrame, k: int, wide: str) -> tuple[DataFrame, DataFrame | None]:
    """As ``_fit_dense``, without the levels of ``wide`` in the systems that are solved.

    A row has one of these levels, so their block of X'X is diagonal: given the other
    features' coefficients g, level t has the coefficient m_t - z_t g, with m_t the mean
    target and z_t the mean of the other features over its training rows (0 without any).
    What is left is S g = r, where S and r sum products of deviations from the level's
    means. Of its solutions the one of least norm of all coefficients minimises
    |g|^2 + sum over t of (m_t - z_t g)^2. Both systems are as wide as the other features
    and summed level by level; a level's own coefficient stays in its table.
    """
    import pandas as pd

    spark = pat.sparkSession
    systems = range(k + 1 if k > 1 else 1)
    last = len(systems) - 1
    trains = lambda s: F.lit(1) if s == last else (F.col("fold") != s).cast("int")
    split = pat.select("fold", "n", "sy", F.filter("feats", lambda x: _level_of(x, wide))[0].alias("level"),
                       F.filter("feats", lambda x: ~_level_of(x, wide)).alias("feats"))
    pairs, xty = _gram_of(split)
    names = [r[0] for r in xty.select("i").distinct().orderBy("i").collect()]
    index, m = {name: i for i, name in enumerate(names)}, len(names)
    stats = _collect_stats(pairs, xty, index, k)
    total_g, total_b = sum(s.g for s in stats), sum(s.xty for s in stats)
    at = index[INTERCEPT]
    middle = float(total_b[at] / total_g[at, at])

    # Dealt by level once: rows of each system with the level, and of these with each feature.
    cells = (split.repartition("level").select("level", "fold", "n", "sy", F.explode("feats").alias("i"))
                  .groupBy("level", "i").agg(*[F.sum(F.col("n") * trains(s)).cast("double").alias(f"c{s}") for s in systems],
                                             *[F.sum(F.col("sy") * trains(s)).alias(f"y{s}") for s in systems]))
    whole = F.col("i") == INTERCEPT
    levels = cut_lineage(cells.groupBy("level").agg(
        F.collect_list(F.struct("i", *[f"c{s}" for s in systems])).alias("cells"),  # at most the other features
        *[F.max(F.when(whole, F.col(f"{v}{s}"))).alias(f"{a}{s}") for s in systems for v, a in (("c", "n"), ("y", "y"))]))
    # Nothing of a level without training rows counts.
    per_row = lambda s, value: F.coalesce(F.when(F.col(f"n{s}") > 0, value / F.col(f"n{s}")), F.lit(0.0))
    each = levels.select("*", F.explode("cells").alias("a"))
    shifted = lambda s: F.col(f"y{s}") - F.lit(middle) * F.col(f"n{s}")
    sides = each.groupBy("a.i").agg(
        *[F.sum(per_row(s, shifted(s) * F.col(f"a.c{s}"))).alias(f"h{s}") for s in systems],
        *[F.sum(per_row(s, per_row(s, F.col(f"y{s}") * F.col(f"a.c{s}")))).alias(f"v{s}") for s in systems]).toPandas()
    both = lambda s: F.col(f"a.c{s}") * F.col(f"b.c{s}")
    # A pair is summed once, for both of its places.
    meets = each.select("*", F.explode("cells").alias("b")).where("a.i <= b.i").groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(
        *[F.sum(per_row(s, both(s))).alias(f"h{s}") for s in systems],
        *[F.sum(per_row(s, per_row(s, both(s)))).alias(f"t{s}") for s in systems]).toPandas()
    row, rows, cols = (t.map(index).to_numpy(int) for t in (sides["i"], meets["i"], meets["j"]))

    def square(values: pd.Series) -> np.ndarray:
        out = np.zeros((m, m))
        out[rows, cols] = out[cols, rows] = values
        return out

    solved = np.zeros((len(systems), m))
    for s in systems:
        g, b = (total_g, total_b) if s == last else (total_g - stats[s].g, total_b - stats[s].xty)
        h, v = np.zeros(m), np.zeros(m)
        h[row], v[row] = sides[f"h{s}"], sides[f"v{s}"]
        solved[s] = _least_norm_rest(g, square(meets[f"h{s}"]), square(meets[f"t{s}"]), b - middle * g[:, at] - h, v)

    held = spark.createDataFrame(pd.DataFrame({"i": names, **{f"g{s}": solved[s] for s in systems}}))
    of_rest = (each.select("level", "a.*").join(F.broadcast(held), "i")  # one row per other feature
                   .groupBy("level").agg(*[F.sum(F.col(f"c{s}") * F.col(f"g{s}")).alias(f"u{s}") for s in systems]))
    own = cut_lineage(levels.drop("cells").join(of_rest, "level").select(
        "level", *[per_row(s, F.col(f"y{s}") - F.col(f"u{s}")).alias(f"b{s}") for s in systems]))
    every = held.toDF("key", *[f"b{s}" for s in systems]).unionByName(own.withColumnRenamed("level", "key"))
    coefs = every.select("key", F.col(f"b{last}").alias("beta"))
    if k == 1:
        return coefs, None
    by_fold = F.explode(F.array(*[F.struct(F.lit(f).alias("fold"), F.col(f"b{f}").alias("b")) for f in range(k)]))
    return coefs, every.select(F.col("key").alias("i"), by_fold.alias("c")).select("c.fold", "i", "c.b")


def _least_norm_rest(g: np.ndarray, between: np.ndarray, means: np.ndarray, r: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The other features' coefficients: S = ``g`` - ``between``, the right side ``r``, and
    over the levels the sums of products of means ``means`` and of means with targets ``v``."""
    w, vectors = np.linalg.eigh(g - between)
    # The sums cancel where a feature is constant within each level.
    cut = max(len(g) * np.finfo(float).eps, 1e-12) * float(np.linalg.norm(g, 2))
    inside, free = vectors[:, w > cut], vectors[:, w <= cut]
    x = inside @ ((inside.T @ r) / w[w > cut])
    norm = np.eye(len(g)) + means
    return x + free @ np.linalg.solve(free.T @ norm @ free, free.T @ (v - norm @ x))


def fold_scores(pat: DataFrame, coefs: DataFrame, n_coefs: int, wide: str | None = None) -> list[dict]:
    """Each fold's scores under its own coefficients (fold, i, b), from the patterns. Where
    they are too many to broadcast, only the levels of ``wide`` take the shuffle join."""
    each = pat.select("fold", "pid", F.explode("feats").alias("i"))
    if n_coefs > LEVEL_BROADCAST_ROWS and wide is not None:
        level = _level_of(F.col("i"), wide)
        valued = each.where(level).join(coefs.where(level), ["fold", "i"], "left").unionByName(
            each.where(~level).join(broadcast_if_small(coefs.where(~level)), ["fold", "i"], "left"))
    else:
        valued = each.join(broadcast_if_small(coefs, known_rows=n_coefs), ["fold", "i"], "left")
    predicted = (valued.groupBy("pid").agg(F.sum(F.coalesce("b", F.lit(0.0))).alias("pred")))
    whole = pat.groupBy("fold").agg((F.sum("sy") / F.sum("n")).alias("mean"))
    off = lambda c: F.sum(F.col("within") + F.col("n") * F.pow(F.col("ybar") - F.col(c), 2))
    rows = (pat.join(predicted, "pid").join(F.broadcast(whole), "fold")  # one row per fold
               .groupBy("fold").agg(F.sum("n").alias("n"), off("pred").alias("sse"), off("mean").alias("sst")).orderBy("fold").collect())
    n_all = sum(r["n"] for r in rows)
    return [{"fold": r["fold"], "n_test": int(r["n"]), "n_train": int(n_all - r["n"]), "sse": r["sse"], "sst": r["sst"],
             "r2": float(_r2(r["sse"], r["sst"])), "mse": r["sse"] / r["n"]} for r in rows]


def _fit_cg(pat: DataFrame, k: int, d: int, tol: float, max_iter: int) -> tuple[DataFrame, DataFrame | None]:
    """As ``_fit_dense``, by conjugate gradients without vectors on the driver.

    System f (of k) leaves fold f out, the last one holds all rows. Their solutions,
    residuals and directions are columns of one table keyed by feature; one pass over
    the patterns multiplies every system's matrix with its residual, so passes do not
    grow with k. The recurrence is the one with a single synchronisation a step: the
    driver gets two dot products per system and the intercept's entries. The patterns
    are dealt by their number once; where the residuals may be broadcast, a step
    shuffles partial sums per feature only. Each step's table is written.
    """
    systems = range(k + 1 if k > 1 else 1)
    last = len(systems) - 1
    # A lost block is recomputed from the written patterns.
    dealt = pat.select("pid", "fold", "n", "sy", "feats").repartition("pid").persist()
    trains = lambda s: F.lit(1.0) if s == last else (F.col("fold") != s).cast("double")
    col = lambda name, s: F.col(f"{name}{s}")

    # Beyond a broadcast, the intercept, which every pattern holds, is no key of a shuffle
    # join: its entries come to the driver with the dot products.
    apart = d > LEVEL_BROADCAST_ROWS

    def product(state: DataFrame, at_intercept: list[float]) -> DataFrame:
        """(key, w0, w1, ...): every system's X'X times its residual."""
        vector = state.where(F.col("key") != INTERCEPT) if apart else state
        vector = broadcast_if_small(vector.select("key", *[f"r{s}" for s in systems]), LEVEL_BROADCAST_ROWS, d, d * (64 + 8 * len(systems)))
        each = dealt.select("pid", F.explode("feats").alias("key"))
        sums = ((each.where(F.col("key") != INTERCEPT) if apart else each).join(vector, "key")
                .groupBy("pid").agg(*[F.sum(f"r{s}").alias(f"t{s}") for s in systems]))
        total = [F.coalesce(col("t", s), F.lit(0.0)) + (F.lit(at_intercept[s]) if apart else 0) for s in systems]
        own = [(F.col("n") * trains(s) * total[s]).alias(f"u{s}") for s in systems]
        return (dealt.join(sums, "pid", "left").select(F.explode("feats").alias("key"), *own)
                     .groupBy("key").agg(*[F.sum(f"u{s}").alias(f"w{s}") for s in systems]))

    names = [f"{v}{s}" for v in "rxpq" for s in systems]

    def advance(state: DataFrame, alpha: np.ndarray, beta: np.ndarray) -> DataFrame:
        """The next residuals, solutions and directions. (In numpy: with the step's factors
        as literals Spark would compile every step's plan anew.)"""
        def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = {c: i for i, c in enumerate(batch.schema.names)}
                r, x, p, q, w = (np.array([batch.column(at[f"{v}{s}"]).to_numpy(zero_copy_only=False) for s in systems]) for v in "rxpqw")
                p, q = beta * p + r, beta * q + w
                made = np.concatenate([r - alpha * q, x + alpha * p, p, q])
                yield pa.RecordBatch.from_arrays([batch.column(at["key"]), *map(pa.array, made)], ["key", *names])

        return state.mapInArrow(update, "key string, " + ", ".join(f"{c} double" for c in names))

    try:
        start = (dealt.select("fold", "sy", F.explode("feats").alias("key"))
                      .groupBy("key").agg(*[F.sum(F.col("sy") * trains(s)).alias(f"r{s}") for s in systems]))
        state = cut_lineage(start.select("key", *[f"r{s}" for s in systems], *[F.lit(0.0).alias(f"{v}{s}") for v in "xpq" for s in systems]))
        head = state.where(F.col("key") == INTERCEPT).first()
        at_intercept = [head[f"r{s}"] for s in systems]
        first, before, alpha = [None] * len(systems), [0.0] * len(systems), [0.0] * len(systems)
        size, open_systems = [0.0] * len(systems), set(systems)
        for step in range(max_iter + 1):
            state = cut_lineage(state.join(product(state, at_intercept), "key"))
            here = F.col("key") == INTERCEPT
            told = state.agg(*[F.sum(col("r", s) * col("r", s)).alias(f"rr{s}") for s in systems],
                             *[F.sum(col("r", s) * col("w", s)).alias(f"rw{s}") for s in systems],
                             *[F.max(F.when(here, col(v, s))).alias(f"{v}{s}") for v in "rwq" for s in systems]).first()
            beta = [0.0] * len(systems)
            for s in systems:
                size[s] = told[f"rr{s}"]
                if step == 0:
                    first[s] = size[s]
                if s not in open_systems:
                    continue
                beta[s] = size[s] / before[s] if step else 0.0
                curve = told[f"rw{s}"] - (beta[s] * size[s] / alpha[s] if step else 0.0)
                if size[s] <= tol ** 2 * first[s] or curve <= 0 or step == max_iter:
                    open_systems.discard(s)
                    alpha[s] = beta[s] = 0.0
                else:
                    alpha[s], before[s] = size[s] / curve, size[s]
            if not open_systems:
                break
            at_intercept = [told[f"r{s}"] - alpha[s] * (told[f"w{s}"] + beta[s] * told[f"q{s}"]) for s in systems]
            state = advance(state, np.array(alpha)[:, None], np.array(beta)[:, None])
        for s in systems:  # rounding may stop the descent short of a very small ``tol``
            if size[s] > max(tol, 1e-9) ** 2 * first[s]:
                raise RuntimeError(f"conjugate gradients did not converge: residual {size[s] ** 0.5:.3g} of {first[s] ** 0.5:.3g}")
    finally:
        dealt.unpersist()
    coefs = state.select("key", col("x", last).alias("beta"))
    if k == 1:
        return coefs, None
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("fold"), col("x", f).alias("b")) for f in range(k)]))
    return coefs, state.select(F.col("key").alias("i"), each.alias("c")).select("c.fold", "i", "c.b")


def gram_table(df: DataFrame, skills_long: DataFrame | None, cat_features: Sequence[str],
               skills_used: Sequence[str], target: str = "normalized_salary",
               id_col: str = "posting_id") -> DataFrame:
    """X'X in long form: (feature_i, feature_j, value)."""
    base = with_skill_array(df.select(id_col, target, *cat_features), skills_long, skills_used, id_col)
    pairs, _ = gram_sums(design_rows(base, cat_features, target, id_col))
    shown = lambda c: F.ltrim(F.col(c), F.lit(SKILL_KEY))
    return pairs.select(shown("i").alias("feature_i"), shown("j").alias("feature_j"),
                        F.col("g").cast("double").alias("value"))


def predict(model: LinearModel, df: DataFrame, skills_col: str = "skills", out: str = "predicted") -> DataFrame:
    """b0 + coefficient of each matching level + coefficients of held skills.

    Each category is a broadcast left join with its level table (unknown level
    -> 0), so predicting keeps the partitioning of ``df`` (no shuffle).
    """
    pred, res = F.lit(model.intercept), df
    for c in model.cat_features:
        prefix, tcol = f"{c}_", f"__coef_{c}"
        table = model.coefs.where(F.col("key").startswith(prefix)).select(
            F.substr("key", F.lit(len(prefix) + 1)).alias("__lvl"), F.col("beta").alias(tcol))
        few = model.n_features if model.n_features <= LEVEL_BROADCAST_ROWS else None
        res = res.join(broadcast_if_small(table, LEVEL_BROADCAST_ROWS, known_rows=few),
                       F.col(c).cast("string") == F.col("__lvl"), "left").drop("__lvl")
        pred = pred + F.coalesce(F.col(tcol), F.lit(0.0))
    if model.skills_used:  # at most the skills the caller chose
        held = model.coefs.where(F.col("key").isin([SKILL_KEY + s for s in model.skills_used])).collect()
        if held:
            m = F.create_map(*[x for r in held for x in (F.lit(r["key"].removeprefix(SKILL_KEY)), F.lit(r["beta"]))])
            pred = pred + F.aggregate(F.col(skills_col), F.lit(0.0),
                                      lambda acc, s: acc + F.coalesce(m[s], F.lit(0.0)))
    res = res.withColumn(out, pred)
    return res.drop(*[f"__coef_{c}" for c in model.cat_features])


def scenario_vectors(scenarios: DataFrame) -> DataFrame:
    """J29 input: scenario rows with category columns and a ``skills`` array."""
    if "skills" not in scenarios.columns:
        scenarios = scenarios.withColumn("skills", F.array().cast("array<string>"))
    return scenarios


def regression_metrics(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """R^2, MSE, explained variance, max error, n."""
    e = F.col(actual) - F.col(predicted)
    a = pred.agg(F.count(F.lit(1)).alias("n"), F.avg(actual).alias("ybar"),
                 F.sum(e * e).alias("sse"), F.var_pop(actual).alias("var_y"), F.var_pop(e).alias("var_e"),
                 F.max(F.abs(e)).alias("max_error"))
    sst = F.col("var_y") * F.col("n")
    r2 = (F.when(sst == 0, F.when(F.col("sse") == 0, 1.0).otherwise(0.0))
           .otherwise(1 - F.col("sse") / sst))
    ev = F.when(F.col("var_y") == 0, F.when(F.col("var_e") == 0, 1.0).otherwise(0.0)) \
          .otherwise(1 - F.col("var_e") / F.col("var_y"))
    return a.select("n", r2.alias("r2"), (F.col("sse") / F.col("n")).alias("mse"),
                    ev.alias("explained_variance"), "max_error")


def top_coefficients(coefs: DataFrame, k: int = 10) -> DataFrame:
    """Top K by |coefficient|, shown in signed order."""
    return (coefs.orderBy(F.col("abs_coeff").desc(), "feature").limit(int(k))
                 .orderBy("coefficient", "feature"))


def parity_range(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Axis range over both columns."""
    return pred.agg(F.least(F.min(actual), F.min(predicted)).alias("min_val"),
                    F.greatest(F.max(actual), F.max(predicted)).alias("max_val"))
