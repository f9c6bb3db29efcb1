"""Exploration aggregates (D1-D9, H11): options, counts, histogram, box summaries.

All of them are one or two aggregations with partial (map-side) aggregation;
top-n cuts are ``orderBy(...).limit(n)`` (TakeOrderedAndProject) with an
explicit tie-break on the label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.execution import broadcast_if_small, cut_lineage
from hirescope.operators.quantiles import exact_quantiles

OPTION_COLUMNS = ["company_name", "title", "location", "work_type", "formatted_experience_level"]
SORTED_OPTION_COLUMNS = ["company_name", "location", "title"]


def filter_options(df: DataFrame, skills: DataFrame | None = None,
                   columns: Sequence[str] = OPTION_COLUMNS) -> DataFrame:
    """Distinct values per filter column (missing counts as a value) + skill names.

    One pass: each row becomes (column, value) pairs, then one ``distinct``.
    """
    cols = [c for c in columns if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    out = df.select(F.explode(pairs).alias("p")).select("p.column", "p.value").distinct()
    if skills is not None:
        out = out.unionByName(skills.select(F.lit("skills").alias("column"), F.col("skill").alias("value")).distinct())
    return out


def sorted_options(df: DataFrame, columns: Sequence[str] = SORTED_OPTION_COLUMNS) -> DataFrame:
    """Sorted distinct non-missing values of the chosen columns, as (column, value)."""
    cols = [c for c in columns if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return (df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")
              .where(F.col("value").isNotNull()).distinct().orderBy("column", "value"))


def posting_count(df: DataFrame) -> DataFrame:
    """D3: number of rows, as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_postings"))


def _label(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit("nan"))


def category_counts(df: DataFrame, col: str, top_n: int = 3) -> DataFrame:
    """Count per category (missing = label 'nan'), most frequent first, top n."""
    return (df.groupBy(_label(col).alias("label")).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), "label").limit(int(top_n)))


def skill_counts(skills: DataFrame, top_n: int = 3, id_col: str = "posting_id") -> DataFrame:
    """Postings per skill (long table), top n."""
    return (skills.select(id_col, "skill").distinct().groupBy("skill").agg(F.count(F.lit(1)).alias("count"))
                  .orderBy(F.col("count").desc(), "skill").limit(int(top_n)))


# --------------------------------------------------------------------------- D7 histogram

def edge_label_value(x: float) -> float:
    """An edge as shown: three decimals, below 1 three significant digits."""
    return round(x, 3) if abs(x) >= 1 else float(f"{x:.3g}")


def histogram_edges(mn: float, mx: float, bins: int) -> list[float]:
    """Edges of ``bins`` right-closed bins of equal width. The lowest edge lies 0.1 % of
    the range below the minimum, so that the minimum falls inside; constant data get a
    range of 0.1 % of their size each way."""
    if bins < 1:
        raise ValueError("bins must be >= 1")
    pad = 0.001 * ((mx - mn) or abs(mn) or 1.0)
    low, high = (mn, mx) if mx > mn else (mn - pad, mx + pad)
    width = (high - low) / bins
    return [mn - pad, *(low + i * width for i in range(1, bins)), high]


def salary_histogram(df: DataFrame, bins: int = 3, col: str = "normalized_salary") -> DataFrame:
    """Counts per salary bin, empty bins kept, missing salaries left out.

    Two passes: min/max (two scalars to the driver), then one grouped count.
    Columns: bin, lo, hi (rounded edges), label ``lo–hi`` (H11), count.
    """
    spark = df.sparkSession
    x = F.col(col)
    vals = df.select(x.cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    mm = vals.agg(F.min("x").alias("mn"), F.max("x").alias("mx")).first()
    if mm is None or mm["mn"] is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, label string, count bigint")
    edges = histogram_edges(float(mm["mn"]), float(mm["mx"]), int(bins))
    b = F.lit(0)
    for e in edges[1:-1]:
        b = b + F.when(F.col("x") > F.lit(e), 1).otherwise(0)
    counts = vals.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    lo = [edge_label_value(e) for e in edges[:-1]]
    hi = [edge_label_value(e) for e in edges[1:]]
    frame = spark.createDataFrame(
        [(i, lo[i], hi[i], f"{lo[i]:,.0f}–{hi[i]:,.0f}") for i in range(int(bins))],
        "bin int, lo double, hi double, label string")
    return (frame.join(F.broadcast(counts), "bin", "left")
                 .select("bin", "lo", "hi", "label", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


# --------------------------------------------------------------------------- D8 / D9 box data

def salary_box_rows(df: DataFrame, group_col: str, top_n: int = 3,
                    salary: str = "normalized_salary") -> DataFrame:
    """D8 rows: (label, salary) for the top-n groups among rows with both values."""
    data = df.select(F.col(group_col).cast("string").alias("label"), F.col(salary).alias(salary)) \
             .na.drop(subset=["label", salary])
    top = (data.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.col("n").desc(), "label").limit(int(top_n)).select("label"))
    return data.join(broadcast_if_small(top, known_rows=int(top_n)), "label", "left_semi")


def salary_box_by_skill_rows(df: DataFrame, skills: DataFrame, top_n: int = 3,
                             salary: str = "normalized_salary", id_col: str = "posting_id") -> DataFrame:
    """D9 rows: a posting counts under each of its skills; skills ranked by postings
    holding them (salary missing or not); rows without salary are then left out."""
    held = df.select(id_col, salary).join(skills.select(id_col, "skill").distinct(), id_col)
    top = (held.groupBy("skill").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.col("n").desc(), "skill").limit(int(top_n)).select("skill"))
    rows = held.join(broadcast_if_small(top, known_rows=int(top_n)), "skill", "left_semi")
    return rows.select(F.col("skill").alias("label"), F.col(salary)).na.drop(subset=[salary])


def box_stats(rows: DataFrame, salary: str = "normalized_salary") -> DataFrame:
    """D8 summary per label: n, q1, median, q3 (linear interpolation), 1.5 IQR fences,
    whiskers (extreme values inside the fences), min, max, number of outliers."""
    rows = cut_lineage(rows.select("label", salary))  # read by the quantiles and the whisker pass
    q = exact_quantiles(rows, "label", salary, (0.25, 0.5, 0.75), names=("q1", "median", "q3"),
                        extra_aggs=[F.min(salary).alias("min"), F.max(salary).alias("max")])
    q = q.select("label", "n", "q1", "median", "q3", "min", "max")
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    s = F.col(salary)
    w = (rows.join(broadcast_if_small(q.select("label", "lo_fence", "hi_fence")), "label")
             .groupBy("label")
             .agg(F.min(F.when(s >= F.col("lo_fence"), s)).alias("whisker_low"),
                  F.max(F.when(s <= F.col("hi_fence"), s)).alias("whisker_high"),
                  F.count(F.when((s < F.col("lo_fence")) | (s > F.col("hi_fence")), 1)).alias("n_outliers")))
    return q.join(w, "label")
