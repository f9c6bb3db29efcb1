"""Deterministic samples and folds.

Seeds of numpy/pandas generators cannot be reproduced on a cluster, so both
use hashes of the row id: the same rows on every run, every partitioning, and
in SQL engines that have md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one digest prefix that are ranked in one task.
RANKED_ROWS = 100_000


def sample_key(id_col: str = "posting_id", seed: int = 42) -> Column:
    """md5 of ``seed:id`` as hex text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def seeded_sample(df: DataFrame, n: int, id_col: str = "posting_id", seed: int = 42) -> DataFrame:
    """exactly ``min(n, rows)`` rows, chosen by the md5 order of ``seed:id``.

    Counts per digest prefix find the prefix in which the n-th row lies; it is
    refined until it holds at most ``RANKED_ROWS`` rows. Everything below it is
    taken by a filter, and only its own rows are ranked, so ``n`` may be as large
    as the table.
    """
    n = int(n)
    keyed = df.withColumn("__key", F.coalesce(sample_key(id_col, seed), F.lit("")))
    prefix, needed = "", n
    while True:
        width = len(prefix) + 4
        inside = keyed.where(F.col("__key").startswith(prefix)) if prefix else keyed
        # At most 16^4 prefixes and the empty one.
        counts = sorted((r["p"], r["n"]) for r in inside.groupBy(F.substring("__key", 1, width).alias("p")).agg(F.count("*").alias("n")).collect())
        size = 0
        for prefix, size in counts:
            if needed <= size:
                break
            needed -= size
        else:
            return df  # n exceeds the table
        if size <= RANKED_ROWS or width >= 32 or len(prefix) < width:
            break
    rank = F.row_number().over(Window.partitionBy("__p").orderBy("__key", id_col))
    edge = keyed.where(F.substring("__key", 1, width) == prefix).withColumn("__p", F.lit(prefix)).withColumn("__rank", rank)
    below = keyed.where((F.col("__key") < prefix) & (F.substring("__key", 1, width) != prefix))
    return below.select(*df.columns).unionByName(edge.where(F.col("__rank") <= needed).select(*df.columns))


def fold_of(id_col: str = "posting_id", k: int = 3, seed: int = 42) -> Column:
    """Fold number in [0, k): the first 32 bits of the md5 digest, modulo k, so
    that folds do not follow any pattern of the ids. A null id gets fold 0."""
    head = F.conv(F.substring(sample_key(id_col, seed), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(head, F.lit(int(k))).cast("int"), F.lit(0))


def kfold_assign(df: DataFrame, k: int = 3, id_col: str = "posting_id", seed: int = 42) -> DataFrame:
    return df.withColumn("fold", fold_of(id_col, k, seed))
