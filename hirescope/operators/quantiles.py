"""Exact grouped quantiles in fixed memory per group.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so a group holding a third of the data lands in one task.
Here values are selected digit by digit, as in a radix sort that only follows the
digits it needs:

1. each value becomes a 64-bit number that orders as the value does (numpy over Arrow
   batches), and the rows are written once as (group, number);
2. four passes over that table, one per 16-bit digit: the rows that agree with a
   wanted rank on all digits so far are counted by the next digit, for all ranks of all
   groups at once; the digit whose cumulative count reaches a rank is that rank's;
3. the digits found are the values at ranks floor(q (n-1)) and ceil(q (n-1)); linear
   interpolation between them, as in numpy / Spark ``percentile``.

A row meets at most one sequence of digits, so it is counted once a pass whatever the
number of quantiles, and counts are summed before the shuffle. What a group keeps is at
most 65,536 counts per wanted rank, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hirescope.execution import broadcast_if_small, cut_lineage

DIGIT = 16
_SIGN = np.uint64(1 << 63)


@F.arrow_udf(T.LongType())
def _ordered(v: pa.Array) -> pa.Array:
    """A number whose unsigned order is the order of the doubles."""
    bits = v.to_numpy(zero_copy_only=False).astype(np.float64).view(np.uint64)
    return pa.array(np.where(bits & _SIGN, ~bits, bits | _SIGN).view(np.int64))


@F.arrow_udf(T.DoubleType())
def _value(n: pa.Array) -> pa.Array:
    """The double of such a number."""
    bits = n.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return pa.array(np.where(bits & _SIGN, bits ^ _SIGN, ~bits).view(np.float64))


def _select(base: DataFrame, targets: DataFrame) -> DataFrame:
    """(g, rank, v): the value at each wanted ``rank`` (from 0) of each group."""
    found = targets.select("g", "rank", F.col("rank").alias("left"), F.lit(0).cast("long").alias("prefix"))
    window = Window.partitionBy("cg", "cp").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for shift in range(64 - DIGIT, -1, -DIGIT):
        # The first digit has nothing before it, and a shift by 64 is none.
        before = F.shiftrightunsigned("i", shift + DIGIT) if shift + DIGIT < 64 else F.lit(0).cast("long")
        digit = F.shiftrightunsigned("i", shift).bitwiseAND(F.lit((1 << DIGIT) - 1).cast("long"))
        rows = base.select(F.col("bg").alias("cg"), before.alias("cp"), digit.alias("digit"))
        if shift + DIGIT < 64:
            live = broadcast_if_small(found.select("g", "prefix").distinct())
            rows = rows.join(live, F.col("cg").eqNullSafe(F.col("g")) & (F.col("cp") == F.col("prefix"))).drop("g", "prefix")
        counts = rows.groupBy("cg", "cp", "digit").agg(F.count(F.lit(1)).alias("c")).withColumn("cum", F.sum("c").over(window))
        hit = (F.col("cg").eqNullSafe(F.col("g")) & (F.col("cp") == F.col("prefix"))
               & (F.col("cum") > F.col("left")) & (F.col("cum") - F.col("c") <= F.col("left")))
        found = cut_lineage(counts.join(broadcast_if_small(found), hit).select(
            "g", "rank", (F.col("left") - F.col("cum") + F.col("c")).alias("left"),
            F.shiftleft("prefix", DIGIT).bitwiseOR(F.col("digit")).alias("prefix")))
    return found.select("g", "rank", _value("prefix").alias("v"))


def exact_quantiles(rows: DataFrame, group: str, value: str, qs: Sequence[float],
                    names: Sequence[str] | None = None, extra_aggs: Sequence | None = None) -> DataFrame:
    """One row per group: ``group``, ``n``, one column per quantile (``names``)
    and any ``extra_aggs``, over the rows whose value is neither null nor NaN."""
    qs = [float(q) for q in qs]
    names = list(names or [f"q{int(round(q * 100))}" for q in qs])
    v = F.col(value).cast("double")
    given = rows.where(v.isNotNull() & ~F.isnan(v))
    base = cut_lineage(given.select(F.col(group).alias("bg"), _ordered(v).alias("i")))
    groups = cut_lineage(given.groupBy(F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("n"), *list(extra_aggs or [])))
    at = [F.lit(q) * (F.col("n") - 1) for q in qs]
    ends = [(F.floor(p).cast("long"), F.ceil(p).cast("long")) for p in at]
    ranks = F.array_distinct(F.array(*[r for pair in ends for r in pair]))
    picked = _select(base, groups.select(F.col("__g").alias("g"), F.explode(ranks).alias("rank")))
    # At most two ranks a quantile.
    per = picked.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("__at"))
    out = groups.join(broadcast_if_small(per), F.col("__g").eqNullSafe(F.col("g")))

    def quantile(p, low, high):
        a, b = F.col("__at")[low], F.col("__at")[high]
        return F.when(low == high, a).otherwise((high - p) * a + (p - low) * b)

    extra = [c for c in groups.columns if c not in ("__g", "n")]
    return out.select(F.col("__g").alias(group), "n",
                      *[quantile(p, *e).alias(name) for p, e, name in zip(at, ends, names, strict=True)], *extra)
