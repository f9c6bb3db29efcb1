"""Frequent item sets and two-sided association rules.

Data model: a long table ``(basket, item)`` (one row per posting and skill)
plus the number of baskets ``n``, which counts baskets without any item too.

Mining works on *patterns*. Baskets become sorted item arrays (the one shuffle of
the input; an array is bounded by the lexicon), keep their frequent items only, and
equal arrays collapse into one row with its number of baskets. The table then has
at most as many rows as there are distinct item combinations. Level k extends each
frequent (k-1)-set of a pattern by a later item of the same row, without a join,
and shuffles only partial counts per candidate set; the frequent sets come back
as a size-checked broadcast filter.

Rules: every unordered pair of disjoint frequent sets A, B (each of at most N
items) whose union is frequent gives A->B and B->A. Instead of a pair loop we
mine unions up to 2N items and split each union into its bipartitions (at most
2^(2N) - 2 per union, N is small), then look up the side counts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.execution import broadcast_if_small, cut_lineage

RULE_METRICS = ("support", "confidence", "lift")


def side_min_count(n: int, min_support: float) -> int:
    """Count a side needs: ceil(n * s) in doubles, at least 1."""
    return max(1, math.ceil(n * float(min_support)))


def union_min_count(n: int, min_support: float) -> int:
    """Smallest count c with c / n >= s in doubles, at least 1."""
    s = float(min_support)
    c = max(1, int(math.floor(n * s)) - 2)
    while c / n < s:
        c += 1
    return c


def _basket_arrays(basket_items: DataFrame, basket: str, item: str) -> DataFrame:
    """One row per basket with its distinct items, sorted: ``basket``, ``items``."""
    rows = (basket_items.select(F.col(basket).alias("basket"), F.col(item).cast("string").alias("item"))
                        .where(F.col("item").isNotNull() & F.col("basket").isNotNull()))
    return rows.groupBy("basket").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _mine(arrays: DataFrame, min_count: int, max_size: int) -> DataFrame:
    """All item sets of size <= max_size with count >= min_count: (items, size, count).

    ``arrays`` holds ``items`` and, with values, ``v``; then sums ``v_sum`` and
    counts ``v_n`` of the values ride along. The collapsed patterns and each
    level's frequent sets are written once below the checkpoint folder.
    """
    with_value = "v" in arrays.columns
    sums = {"count": F.sum("n")} | ({"v_sum": F.sum("v_sum"), "v_n": F.sum("v_n")} if with_value else {})
    carry = ["n"] + (["v_sum", "v_n"] if with_value else [])
    counts = [F.count(F.lit(1)).alias("n")] + ([F.sum("v").alias("v_sum"), F.count("v").alias("v_n")] if with_value else [])

    def frequent(sets: DataFrame) -> DataFrame:
        counted = sets.groupBy("items").agg(*[e.alias(k) for k, e in sums.items()])
        return cut_lineage(counted.where(F.col("count") >= min_count).select("items", F.size("items").alias("size"), *sums))

    # Equal baskets collapse before anything is counted, and once more after the rare
    # items are gone.
    whole = cut_lineage(arrays.groupBy("items").agg(*counts))
    levels = [frequent(whole.select(F.explode("items").alias("item"), *carry).select(F.array("item").alias("items"), *carry))]
    # Frequent items number at most (mean basket size) / support.
    singles = [r[0] for r in levels[0].select(F.element_at("items", 1)).collect()]
    if max_size < 2 or not singles:
        return levels[0]
    sums_of = [F.sum(c).alias(c) for c in carry]
    patterns = cut_lineage(whole.withColumn("items", F.array_intersect("items", F.lit(sorted(singles))))
                                .where(F.size("items") >= 2).groupBy("items").agg(*sums_of))
    # (items: a frequent set held by the pattern, later: the pattern's items after it)
    held = patterns.select(F.posexplode("items").alias("at", "item"), "items", *carry).select(
        F.array("item").alias("items"), F.expr("slice(items, at + 2, size(items))").alias("later"), *carry)
    for _ in range(2, max_size + 1):
        grown = held.select("items", "later", F.posexplode("later").alias("at", "item"), *carry).select(
            F.concat("items", F.array("item")).alias("items"),
            F.expr("slice(later, at + 2, size(later))").alias("later"), *carry)
        level = frequent(grown)
        known = level.count()
        if known == 0:
            break
        levels.append(level)
        held = grown.where(F.size("later") > 0).join(broadcast_if_small(level.select("items"), known_rows=known), "items", "left_semi")
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def frequent_itemsets(basket_items: DataFrame, n_baskets: int, min_support: float, max_size: int,
                      basket: str = "posting_id", item: str = "skill") -> DataFrame:
    """Item sets of at most ``max_size`` items with count >= ceil(n * min_support).

    Returns ``(items array<string> sorted, size int, count long)``.
    """
    if n_baskets <= 0:
        raise ValueError("n_baskets must be positive")
    arrays = _basket_arrays(basket_items, basket, item)
    return _mine(arrays, side_min_count(n_baskets, min_support), max_size)


def association_rules(basket_items: DataFrame, n_baskets: int, min_support: float, max_side: int,
                      top_k: int | None = None, sort_by: str = "confidence",
                      basket: str = "posting_id", item: str = "skill") -> DataFrame:
    """Two-sided rules A -> B with |A|, |B| <= max_side.

    Columns: antecedent, consequent (sorted array<string>), support, confidence,
    lift (rounded half-even to 4 places), correlation (from the rounded lift).
    With ``top_k`` the rules are ordered by ``sort_by`` descending (ties by the
    joined antecedent, then consequent) and cut to K.
    """
    if sort_by not in RULE_METRICS:
        raise ValueError(f"sort_by must be one of {RULE_METRICS}")
    n = int(n_baskets)
    if n <= 0:
        raise ValueError("n_baskets must be positive")
    mined = _mine(_basket_arrays(basket_items, basket, item), union_min_count(n, min_support), 2 * max_side)
    side_min = side_min_count(n, min_support)
    sides = mined.where((F.col("size") <= max_side) & (F.col("count") >= side_min))
    nsides = sides.count()
    side_a = broadcast_if_small(sides.select(F.col("items").alias("antecedent"), F.col("count").alias("count_a")),
                                known_rows=nsides)
    side_b = broadcast_if_small(sides.select(F.col("items").alias("consequent"), F.col("count").alias("count_b")),
                                known_rows=nsides)
    masks = F.expr("sequence(1, CAST(pow(2, size) AS INT) - 2)")
    splits = (mined.where(F.col("size") >= 2)
                   .select("items", F.col("count").alias("count_u"), F.explode(masks).alias("mask"))
                   .select("count_u",
                           F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 1)").alias("antecedent"),
                           F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 0)").alias("consequent"))
                   .where((F.size("antecedent") <= max_side) & (F.size("consequent") <= max_side)))
    nd = float(n)
    sup = F.col("count_u") / F.lit(nd)
    conf = sup / (F.col("count_a") / F.lit(nd))
    lift = conf / (F.col("count_b") / F.lit(nd))
    rules = (splits.join(side_a, "antecedent").join(side_b, "consequent")
                   .select("antecedent", "consequent",
                           F.bround(sup, 4).alias("support"), F.bround(conf, 4).alias("confidence"),
                           F.bround(lift, 4).alias("lift")))
    rules = rules.withColumn(
        "correlation",
        F.when(F.col("lift") > 1, "positive").when(F.col("lift") < 1, "negative").otherwise("independent"))
    if top_k is not None:
        rules = rules.orderBy(F.col(sort_by).desc(), F.array_join("antecedent", ", "),
                              F.array_join("consequent", ", ")).limit(int(top_k))
    return rules


def rules_min_confidence(rules: DataFrame, min_confidence: float = 0.4) -> DataFrame:
    """Keep rules with confidence >= the threshold."""
    return rules.where(F.col("confidence") >= F.lit(float(min_confidence)))


def rules_display(rules: DataFrame, sep: str = ", ") -> DataFrame:
    """H9: item lists as sorted text joined by ``sep``."""
    return rules.withColumn("antecedent", F.array_join(F.array_sort("antecedent"), sep)) \
                .withColumn("consequent", F.array_join(F.array_sort("consequent"), sep))


def lift_heatmap(rules: DataFrame, known_items: DataFrame, max_side: int, grid: int = 10,
                 agg: str = "max", item: str = "skill") -> DataFrame:
    """Lift grid of the best LHS x RHS bundles, in long form.

    Normal form (sorted sides), B13 filters (all items known, sides disjoint,
    sizes <= max_side), duplicate pairs merged by max (or mean), the ``grid``
    best LHS and RHS by their best lift (ties by label), then every cell of
    the kept LHS x RHS grid that the pivot would show, holes filled with 1.0.
    Columns: lhs, rhs (labels joined by " & "), lift.
    """
    r = cut_lineage(rules.select(F.array_sort("antecedent").alias("lhs_set"),
                                 F.array_sort("consequent").alias("rhs_set"), "lift"))
    # Every item must be a known item. Of the known items only those that occur
    # in a rule matter, so their table is read once, filtered, and not shuffled whole.
    sides = r.select("lhs_set", "rhs_set", F.explode(F.array_union("lhs_set", "rhs_set")).alias("it"))
    known = known_items.select(F.col(item).cast("string").alias("it")).join(
        broadcast_if_small(sides.select("it").distinct()), "it", "left_semi").distinct()
    unknown = sides.join(broadcast_if_small(known), "it", "left_anti").select("lhs_set", "rhs_set").distinct()
    r = (r.join(broadcast_if_small(unknown), ["lhs_set", "rhs_set"], "left_anti")
          .where(~F.arrays_overlap("lhs_set", "rhs_set")
                 & (F.size("lhs_set") <= max_side) & (F.size("rhs_set") <= max_side)))
    aggf = F.max if agg == "max" else F.avg
    pair = (r.groupBy(F.array_join("lhs_set", " & ").alias("lhs"), F.array_join("rhs_set", " & ").alias("rhs"))
              .agg(aggf("lift").alias("lift")))
    lhs_keep = (pair.groupBy("lhs").agg(F.max("lift").alias("best"))
                    .orderBy(F.col("best").desc(), "lhs").limit(grid).select("lhs"))
    rhs_keep = (pair.groupBy("rhs").agg(F.max("lift").alias("best"))
                    .orderBy(F.col("best").desc(), "rhs").limit(grid).select("rhs"))
    sub = pair.join(broadcast_if_small(lhs_keep, known_rows=grid), "lhs", "left_semi").join(
        broadcast_if_small(rhs_keep, known_rows=grid), "rhs", "left_semi")
    # Pivot over the (at most ``grid``) RHS labels that survive, holes = 1.0, then back to long form.
    rhs_vals = [r_[0] for r_ in sub.select("rhs").distinct().orderBy("rhs").collect()]
    if not rhs_vals:
        return sub.select("lhs", "rhs", "lift")
    cols = [f"c{i}" for i in range(len(rhs_vals))]
    wide = (sub.withColumn("rc", F.col("rhs"))
               .groupBy("lhs").pivot("rc", rhs_vals).agg(F.max("lift")))
    wide = wide.toDF("lhs", *cols).na.fill(1.0, subset=cols)
    label = F.create_map(*[x for i, v in enumerate(rhs_vals) for x in (F.lit(cols[i]), F.lit(v))])
    long = wide.unpivot("lhs", cols, "col", "lift")
    return long.select("lhs", label[F.col("col")].alias("rhs"), "lift")


def rule_salary_premium(basket_items: DataFrame, postings: DataFrame, n_baskets: int, min_support: float,
                        max_side: int, basket: str = "posting_id", item: str = "skill",
                        salary: str = "normalized_salary") -> DataFrame:
    """Rules with the mean salary of postings holding both sides (and the
    antecedent), and their premium over the overall mean salary.

    The salary rides along with the patterns (sum and count per item set), so no
    rule is ever joined back to the baskets. ``postings`` holds a basket once.
    """
    n = int(n_baskets)
    sal = postings.select(F.col(basket).alias("basket"), F.col(salary).cast("double").alias("v"))
    overall = postings.agg(F.avg(salary)).first()[0]
    arrays = _basket_arrays(basket_items, basket, item).join(sal, "basket", "left")
    mined = _mine(arrays, union_min_count(n, min_support), 2 * max_side)
    side_min = side_min_count(n, min_support)
    sides = mined.where((F.col("size") <= max_side) & (F.col("count") >= side_min))
    nsides = sides.count()
    side_a = broadcast_if_small(sides.select(F.col("items").alias("antecedent"), F.col("count").alias("count_a"),
                                             (F.col("v_sum") / F.col("v_n")).alias("antecedent_mean_salary")),
                                known_rows=nsides)
    side_b = broadcast_if_small(sides.select(F.col("items").alias("consequent"), F.col("count").alias("count_b")),
                                known_rows=nsides)
    masks = F.expr("sequence(1, CAST(pow(2, size) AS INT) - 2)")
    splits = (mined.where(F.col("size") >= 2)
                   .select("items", F.col("count").alias("count_u"),
                           (F.col("v_sum") / F.col("v_n")).alias("pair_mean_salary"), F.explode(masks).alias("mask"))
                   .select("count_u", "pair_mean_salary",
                           F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 1)").alias("antecedent"),
                           F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 0)").alias("consequent"))
                   .where((F.size("antecedent") <= max_side) & (F.size("consequent") <= max_side)))
    nd = float(n)
    sup = F.col("count_u") / F.lit(nd)
    conf = sup / (F.col("count_a") / F.lit(nd))
    ov = F.lit(overall).cast("double")
    return (splits.join(side_a, "antecedent").join(side_b, "consequent")
                  .select("antecedent", "consequent", F.bround(sup, 4).alias("support"),
                          F.bround(conf, 4).alias("confidence"),
                          ov.alias("overall_mean_salary"), "pair_mean_salary",
                          (F.col("pair_mean_salary") - ov).alias("pair_premium_vs_overall"),
                          "antecedent_mean_salary",
                          (F.col("antecedent_mean_salary") - ov).alias("antecedent_premium_vs_overall"),
                          F.col("count_a").alias("antecedent_n")))
