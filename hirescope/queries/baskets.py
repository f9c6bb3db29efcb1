"""Queries for frequent sets, rules and the lift heat-map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.operators import baskets as B
from hirescope.sources import fixtures as fx

SUPPORT, SIDE, TOPK = 0.05, 3, 100


def _n(spark: SparkSession, sf: str) -> int:
    return fx.postings(spark, sf).count()


def _rules(spark: SparkSession, sf: str, top_k=None, sort_by="confidence",
           support=SUPPORT, side=SIDE) -> DataFrame:
    return B.association_rules(fx.posting_skills(spark, sf), _n(spark, sf), support, side,
                               top_k=top_k, sort_by=sort_by)


def q_frequent_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    f = B.frequent_itemsets(fx.posting_brands(spark, sf), _n(spark, sf), 0.02, 2)
    return f.select(F.array_join("items", ", ").alias("items"), F.col("size").cast("bigint").alias("size"),
                    F.col("count").cast("bigint").alias("count"))


def q_association_rules(spark: SparkSession, sf: str) -> DataFrame:
    return B.rules_display(_rules(spark, sf))


def _topk(metric: str):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return B.rules_display(_rules(spark, sf, top_k=TOPK, sort_by=metric))
    return q


def q_rules_min_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return B.rules_display(B.rules_min_confidence(_rules(spark, sf), 0.4))


def q_rules_display(spark: SparkSession, sf: str) -> DataFrame:
    return B.rules_display(_rules(spark, sf, top_k=TOPK, sort_by="lift"), sep=" & ")


def q_lift_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    skills = fx.posting_skills(spark, sf)
    rules = B.association_rules(skills, _n(spark, sf), SUPPORT, SIDE, top_k=TOPK, sort_by="confidence")
    return B.lift_heatmap(rules, skills, SIDE, grid=10)


def q_rule_salary_premium(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.postings(spark, sf)
    r = B.rule_salary_premium(fx.posting_skills(spark, sf), p, p.count(), SUPPORT, SIDE)
    money = ["overall_mean_salary", "pair_mean_salary", "pair_premium_vs_overall",
             "antecedent_mean_salary", "antecedent_premium_vs_overall"]
    return B.rules_display(r).select("antecedent", "consequent", "support", "confidence",
                                     *[F.bround(c, 2).alias(c) for c in money], "antecedent_n")


# --------------------------------------------------------------------------- oracle SQL

def _rules_sql(support: float, side: int, view: str = "S") -> str:
    s = f"CAST({support!r} AS DOUBLE)"
    extra = f"""
nb AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM P),
bi AS (SELECT DISTINCT posting_id AS basket, skill AS item FROM {view}),
sub(basket, items, last) AS (
  SELECT basket, [item], item FROM bi
  UNION ALL
  SELECT s.basket, list_append(s.items, b.item), b.item
  FROM sub s JOIN bi b ON b.basket = s.basket AND b.item > s.last
  WHERE len(s.items) < {2 * side}
),
cnt AS (SELECT items, count(*) AS c FROM sub GROUP BY items),
fs AS (SELECT items, c FROM cnt, nb WHERE c >= greatest(1, ceil(nb.n * {s})) AND len(items) <= {side}),
pairs AS (
  SELECT a.items AS A, b.items AS B, a.c AS ca, b.c AS cb, u.c AS cu, nb.n AS n
  FROM fs a JOIN fs b ON NOT list_has_any(a.items, b.items)
  JOIN cnt u ON u.items = list_sort(list_concat(a.items, b.items))
  CROSS JOIN nb
  WHERE u.c / nb.n >= {s}
),
rules AS (
  SELECT A, B, round_even(cu / n, 4) AS support,
         round_even((cu / n) / (ca / n), 4) AS confidence,
         round_even(((cu / n) / (ca / n)) / (cb / n), 4) AS lift
  FROM pairs
),
rules_l AS (
  SELECT A, B, support, confidence, lift,
         CASE WHEN lift > 1 THEN 'positive' WHEN lift < 1 THEN 'negative' ELSE 'independent' END AS correlation
  FROM rules
)"""
    return extra


def _rules_body(sep=", ", order=None, limit=None, where="") -> str:
    q = (f"SELECT array_to_string(A, '{sep}') AS antecedent, array_to_string(B, '{sep}') AS consequent, "
         f"support, confidence, lift, correlation FROM rules_l {where}")
    if order:
        q += f" ORDER BY {order} DESC, array_to_string(A, ', '), array_to_string(B, ', ') LIMIT {limit}"
    return q


def _sql_rules(body: str) -> str:
    return fx.with_views(body, "P", "S", extra=_rules_sql(SUPPORT, SIDE), recursive=True)


SQL_FREQUENT = fx.with_views("""
SELECT array_to_string(items, ', ') AS items, CAST(len(items) AS BIGINT) AS size, CAST(c AS BIGINT) AS count
FROM cnt, nb WHERE c >= greatest(1, ceil(nb.n * CAST(0.02 AS DOUBLE)))""", "P", "SB", extra="""
nb AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM P),
bi AS (SELECT DISTINCT posting_id AS basket, skill AS item FROM SB),
sub(basket, items, last) AS (
  SELECT basket, [item], item FROM bi
  UNION ALL
  SELECT s.basket, list_append(s.items, b.item), b.item
  FROM sub s JOIN bi b ON b.basket = s.basket AND b.item > s.last
  WHERE len(s.items) < 2
),
cnt AS (SELECT items, count(*) AS c FROM sub GROUP BY items)""", recursive=True)

SQL_HEATMAP = fx.with_views("""
SELECT l.lhs, r.rhs, coalesce(p.lift, 1.0) AS lift
FROM (SELECT DISTINCT lhs FROM cells) l CROSS JOIN (SELECT DISTINCT rhs FROM cells) r
LEFT JOIN cells p ON p.lhs = l.lhs AND p.rhs = r.rhs""", "P", "S", extra=_rules_sql(SUPPORT, SIDE) + """,
top AS (SELECT * FROM rules_l ORDER BY confidence DESC, array_to_string(A, ', '), array_to_string(B, ', ') LIMIT 100),
pair AS (SELECT array_to_string(list_sort(A), ' & ') AS lhs, array_to_string(list_sort(B), ' & ') AS rhs, max(lift) AS lift
         FROM top WHERE NOT list_has_any(A, B) AND len(A) <= 3 AND len(B) <= 3 GROUP BY 1, 2),
lk AS (SELECT lhs FROM pair GROUP BY lhs ORDER BY max(lift) DESC, lhs LIMIT 10),
rk AS (SELECT rhs FROM pair GROUP BY rhs ORDER BY max(lift) DESC, rhs LIMIT 10),
cells AS (SELECT * FROM pair WHERE lhs IN (SELECT lhs FROM lk) AND rhs IN (SELECT rhs FROM rk))""", recursive=True)


SQL_PREMIUM = fx.with_views("""
SELECT array_to_string(A, ', ') AS antecedent, array_to_string(B, ', ') AS consequent,
       round_even(cu / n, 4) AS support, round_even((cu / n) / (ca / n), 4) AS confidence,
       round_even(o.m, 2) AS overall_mean_salary, round_even(su.m, 2) AS pair_mean_salary,
       round_even(su.m - o.m, 2) AS pair_premium_vs_overall,
       round_even(sa.m, 2) AS antecedent_mean_salary, round_even(sa.m - o.m, 2) AS antecedent_premium_vs_overall,
       ca AS antecedent_n
FROM pairs
JOIN setsal su ON su.items = list_sort(list_concat(A, B))
JOIN setsal sa ON sa.items = A
CROSS JOIN (SELECT avg(normalized_salary) AS m FROM P) o""", "P", "S", extra=_rules_sql(SUPPORT, SIDE) + """,
subsal AS (SELECT s.items, p.normalized_salary AS v FROM sub s JOIN P p ON p.posting_id = s.basket),
setsal AS (SELECT items, avg(v) AS m FROM subsal GROUP BY items)""", recursive=True)

QUERIES = {
    "frequent_itemsets": (q_frequent_itemsets, SQL_FREQUENT),
    "association_rules": (q_association_rules, _sql_rules(_rules_body())),
    "rules_topk_support": (_topk("support"), _sql_rules(_rules_body(order="support", limit=TOPK))),
    "rules_topk_confidence": (_topk("confidence"), _sql_rules(_rules_body(order="confidence", limit=TOPK))),
    "rules_topk_lift": (_topk("lift"), _sql_rules(_rules_body(order="lift", limit=TOPK))),
    "rules_min_confidence": (q_rules_min_confidence, _sql_rules(_rules_body(where="WHERE confidence >= 0.4"))),
    "rules_display": (q_rules_display, _sql_rules(_rules_body(sep=" & ", order="lift", limit=TOPK))),
    "lift_heatmap": (q_lift_heatmap, SQL_HEATMAP),
    "rule_salary_premium": (q_rule_salary_premium, SQL_PREMIUM),
}
