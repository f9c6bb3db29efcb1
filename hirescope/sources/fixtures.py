"""Stand-in views over the driver's TPC-H-like tables (see FIXTURES.md).

Each view has a DataFrame builder (what the Spark queries read) and the same
view as DuckDB SQL (what the oracle reads). The two are kept side by side so a
change to one is visible next to the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.sources.tables import load_table


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return load_table(spark, sf, name)


def postings(spark: SparkSession, sf: str) -> DataFrame:
    """P: one posting per order, company = customer segment, title = customer name."""
    o = _t(spark, sf, "orders")
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, c.c_nationkey == n.n_nationkey)
             .select(o.o_orderkey.alias("posting_id"), c.c_custkey.alias("company_id"),
                     c.c_mktsegment.alias("company_name"), c.c_name.alias("title"),
                     n.n_name.alias("location"), o.o_orderpriority.alias("work_type"),
                     o.o_orderstatus.alias("formatted_experience_level"),
                     o.o_totalprice.alias("normalized_salary"),
                     o.o_orderdate.alias("listed_time")))


def postings_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """PN: P with missing company names and salaries."""
    p = postings(spark, sf)
    pid = F.col("posting_id")
    return p.select(
        "posting_id", "title", "location", "work_type",
        F.when(pid % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("company_name")).alias("company_name"),
        F.when(pid % 23 == 0, F.lit(None).cast("double")).otherwise(F.col("normalized_salary")).alias("normalized_salary"),
    )


def _skills(spark: SparkSession, sf: str, attr: str) -> DataFrame:
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    pa = _t(spark, sf, "part").select("p_partkey", attr)
    return (li.join(pa, li.l_partkey == pa.p_partkey)
              .select(F.col("l_orderkey").alias("posting_id"), F.col(attr).alias("skill"))
              .distinct())


def posting_skills(spark: SparkSession, sf: str) -> DataFrame:
    """S: (posting_id, skill) with 6 skill values."""
    return _skills(spark, sf, "p_type")


def posting_brands(spark: SparkSession, sf: str) -> DataFrame:
    """SB: (posting_id, skill) with 25 skill values."""
    return _skills(spark, sf, "p_brand")


def customer_postings(spark: SparkSession, sf: str) -> DataFrame:
    """C: postings that include negative salaries."""
    return _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("posting_id"), F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("company_name"), F.col("c_acctbal").alias("normalized_salary"))


def raw_wages(spark: SparkSession, sf: str) -> DataFrame:
    """W: raw wage fields as text/double with pay periods."""
    s = F.col("p_size")
    period = (F.when(s % 8 == 0, "HOURLY").when(s % 8 == 1, "weekly").when(s % 8 == 2, "Biweekly")
               .when(s % 8 == 3, "MONTHLY").when(s % 8 == 4, "yearly").when(s % 8 == 5, "daily")
               .when(s % 8 == 6, "contract").otherwise(F.lit(None).cast("string")))
    return _t(spark, sf, "part").select(
        F.col("p_partkey").alias("posting_id"),
        F.when(s % 6 == 0, F.lit("n/a")).otherwise((s * 10).cast("string")).alias("min_salary"),
        F.when(s % 7 == 0, F.lit(None).cast("double")).otherwise(s * 12.0).cast("double").alias("max_salary"),
        F.when(s % 5 == 0, s * 11.0).otherwise(F.lit(None).cast("double")).cast("double").alias("med_salary"),
        period.alias("pay_period"))


def posting_texts(spark: SparkSession, sf: str) -> DataFrame:
    """D: one posting per document."""
    return _t(spark, sf, "documents").select(
        F.col("doc_id").alias("posting_id"), F.col("source").alias("company_name"),
        F.col("lang").alias("work_type"), F.col("text").alias("description"))


# Fixed values of the raw lexicon fixture (FIXTURES.md §2, view L).
LEXICON_LITERALS = ["THE", " of   the ", "the and attion to", "Thanedble the anea. eriner",
                    "in", "de de", "!!!", None, "one two three four five"]


def raw_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """L: raw lexicon rows (column ``Skill``) cut from benchmark texts plus edge cases."""
    b = _t(spark, sf, "benchmark")
    words = F.split(F.col("text"), " ")
    windows = [F.array_join(F.slice(words, a, n), " ") for a in (1, 6) for n in range(1, 6)]
    cut = b.select(F.explode(F.array(*windows)).alias("Skill"))
    lits = spark.createDataFrame([(x,) for x in LEXICON_LITERALS], "Skill string")
    return lits.unionByName(cut)


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """E: vectors as array<double>."""
    return _t(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")


# ---------------------------------------------------------------------------
# DuckDB SQL for the same views (used by oracle_sql()).

VIEW_SQL: dict[str, str] = {
    "P": """SELECT o.o_orderkey AS posting_id, c.c_custkey AS company_id, c.c_mktsegment AS company_name,
       c.c_name AS title, n.n_name AS location, o.o_orderpriority AS work_type,
       o.o_orderstatus AS formatted_experience_level, o.o_totalprice AS normalized_salary,
       o.o_orderdate AS listed_time
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
              JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "PN": """SELECT posting_id, title, location, work_type,
       CASE WHEN posting_id % 17 = 0 THEN NULL ELSE company_name END AS company_name,
       CASE WHEN posting_id % 23 = 0 THEN NULL ELSE normalized_salary END AS normalized_salary
FROM P""",
    "S": """SELECT DISTINCT l.l_orderkey AS posting_id, p.p_type AS skill
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "SB": """SELECT DISTINCT l.l_orderkey AS posting_id, p.p_brand AS skill
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "C": """SELECT c_custkey AS posting_id, c_name AS title, c_mktsegment AS company_name,
       c_acctbal AS normalized_salary
FROM customer""",
    "W": """SELECT p_partkey AS posting_id,
       CASE WHEN p_size % 6 = 0 THEN 'n/a' ELSE CAST(p_size * 10 AS VARCHAR) END AS min_salary,
       CAST(CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size * 12.0 END AS DOUBLE) AS max_salary,
       CAST(CASE WHEN p_size % 5 = 0 THEN p_size * 11.0 ELSE NULL END AS DOUBLE) AS med_salary,
       CASE p_size % 8 WHEN 0 THEN 'HOURLY' WHEN 1 THEN 'weekly' WHEN 2 THEN 'Biweekly'
            WHEN 3 THEN 'MONTHLY' WHEN 4 THEN 'yearly' WHEN 5 THEN 'daily'
            WHEN 6 THEN 'contract' ELSE NULL END AS pay_period
FROM part""",
    "D": """SELECT doc_id AS posting_id, source AS company_name, lang AS work_type, text AS description
FROM documents""",
    "L": """SELECT * FROM (VALUES ('THE'), (' of   the '), ('the and attion to'), ('Thanedble the anea. eriner'),
       ('in'), ('de de'), ('!!!'), (NULL), ('one two three four five')) v(Skill)
UNION ALL
SELECT array_to_string(list_slice(string_split(text, ' '), a, a + n - 1), ' ') AS Skill
FROM benchmark, (VALUES (1), (6)) s(a), (VALUES (1), (2), (3), (4), (5)) w(n)""",
    "E": """SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings""",
}

_DEPS = {"PN": ["P"]}
_ORDER = ["P", "PN", "S", "SB", "C", "W", "D", "L", "E"]


def with_views(body: str, *names: str, extra: str = "", recursive: bool = False) -> str:
    """Prefix ``body`` with the CTEs for the named views (and their dependencies).

    ``extra`` holds further CTE definitions (``name AS (...)``, comma separated)
    that may refer to the views; ``recursive`` emits ``WITH RECURSIVE``.
    """
    need: set[str] = set()

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        need.add(n)

    for n in names:
        add(n)
    parts = [f"{n} AS (\n{VIEW_SQL[n]}\n)" for n in _ORDER if n in need]
    if extra.strip():
        parts.append(extra.strip().rstrip(","))
    if not parts:
        return body
    kw = "WITH RECURSIVE" if recursive else "WITH"
    return f"{kw} " + ",\n".join(parts) + "\n" + body
