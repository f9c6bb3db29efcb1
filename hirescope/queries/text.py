"""Queries for text normalisation, lexicon and skill extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions.text import count_ngrams, norm
from hirescope.operators import skills as SK
from hirescope.sources import fixtures as fx

MAX_LEN = 4
WIDE = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _docs(spark, sf):
    return fx.posting_texts(spark, sf)


def _lex(spark, sf, max_len=MAX_LEN):
    return SK.build_lexicon(fx.raw_lexicon(spark, sf), 1, max_len)


def q_text_norm(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("posting_id", norm(F.coalesce("description", F.lit(""))).alias("norm_text"))


def q_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = SK.text_tokens(_docs(spark, sf))
    return t.select("posting_id", F.size("toks").cast("bigint").alias("n_tokens"))


def q_ngram_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = SK.text_tokens(_docs(spark, sf))
    told = [(n, *count_ngrams("toks", n)) for n in range(1, MAX_LEN + 1)]
    per_n = F.array(*[F.struct(F.lit(n).cast("bigint").alias("n"), grams.cast("bigint").alias("n_grams"),
                               distinct.cast("bigint").alias("n_distinct")) for n, grams, distinct in told])
    return t.select("posting_id", F.inline(per_n))


def q_lexicon_build(spark: SparkSession, sf: str) -> DataFrame:
    return _lex(spark, sf).select("phrase", F.col("n_words").cast("bigint").alias("n_words"))


def q_skill_extract(spark: SparkSession, sf: str) -> DataFrame:
    return SK.extract_skills(_docs(spark, sf), _lex(spark, sf))


def q_skill_doc_freq(spark: SparkSession, sf: str) -> DataFrame:
    found = SK.extract_skills(SK.distinct_descriptions(_docs(spark, sf)), _lex(spark, sf))
    return SK.skill_doc_freq(found, 10)


def q_distinct_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    return SK.distinct_descriptions(_docs(spark, sf))


def q_skill_postings(spark: SparkSession, sf: str) -> DataFrame:
    return SK.skill_postings(SK.extract_skills(_docs(spark, sf), _lex(spark, sf)))


def q_skill_wide(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.postings(spark, sf).select("posting_id", "company_name")
    return SK.skill_wide(p, fx.posting_skills(spark, sf), names=WIDE)


def q_skill_flags_by_id(spark: SparkSession, sf: str) -> DataFrame:
    """C2 with repeated posting ids: every row of an id gets the id's skills."""
    p = fx.postings(spark, sf).select("posting_id", "company_name")
    flags = SK.skill_flags(p.unionByName(p.where("posting_id % 10 = 0")), fx.posting_skills(spark, sf))
    return flags.select("posting_id", "company_name", F.array_join("skills", ", ").alias("skills"))


def q_skill_matrix(spark: SparkSession, sf: str) -> DataFrame:
    m, _ = SK.skill_matrix(_docs(spark, sf), fx.raw_lexicon(spark, sf), max_phrase_len=3, min_skill_df=10)
    return m.select("posting_id", "skill", F.col("col").cast("bigint").alias("col"))


def q_skill_matrix_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """I3 with company and title: the texts of one source whose title, here language and id, holds ' EN'."""
    docs = _docs(spark, sf).withColumn("title", F.concat_ws(" ", F.lit("Text"), F.col("work_type"), F.col("posting_id").cast("string")))
    company = docs.agg(F.min("company_name")).first()[0]
    m, _ = SK.skill_matrix(docs, fx.raw_lexicon(spark, sf), company, " EN", max_phrase_len=3, min_skill_df=2)
    return m.select("posting_id", "skill", F.col("col").cast("bigint").alias("col"))


# --------------------------------------------------------------------------- oracle SQL

def norm_sql(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9+#./\\- ]', ' ', 'g'), ' +', ' ', 'g'))")


def toks_sql(x: str) -> str:
    return f"list_filter(string_split({norm_sql(x)}, ' '), lambda w: w <> '')"


def grams_sql(t: str, n: int) -> str:
    if n == 1:
        return t
    return f"list_transform(range(1, len({t}) - {n} + 2), lambda i: array_to_string({t}[i:i + {n} - 1], ' '))"


def lex_cte(max_len: int = MAX_LEN) -> str:
    return f"""lex AS (
  SELECT DISTINCT phrase, CAST(len(string_split(phrase, ' ')) AS BIGINT) AS n_words
  FROM (SELECT {norm_sql('CAST(Skill AS VARCHAR)')} AS phrase FROM L WHERE Skill IS NOT NULL)
  WHERE phrase <> '' AND len(string_split(phrase, ' ')) BETWEEN 1 AND {max_len}
)"""


def extract_cte(src: str = "D", max_len: int = MAX_LEN, name: str = "found") -> str:
    gl = ", ".join(grams_sql("t", n) for n in range(1, max_len + 1))
    return f"""{name}_docs AS (SELECT posting_id, {toks_sql("coalesce(description, '')")} AS t FROM {src}),
{name}_grams AS (SELECT posting_id, unnest(list_concat({gl})) AS skill FROM {name}_docs),
{name} AS (SELECT DISTINCT g.posting_id, g.skill FROM {name}_grams g JOIN lex l ON l.phrase = g.skill)"""


DDESC = """ddesc AS (SELECT min(posting_id) AS posting_id, description
  FROM (SELECT posting_id, coalesce(description, '') AS description FROM D) GROUP BY description)"""

DESC = "coalesce(description, '')"

SQL = {
    "text_norm": fx.with_views(f"SELECT posting_id, {norm_sql(DESC)} AS norm_text FROM D", "D"),
    "token_counts": fx.with_views(f"SELECT posting_id, CAST(len({toks_sql(DESC)}) AS BIGINT) AS n_tokens FROM D", "D"),
    "ngram_counts": fx.with_views(
        "SELECT posting_id, CAST(n AS BIGINT) AS n, CAST(len(g) AS BIGINT) AS n_grams, "
        "CAST(len(list_distinct(g)) AS BIGINT) AS n_distinct FROM (" +
        " UNION ALL ".join(f"SELECT posting_id, {n} AS n, {grams_sql('t', n)} AS g FROM tk" for n in range(1, MAX_LEN + 1)) + ")",
        "D", extra=f"tk AS (SELECT posting_id, {toks_sql(DESC)} AS t FROM D)"),
    "lexicon_build": fx.with_views("SELECT phrase, n_words FROM lex", "L", extra=lex_cte()),
    "skill_extract": fx.with_views("SELECT posting_id, skill FROM found", "D", "L",
                                   extra=lex_cte() + ",\n" + extract_cte()),
    "skill_doc_freq": fx.with_views("SELECT skill, count(*) AS doc_freq FROM found GROUP BY skill HAVING count(*) >= 10",
                                    "D", "L", extra=DDESC + ",\n" + lex_cte() + ",\n" + extract_cte("ddesc")),
    "distinct_descriptions": fx.with_views("SELECT posting_id, description FROM ddesc", "D", extra=DDESC),
    "skill_postings": fx.with_views("SELECT skill, posting_id FROM found", "D", "L",
                                    extra=lex_cte() + ",\n" + extract_cte()),
    "skill_wide": fx.with_views("SELECT p.posting_id, p.company_name, " + ", ".join(
        f"CAST(EXISTS (SELECT 1 FROM S WHERE S.posting_id = p.posting_id AND S.skill = '{v}') AS INTEGER) AS \"skill_{v}\"" for v in WIDE) + " FROM P p", "P", "S"),
    "skill_flags_by_id": fx.with_views("""
SELECT p.posting_id, p.company_name, coalesce(s.skills, '') AS skills
FROM (SELECT * FROM P UNION ALL SELECT * FROM P WHERE posting_id % 10 = 0) p
LEFT JOIN (SELECT posting_id, string_agg(skill, ', ' ORDER BY skill) AS skills FROM S GROUP BY posting_id) s USING (posting_id)""", "P", "S"),
    "skill_matrix": fx.with_views("""
SELECT f.posting_id, f.skill, CAST(v.col AS BIGINT) AS col
FROM found f JOIN (SELECT skill, row_number() OVER (ORDER BY skill) - 1 AS col
                   FROM found GROUP BY skill HAVING count(*) >= 10) v ON v.skill = f.skill""",
        "D", "L", extra=DDESC + ",\n" + lex_cte(3) + ",\n" + extract_cte("ddesc", 3)),
    "skill_matrix_filtered": fx.with_views("""
SELECT f.posting_id, f.skill, CAST(v.col AS BIGINT) AS col
FROM found f JOIN (SELECT skill, row_number() OVER (ORDER BY skill) - 1 AS col
                   FROM found GROUP BY skill HAVING count(*) >= 2) v ON v.skill = f.skill""",
        "D", "L", extra="""ddesc AS (SELECT min(posting_id) AS posting_id, description FROM (
  SELECT posting_id, coalesce(description, '') AS description FROM D
  WHERE company_name = (SELECT min(company_name) FROM D) AND contains(lower('Text ' || work_type || ' ' || posting_id), ' en'))
  GROUP BY description),
""" + lex_cte(3) + ",\n" + extract_cte("ddesc", 3)),
}

QUERIES = {
    "text_norm": (q_text_norm, SQL["text_norm"]),
    "token_counts": (q_token_counts, SQL["token_counts"]),
    "ngram_counts": (q_ngram_counts, SQL["ngram_counts"]),
    "lexicon_build": (q_lexicon_build, SQL["lexicon_build"]),
    "skill_extract": (q_skill_extract, SQL["skill_extract"]),
    "skill_doc_freq": (q_skill_doc_freq, SQL["skill_doc_freq"]),
    "distinct_descriptions": (q_distinct_descriptions, SQL["distinct_descriptions"]),
    "skill_postings": (q_skill_postings, SQL["skill_postings"]),
    "skill_wide": (q_skill_wide, SQL["skill_wide"]),
    "skill_flags_by_id": (q_skill_flags_by_id, SQL["skill_flags_by_id"]),
    "skill_matrix": (q_skill_matrix, SQL["skill_matrix"]),
    "skill_matrix_filtered": (q_skill_matrix_filtered, SQL["skill_matrix_filtered"]),
}
