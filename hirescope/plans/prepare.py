"""The batch preparation of postings, as one Spark job.

B1 key rename -> H4 epoch-ms times -> B7 negative salaries -> A2 lexicon ->
J32 phrase matching -> C2 skills per posting id -> A3 parquet sink.

Output is the *long* skill table plus the cleaned postings; the wide 0/1 form
(I1) is an export on request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirescope.functions.salary import epoch_ms_to_timestamp
from hirescope.operators.filters import negative_salary, standardize_posting_id
from hirescope.operators.skills import build_lexicon, extract_skills

TIME_COLUMNS = ("listed_time", "expiry")


def clean_postings(postings: DataFrame, negative: str = "drop") -> DataFrame:
    """B1, H4 (numeric epoch-ms columns only), B7."""
    df = standardize_posting_id(postings)
    for c in TIME_COLUMNS:
        if c in df.columns and isinstance(df.schema[c].dataType, T.NumericType):
            df = df.withColumn(c, epoch_ms_to_timestamp(c))
    if "normalized_salary" in df.columns:
        df = negative_salary(df, mode=negative)
    return df


def prepare(postings: DataFrame, lexicon_raw: DataFrame, negative: str = "drop",
            min_len: int = 1, max_len: int = 4) -> tuple[DataFrame, DataFrame]:
    """Returns ``(clean postings, posting_skill(posting_id, skill))``."""
    clean = clean_postings(postings, negative)
    lex = build_lexicon(lexicon_raw, min_len, max_len)
    skills = extract_skills(clean, lex)
    return clean, skills


def write_prepared(clean: DataFrame, skills: DataFrame, out_dir: str, mode: str = "overwrite") -> None:
    """A3: parquet sink for both tables (the long skill table stays long)."""
    clean.write.mode(mode).parquet(f"{out_dir.rstrip('/')}/postings")
    skills.write.mode(mode).parquet(f"{out_dir.rstrip('/')}/posting_skill")


def with_skill_list(clean: DataFrame, skills: DataFrame, sep: str = ", ") -> DataFrame:
    """Cleaned postings with their sorted skills as text and their number."""
    per = skills.groupBy("posting_id").agg(F.array_sort(F.collect_set("skill")).alias("s"))
    out = clean.join(per, "posting_id", "left")
    return (out.withColumn("n_skills", F.coalesce(F.size("s"), F.lit(0)).cast("bigint"))
               .withColumn("skills", F.coalesce(F.array_join("s", sep), F.lit("")))
               .drop("s"))
