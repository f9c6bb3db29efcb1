"""Projections and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirescope.execution import broadcast_if_small

# Alternative names of the posting key, tried in this order.
POSTING_ID_ALIASES = ["id", "job_id", "postingId", "postingID", "PostingID"]

# The 19 columns of the posting table view, in display order.
POSTING_TABLE_COLUMNS = [
    "posting_id", "company_id", "company_name", "title", "formatted_experience_level", "description",
    "normalized_salary", "max_salary", "med_salary", "min_salary", "location", "zip_code", "work_type",
    "applies", "listed_time", "expiry", "remote_allowed", "application_type", "job_posting_url",
]

# Filter keys of the market view.
FILTER_KEYS = ["company_name", "title", "location", "work_type", "formatted_experience_level", "skills"]

SALARY_CAP = 2_000_000.0
ISIN_LITERAL_MAX = 1000


def standardize_posting_id(df: DataFrame) -> DataFrame:
    """B1: rename the first present alias to ``posting_id`` (exact-case match)."""
    if "posting_id" in df.columns:
        return df
    for c in POSTING_ID_ALIASES:
        if c in df.columns:
            return df.select(*[F.col(f"`{x}`").alias("posting_id") if x == c else F.col(f"`{x}`")
                               for x in df.columns])
    return df


def posting_table(df: DataFrame) -> DataFrame:
    """The fixed display projection (columns the table has, in display order)."""
    return df.select(*[c for c in POSTING_TABLE_COLUMNS if c in df.columns])


def filter_in_lists(df: DataFrame, filters: Mapping[str, Sequence]) -> DataFrame:
    """Per column value IN list (OR within), AND across columns; empty list = no filter.

    Short lists become ``isin`` (pushed into the parquet scan); long lists a
    broadcast left-semi join.
    """
    spark = df.sparkSession
    for col, vals in filters.items():
        if col == "skills" or not vals:
            continue
        vals = list(vals)
        if len(vals) <= ISIN_LITERAL_MAX:
            df = df.where(F.col(col).isin(vals))
        else:
            dtype = df.schema[col].dataType
            keys = spark.createDataFrame([(v,) for v in vals], T.StructType([T.StructField(col, dtype)]))
            df = df.join(broadcast_if_small(keys, known_rows=len(vals)), col, "left_semi")
    return df


def filter_any_skill(df: DataFrame, skills: DataFrame, chosen: Sequence[str],
                     id_col: str = "posting_id") -> DataFrame:
    """Keep postings that hold at least one chosen skill (semi-join on the long table)."""
    if not chosen:
        return df
    hits = skills.where(F.col("skill").isin(list(chosen))).select(id_col)
    return df.join(hits, id_col, "left_semi")


def salary_ceiling(df: DataFrame, cap: float = SALARY_CAP, col: str = "normalized_salary") -> DataFrame:
    """Keep ``salary <= cap``; missing (and NaN) salaries are dropped too."""
    c = F.col(col)
    return df.where(c.isNotNull() & ~F.isnan(c) & (c <= F.lit(float(cap))))


def _zero_of(dt: T.DataType):
    if isinstance(dt, T.StringType):
        return F.lit("0")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'").cast(dt)
    if isinstance(dt, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dt, T.NumericType):
        return F.lit(0).cast(dt)
    return F.lit(None).cast(dt)


def negative_salary(df: DataFrame, mode: str = "drop", col: str = "normalized_salary") -> DataFrame:
    """Rows with a negative salary.

    ``drop`` (default) removes them; ``zero_row`` reproduces the source
    behaviour of overwriting every column of such a row with 0.
    """
    neg = F.coalesce(F.col(col) < 0, F.lit(False))
    if mode == "drop":
        return df.where(~neg)
    if mode != "zero_row":
        raise ValueError("mode must be 'drop' or 'zero_row'")
    return df.select(*[F.when(neg, _zero_of(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
                       for f in df.schema.fields])


def filter_company_title(df: DataFrame, company: str | None = None, title: str | None = None) -> DataFrame:
    """B8 + B9: optional company equality, optional case-insensitive literal title substring."""
    if company:
        df = df.where(F.col("company_name") == F.lit(company))
    if title:
        hit = F.contains(F.lower(F.col("title")), F.lower(F.lit(title)))
        df = df.where(F.coalesce(hit, F.lit(False)))
    return df


def positive_salary(df: DataFrame, col: str = "normalized_salary") -> DataFrame:
    """Salary > 0."""
    return df.where(F.col(col) > 0)


def dropna_subset(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows missing any of ``cols`` (all columns when None); NaN counts as missing."""
    return df.na.drop(how="any", subset=list(cols) if cols else None)


def apply_filters(df: DataFrame, skills: DataFrame | None, filters: Mapping[str, Sequence],
                  id_col: str = "posting_id") -> DataFrame:
    """B4 then B5 for one filter dict."""
    out = filter_in_lists(df, filters)
    chosen = list(filters.get("skills") or [])
    if chosen:
        if skills is None:
            raise ValueError("a skills table is needed to filter by skill")
        out = filter_any_skill(out, skills, chosen, id_col)
    return out


def filter_with_fallback(df: DataFrame, skills: DataFrame | None, filters: Mapping[str, Sequence],
                         previous: Mapping[str, Sequence] | None = None,
                         id_col: str = "posting_id") -> DataFrame:
    """If the filters leave nothing, apply the previous filters instead.

    The emptiness test runs once (``isEmpty`` stops at the first row).
    """
    out = apply_filters(df, skills, filters, id_col)
    if previous is not None and out.isEmpty():
        out = apply_filters(df, skills, previous, id_col)
    return out
