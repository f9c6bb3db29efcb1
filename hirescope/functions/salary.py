"""Salary and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pay-period words (lower case) and the factor that annualises them.
PAY_PERIOD_FACTORS = {
    "hour": 2080, "hourly": 2080,
    "day": 260, "daily": 260,
    "week": 52, "weekly": 52,
    "biweekly": 26,
    "month": 12, "monthly": 12,
    "year": 1, "annual": 1, "annum": 1, "yearly": 1,
}

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_ms_to_timestamp(col: Column | str) -> Column:
    """H4: epoch milliseconds -> timestamp_ntz (UTC wall clock), missing stays missing.

    Zone-free: adds microseconds to the epoch, so the session time zone does not matter.
    """
    c = F.col(col) if isinstance(col, str) else col
    micros = F.round(c.cast("double") * F.lit(1000.0)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH))


def timestamp_to_epoch_ms(col: Column | str) -> Column:
    """Inverse of H4 for timestamp_ntz values (zone-free): epoch ms as a double,
    keeping the microseconds as a fraction."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), c.cast("timestamp_ntz")) / F.lit(1000.0)


def numeric_or_null(col: Column | str) -> Column:
    """H5: bad text -> missing (``try_cast``; ANSI ``cast`` would fail)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("double")


def pay_period_factor(col: Column | str) -> Column:
    """H6: factor for a pay-period word, case-insensitive; unknown -> null."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    expr = None
    for word, f in PAY_PERIOD_FACTORS.items():
        expr = (F.when(c == word, F.lit(float(f))) if expr is None else expr.when(c == word, F.lit(float(f))))
    return expr.otherwise(F.lit(None).cast("double"))


def normalize_salary(df: DataFrame, out: str = "salary") -> DataFrame:
    """Annualised salary from whatever wage columns the table has.

    * min and max present: midpoint (missing if either is missing);
    * med_salary present: it wins where it is given;
    * otherwise a given ``salary`` column is the base;
    * times the pay-period factor where the period is known;
    * ``annual_salary`` (when present) wins over all of that, unscaled.
    """
    cols = set(df.columns)
    base: Column | None = None
    if {"min_salary", "max_salary"} <= cols:
        base = (numeric_or_null("min_salary") + numeric_or_null("max_salary")) / F.lit(2.0)
    elif "salary" in cols:
        base = numeric_or_null("salary")
    if "med_salary" in cols:
        med = numeric_or_null("med_salary")
        base = F.coalesce(med, base) if base is not None else med
    if base is None:
        base = F.lit(None).cast("double")
    if "pay_period" in cols:
        base = F.coalesce(base * pay_period_factor("pay_period"), base)
    if "annual_salary" in cols:
        base = F.coalesce(numeric_or_null("annual_salary"), base)
    return df.withColumn(out, base)
