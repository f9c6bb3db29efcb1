"""The market view - B4, B5, B12 (fall-back), B6, in that order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from hirescope.operators.filters import FILTER_KEYS, SALARY_CAP, filter_with_fallback, salary_ceiling


def empty_filters() -> dict[str, list]:
    """The initial filter map: every key present, no value chosen (no filtering)."""
    return {k: [] for k in FILTER_KEYS}


def market_view(postings: DataFrame, skills: DataFrame | None, filters: Mapping[str, Sequence],
                previous: Mapping[str, Sequence] | None = None, cap: float = SALARY_CAP,
                persist: bool = False) -> DataFrame:
    """Filtered postings shared by every page (A4: ``persist`` and a temp view are the caller's choice)."""
    out = salary_ceiling(filter_with_fallback(postings, skills, filters, previous), cap)
    return out.persist() if persist else out
