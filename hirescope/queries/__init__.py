"""Registered queries: name -> (spark callable, DuckDB oracle SQL or None).

Each module exposes ``QUERIES``; ``all_queries()`` merges them. Oracle SQL
reads the driver's tables through the fixture views of ``FIXTURES.md``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, tuple[QueryFn, str | None]]:
    from hirescope.queries import baskets, text, market, explore, linear, cluster

    out: dict[str, tuple[QueryFn, str | None]] = {}
    for mod in (baskets, text, market, explore, linear, cluster):
        for k, v in mod.QUERIES.items():
            if k in out:
                raise KeyError(f"duplicate query {k}")
            out[k] = v
    return out
