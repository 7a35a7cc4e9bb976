"""Keeping an expensive expression from being evaluated more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also when ``body`` uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def add_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` whose results later filters read instead of computing again.

    Catalyst moves a filter below a projection by copying the projected
    expression into it, so a filter on a cleaned text would clean every text
    twice. It does not move one below a one-row generator.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [F.col(f"`{c}`") for c in df.columns]
    return (
        df.select(*kept, F.explode(F.array(row)).alias("_row"))
        .select(*[F.col(f"`{c}`") for c in df.columns if c not in columns],
                *[F.col("_row")[n].alias(n) for n in columns])
    )
