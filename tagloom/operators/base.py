"""The one aggregation every metric goes through."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.exprs import text_user

Tables = Callable[[str], DataFrame]
"""Resolves a table name of ``tagloom.sources.schemas`` to a DataFrame."""

BY_ITEM = ("user_id", "item_code")
BY_USER = ("user_id",)


def per_key(facts: DataFrame, by: tuple[str, ...], **metrics: Column) -> DataFrame:
    """Aggregate ``facts`` per key: partial aggregation on the map side, then one shuffle.

    Grouping happens on the user id in its own type; only the much fewer result rows are
    converted to text.
    """
    grouped = facts.groupBy(*by).agg(*[expr.alias(name) for name, expr in metrics.items()])
    return text_user(grouped).select(*by, *metrics)


def tallied(lines: DataFrame, /, *keys: str, **sums: Column) -> DataFrame:
    """``lines`` added up per join key before the join: by default their number, as ``lines``.

    A join key with very many lines reaches the join as one row, or as one per further key,
    because the rows are combined on the map side. Without further keys the join finds its
    input already partitioned, so this takes no exchange of its own. AQE alone would not do:
    it measures bytes, and the lines of one key compress to almost nothing.
    """
    wanted = sums or {"lines": F.count(F.lit(1))}
    return lines.groupBy(*keys).agg(*[expr.alias(name) for name, expr in wanted.items()])


def rows() -> Column:
    return F.count(F.lit(1))


def total(column: str = "lines") -> Column:
    return F.sum(column)


def usages(column: str = "lines") -> Column:
    """Usage counters per item are floating point in the profile documents."""
    return F.sum(column).cast("double")
