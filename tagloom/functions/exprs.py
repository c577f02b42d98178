"""Column builders shared by the operators. All of them are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any of ``columns``.

    An explicit conjunction rather than ``na.drop``: the null tests then reach the scan,
    and Catalyst may turn an outer join below them into an inner one.
    """
    if not columns:
        return df
    checks = []
    for name in columns:
        checks.append(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            checks.append(~F.isnan(name))
    return df.filter(reduce(and_, checks))


def valid_users(df: DataFrame, column: str = "user_id") -> DataFrame:
    """Keep rows with a usable user id: not NULL and, for text ids, not blank."""
    kept = df.filter(F.col(column).isNotNull())
    if isinstance(df.schema[column].dataType, T.StringType):
        kept = kept.filter(F.trim(column) != "")
    return kept


def text_user(df: DataFrame) -> DataFrame:
    """Give ``user_id`` the text type that every result carries."""
    if isinstance(df.schema["user_id"].dataType, T.StringType):
        return df
    return df.withColumn("user_id", F.col("user_id").cast("string"))


def csv_items(column: str) -> Column:
    """Non-empty parts of a comma list, so trailing and doubled commas add nothing."""
    return F.array_remove(F.split(column, ","), "")


def article_id(url: str) -> Column:
    """Fifth part of the URL path without its query string; '' when the path stops before it."""
    return F.split_part(F.split_part(F.col(url), F.lit("/"), F.lit(5)), F.lit("?"), F.lit(1))


def has_prefix(column: str, prefixes: Iterable[str]) -> Column:
    """True when the text starts with one of ``prefixes``; pushed to the Parquet scan."""
    return reduce(or_, [F.col(column).startswith(p) for p in prefixes])


def prefix_lookup(column: str, prefix_by_id: Mapping[str, str]) -> Column:
    """Id of the prefix that the text starts with, NULL if none; the longest prefix wins.

    The table of prefixes is part of the program (a dozen entries), so it becomes a CASE
    expression in generated code instead of a join.
    """
    longest_first = sorted(prefix_by_id.items(), key=lambda entry: (-len(entry[1]), entry[0]))
    (first_id, first_prefix), *others = longest_first
    lookup = F.when(F.col(column).startswith(first_prefix), F.lit(first_id))
    for banner, prefix in others:
        lookup = lookup.when(F.col(column).startswith(prefix), F.lit(banner))
    return lookup


def first_label(column: str, labels: Iterable[tuple[str, str]]) -> Column:
    """Name of the first entry of ``labels`` whose word occurs in the text, NULL if none."""
    (name, word), *others = labels
    chain = F.when(F.col(column).contains(word), F.lit(name))
    for name, word in others:
        chain = chain.when(F.col(column).contains(word), F.lit(name))
    return chain


def whole_amount(column: str) -> Column:
    """Amount truncated toward zero, as every average of order amounts uses it."""
    return F.col(column).try_cast("bigint")


def epoch_seconds(column: str, zone: str) -> Column:
    """Epoch second of a leading ``yyyy-MM-dd HH:mm:ss`` in ``zone``; NULL when it does not parse.

    The zone is spelled out in the cast text, so the session time zone does not matter.
    """
    shaped = F.col(column).rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}")
    instant = F.concat(F.substring(column, 1, 19), F.lit(" " + zone)).try_cast("timestamp")
    return F.when(shaped, F.unix_seconds(instant))


def exact(amount: Column | str) -> Column:
    """A price as a decimal, so that its sum does not depend on the order of the rows."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return amount.cast("decimal(18,2)")


def mean(amount: str, number: str) -> Column:
    """Average of exactly added-up amounts: total over total number, NULL when there are none."""
    return F.sum(amount).cast("double") / F.nullif(F.sum(number), F.lit(0))


def truncated_mean(amount: str, number: str) -> Column:
    """Integer average of added-up whole amounts, NULL when there are none."""
    return F.call_function("div", F.sum(amount), F.nullif(F.sum(number), F.lit(0)))
