"""Equi joins whose hot keys are spread over many tasks, found by a mergeable sketch of the keys.

A sketch counts the heavy hitters of a join key in one pass over that column; sketches of parts (days, files) are
combined without reading the parts again. Keys with more than one row in ``SHARE`` are hot, so there are fewer
than ``SHARE`` of them, whatever the table. Their rows are dealt over ``SPREAD`` salts and meet a copy of the other
side's rows per salt; all other rows join directly, by the one shuffle that a join takes. Nothing is added up in a
shuffle of its own before the join. AQE cannot do this: it measures bytes, and the lines of one key compress to
almost nothing.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.base import Tables

#: A key with more than one row in so many is hot.
SHARE = 2048
#: Keys that a sketch keeps count of: its error is far below a hot key's count.
TRACKED = 32_768
#: Tasks that the rows of one hot key go to.
SPREAD = 64


def key_sketch(rows: DataFrame, key: str) -> DataFrame:
    """One row: ``sketch`` of the key's values, and the ``rows`` that have one."""
    keys = rows.select(F.col(key).cast("string").alias("key")).filter("key is not null")
    return keys.select(F.expr(f"approx_top_k_accumulate(key, {TRACKED}) as sketch"), F.expr("count(*) as rows"))


def combined(sketches: DataFrame) -> DataFrame:
    """The sketch of all the parts whose sketches are given."""
    return sketches.select(F.expr(f"approx_top_k_combine(sketch, {TRACKED}) as sketch"), F.expr("sum(rows) as rows"))


def heavy_hitters(sketch: DataFrame, share: int = SHARE) -> list[str]:
    """Keys with more than one row in ``share``, fewer than ``share`` of them."""
    found = sketch.filter("rows > 0").select(
        F.explode(F.expr(f"approx_top_k_estimate(sketch, {share})")).alias("top"), "rows"
    )
    # A key counted once is no heavy hitter, however small the table.
    hot = found.filter((F.col("top.count") * share > F.col("rows")) & (F.col("top.count") > SPREAD))
    return sorted(r["key"] for r in hot.select(F.col("top.item").alias("key")).collect())


_known: WeakKeyDictionary[DataFrame, dict[str, list[str]]] = WeakKeyDictionary()


def hot_keys(tables: Tables, table: str, key: str) -> list[str]:
    """Hot keys of a table's column; one pass over that column for all the queries of a resolver."""
    rows = tables(table)
    known = _known.setdefault(rows, {})
    if key not in known:
        known[key] = heavy_hitters(key_sketch(rows, key))
    return known[key]


def spread_join(many: DataFrame, few: DataFrame, key: str, hot: list[str]) -> DataFrame:
    """``many`` joined with ``few`` on ``key``, whose values in ``hot`` have very many rows in ``many``.

    Rows of a hot key are dealt in turn within their task, so a retried task deals them alike.
    """
    if not hot:
        return many.join(few, key)
    is_hot = F.col(key).cast("string").isin(hot)
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int")
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    dealt = many.withColumn("_salt", F.when(is_hot, turn).otherwise(0))
    copied = few.withColumn("_salt", F.explode(salts))
    return dealt.join(copied, [key, "_salt"]).drop("_salt")
