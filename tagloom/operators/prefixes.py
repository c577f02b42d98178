"""Longest-prefix lookup in a table of prefixes of any size, by equi joins on hashes.

The index has a row for each prefix: its length and two hashes. A text is cut at the lengths that occur
in the index, and only there; the hashes of the cuts meet the index in an ordinary equi join, which Spark broadcasts
while the index is small and shuffles beyond that. Of the prefixes that a row meets the longest stays. There is
neither a nested loop nor a chain of conditions, so the work for a row is the number of different lengths, not of
prefixes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def prefix_table(spark: SparkSession, prefix_by_id: Mapping[str, str]) -> DataFrame:
    """``id, prefix`` rows of a mapping."""
    return spark.createDataFrame(list(prefix_by_id.items()), "id string, prefix string")


def _hashes(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("hash_a"), F.xxhash64(F.lit(1), text).alias("hash_b")]


def prefix_index(prefixes: DataFrame) -> DataFrame:
    """``hash_a, hash_b, length, id`` of ``id, prefix`` rows; of equal prefixes the least id stays."""
    known = prefixes.filter("id is not null and prefix <> ''")
    rows = known.select(F.col("id"), F.char_length("prefix").alias("length"), *_hashes(F.col("prefix")))
    return rows.groupBy("hash_a", "hash_b", "length").agg(F.min("id").alias("id"))


def lengths_of(prefixes: DataFrame) -> list[int]:
    """Different lengths of the prefixes, at most as many as the longest has characters."""
    rows = prefixes.filter("id is not null and prefix <> ''").select(F.char_length("prefix").alias("n"))
    return sorted(r["n"] for r in rows.distinct().collect())


def longest_prefix(rows: DataFrame, column: str, prefixes: DataFrame, name: str = "id") -> DataFrame:
    """``rows`` whose text in ``column`` starts with a prefix, and the id of the longest one as ``name``.

    Rows without a prefix, or with a NULL text, are left out; a row that is there twice comes out twice.
    The other columns ride along once per prefix that matches, not once per length.
    """
    lengths = lengths_of(prefixes)
    taken = [c for c in rows.columns if c != name]
    if not lengths:
        return rows.select(*taken, F.lit(None).cast("string").alias(name)).filter(F.lit(False))
    texts = rows.filter(F.col(column).isNotNull()).select(F.struct(*taken).alias("row"), F.col(column).alias("text"))
    # A number for each row; a retried task reads the same split in the same order.
    numbered = texts.withColumn("number", F.monotonically_increasing_id())
    cut = numbered.withColumn("length", F.explode(_cuts(lengths)))
    hashed = cut.select("row", "number", "length", *_hashes(F.substring(F.col("text"), F.lit(1), F.col("length"))))
    met = hashed.join(prefix_index(prefixes), ["hash_a", "hash_b", "length"])
    best = met.groupBy("number").agg(F.max_by("id", "length").alias(name), F.first("row").alias("row"))
    return best.select(*[F.col(f"row.`{c}`").alias(c) for c in taken], name)


def _cuts(lengths: list[int]) -> Column:
    every = F.array(*[F.lit(n) for n in lengths])
    return F.filter(every, lambda n: n <= F.char_length("text"))
