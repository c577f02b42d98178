"""Tuple text and partitioned Parquet for the extracts, bucketed tables for the order joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tuple_lines(df: DataFrame) -> DataFrame:
    """Each row as one ``(a,b,c)`` line; NULL is written as ``null``."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("null")) for name in df.columns]
    return df.select(F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")")).alias("line"))


def write_tuples(df: DataFrame, path: str) -> None:
    tuple_lines(df).write.mode("errorifexists").text(path)


def write_extract(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Typed Parquet, laid out by the column later reads select on.

    Rows are brought together first, so that the number of files follows the bytes and not the
    tasks of the scan; a partition with very many rows is written by several tasks.
    """
    columns = () if partition is None else (partition,)
    writer = df.hint("rebalance", *columns).write.mode("errorifexists")
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, spread: int = 4) -> None:
    """Store a table bucketed and sorted by its join key.

    Tables bucketed alike on the order number join without shuffling either side. Rows are
    brought together by bucket first, so that a bucket is at most ``spread`` files rather than
    one per task; each bucket is written by ``spread`` tasks, whatever keys it holds.

    A bucket is read by one task, and a join without a shuffle cannot be split. Bucket tables
    whose key hardly repeats, such as the orders; leave the others to the shuffled join.
    """
    placed = df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
    placed = placed.withColumn("_share", F.spark_partition_id() % spread)
    brought = placed.repartition(buckets * spread, "_bucket", "_share").drop("_bucket", "_share")
    brought.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
