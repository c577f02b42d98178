"""Table resolvers over files. A resolver is a function from table name to DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.sources.schemas import columns


def remembered(load: Callable[[str], DataFrame]) -> Callable[[str], DataFrame]:
    """Resolve each table once, so its file listing and footer are read once per resolver."""
    seen: dict[str, DataFrame] = {}

    def resolve(name: str) -> DataFrame:
        if name not in seen:
            seen[name] = load(name)
        return seen[name]

    return resolve


def only_declared(table: str, df: DataFrame) -> DataFrame:
    """Select the declared columns, in order, and name the missing ones if there are any."""
    absent = [name for name in columns(table) if name not in df.columns]
    if absent:
        raise ValueError(f"table {table} lacks columns {absent}")
    return df.select(*columns(table))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a tuple text file as column ``line``."""
    return spark.read.text(path).select(F.col("value").alias("line"))


def parquet_tables(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    """Tables stored as ``root/<table>``; browse hours may instead be text at that path."""
    return remembered(
        lambda name: only_declared(name, spark.read.parquet(f"{root.rstrip('/')}/{name}"))
    )


def catalog_tables(spark: SparkSession, database: str) -> Callable[[str], DataFrame]:
    """Tables of a metastore database; bucketed ones keep their bucketing for the joins."""
    return remembered(lambda name: only_declared(name, spark.table(f"{database}.{name}")))


def given_tables(frames: Mapping[str, DataFrame]) -> Callable[[str], DataFrame]:
    """Tables handed over as DataFrames."""
    return frames.__getitem__


def with_browse_hours(
    tables: Callable[[str], DataFrame], lines: DataFrame
) -> Callable[[str], DataFrame]:
    """The same tables, with the browse hours read from elsewhere (usually a text file)."""
    return lambda name: lines if name == "browse_hours" else tables(name)
