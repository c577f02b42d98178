"""Partial upsert of metrics into a stored profile table, and its index-document form."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Document fields whose names are not the plain camel case of the column.
DOCUMENT_FIELDS: dict[str, str] = {
    "item_code": "restaurantCode",
    "cip_consumption_num": "CIPConsumptionNum",
    "cip_average_order_amount": "CIPAverageOrderAmount",
    "cip_usage_counter": "CIPUsageCounter",
    "cip_browse_num": "CIPBrowseNum",
    "vvip_consumption_num": "VVIPConsumptionNum",
    "vvip_average_order_amount": "VVIPAverageOrderAmount",
    "vvip_browse_num": "VVIPBrowseNum",
    "vvip_collection_num": "VVIPCollectionNum",
}


def document_field(column: str) -> str:
    first, *rest = column.split("_")
    return DOCUMENT_FIELDS.get(column, first + "".join(word.capitalize() for word in rest))


def document_id(keys: list[str]) -> Column:
    """Document id: the key columns without a separator.

    Two keys can share an id (user 1 with item 2X, user 12 with item X), which is why the
    stored profile is keyed by the columns themselves and the id is only added on the way out.
    """
    return F.concat(*keys)


def as_documents(profile: DataFrame, keys: list[str]) -> DataFrame:
    """Profile rows under their document field names, with the document id."""
    fields = [F.col(name).alias(document_field(name)) for name in profile.columns]
    return profile.select(document_id(keys).alias("id"), *fields)


def merge_profile(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: fresh values win, stored ones stay where the fresh row has NULL or is absent."""
    both = [c for c in fresh.columns if c in stored.columns and c not in keys]
    only_stored = [c for c in stored.columns if c not in fresh.columns]
    only_fresh = [c for c in fresh.columns if c not in stored.columns]
    old, new = stored.alias("old"), fresh.alias("new")
    joined = old.join(new, keys, "full_outer")
    return joined.select(
        *keys,
        *[F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) for c in both],
        *[F.col(f"old.{c}") for c in only_stored],
        *[F.col(f"new.{c}") for c in only_fresh],
    )


def upsert_profile(
    spark: SparkSession, fresh: DataFrame, keys: list[str], current: str | None, target: str
) -> DataFrame:
    """Merge ``fresh`` into the profile at ``current`` and write the outcome to ``target``.

    The two paths differ, so readers of the current profile are not disturbed and a failed
    run leaves it intact. Without a current profile the fresh rows are the profile.
    """
    if current is not None:
        if current.rstrip("/") == target.rstrip("/"):
            raise ValueError("the profile cannot be rewritten in place: give another target path")
        fresh = merge_profile(spark.read.parquet(current), fresh, keys)
    fresh.write.mode("errorifexists").parquet(target)
    return spark.read.parquet(target)


def write_index(documents: DataFrame, resource: str, options: Mapping[str, str]) -> None:
    """Upsert documents into a search index through its public Spark connector, if installed."""
    writer = documents.write.format("org.elasticsearch.spark.sql").mode("append")
    defaults = {"es.mapping.id": "id", "es.write.operation": "upsert"}
    writer.options(**{**defaults, **options}).save(resource)
