"""Row extracts of the page-path log and the URL log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom import settings as fixed
from tagloom.functions.exprs import drop_missing, epoch_seconds, valid_users
from tagloom.operators.base import Tables

PATH_COLUMNS = ("id", "user_id", "page_order", "page_name", "page_time", "page_parent_id")


def path_detail(tables: Tables) -> DataFrame:
    """Visits of the restaurant detail page in either mobile application."""
    pages = tables("tbd_app_opera_path").filter(F.col("page_name").isin(*fixed.DETAIL_PAGE_NAMES))
    return pages.select("id", "user_id", "page_time", "page_parent_id")


def path_page(tables: Tables, page_order: int) -> DataFrame:
    """All rows of one page position."""
    return tables("tbd_app_opera_path").filter(F.col("page_order") == page_order)


def path_range(tables: Tables, first: int = 18, last: int = 25) -> DataFrame:
    """All rows of a range of page positions; to be written with ``partitionBy("page_order")``."""
    return tables("tbd_app_opera_path").filter(F.col("page_order").between(first, last))


def path_tail(tables: Tables, ranges=fixed.TAIL_RANGES) -> DataFrame:
    """Rows from the first range on, with the number of their range as ``path_bucket``."""
    order = F.col("page_order")
    rows = tables("tbd_app_opera_path").filter(order >= ranges[0][0])
    bucket = None
    for number, (_, last) in enumerate(ranges):
        inside = F.lit(True) if last is None else order <= last
        bucket = F.when(inside, number) if bucket is None else bucket.when(inside, number)
    return rows.withColumn("path_bucket", bucket)


def url_visits(tables: Tables, zone: str) -> DataFrame:
    """Restaurant detail hits as (user, restaurant, epoch second).

    The user comes from the log column, the restaurant from the JSON parameter. User "0" is
    the anonymous user.
    """
    hits = tables("tbd_url_element").filter(F.col("url").isin(*fixed.RESTAURANT_PAGES))
    named = valid_users(hits).filter(F.col("user_id") != "0")
    visits = named.select(
        "user_id",
        F.json_tuple("param", "code").alias("item_code"),
        epoch_seconds("begin_date", zone).alias("visit_second"),
    )
    restaurants = visits.filter(F.col("item_code").startswith(fixed.RESTAURANT_PREFIX))
    return drop_missing(restaurants, "visit_second")
