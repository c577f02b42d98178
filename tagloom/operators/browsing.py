"""Page views from the URL log, whose ``param`` column holds a JSON object."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.exprs import drop_missing, valid_users
from tagloom.operators.base import BY_ITEM, BY_USER, Tables, per_key, rows


def page_views(tables: Tables, urls: Iterable[str], item_field: str | None = None) -> DataFrame:
    """Views of ``urls``: url, the JSON user id and, when ``item_field`` is given, the item code.

    ``json_tuple`` reads all fields in one pass over the text; broken JSON gives NULLs. The
    URL test is pushed to the scan, and the user test sits above the parse, so no text is
    parsed twice.
    """
    hits = tables("tbd_url_element").filter(F.col("url").isin(*urls))
    if item_field is None:
        views = hits.select("url", F.json_tuple("param", "userId").alias("user_id"))
        return valid_users(views)
    fields = F.json_tuple("param", "userId", item_field).alias("user_id", "item_code")
    return drop_missing(valid_users(hits.select("url", fields)), "item_code")


def browse(tables: Tables, urls: Iterable[str], item_field: str) -> DataFrame:
    """Views per user and item."""
    return per_key(page_views(tables, urls, item_field), BY_ITEM, browse_num=rows())


def browse_tag(tables: Tables, urls: Iterable[str], name: str) -> DataFrame:
    """Views per user, whatever the item."""
    return per_key(page_views(tables, urls), BY_USER, **{name: rows()})
