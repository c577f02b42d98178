"""Favourites and comments: the first letter of the item code tells the item type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom import settings as fixed
from tagloom.functions.exprs import valid_users
from tagloom.operators.base import BY_ITEM, BY_USER, Tables, per_key, rows


def favourites(tables: Tables, prefix: str | None = None) -> DataFrame:
    """Favourites of the item type, or of every type when no prefix is given."""
    collected = tables("tb_user_collect").select("user_id", F.col("code").alias("item_code"))
    if prefix is not None:
        collected = collected.filter(F.col("item_code").startswith(prefix))
    return valid_users(collected)


def collection(tables: Tables, prefix: str) -> DataFrame:
    """Favourites per user and item."""
    return per_key(favourites(tables, prefix), BY_ITEM, collection_num=rows())


def collection_tag(tables: Tables, name: str, prefix: str | None = None) -> DataFrame:
    """Favourites per user."""
    return per_key(favourites(tables, prefix), BY_USER, **{name: rows()})


def restaurant_remarks(tables: Tables) -> DataFrame:
    """Comments on restaurants."""
    comments = tables("customer_share").select("user_id", F.col("code").alias("item_code"))
    about = comments.filter(F.col("item_code").startswith(fixed.RESTAURANT_PREFIX))
    return valid_users(about)


def restaurant_comments(tables: Tables) -> DataFrame:
    """Comments per user and restaurant."""
    return per_key(restaurant_remarks(tables), BY_ITEM, comment_num=rows())


def lounge_praise(tables: Tables) -> DataFrame:
    """Positive comments (score above 2) on lounges."""
    comments = tables("tb_customer_share").select(
        "user_id", F.col("code").alias("item_code"), "score"
    )
    praise = comments.filter(
        (F.col("score") > 2) & F.col("item_code").startswith(fixed.LOUNGE_PREFIX)
    )
    return valid_users(praise)


def lounge_comments(tables: Tables) -> DataFrame:
    """Positive comments per user and lounge."""
    return per_key(lounge_praise(tables), BY_ITEM, comment_num=rows())


def lounge_comments_tag(tables: Tables) -> DataFrame:
    """Positive lounge comments per user."""
    return per_key(lounge_praise(tables), BY_USER, lounge_comment_num=rows())
