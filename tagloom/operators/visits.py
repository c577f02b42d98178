"""Banner visits, article reads, article likes and persona labels from the visit log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import settings as fixed
from tagloom.functions.exprs import (
    article_id,
    drop_missing,
    first_label,
    has_prefix,
    prefix_lookup,
    valid_users,
)
from tagloom.operators.base import BY_ITEM, BY_USER, Tables, per_key, rows
from tagloom.operators.prefixes import longest_prefix
from tagloom.settings import Settings


Banners = Mapping[str, str] | DataFrame
"""Prefixes by banner id: a few as a mapping, any number as ``id, prefix`` rows."""


def banners_of(tables: Tables, settings: Settings) -> Banners:
    return tables(settings.banner_table) if settings.banner_table else settings.banners


def banner_visits(tables: Tables, banners: Banners) -> DataFrame:
    """Visits whose URL starts with a banner's prefix; the item code is the banner id."""
    if isinstance(banners, DataFrame):
        visits = valid_users(tables("tbd_visit_url").select("user_id", "url"))
        return longest_prefix(visits, "url", banners, "item_code").drop("url")
    visits = tables("tbd_visit_url").filter(has_prefix("url", banners.values()))
    matched = visits.select("user_id", prefix_lookup("url", banners).alias("item_code"))
    return valid_users(matched)


def banner_browse(tables: Tables, banners: Banners) -> DataFrame:
    """Visits per user and banner."""
    return per_key(banner_visits(tables, banners), BY_ITEM, browse_num=rows())


def banner_browse_tag(tables: Tables, banners: Banners) -> DataFrame:
    """Banner visits per user."""
    return per_key(banner_visits(tables, banners), BY_USER, banner_browse_num=rows())


def article_reads(tables: Tables, prefix: str) -> DataFrame:
    """Visits of article pages; the item code is the article id in the path."""
    visits = tables("tbd_visit_url").filter(F.col("url").startswith(prefix))
    reads = visits.select("user_id", article_id("url").alias("item_code"))
    return valid_users(reads).filter(F.col("item_code") != "")


def article_browse(tables: Tables, prefix: str) -> DataFrame:
    """Reads per user and article."""
    return per_key(article_reads(tables, prefix), BY_ITEM, browse_num=rows())


def article_browse_tag(tables: Tables, prefix: str) -> DataFrame:
    """Article reads per user."""
    return per_key(article_reads(tables, prefix), BY_USER, article_browse_num=rows())


def article_likes(tables: Tables) -> DataFrame:
    """Likes of articles."""
    likes = tables("tbd_lettres_favor").select("user_id", F.col("lettres_id").alias("item_code"))
    return drop_missing(valid_users(likes), "item_code")


def article_favor(tables: Tables) -> DataFrame:
    """Likes per user and article."""
    return per_key(article_likes(tables), BY_ITEM, favor_num=rows())


def article_favor_tag(tables: Tables) -> DataFrame:
    """Likes per user."""
    return per_key(article_likes(tables), BY_USER, article_favor_num=rows())


def labelled_reads(tables: Tables, prefix: str) -> DataFrame:
    """Article reads with the persona label of the article, NULL when it has none.

    Labels are worked out per article before the join, and articles without one stay out of
    it. A popular article makes a hot join key only on the reads side, which AQE splits.
    """
    articles = tables("tbd_belles_lettres").select(
        F.col("id").alias("item_code"),
        first_label("person_labels", fixed.PERSONA_LABELS).alias("label"),
    )
    labelled = drop_missing(articles, "item_code", "label")
    return article_reads(tables, prefix).join(labelled, "item_code", "left")


def persona_counts() -> dict[str, Column]:
    """One counter per persona, 0 for users who read nothing with that label."""
    return {name: F.count_if(F.col("label") == name) for name, _ in fixed.PERSONA_LABELS}


def article_labels(tables: Tables, prefix: str) -> DataFrame:
    """Five persona counters per user."""
    return per_key(labelled_reads(tables, prefix), BY_USER, **persona_counts())
