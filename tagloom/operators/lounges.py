"""Lounge orders and visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import settings as fixed
from tagloom.functions.exprs import csv_items, drop_missing, mean, truncated_mean, valid_users
from tagloom.operators.base import BY_ITEM, BY_USER, Tables, per_key, tallied, total, usages
from tagloom.operators.services import order_users


def card_users(tables: Tables) -> DataFrame:
    """Membership cards bound to a usable user."""
    cards = tables("tb_bindrecord").select("dragoncode", "user_id")
    return valid_users(drop_missing(cards, "dragoncode"))


def ordered_lounges(tables: Tables) -> DataFrame:
    """Lounges in the comma lists of lounge orders with the card's user, counted per card."""
    orders = tables("tb_order_loungeserv").select("dragoncode", "lounge_code")
    listed = drop_missing(orders, "dragoncode", "lounge_code").select(
        "dragoncode", F.explode(csv_items("lounge_code")).alias("item_code")
    )
    return tallied(listed, "dragoncode", "item_code").join(card_users(tables), "dragoncode")


def consumption(tables: Tables) -> DataFrame:
    """Ordered lounges per user and lounge."""
    return per_key(ordered_lounges(tables), BY_ITEM, consumption_num=total())


def self_item_lines(tables: Tables) -> DataFrame:
    """Own items per lounge order, counted from the list length without exploding it."""
    orders = tables("tb_order_loungeserv").select("order_no", "self")
    counted = drop_missing(orders, "order_no", "self").select(
        "order_no", F.size(csv_items("self")).cast("bigint").alias("items")
    )
    listed = counted.filter(F.col("items") > 0)
    return tallied(listed, "order_no", lines=F.sum("items"))


def consumption_tag(tables: Tables) -> DataFrame:
    """Own items of a user's lounge orders."""
    lines = self_item_lines(tables).join(order_users(tables), "order_no")
    return per_key(lines, BY_USER, lounge_consumption_num=total())


def visits(tables: Tables, by: tuple[str, ...], **sums: Column) -> DataFrame:
    """Lounge visits added up per card (and lounge) with the card's user.

    ``sums`` are aggregates over ``point`` and ``personcount``; by default visits are counted.
    """
    records = tables("tblconsumerecord").select(
        "dragoncode", F.col("loungecode").alias("item_code"), "point", "personcount"
    )
    lounges = records.filter(F.col("item_code").startswith(fixed.LOUNGE_PREFIX))
    per_card = tallied(drop_missing(lounges, "dragoncode"), "dragoncode", *by[1:], **sums)
    return per_card.join(card_users(tables), "dragoncode")


def point_sums() -> dict[str, Column]:
    return {"points": F.sum("point"), "pointed": F.count("point")}


def person_sums() -> dict[str, Column]:
    return {"persons": F.sum("personcount")}


def average_amount(tables: Tables) -> DataFrame:
    """Mean points per user and lounge."""
    facts = visits(tables, BY_ITEM, **point_sums())
    return per_key(facts, BY_ITEM, average_order_amount=mean("points", "pointed"))


def people(tables: Tables) -> DataFrame:
    """Persons admitted per user and lounge."""
    facts = visits(tables, BY_ITEM, **person_sums())
    return per_key(facts, BY_ITEM, people_consumption=total("persons"))


def usage(tables: Tables) -> DataFrame:
    """Visits per user and lounge."""
    return per_key(visits(tables, BY_ITEM), BY_ITEM, usage_counter=usages())


def average_amount_tag(tables: Tables) -> DataFrame:
    """Integer mean of the points per user."""
    facts = visits(tables, BY_USER, **point_sums())
    mean_points = truncated_mean("points", "pointed")
    return per_key(facts, BY_USER, lounge_average_order_amount=mean_points)


def people_tag(tables: Tables) -> DataFrame:
    """Persons admitted per user."""
    facts = visits(tables, BY_USER, **person_sums())
    return per_key(facts, BY_USER, lounge_people_consumption=total("persons"))


def usage_tag(tables: Tables) -> DataFrame:
    """Visits per user."""
    return per_key(visits(tables, BY_USER), BY_USER, lounge_usage_counter=total())
