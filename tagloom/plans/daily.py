"""Every metric and tag as a mergeable state: a day's rows make a partial result, days fold to the metric.

A state has a row per key, and per day of the order where the metric asks for it, with counts and exact sums
only; states of any split of the rows add up to the state of all of them. Averages, flags and words are
worked out of the sums last. The table named by a metric comes in by day; the tables that it is joined with
(orders, cards, restaurants, articles, order lines of a record) are read whole, and must hold what the day's rows refer to.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import settings as fixed
from tagloom.functions.exprs import drop_missing, mean, text_user, truncated_mean
from tagloom.operators import browsing, favourites, lounges, restaurants, services, visits
from tagloom.operators.base import BY_ITEM, BY_USER, Tables, rows, total
from tagloom.settings import Settings


@dataclass(frozen=True)
class Daily:
    """How a metric is made of days.

    ``state`` are aggregates over the facts of a day, which add up; ``results`` are aggregates over
    states. ``level`` are further keys of the state, by which it is added up before ``results``.
    """

    table: str
    facts: Callable[[Tables, Settings], DataFrame]
    by: tuple[str, ...]
    state: dict[str, Column]
    results: dict[str, Column]
    level: tuple[str, ...] = ()
    finish: Callable[[DataFrame], DataFrame] | None = field(default=None)

    def of_day(self, tables: Tables, settings: Settings) -> DataFrame:
        """The state of the rows that the metric's table has."""
        keys = [*self.by, *self.level]
        facts = text_user(self.facts(tables, settings))
        return facts.groupBy(*keys).agg(*[c.alias(n) for n, c in self.state.items()])

    def merged(self, states: DataFrame) -> DataFrame:
        """States of one another's parts as one state."""
        sums = [F.sum(n).cast(states.schema[n].dataType).alias(n) for n in self.state]
        return states.groupBy(*self.by, *self.level).agg(*sums)

    def folded(self, states: DataFrame) -> DataFrame:
        """The metric out of the states of all parts."""
        if self.finish is not None:
            return self.finish(self.merged(states))
        parts = self.merged(states) if self.level else states
        return parts.groupBy(*self.by).agg(*[c.alias(n) for n, c in self.results.items()])


def counted(table, facts, by, name, kind="bigint", state=None) -> Daily:
    """A number of rows."""
    return Daily(table, facts, by, {"n": rows() if state is None else state}, {name: F.sum("n").cast(kind)})


def averaged(table, facts, by, name, result, amount="paid", number="lines") -> Daily:
    """An exact sum and a number of rows."""
    state = {"paid": F.sum(amount), "lines": F.sum(number)}
    return Daily(table, facts, by, state, {name: result("paid", "lines")})


def whole_mean(amount: str, number: str) -> Column:
    return mean(amount, number).cast("bigint")


def viewed(urls, by, name, item=None) -> Daily:
    return counted("tbd_url_element", lambda t, s: browsing.page_views(t, urls, item), by, name)


def collected(prefix, by, name) -> Daily:
    return counted("tb_user_collect", lambda t, s: favourites.favourites(t, prefix), by, name)


DETAILS, RECORDS, LOG = "restaurant_order_detail2", "tblconsumerecord", "tbd_visit_url"


def ordered(by) -> Callable[[Tables, Settings], DataFrame]:
    return lambda t, s: restaurants.user_orders(t, restaurants.order_lines(t, "cprice"), by, lines=F.lit(1))


def paid(by) -> Callable[[Tables, Settings], DataFrame]:
    return lambda t, s: restaurants.payments(t, by)


PER_DAY = (*BY_ITEM, "order_day")


def multitime(by, name, result) -> Daily:
    return Daily(DETAILS, ordered(PER_DAY), by, {"n": total()}, {name: result}, PER_DAY[len(by) :])


def visited(by, name, kind="bigint") -> Daily:
    return counted(RECORDS, lambda t, s: lounges.visits(t, by), by, name, kind, total())


def pointed(by, name, result) -> Daily:
    facts = lambda t, s: lounges.visits(t, by, **lounges.point_sums())
    return averaged(RECORDS, facts, by, name, result, "points", "pointed")


def admitted(by, name) -> Daily:
    facts = lambda t, s: lounges.visits(t, by, **lounges.person_sums())
    return Daily(RECORDS, facts, by, {"persons": F.sum("persons")}, {name: F.sum("persons")})


def service_items(table, item) -> Callable[[Tables, Settings], DataFrame]:
    return lambda t, s: services.item_lines(t, table, item, services.order_users(t))


def paid_items(table, item) -> Callable[[Tables, Settings], DataFrame]:
    def facts(t: Tables, s: Settings) -> DataFrame:
        orders = drop_missing(services.paid_orders(t), "amount")
        return services.item_lines(t, table, item, orders).withColumn("lines", F.lit(1))

    return facts


def serviced(table, name, require=None) -> Daily:
    facts = lambda t, s: services.service_lines(t, table, require).join(services.order_users(t), "order_no")
    return counted(table, facts, BY_USER, name, state=total())


def service_paid(table, name, require=None) -> Daily:
    facts = lambda t, s: services.payments(t, services.service_lines(t, table, require))
    return averaged(table, facts, BY_USER, name, truncated_mean)


def hour_lines(states: DataFrame) -> DataFrame:
    """A line of the hand-off file for each that came in; the state counts equal ones."""
    again = states.select(*BY_ITEM, "hours", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return again.select(*BY_ITEM, F.col("hours").alias("browse_hour"))


def banners(t: Tables, s: Settings) -> DataFrame:
    return visits.banner_visits(t, visits.banners_of(t, s))


def reads(t: Tables, s: Settings) -> DataFrame:
    return visits.article_reads(t, s.article_prefix)


def by_order(define) -> Callable[[Tables, Settings], DataFrame]:
    return lambda t, s: define(t).join(services.order_users(t), "order_no")


def hours() -> Daily:
    facts = lambda t, s: restaurants.browse_hours(t)
    return Daily("browse_hours", facts, BY_ITEM, {"n": rows()}, {}, ("hours",), hour_lines)


def hours_tag() -> Daily:
    sums = {"hours": F.sum("hours")}
    return Daily("browse_hours", hours().facts, BY_USER, sums, {"rest_browse_hour": F.sum("hours")})


def preference() -> Daily:
    sums = {"flags": F.sum("flags"), "lines": F.sum("lines")}
    word = restaurants.preference_word(restaurants.prefers_chinese())
    facts = lambda t, s: restaurants.ordered_classes(t)
    return Daily(DETAILS, facts, BY_USER, sums, {"restaurant_preferences": word})


def personas() -> Daily:
    counts = visits.persona_counts()
    facts = lambda t, s: visits.labelled_reads(t, s.article_prefix)
    return Daily(LOG, facts, BY_USER, counts, {name: F.sum(name) for name in counts})


def daily_metrics() -> dict[str, Daily]:
    """All of them by name; needs a running session, for columns are built in it."""
    return {
        "rest_consumption": counted(DETAILS, ordered(BY_ITEM), BY_ITEM, "consumption_num", state=total()),
        "rest_avg_amount": averaged(DETAILS, paid(BY_ITEM), BY_ITEM, "average_order_amount", mean),
        "rest_multitime": multitime(BY_ITEM, "multitime_consumption", F.bool_or(F.col("n") > 1)),
        "rest_usage": counted("td_restaurant_order", lambda t, s: restaurants.redemptions(t), BY_ITEM, "usage_counter", "double"),
        "rest_browse": viewed(fixed.RESTAURANT_PAGES, BY_ITEM, "browse_num", "code"),
        "rest_browse_hour": hours(),
        "rest_collection": collected(fixed.RESTAURANT_PREFIX, BY_ITEM, "collection_num"),
        "rest_comment": counted("customer_share", lambda t, s: favourites.restaurant_remarks(t), BY_ITEM, "comment_num"),
        "lounge_consumption": counted("tb_order_loungeserv", lambda t, s: lounges.ordered_lounges(t), BY_ITEM, "consumption_num", state=total()),
        "lounge_avg_amount": pointed(BY_ITEM, "average_order_amount", mean),
        "lounge_people": admitted(BY_ITEM, "people_consumption"),
        "lounge_usage": visited(BY_ITEM, "usage_counter", "double"),
        "lounge_browse": viewed(fixed.LOUNGE_PAGES, BY_ITEM, "browse_num", "code"),
        "lounge_collection": collected(fixed.LOUNGE_PREFIX, BY_ITEM, "collection_num"),
        "lounge_comment": counted("tb_customer_share", lambda t, s: favourites.lounge_praise(t), BY_ITEM, "comment_num"),
        "shop_browse": viewed(fixed.SHOP_PAGES, BY_ITEM, "browse_num", "shopCode"),
        "shop_collection": collected(fixed.SHOP_PREFIX, BY_ITEM, "collection_num"),
        "parking_consumption": counted("tb_order_parking", service_items("tb_order_parking", "parking_code"), BY_ITEM, "consumption_num"),
        "parking_avg_amount": averaged("tb_order_parking", paid_items("tb_order_parking", "parking_code"), BY_ITEM, "average_order_amount", mean, "amount"),
        "parking_browse": viewed(fixed.PARKING_LOT_PAGES, BY_ITEM, "browse_num", "parkingCode"),
        "cip_consumption": counted("tb_order_cip", service_items("tb_order_cip", "pro_code"), BY_ITEM, "consumption_num"),
        "cip_avg_amount": averaged("tb_order_cip", paid_items("tb_order_cip", "pro_code"), BY_ITEM, "average_order_amount", mean, "amount"),
        "cip_usage": counted("tb_order_cip_record", lambda t, s: services.cip_uses(t), BY_ITEM, "usage_counter", "double", total("records")),
        "vvip_collection": collected(fixed.VVIP_PREFIX, BY_ITEM, "collection_num"),
        "banner_browse": counted(LOG, banners, BY_ITEM, "browse_num"),
        "article_browse": counted(LOG, reads, BY_ITEM, "browse_num"),
        "article_favor": counted("tbd_lettres_favor", lambda t, s: visits.article_likes(t), BY_ITEM, "favor_num"),
        "rest_consumption_tag": counted(DETAILS, ordered(BY_USER), BY_USER, "rest_consumption_num", state=total()),
        "rest_avg_amount_tag": averaged(DETAILS, paid(BY_USER), BY_USER, "rest_average_order_amount_int", whole_mean),
        "rest_multitime_tag": multitime(BY_USER, "rest_multitime_consumption_num", F.count_if(F.col("n") > 1)),
        "rest_usage_tag": counted("td_restaurant_order", by_order(restaurants.redemption_lines), BY_USER, "rest_usage_counter", state=total()),
        "rest_browse_tag": viewed(fixed.RESTAURANT_PAGES, BY_USER, "rest_browse_num"),
        "rest_browse_hour_tag": hours_tag(),
        "rest_collection_tag": collected(None, BY_USER, "rest_collection_num"),
        "rest_preference": preference(),
        "lounge_consumption_tag": counted("tb_order_loungeserv", by_order(lounges.self_item_lines), BY_USER, "lounge_consumption_num", state=total()),
        "lounge_avg_amount_tag": pointed(BY_USER, "lounge_average_order_amount", truncated_mean),
        "lounge_people_tag": admitted(BY_USER, "lounge_people_consumption"),
        "lounge_usage_tag": visited(BY_USER, "lounge_usage_counter"),
        "lounge_browse_tag": viewed(fixed.LOUNGE_PAGES, BY_USER, "lounge_browse_num"),
        "lounge_collection_tag": collected(fixed.LOUNGE_PREFIX, BY_USER, "lounge_collection_num"),
        "lounge_comment_tag": counted("tb_customer_share", lambda t, s: favourites.lounge_praise(t), BY_USER, "lounge_comment_num"),
        "shop_browse_tag": viewed(fixed.SHOP_PAGES, BY_USER, "shop_browse_num"),
        "shop_collection_tag": collected(fixed.SHOP_PREFIX, BY_USER, "shop_collection_num"),
        "banner_browse_tag": counted(LOG, banners, BY_USER, "banner_browse_num"),
        "article_browse_tag": counted(LOG, reads, BY_USER, "article_browse_num"),
        "article_favor_tag": counted("tbd_lettres_favor", lambda t, s: visits.article_likes(t), BY_USER, "article_favor_num"),
        "article_labels": personas(),
        "cip_consumption_tag": serviced("tb_order_cip", "cip_consumption_num", "pro_code"),
        "cip_avg_amount_tag": service_paid("tb_order_cip", "cip_average_order_amount", "pro_code"),
        "cip_usage_tag": counted("tb_order_cip_record", by_order(services.cip_use_lines), BY_USER, "cip_usage_counter", state=total()),
        "cip_browse_tag": viewed(fixed.CIP_PAGES, BY_USER, "cip_browse_num"),
        "vvip_consumption_tag": serviced("tb_order_vvip", "vvip_consumption_num"),
        "vvip_avg_amount_tag": service_paid("tb_order_vvip", "vvip_average_order_amount"),
        "vvip_browse_tag": viewed(fixed.VVIP_PAGES, BY_USER, "vvip_browse_num"),
        "vvip_collection_tag": collected(fixed.VVIP_PREFIX, BY_USER, "vvip_collection_num"),
        "car_consumption_tag": serviced("tb_order_limousine", "car_consumption_num"),
        "car_avg_amount_tag": service_paid("tb_order_limousine", "car_average_order_amount"),
        "car_browse_tag": viewed(fixed.CAR_PAGES, BY_USER, "car_browse_num"),
        "parking_consumption_tag": serviced("tb_order_parking", "parking_consumption_num"),
        "parking_avg_amount_tag": service_paid("tb_order_parking", "parking_average_order_amount"),
        "parking_browse_tag": viewed(fixed.PARKING_PAGES, BY_USER, "parking_browse_num"),
    }
