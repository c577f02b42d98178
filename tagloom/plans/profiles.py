"""Wide profile tables: one row per user and item, or one row per user.

Metrics that read the same table share one scan, one join and one aggregate here. The
branches are combined with a union and one more aggregate instead of outer joins: every
branch is already partitioned by the text key, Spark keeps that partitioning across the
union, and the closing aggregate therefore needs no exchange. Each profile column has one
producing branch, so ``max`` only picks its value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import settings as fixed
from tagloom.functions.exprs import (
    article_id,
    exact,
    has_prefix,
    mean,
    text_user,
    truncated_mean,
    valid_users,
)
from tagloom.operators import browsing, favourites, lounges, restaurants, services, visits
from tagloom.operators.base import BY_ITEM, BY_USER, Tables, per_key, rows, total, usages
from tagloom.settings import Settings


def keyed(facts: DataFrame, by: tuple[str, ...], **metrics: Column) -> DataFrame:
    """``per_key`` on the text user id, so that all branches of a union are partitioned alike."""
    return per_key(text_user(facts), by, **metrics)


def assemble(frames: list[DataFrame], by: tuple[str, ...]) -> DataFrame:
    """One row per key with the columns of all ``frames``; NULL where a frame lacks the key."""
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    values = [name for name in together.columns if name not in by]
    return together.groupBy(*by).agg(*[F.max(name).alias(name) for name in values])


def counted(condition: Column) -> Column:
    """Number of rows meeting the condition, NULL instead of 0: no row means no metric."""
    return F.nullif(F.count_if(condition), F.lit(0))


def restaurant_orders(tables: Tables) -> DataFrame:
    """Orders per user, restaurant and day with the sum of the paid prices.

    The two prices are required by different metrics, so each is counted on its own.
    """
    lines = restaurants.order_lines(tables, "cprice", "xfprice", require=())
    priced, paid = present(lines, "cprice"), present(lines, "xfprice")
    orders = restaurants.user_orders(
        tables,
        lines.filter(priced | paid),
        (*BY_ITEM, "order_day"),
        orders=priced.cast("int"),
        payments=paid.cast("int"),
        paid=F.when(paid, exact("xfprice")),
    )
    sums = [F.sum(name).alias(name) for name in ("orders", "payments", "paid")]
    return text_user(orders).groupBy(*BY_ITEM, "order_day").agg(*sums)


def present(df: DataFrame, column: str) -> Column:
    known = F.col(column).isNotNull()
    if dict(df.dtypes)[column] in ("double", "float"):
        known = known & ~F.isnan(column)
    return known


def any_orders() -> Column:
    return F.sum("orders") > 0


def profile_rest(tables: Tables, settings: Settings) -> DataFrame:
    """User x restaurant: orders, mean price, repeat flag, redemptions, views, hours, ..."""
    orders = keyed(
        restaurant_orders(tables),
        BY_ITEM,
        consumption_num=F.nullif(F.sum("orders"), F.lit(0)),
        average_order_amount=mean("paid", "payments"),
        multitime_consumption=F.when(any_orders(), F.bool_or(F.col("orders") > 1)),
    )
    viewed = browsing.page_views(tables, fixed.RESTAURANT_PAGES, "code")
    return assemble(
        [
            orders,
            keyed(restaurants.redemptions(tables), BY_ITEM, usage_counter=rows().cast("double")),
            keyed(viewed, BY_ITEM, browse_num=rows()),
            # The hand-off file may hold several lines per key; the largest one is kept.
            keyed(restaurants.browse_hours(tables), BY_ITEM, browse_hour=F.max("hours")),
            keyed(
                favourites.favourites(tables, fixed.RESTAURANT_PREFIX),
                BY_ITEM,
                collection_num=rows(),
            ),
            keyed(favourites.restaurant_remarks(tables), BY_ITEM, comment_num=rows()),
        ],
        BY_ITEM,
    )


def all_visits(tables: Tables, by: tuple[str, ...]) -> DataFrame:
    sums = {**lounges.point_sums(), **lounges.person_sums(), "lines": rows()}
    return lounges.visits(tables, by, **sums)


def profile_lounge(tables: Tables, settings: Settings) -> DataFrame:
    """User x lounge: orders, mean points, persons, visits, views, favourites, praise."""
    visited = keyed(
        all_visits(tables, BY_ITEM),
        BY_ITEM,
        average_order_amount=mean("points", "pointed"),
        people_consumption=total("persons"),
        usage_counter=usages(),
    )
    viewed = browsing.page_views(tables, fixed.LOUNGE_PAGES, "code")
    return assemble(
        [
            visited,
            keyed(lounges.ordered_lounges(tables), BY_ITEM, consumption_num=total()),
            keyed(viewed, BY_ITEM, browse_num=rows()),
            keyed(
                favourites.favourites(tables, fixed.LOUNGE_PREFIX), BY_ITEM, collection_num=rows()
            ),
            keyed(favourites.lounge_praise(tables), BY_ITEM, comment_num=rows()),
        ],
        BY_ITEM,
    )


def profile_shop(tables: Tables, settings: Settings) -> DataFrame:
    """User x shop: views and favourites."""
    viewed = browsing.page_views(tables, fixed.SHOP_PAGES, "shopCode")
    collected = favourites.favourites(tables, fixed.SHOP_PREFIX)
    return assemble(
        [
            keyed(viewed, BY_ITEM, browse_num=rows()),
            keyed(collected, BY_ITEM, collection_num=rows()),
        ],
        BY_ITEM,
    )


def paid_service(tables: Tables, table: str, item: str) -> DataFrame:
    """Service orders per user and item with their mean whole amount, from a single join."""
    lines = services.item_lines(tables, table, item, services.paid_orders(tables))
    paid = F.col("amount").isNotNull().cast("int")
    return keyed(
        lines.withColumn("payments", paid),
        BY_ITEM,
        consumption_num=rows(),
        average_order_amount=mean("amount", "payments"),
    )


def with_payments(lines: DataFrame) -> DataFrame:
    """Add the amount of all lines and their number, both NULL where the amount is unknown."""
    return lines.withColumns(
        {
            "paid": F.col("amount") * F.col("lines"),
            "payments": F.when(F.col("amount").isNotNull(), F.col("lines")),
        }
    )


def profile_parking(tables: Tables, settings: Settings) -> DataFrame:
    """User x car park: orders, mean amount, views."""
    viewed = browsing.page_views(tables, fixed.PARKING_LOT_PAGES, "parkingCode")
    return assemble(
        [
            paid_service(tables, "tb_order_parking", "parking_code"),
            keyed(viewed, BY_ITEM, browse_num=rows()),
        ],
        BY_ITEM,
    )


def profile_cip(tables: Tables, settings: Settings) -> DataFrame:
    """User x CIP product: orders, mean amount, uses."""
    return assemble(
        [
            paid_service(tables, "tb_order_cip", "pro_code"),
            keyed(services.cip_uses(tables), BY_ITEM, usage_counter=usages("records")),
        ],
        BY_ITEM,
    )


def profile_article(tables: Tables, settings: Settings) -> DataFrame:
    """User x article: reads and likes."""
    reads = visits.article_reads(tables, settings.article_prefix)
    return assemble(
        [
            keyed(reads, BY_ITEM, browse_num=rows()),
            keyed(visits.article_likes(tables), BY_ITEM, favor_num=rows()),
        ],
        BY_ITEM,
    )


def restaurant_order_tags(tables: Tables) -> DataFrame:
    return keyed(
        restaurant_orders(tables),
        BY_USER,
        rest_consumption_num=F.nullif(F.sum("orders"), F.lit(0)),
        rest_average_order_amount_int=mean("paid", "payments").cast("bigint"),
        rest_multitime_consumption_num=F.when(any_orders(), F.count_if(F.col("orders") > 1)),
    )


def preference_tags(tables: Tables) -> DataFrame:
    """The preference as a number: a text column would turn ``assemble`` into a sort aggregate."""
    chinese = restaurants.prefers_chinese().cast("int")
    return keyed(restaurants.ordered_classes(tables), BY_USER, chinese=chinese)


def order_tags(tables: Tables) -> DataFrame:
    """Tags that reach their user through the order number, from one join to the orders.

    Every branch is counted per order and thereby partitioned by the order number, which the
    union keeps: the join shuffles nothing but the orders.
    """
    sources = {
        "cip": services.service_lines(tables, "tb_order_cip", "pro_code"),
        "cip use": services.cip_use_lines(tables),
        "vvip": services.service_lines(tables, "tb_order_vvip"),
        "car": services.service_lines(tables, "tb_order_limousine"),
        "parking": services.service_lines(tables, "tb_order_parking"),
        "redeemed": restaurants.redemption_lines(tables),
        "lounge item": lounges.self_item_lines(tables),
    }
    code = {kind: F.lit(number).cast("tinyint") for number, kind in enumerate(sources)}
    branches = [df.withColumn("kind", code[kind]) for kind, df in sources.items()]
    lines = reduce(DataFrame.unionByName, branches)

    def of_kind(kind: str, column: str) -> Column:
        return F.sum(F.when(F.col("kind") == code[kind], F.col(column)))

    def number(kind: str) -> Column:
        return of_kind(kind, "lines")

    def mean_amount(kind: str) -> Column:
        return F.call_function("div", of_kind(kind, "paid"), of_kind(kind, "payments"))

    return keyed(
        with_payments(lines.join(services.paid_orders(tables), "order_no")),
        BY_USER,
        cip_consumption_num=number("cip"),
        cip_average_order_amount=mean_amount("cip"),
        cip_usage_counter=number("cip use"),
        vvip_consumption_num=number("vvip"),
        vvip_average_order_amount=mean_amount("vvip"),
        car_consumption_num=number("car"),
        car_average_order_amount=mean_amount("car"),
        parking_consumption_num=number("parking"),
        parking_average_order_amount=mean_amount("parking"),
        rest_usage_counter=number("redeemed"),
        lounge_consumption_num=number("lounge item"),
    )


def visit_tags(tables: Tables) -> DataFrame:
    return keyed(
        all_visits(tables, BY_USER),
        BY_USER,
        lounge_average_order_amount=truncated_mean("points", "pointed"),
        lounge_people_consumption=total("persons"),
        lounge_usage_counter=total(),
    )


def view_tags(tables: Tables) -> DataFrame:
    """All view counters from one pass over the URL log."""
    pages = {
        "rest_browse_num": fixed.RESTAURANT_PAGES,
        "lounge_browse_num": fixed.LOUNGE_PAGES,
        "shop_browse_num": fixed.SHOP_PAGES,
        "cip_browse_num": fixed.CIP_PAGES,
        "vvip_browse_num": fixed.VVIP_PAGES,
        "car_browse_num": fixed.CAR_PAGES,
        "parking_browse_num": fixed.PARKING_PAGES,
    }
    every_page = [url for urls in pages.values() for url in urls]
    views = browsing.page_views(tables, every_page)
    counters = {name: counted(F.col("url").isin(*urls)) for name, urls in pages.items()}
    return keyed(views, BY_USER, **counters)


def collection_tags(tables: Tables) -> DataFrame:
    """All favourite counters from one pass over the favourites."""

    def of_type(prefix: str) -> Column:
        return counted(F.col("item_code").startswith(prefix))

    return keyed(
        favourites.favourites(tables),
        BY_USER,
        rest_collection_num=rows(),
        lounge_collection_num=of_type(fixed.LOUNGE_PREFIX),
        shop_collection_num=of_type(fixed.SHOP_PREFIX),
        vvip_collection_num=of_type(fixed.VVIP_PREFIX),
    )


def visit_log_tags(tables: Tables, settings: Settings) -> DataFrame:
    """Banner visits and article reads, from one pass over the visit log if the banners are few."""
    if settings.banner_table:
        banners = visits.banner_visits(tables, visits.banners_of(tables, settings))
        reads = visits.article_reads(tables, settings.article_prefix)
        return assemble(
            [
                keyed(banners, BY_USER, banner_browse_num=rows()),
                keyed(reads, BY_USER, article_browse_num=rows()),
            ],
            BY_USER,
        )
    article = F.col("url").startswith(settings.article_prefix) & (article_id("url") != "")
    banner = has_prefix("url", settings.banners.values())
    log = tables("tbd_visit_url").select("user_id", "url")
    return keyed(
        valid_users(log.filter(article | banner)),
        BY_USER,
        banner_browse_num=counted(banner),
        article_browse_num=counted(article),
    )


def profile_user_tags(tables: Tables, settings: Settings) -> DataFrame:
    """One row per user with every tag."""
    tags = assemble(
        [
            restaurant_order_tags(tables),
            preference_tags(tables),
            order_tags(tables),
            visit_tags(tables),
            view_tags(tables),
            collection_tags(tables),
            visit_log_tags(tables, settings),
            keyed(
                visits.labelled_reads(tables, settings.article_prefix),
                BY_USER,
                **visits.persona_counts(),
            ),
            keyed(favourites.lounge_praise(tables), BY_USER, lounge_comment_num=rows()),
            keyed(visits.article_likes(tables), BY_USER, article_favor_num=rows()),
            keyed(restaurants.browse_hours(tables), BY_USER, rest_browse_hour=F.sum("hours")),
        ],
        BY_USER,
    )
    word = restaurants.preference_word(F.col("chinese") == 1)
    return tags.withColumn(
        "restaurant_preferences", F.when(F.col("chinese").isNotNull(), word)
    ).drop("chinese")


PROFILES = {
    "profile_rest": profile_rest,
    "profile_lounge": profile_lounge,
    "profile_shop": profile_shop,
    "profile_parking": profile_parking,
    "profile_cip": profile_cip,
    "profile_article": profile_article,
    "profile_user_tags": profile_user_tags,
}
