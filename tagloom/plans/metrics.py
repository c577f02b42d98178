"""Registry of every metric, tag and extract: name -> function of (tables, settings)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tagloom import settings as fixed
from tagloom.operators import (
    browsing,
    extracts,
    favourites,
    lounges,
    restaurants,
    services,
    visits,
)
from tagloom.operators.base import BY_ITEM, BY_USER, Tables
from tagloom.settings import Settings

Metric = Callable[[Tables, Settings], DataFrame]

BANNER_TABLE = Settings(banner_table="banner_prefixes")

#: Lookups in tables of any size where the metrics use a few fixed values.
LOOKUPS: dict[str, Metric] = {
    "banner_table_browse": lambda t, s: visits.banner_browse(t, visits.banners_of(t, BANNER_TABLE)),
}

ITEM_METRICS: dict[str, Metric] = {
    "rest_consumption": lambda t, s: restaurants.consumption(t, BY_ITEM, "consumption_num"),
    "rest_avg_amount": lambda t, s: restaurants.average_amount(t),
    "rest_multitime": lambda t, s: restaurants.multitime(t),
    "rest_usage": lambda t, s: restaurants.usage(t),
    "rest_browse": lambda t, s: browsing.browse(t, fixed.RESTAURANT_PAGES, "code"),
    "rest_browse_hour": lambda t, s: restaurants.browse_hour(t),
    "rest_collection": lambda t, s: favourites.collection(t, fixed.RESTAURANT_PREFIX),
    "rest_comment": lambda t, s: favourites.restaurant_comments(t),
    "lounge_consumption": lambda t, s: lounges.consumption(t),
    "lounge_avg_amount": lambda t, s: lounges.average_amount(t),
    "lounge_people": lambda t, s: lounges.people(t),
    "lounge_usage": lambda t, s: lounges.usage(t),
    "lounge_browse": lambda t, s: browsing.browse(t, fixed.LOUNGE_PAGES, "code"),
    "lounge_collection": lambda t, s: favourites.collection(t, fixed.LOUNGE_PREFIX),
    "lounge_comment": lambda t, s: favourites.lounge_comments(t),
    "shop_browse": lambda t, s: browsing.browse(t, fixed.SHOP_PAGES, "shopCode"),
    "shop_collection": lambda t, s: favourites.collection(t, fixed.SHOP_PREFIX),
    "parking_consumption": lambda t, s: services.consumption(t, "tb_order_parking", "parking_code"),
    "parking_avg_amount": lambda t, s: services.average_amount(
        t, "tb_order_parking", "parking_code"
    ),
    "parking_browse": lambda t, s: browsing.browse(t, fixed.PARKING_LOT_PAGES, "parkingCode"),
    "cip_consumption": lambda t, s: services.consumption(t, "tb_order_cip", "pro_code"),
    "cip_avg_amount": lambda t, s: services.average_amount(t, "tb_order_cip", "pro_code"),
    "cip_usage": lambda t, s: services.cip_usage(t),
    "vvip_collection": lambda t, s: favourites.collection(t, fixed.VVIP_PREFIX),
    "banner_browse": lambda t, s: visits.banner_browse(t, visits.banners_of(t, s)),
    "article_browse": lambda t, s: visits.article_browse(t, s.article_prefix),
    "article_favor": lambda t, s: visits.article_favor(t),
}

USER_TAGS: dict[str, Metric] = {
    "rest_consumption_tag": lambda t, s: restaurants.consumption(
        t, BY_USER, "rest_consumption_num"
    ),
    "rest_avg_amount_tag": lambda t, s: restaurants.average_amount_tag(t),
    "rest_multitime_tag": lambda t, s: restaurants.multitime_tag(t),
    "rest_usage_tag": lambda t, s: restaurants.usage_tag(t),
    "rest_browse_tag": lambda t, s: browsing.browse_tag(
        t, fixed.RESTAURANT_PAGES, "rest_browse_num"
    ),
    "rest_browse_hour_tag": lambda t, s: restaurants.browse_hour_tag(t),
    # Counts the favourites of every item type, not only restaurants.
    "rest_collection_tag": lambda t, s: favourites.collection_tag(t, "rest_collection_num"),
    "rest_preference": lambda t, s: restaurants.preference(t),
    "lounge_consumption_tag": lambda t, s: lounges.consumption_tag(t),
    "lounge_avg_amount_tag": lambda t, s: lounges.average_amount_tag(t),
    "lounge_people_tag": lambda t, s: lounges.people_tag(t),
    "lounge_usage_tag": lambda t, s: lounges.usage_tag(t),
    "lounge_browse_tag": lambda t, s: browsing.browse_tag(
        t, fixed.LOUNGE_PAGES, "lounge_browse_num"
    ),
    "lounge_collection_tag": lambda t, s: favourites.collection_tag(
        t, "lounge_collection_num", fixed.LOUNGE_PREFIX
    ),
    "lounge_comment_tag": lambda t, s: favourites.lounge_comments_tag(t),
    "shop_browse_tag": lambda t, s: browsing.browse_tag(t, fixed.SHOP_PAGES, "shop_browse_num"),
    "shop_collection_tag": lambda t, s: favourites.collection_tag(
        t, "shop_collection_num", fixed.SHOP_PREFIX
    ),
    "banner_browse_tag": lambda t, s: visits.banner_browse_tag(t, visits.banners_of(t, s)),
    "article_browse_tag": lambda t, s: visits.article_browse_tag(t, s.article_prefix),
    "article_favor_tag": lambda t, s: visits.article_favor_tag(t),
    "article_labels": lambda t, s: visits.article_labels(t, s.article_prefix),
    "cip_consumption_tag": lambda t, s: services.consumption_tag(
        t, "tb_order_cip", "cip_consumption_num", "pro_code"
    ),
    "cip_avg_amount_tag": lambda t, s: services.average_amount_tag(
        t, "tb_order_cip", "cip_average_order_amount", "pro_code"
    ),
    "cip_usage_tag": lambda t, s: services.cip_usage_tag(t),
    "cip_browse_tag": lambda t, s: browsing.browse_tag(t, fixed.CIP_PAGES, "cip_browse_num"),
    "vvip_consumption_tag": lambda t, s: services.consumption_tag(
        t, "tb_order_vvip", "vvip_consumption_num"
    ),
    "vvip_avg_amount_tag": lambda t, s: services.average_amount_tag(
        t, "tb_order_vvip", "vvip_average_order_amount"
    ),
    "vvip_browse_tag": lambda t, s: browsing.browse_tag(t, fixed.VVIP_PAGES, "vvip_browse_num"),
    "vvip_collection_tag": lambda t, s: favourites.collection_tag(
        t, "vvip_collection_num", fixed.VVIP_PREFIX
    ),
    "car_consumption_tag": lambda t, s: services.consumption_tag(
        t, "tb_order_limousine", "car_consumption_num"
    ),
    "car_avg_amount_tag": lambda t, s: services.average_amount_tag(
        t, "tb_order_limousine", "car_average_order_amount"
    ),
    "car_browse_tag": lambda t, s: browsing.browse_tag(t, fixed.CAR_PAGES, "car_browse_num"),
    "parking_consumption_tag": lambda t, s: services.consumption_tag(
        t, "tb_order_parking", "parking_consumption_num"
    ),
    "parking_avg_amount_tag": lambda t, s: services.average_amount_tag(
        t, "tb_order_parking", "parking_average_order_amount"
    ),
    "parking_browse_tag": lambda t, s: browsing.browse_tag(
        t, fixed.PARKING_PAGES, "parking_browse_num"
    ),
}

ITEM_FACTS: dict[str, Metric] = {
    "restaurant_priority": lambda t, s: restaurants.priority(t),
}

EXTRACTS: dict[str, Metric] = {
    "path_detail_extract": lambda t, s: extracts.path_detail(t),
    "path_page_extract": lambda t, s: extracts.path_page(t, s.page_order),
    "path_range_extract": lambda t, s: extracts.path_range(t),
    "path_tail_extract": lambda t, s: extracts.path_tail(t),
    "url_visit_extract": lambda t, s: extracts.url_visits(t, s.log_time_zone),
}

METRICS: dict[str, Metric] = {**ITEM_METRICS, **USER_TAGS, **ITEM_FACTS, **EXTRACTS}
