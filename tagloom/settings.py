"""Parameters of the metric definitions: URL sets, prefixes, label words, page names."""

from __future__ import annotations

from dataclasses import dataclass, field

# They must equal what the application logs contain.
RESTAURANT_PAGES = (
    "/VirtualCard-en/restaurant/detail",
    "/VirtualCard-v5/restaurant/detail",
    "/VirtualCard-v6/restaurant/detail",
)
LOUNGE_PAGES = (
    "/VirtualCard-en/lounge/detail",
    "/VirtualCard-v5/lounge/detail",
    "/VirtualCard-v6/lounge/detail",
    "/VirtualCard-v6/lounge/buttonShow",
)
SHOP_PAGES = (
    "/VirtualCard-v5/shop/detail",
    "/VirtualCard-v5/shop/getNearbyShare",
)
PARKING_LOT_PAGES = ("/VirtualCard-v6/parking/items",)
PARKING_PAGES = (
    "/VirtualCard-v6/parking/index",
    "/VirtualCard-v6/parking/items",
    "/VirtualCard-v6/trafficsite/list/parking",
)
CIP_PAGES = (
    "/VirtualCard-v6/orderCip/listCip",
    "/VirtualCard-v6/trafficsite/list/cip",
    "/VirtualCard-v5/orderCip/getCips",
)
CAR_PAGES = (
    "/VirtualCard-v6/limousine/carTypeList",
    "/VirtualCard-v6/trafficsite/listHot/limousine",
    "/VirtualCard-v6/trafficsite/list/limousine",
)
VVIP_PAGES = (
    "/VirtualCard-v6/share/count/vvip",
    "/VirtualCard-v6/vvip/index",
    "/VirtualCard-v5/vvip/index",
    "/VirtualCard-v5/vvip/setTypes",
    "/VirtualCard-v5/share/getVvipShare",
)

# First letter of an item code per item type.
RESTAURANT_PREFIX = "R"
SHOP_PREFIX = "F"
LOUNGE_PREFIX = "N"
VVIP_PREFIX = "M"

# Persona tag and the label word that earns it; the first match wins.
PERSONA_LABELS = (
    ("business", "商旅出行"),
    ("student", "学生/背包客"),
    ("eleven", "十一"),
    ("home", "家庭出行"),
    ("crowd", "人群标签"),
)

# The language whose restaurant rows count, and the two preference words.
RESTAURANT_LANGUAGE = "zh-cn"
PREFERENCE_CHINESE = "中餐"
PREFERENCE_WESTERN = "西餐"

# Names of the restaurant detail page in the two mobile applications.
DETAIL_PAGE_NAMES = ("RestaurantDetailViewController", "NetworkRestaurantActivity")

# page_order ranges of the tail extract; the last one is open-ended.
TAIL_RANGES = ((26, 29), (30, 33), (34, 38), (39, 55), (56, 70), (71, 82), (83, 700), (701, None))


@dataclass(frozen=True)
class Settings:
    """Deployment-specific values; the defaults fit the bundled sample views."""

    article_prefix: str = "https://m.example.org/institute/"
    banners: dict[str, str] = field(
        default_factory=lambda: {
            "B1": "https://activity.example.org/newest",
            "B2": "https://activity.example.org/lucky/",
            "B3": "https://activity.example.org/page3/",
            "B4": "https://activity.example.org/page4/",
            "B5": "https://activity.example.org/page5/",
            "B6": "https://activity.example.org/page6/",
            "B7": "https://activity.example.org/page7/",
            "B8": "https://activity.example.org/page8/",
            "B9": "https://activity.example.org/page9/",
            "B10": "https://activity.example.org/page10/",
            "B11": "https://activity.example.org/page11/",
            "B12": "https://activity.example.org/page3/deep",
        }
    )
    #: Table with ``id, prefix`` rows, of any size, that takes the place of ``banners``.
    banner_table: str = ""
    page_order: int = 1
    log_time_zone: str = "UTC"
