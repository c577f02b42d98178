"""Declared input schemas, one DDL string per table."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns each input table must offer.
SCHEMAS: dict[str, str] = {
    "tb_order": "order_no string, user_id bigint, actual_amount double",
    "restaurant_order_detail2": (
        "fd_code string, fd_restaurant_code string, ordertime timestamp, cprice double, "
        "xfprice double, fd_class string"
    ),
    "itd_restaurant": (
        "fd_code string, fd_lg string, fd_inspection string, fd_iscoupon bigint, "
        "fd_isflashsale bigint, fd_settlementdiscount bigint"
    ),
    "td_restaurant_order": "fd_code string, fd_restaurant_code string",
    "restaurant_class": "fd_class string, fd_cls string",
    "tb_user_collect": "user_id bigint, code string",
    "customer_share": "user_id bigint, code string",
    "tb_customer_share": "user_id bigint, code string, score bigint",
    "tblconsumerecord": "dragoncode string, loungecode string, point bigint, personcount bigint",
    "tb_bindrecord": "dragoncode string, user_id bigint",
    "tb_order_loungeserv": "order_no string, dragoncode string, lounge_code string, self string",
    "tbd_url_element": "user_id string, url string, param string, begin_date string",
    "tbd_visit_url": "user_id string, url string",
    "tbd_belles_lettres": "id string, person_labels string",
    "tbd_lettres_favor": "user_id string, lettres_id string",
    "tb_order_cip": "order_no string, pro_code string",
    "tb_order_cip_record": "order_no string",
    "tb_order_vvip": "order_no string",
    "tb_order_parking": "order_no string, parking_code string",
    "tb_order_limousine": "order_no string",
    "tbd_app_opera_path": (
        "id bigint, user_id bigint, page_order bigint, page_name string, page_time timestamp, "
        "page_parent_id bigint"
    ),
    "browse_hours": "line string",
    "banner_prefixes": "id string, prefix string",
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


def columns(table: str) -> list[str]:
    return schema(table).fieldNames()
