"""DuckDB SQL for every registered query, written apart from the Spark definitions.

Only the input views are shared. Values that an engine could round differently are avoided:
averages are one division of exactly summed whole numbers.
"""

from __future__ import annotations

import re

from tagloom.plans.profiles import PROFILES
from tagloom.sources.samples import BASE_TABLES, VIEWS

REST_LINES = """
    from restaurant_order_detail2 d
    join itd_restaurant r on d.fd_restaurant_code = r.fd_code and r.fd_lg = 'zh-cn'
    join tb_order o on d.fd_code = o.order_no
    where o.user_id is not null and d.ordertime is not null and d.{price} is not null
      and r.fd_inspection is not null and d.fd_class is not null"""

PER_DAY = """
    select cast(o.user_id as varchar) user_id, d.fd_restaurant_code item_code,
           cast(d.ordertime as date) order_day, count(*) n""" + REST_LINES.format(
    price="cprice"
) + " group by all"

RESTAURANT_URLS = (
    "'/VirtualCard-en/restaurant/detail', '/VirtualCard-v5/restaurant/detail', "
    "'/VirtualCard-v6/restaurant/detail'"
)
LOUNGE_URLS = (
    "'/VirtualCard-en/lounge/detail', '/VirtualCard-v5/lounge/detail', "
    "'/VirtualCard-v6/lounge/detail', '/VirtualCard-v6/lounge/buttonShow'"
)
SHOP_URLS = "'/VirtualCard-v5/shop/detail', '/VirtualCard-v5/shop/getNearbyShare'"
PARKING_LOT_URLS = "'/VirtualCard-v6/parking/items'"
PARKING_URLS = (
    "'/VirtualCard-v6/parking/index', '/VirtualCard-v6/parking/items', "
    "'/VirtualCard-v6/trafficsite/list/parking'"
)
CIP_URLS = (
    "'/VirtualCard-v6/orderCip/listCip', '/VirtualCard-v6/trafficsite/list/cip', "
    "'/VirtualCard-v5/orderCip/getCips'"
)
CAR_URLS = (
    "'/VirtualCard-v6/limousine/carTypeList', '/VirtualCard-v6/trafficsite/listHot/limousine', "
    "'/VirtualCard-v6/trafficsite/list/limousine'"
)
VVIP_URLS = (
    "'/VirtualCard-v6/share/count/vvip', '/VirtualCard-v6/vvip/index', "
    "'/VirtualCard-v5/vvip/index', '/VirtualCard-v5/vvip/setTypes', "
    "'/VirtualCard-v5/share/getVvipShare'"
)


def json_text(field: str) -> str:
    return f"case when json_valid(param) then json_extract_string(param, '$.{field}') end"


def browse(urls: str, field: str) -> str:
    return f"""
    select user_id, item_code, count(*) browse_num
    from (select {json_text('userId')} user_id, {json_text(field)} item_code
          from tbd_url_element where url in ({urls}))
    where trim(user_id) <> '' and item_code is not null
    group by all"""


def browse_tag(urls: str, name: str) -> str:
    return f"""
    select user_id, count(*) {name}
    from (select {json_text('userId')} user_id from tbd_url_element where url in ({urls}))
    where trim(user_id) <> ''
    group by all"""


def collection(prefix: str) -> str:
    return f"""
    select cast(user_id as varchar) user_id, code item_code, count(*) collection_num
    from tb_user_collect where user_id is not null and starts_with(code, '{prefix}')
    group by all"""


def collection_tag(name: str, prefix: str = "") -> str:
    kept = f"and starts_with(code, '{prefix}')" if prefix else ""
    return f"""
    select cast(user_id as varchar) user_id, count(*) {name}
    from tb_user_collect where user_id is not null {kept}
    group by all"""


def service(table: str, item: str) -> str:
    return f"""
    select cast(o.user_id as varchar) user_id, s.{item} item_code, count(*) consumption_num
    from {table} s join tb_order o on s.order_no = o.order_no
    where o.user_id is not null and s.{item} is not null
    group by all"""


def service_average(table: str, item: str) -> str:
    return f"""
    select cast(o.user_id as varchar) user_id, s.{item} item_code,
           cast(sum(cast(trunc(o.actual_amount) as bigint)) as double) / count(*)
               average_order_amount
    from {table} s join tb_order o on s.order_no = o.order_no
    where o.user_id is not null and s.{item} is not null and o.actual_amount is not null
    group by all"""


def service_tag(table: str, name: str, condition: str = "true") -> str:
    return f"""
    select cast(o.user_id as varchar) user_id, count(*) {name}
    from {table} s join tb_order o on s.order_no = o.order_no
    where o.user_id is not null and {condition}
    group by all"""


def service_average_tag(table: str, name: str, condition: str = "true") -> str:
    return f"""
    select cast(o.user_id as varchar) user_id,
           cast(sum(cast(trunc(o.actual_amount) as bigint)) // count(*) as bigint) {name}
    from {table} s join tb_order o on s.order_no = o.order_no
    where o.user_id is not null and o.actual_amount is not null and {condition}
    group by all"""


CIP_USES = """
    from tb_order_cip_record u join tb_order_cip c on u.order_no = c.order_no
    join tb_order o on c.order_no = o.order_no
    where o.user_id is not null and c.pro_code is not null"""

VISITS = """
    from tblconsumerecord v join tb_bindrecord b on v.dragoncode = b.dragoncode
    where b.user_id is not null and starts_with(v.loungecode, 'N')"""

BANNERS = """
    from (select user_id,
                 case when starts_with(url, 'https://activity.example.org/newest') then 'B1'
                      when starts_with(url, 'https://activity.example.org/lucky/') then 'B2'
                      when starts_with(url, 'https://activity.example.org/page3/deep') then 'B12'
                      when starts_with(url, 'https://activity.example.org/page3/') then 'B3'
                      when starts_with(url, 'https://activity.example.org/page4/') then 'B4'
                      when starts_with(url, 'https://activity.example.org/page5/') then 'B5'
                      when starts_with(url, 'https://activity.example.org/page6/') then 'B6'
                      when starts_with(url, 'https://activity.example.org/page7/') then 'B7'
                      when starts_with(url, 'https://activity.example.org/page8/') then 'B8'
                      when starts_with(url, 'https://activity.example.org/page9/') then 'B9'
                      when starts_with(url, 'https://activity.example.org/page10/') then 'B10'
                      when starts_with(url, 'https://activity.example.org/page11/') then 'B11'
                 end banner
          from tbd_visit_url) v
    where banner is not null and trim(v.user_id) <> ''"""

READS = """
    (select user_id, split_part(split_part(url, '/', 5), '?', 1) item_code from tbd_visit_url
     where starts_with(url, 'https://m.example.org/institute/') and trim(user_id) <> ''
       and split_part(split_part(url, '/', 5), '?', 1) <> '')"""

HOURS = """
    (select split_part(bare, ',', 1) user_id, split_part(bare, ',', 2) item_code,
            try_cast(split_part(bare, ',', 3) as bigint) as spent
     from (select replace(replace(line, '(', ''), ')', '') bare from browse_hours))
    where trim(user_id) <> '' and spent is not null"""

METRIC_SQL: dict[str, str] = {
    "rest_consumption": """
    select cast(o.user_id as varchar) user_id, d.fd_restaurant_code item_code,
           count(*) consumption_num""" + REST_LINES.format(price="cprice") + " group by all",
    "rest_avg_amount": """
    select cast(o.user_id as varchar) user_id, d.fd_restaurant_code item_code,
           cast(sum(cast(d.xfprice as decimal(18,2))) as double) / count(*) average_order_amount"""
    + REST_LINES.format(price="xfprice")
    + " group by all",
    "rest_multitime": f"""
    select user_id, item_code, bool_or(n > 1) multitime_consumption
    from ({PER_DAY}) group by all""",
    "rest_usage": """
    select cast(o.user_id as varchar) user_id, t.fd_restaurant_code item_code,
           cast(count(*) as double) usage_counter
    from td_restaurant_order t join tb_order o on t.fd_code = o.order_no
    where o.user_id is not null and t.fd_restaurant_code is not null
    group by all""",
    "rest_browse": browse(RESTAURANT_URLS, "code"),
    "rest_browse_hour": f"""
    select user_id, item_code, spent browse_hour from {HOURS} and item_code is not null""",
    "rest_collection": collection("R"),
    "rest_comment": """
    select cast(user_id as varchar) user_id, code item_code, count(*) comment_num
    from customer_share where user_id is not null and starts_with(code, 'R')
    group by all""",
    "lounge_consumption": """
    select user_id, item_code, count(*) consumption_num
    from (select cast(b.user_id as varchar) user_id,
                 unnest(string_split(rtrim(l.lounge_code, ','), ',')) item_code
          from tb_order_loungeserv l join tb_bindrecord b on l.dragoncode = b.dragoncode
          where l.lounge_code is not null and b.user_id is not null)
    where item_code <> ''
    group by all""",
    "lounge_avg_amount": f"""
    select cast(b.user_id as varchar) user_id, v.loungecode item_code,
           cast(sum(v.point) as double) / count(v.point) average_order_amount
    {VISITS} group by all""",
    "lounge_people": f"""
    select cast(b.user_id as varchar) user_id, v.loungecode item_code,
           cast(sum(v.personcount) as bigint) people_consumption
    {VISITS} group by all""",
    "lounge_usage": f"""
    select cast(b.user_id as varchar) user_id, v.loungecode item_code,
           cast(count(*) as double) usage_counter
    {VISITS} group by all""",
    "lounge_browse": browse(LOUNGE_URLS, "code"),
    "lounge_collection": collection("N"),
    "lounge_comment": """
    select cast(user_id as varchar) user_id, code item_code, count(*) comment_num
    from tb_customer_share
    where user_id is not null and score > 2 and starts_with(code, 'N')
    group by all""",
    "shop_browse": browse(SHOP_URLS, "shopCode"),
    "shop_collection": collection("F"),
    "parking_consumption": service("tb_order_parking", "parking_code"),
    "parking_avg_amount": service_average("tb_order_parking", "parking_code"),
    "parking_browse": browse(PARKING_LOT_URLS, "parkingCode"),
    "cip_consumption": service("tb_order_cip", "pro_code"),
    "cip_avg_amount": service_average("tb_order_cip", "pro_code"),
    "cip_usage": f"""
    select cast(o.user_id as varchar) user_id, c.pro_code item_code,
           cast(count(*) as double) usage_counter
    {CIP_USES} group by all""",
    "vvip_collection": collection("M"),
    "banner_browse": f"""
    select v.user_id, banner item_code, count(*) browse_num {BANNERS} group by all""",
    "article_browse": f"""
    select user_id, item_code, count(*) browse_num from {READS} group by all""",
    "article_favor": """
    select user_id, lettres_id item_code, count(*) favor_num from tbd_lettres_favor
    where trim(user_id) <> '' and lettres_id is not null
    group by all""",
    "rest_consumption_tag": """
    select cast(o.user_id as varchar) user_id, count(*) rest_consumption_num"""
    + REST_LINES.format(price="cprice")
    + " group by all",
    "rest_avg_amount_tag": """
    select cast(o.user_id as varchar) user_id,
           cast(trunc(cast(sum(cast(d.xfprice as decimal(18,2))) as double) / count(*)) as bigint) rest_average_order_amount_int"""
    + REST_LINES.format(price="xfprice")
    + " group by all",
    "rest_multitime_tag": f"""
    select user_id, cast(sum(case when n > 1 then 1 else 0 end) as bigint)
               rest_multitime_consumption_num
    from ({PER_DAY}) group by all""",
    "rest_usage_tag": """
    select cast(o.user_id as varchar) user_id, count(*) rest_usage_counter
    from td_restaurant_order t join tb_order o on t.fd_code = o.order_no
    where o.user_id is not null
    group by all""",
    "rest_browse_tag": browse_tag(RESTAURANT_URLS, "rest_browse_num"),
    "rest_browse_hour_tag": f"""
    select user_id, cast(sum(spent) as bigint) rest_browse_hour from {HOURS} group by all""",
    "rest_collection_tag": collection_tag("rest_collection_num"),
    "rest_preference": """
    select cast(o.user_id as varchar) user_id,
           case when sum(cast(c.fd_cls as double)) / count(*) >= 0.5 then '中餐' else '西餐' end
               restaurant_preferences
    from restaurant_order_detail2 d join tb_order o on d.fd_code = o.order_no
    join restaurant_class c on d.fd_class = c.fd_class
    where o.user_id is not null
    group by o.user_id""",
    "lounge_consumption_tag": """
    select user_id, count(*) lounge_consumption_num
    from (select cast(o.user_id as varchar) user_id,
                 unnest(string_split(rtrim(l.self, ','), ',')) part
          from tb_order_loungeserv l join tb_order o on l.order_no = o.order_no
          where o.user_id is not null and l.self is not null)
    where part <> ''
    group by user_id""",
    "lounge_avg_amount_tag": f"""
    select cast(b.user_id as varchar) user_id,
           cast(sum(v.point) // count(v.point) as bigint) lounge_average_order_amount
    {VISITS} group by all""",
    "lounge_people_tag": f"""
    select cast(b.user_id as varchar) user_id,
           cast(sum(v.personcount) as bigint) lounge_people_consumption
    {VISITS} group by all""",
    "lounge_usage_tag": f"""
    select cast(b.user_id as varchar) user_id, count(*) lounge_usage_counter
    {VISITS} group by all""",
    "lounge_browse_tag": browse_tag(LOUNGE_URLS, "lounge_browse_num"),
    "lounge_collection_tag": collection_tag("lounge_collection_num", "N"),
    "lounge_comment_tag": """
    select cast(user_id as varchar) user_id, count(*) lounge_comment_num
    from tb_customer_share
    where user_id is not null and score > 2 and starts_with(code, 'N')
    group by all""",
    "shop_browse_tag": browse_tag(SHOP_URLS, "shop_browse_num"),
    "shop_collection_tag": collection_tag("shop_collection_num", "F"),
    "banner_browse_tag": f"""
    select v.user_id, count(*) banner_browse_num {BANNERS} group by all""",
    "article_browse_tag": f"""
    select user_id, count(*) article_browse_num from {READS} group by all""",
    "article_favor_tag": """
    select user_id, count(*) article_favor_num from tbd_lettres_favor
    where trim(user_id) <> '' and lettres_id is not null
    group by all""",
    "article_labels": f"""
    select user_id,
           cast(sum(case when label = 1 then 1 else 0 end) as bigint) business,
           cast(sum(case when label = 2 then 1 else 0 end) as bigint) student,
           cast(sum(case when label = 3 then 1 else 0 end) as bigint) eleven,
           cast(sum(case when label = 4 then 1 else 0 end) as bigint) home,
           cast(sum(case when label = 5 then 1 else 0 end) as bigint) crowd
    from (select r.user_id,
                 case when contains(coalesce(l.person_labels, '0'), '商旅出行') then 1
                      when contains(coalesce(l.person_labels, '0'), '学生/背包客') then 2
                      when contains(coalesce(l.person_labels, '0'), '十一') then 3
                      when contains(coalesce(l.person_labels, '0'), '家庭出行') then 4
                      when contains(coalesce(l.person_labels, '0'), '人群标签') then 5
                      else 0 end label
          from {READS} r left join tbd_belles_lettres l on r.item_code = l.id)
    group by user_id""",
    "cip_consumption_tag": service_tag(
        "tb_order_cip", "cip_consumption_num", "s.pro_code is not null"
    ),
    "cip_avg_amount_tag": service_average_tag(
        "tb_order_cip", "cip_average_order_amount", "s.pro_code is not null"
    ),
    "cip_usage_tag": f"""
    select cast(o.user_id as varchar) user_id, count(*) cip_usage_counter
    {CIP_USES} group by all""",
    "cip_browse_tag": browse_tag(CIP_URLS, "cip_browse_num"),
    "vvip_consumption_tag": service_tag("tb_order_vvip", "vvip_consumption_num"),
    "vvip_avg_amount_tag": service_average_tag("tb_order_vvip", "vvip_average_order_amount"),
    "vvip_browse_tag": browse_tag(VVIP_URLS, "vvip_browse_num"),
    "vvip_collection_tag": collection_tag("vvip_collection_num", "M"),
    "car_consumption_tag": service_tag("tb_order_limousine", "car_consumption_num"),
    "car_avg_amount_tag": service_average_tag("tb_order_limousine", "car_average_order_amount"),
    "car_browse_tag": browse_tag(CAR_URLS, "car_browse_num"),
    "parking_consumption_tag": service_tag("tb_order_parking", "parking_consumption_num"),
    "parking_avg_amount_tag": service_average_tag(
        "tb_order_parking", "parking_average_order_amount"
    ),
    "parking_browse_tag": browse_tag(PARKING_URLS, "parking_browse_num"),
    "restaurant_priority": """
    select fd_code restaurant_code,
           cast(case when coalesce(fd_isflashsale, 0) = 1 then 3
                     when coalesce(fd_iscoupon, 0) = 1 then 2
                     when coalesce(fd_settlementdiscount, 0) = 1 then 1
                     else 0 end as bigint) priority
    from itd_restaurant where fd_lg = 'zh-cn'""",
    "path_detail_extract": """
    select id, user_id, page_time, page_parent_id from tbd_app_opera_path
    where page_name in ('RestaurantDetailViewController', 'NetworkRestaurantActivity')""",
    "path_page_extract": """
    select id, user_id, page_order, page_name, page_time, page_parent_id
    from tbd_app_opera_path where page_order = 1""",
    "path_range_extract": """
    select id, user_id, page_order, page_name, page_time, page_parent_id
    from tbd_app_opera_path where page_order >= 18 and page_order <= 25""",
    "path_tail_extract": """
    select id, user_id, page_order, page_name, page_time, page_parent_id,
           cast(case when page_order <= 29 then 0 when page_order <= 33 then 1
                     when page_order <= 38 then 2 when page_order <= 55 then 3
                     when page_order <= 70 then 4 when page_order <= 82 then 5
                     when page_order <= 700 then 6 else 7 end as integer) path_bucket
    from tbd_app_opera_path where page_order >= 26""",
    "url_visit_extract": f"""
    select user_id, item_code,
           cast(epoch(try_cast(begin_date as timestamp)) as bigint) visit_second
    from (select user_id, begin_date, {json_text('code')} item_code from tbd_url_element
          where url in ({RESTAURANT_URLS}))
    where trim(user_id) <> '' and user_id <> '0' and starts_with(item_code, 'R')
      and try_cast(begin_date as timestamp) is not null""",
}

PARTS_OF_PROFILE: dict[str, list[str]] = {
    "profile_rest": [
        "rest_consumption",
        "rest_avg_amount",
        "rest_multitime",
        "rest_usage",
        "rest_browse",
        "rest_browse_hour",
        "rest_collection",
        "rest_comment",
    ],
    "profile_lounge": [
        "lounge_consumption",
        "lounge_avg_amount",
        "lounge_people",
        "lounge_usage",
        "lounge_browse",
        "lounge_collection",
        "lounge_comment",
    ],
    "profile_shop": ["shop_browse", "shop_collection"],
    "profile_parking": ["parking_consumption", "parking_avg_amount", "parking_browse"],
    "profile_cip": ["cip_consumption", "cip_avg_amount", "cip_usage"],
    "profile_article": ["article_browse", "article_favor"],
    "profile_user_tags": [
        name
        for name in METRIC_SQL
        if name.endswith("_tag") or name in ("rest_preference", "article_labels")
    ],
}


def profile_sql(name: str) -> str:
    """Every metric on its own, stacked by column name and folded to one row per key."""
    keys = "user_id" if name == "profile_user_tags" else "user_id, item_code"
    stacked = " union all by name ".join(f"({METRIC_SQL[p]})" for p in PARTS_OF_PROFILE[name])
    return f"select {keys}, max(columns(* exclude ({keys}))) from ({stacked}) group by {keys}"


def with_views(sql: str) -> str:
    """Prefix the query with the input views it mentions."""
    used = [view for view in VIEWS if re.search(rf"\b{view}\b", sql)]
    base = {name: name for name in BASE_TABLES}
    ctes = ",\n".join(f"{view} as ({VIEWS[view].format(**base)})" for view in used)
    return f"with {ctes}\n{sql}"


LOOKUP_SQL = {
    "banner_table_browse": """
    select user_id, id item_code, count(*) browse_num
    from (select v.user_id, v.url, v.n, p.id
          from (select *, row_number() over () n from tbd_visit_url) v
          join (select prefix, min(id) id from banner_prefixes group by prefix) p on starts_with(v.url, p.prefix)
          where trim(v.user_id) <> ''
          qualify row_number() over (partition by v.n order by length(p.prefix) desc) = 1)
    group by all""",
}


def all_sql() -> dict[str, str]:
    queries = {**METRIC_SQL, **LOOKUP_SQL, **{name: profile_sql(name) for name in PROFILES}}
    return {name: with_views(sql) for name, sql in queries.items()}
