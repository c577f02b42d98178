"""Input tables derived from the bundled star-schema test data.

Each view is SQL that Spark and DuckDB both accept; ``{orders}`` and the like stand for the
base tables. The views plant the awkward inputs: NULL and blank users, NULL flags, trailing
commas, broken JSON, foreign prefixes, overlapping labels and restaurants without a counted row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.sources.tables import remembered

# Columns of the base tables. Declaring them spares the job that would read a
# file footer to infer them.
BASE_SCHEMAS: dict[str, str] = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "pages": "page_id bigint, url string, html string",
}
BASE_TABLES = tuple(BASE_SCHEMAS)

VIEWS: dict[str, str] = {
    "tb_order": """
        select cast(o_orderkey as string) order_no,
               case when o_orderkey % 50 = 0 then null else o_custkey end user_id,
               o_totalprice actual_amount
        from {orders}""",
    "restaurant_order_detail2": """
        select cast(l_orderkey as string) fd_code,
               concat('R', cast(l_suppkey as string)) fd_restaurant_code,
               o_orderdate ordertime, l_extendedprice cprice,
               cast(floor(l_extendedprice*(1-l_discount)*100)/100 as double) xfprice, p_type fd_class
        from {lineitem} join {orders} on l_orderkey=o_orderkey join {part} on l_partkey=p_partkey""",
    "itd_restaurant": """
        select concat('R', cast(s_suppkey as string)) fd_code,
               case when s_nationkey % 5 = 0 then 'en' else 'zh-cn' end fd_lg,
               n_name fd_inspection,
               case when s_suppkey % 7 = 0 then null else s_suppkey % 2 end fd_iscoupon,
               case when s_suppkey % 3 = 0 then 1 else 0 end fd_isflashsale,
               case when s_suppkey % 5 = 0 then 1 else 0 end fd_settlementdiscount
        from {supplier} join {nation} on s_nationkey=n_nationkey""",
    "td_restaurant_order": """
        select distinct cast(l_orderkey as string) fd_code,
               concat('R', cast(l_suppkey as string)) fd_restaurant_code
        from {lineitem} where l_returnflag='R'""",
    "restaurant_class": """
        select distinct p_type fd_class,
               case when p_type in ('ECONOMY','SMALL','PROMO') then '1' else '0' end fd_cls
        from {part}""",
    "tb_user_collect": """
        select o_custkey user_id,
               concat(substr('RFNM', cast(l_linenumber % 4 + 1 as int), 1),
                      cast(l_partkey as string)) code
        from {lineitem} join {orders} on l_orderkey=o_orderkey where l_returnflag='A'""",
    "customer_share": """
        select o_custkey user_id,
               case when l_linenumber=1 then null
                    else concat(case when l_linenumber % 2 = 0 then 'R' else 'N' end,
                                cast(l_suppkey as string)) end code
        from {lineitem} join {orders} on l_orderkey=o_orderkey where l_linestatus='F'""",
    "tb_customer_share": """
        select o_custkey user_id,
               concat(case when l_linenumber % 2 = 0 then 'R' else 'N' end,
                      cast(l_suppkey as string)) code,
               cast(l_quantity as bigint) % 6 score
        from {lineitem} join {orders} on l_orderkey=o_orderkey where l_linestatus='O'""",
    "tblconsumerecord": """
        select cast(o_custkey as string) dragoncode,
               concat(case when l_linenumber=3 then 'X' else 'N' end,
                      cast(l_suppkey as string)) loungecode,
               cast(l_quantity as bigint) point, cast(l_linenumber as bigint) personcount
        from {lineitem} join {orders} on l_orderkey=o_orderkey""",
    "tb_bindrecord": """
        select cast(c_custkey as string) dragoncode,
               case when c_custkey % 20 = 0 then null else c_custkey end user_id
        from {customer}""",
    "tb_order_loungeserv": """
        select cast(o_orderkey as string) order_no, cast(o_custkey as string) dragoncode,
               case when o_orderkey % 9 = 0 then null
                    else concat('N', cast(o_orderkey % 7 as string),
                                ',N', cast(o_orderkey % 11 as string),
                                case when o_orderkey % 4 = 0 then ',' else '' end) end lounge_code,
               concat(cast(o_orderkey % 3 as string),
                      case when o_orderkey % 2 = 0 then ',1,' else '' end) self
        from {orders} where o_orderstatus='O'""",
    "tbd_url_element": """
        select cast(user_id as string) user_id,
               case event_id % 8 when 0 then '/VirtualCard-v6/restaurant/detail'
                    when 1 then '/VirtualCard-v5/lounge/detail'
                    when 2 then '/VirtualCard-v5/shop/detail'
                    when 3 then '/VirtualCard-v6/parking/items'
                    when 4 then '/VirtualCard-v6/vvip/index'
                    when 5 then '/VirtualCard-v6/orderCip/listCip'
                    when 6 then '/VirtualCard-v6/limousine/carTypeList'
                    else '/VirtualCard-v6/parking/index' end url,
               case when event_id % 200 = 8 then 'bad'
                    else concat('{{"userId":"',
                                case when event_id % 40 < 3 then '' else cast(user_id as string) end,
                                '","code":"',
                                case when event_id % 24 = 0 then 'X'
                                     when event_id % 8 = 1 then 'N' else 'R' end,
                                cast(item as string),
                                '","shopCode":"F', cast(item as string),
                                '","parkingCode":"P', cast(item as string),
                                '"}}') end param,
               substr(cast(ts as string),1,19) begin_date
        from (select event_id, user_id, ts, cast(floor(event_id / 8) as bigint)
                                            % (select count(*) from {supplier}) item
              from {events}) view""",
    "tbd_visit_url": """
        select case when event_id % 40 = 0 then null else cast(user_id as string) end user_id,
               case event_id % 4
                    when 0 then concat('https://m.example.org/institute/', cast(page as string),
                                       '?src=feed')
                    when 1 then concat('https://activity.example.org/',
                                       case place when 0 then 'newest/a' when 1 then 'lucky/b?x=1'
                                            when 2 then 'page3/deep?y'
                                            else concat('page', cast(place as string), '/z') end)
                    when 2 then 'https://activity.example.org/lucky/b?x=1'
                    else url end url
        from (select event_id, user_id, cast(floor(event_id / 4) as bigint) % 12 place,
                     cast(floor(event_id / 4) as bigint) % (select count(*) from {pages}) page
              from {events}) visit
        join {pages} on page = page_id""",
    "tbd_belles_lettres": """
        select cast(page_id as string) id,
               case page_id % 6 when 0 then '商旅出行,十一' when 1 then '学生/背包客'
                    when 2 then '十一' when 3 then '家庭出行' when 4 then '人群标签'
                    else null end person_labels
        from {pages}""",
    "tbd_lettres_favor": """
        select cast(user_id as string) user_id,
               case when event_id % 30 = 0 then null
                    else cast(cast(floor(event_id / 4) as bigint)
                              % (select count(*) from {pages}) as string) end lettres_id
        from {events} where event_type='click'""",
    "tb_order_cip": """
        select cast(o_orderkey as string) order_no,
               concat('C', cast(o_custkey % 10 as string)) pro_code
        from {orders} where o_orderkey % 4 = 0""",
    "tb_order_cip_record": """
        select cast(l_orderkey as string) order_no from {lineitem} where l_orderkey % 4 = 0""",
    "tb_order_vvip": """
        select cast(o_orderkey as string) order_no from {orders} where o_orderkey % 4 = 1""",
    "tb_order_parking": """
        select cast(o_orderkey as string) order_no,
               case when o_orderkey % 10 = 2 then null
                    else concat('P', cast(o_custkey % 10 as string)) end parking_code
        from {orders} where o_orderkey % 4 = 2""",
    "tb_order_limousine": """
        select cast(o_orderkey as string) order_no from {orders} where o_orderkey % 4 = 3""",
    "tbd_app_opera_path": """
        select event_id id, user_id, event_id % 1500 page_order,
               case event_type when 'view' then 'RestaurantDetailViewController'
                    when 'click' then 'NetworkRestaurantActivity'
                    else event_type end page_name,
               ts page_time, event_id - 1 page_parent_id
        from {events}""",
    "banner_prefixes": """
        select concat('P', cast(page_id as string)) id, url prefix from {pages}
        union all select 'site' id, 'https://' prefix""",
    "browse_hours": """
        select concat('(', cast(user_id as string), ',R',
                      cast(event_id % (select count(*) from {supplier}) as string), ',',
                      cast(cast(floor(value) as bigint) % 24 as string), ')') line
        from {events}""",
}


def base_tables_of(view: str) -> list[str]:
    return [name for name in BASE_TABLES if "{" + name + "}" in VIEWS[view]]


def sample_tables(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Resolver over ``sf_dir/<base table>.parquet``."""
    root = sf_dir.rstrip("/")
    base = remembered(
        lambda name: spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{root}/{name}.parquet")
    )

    def load(name: str) -> DataFrame:
        return spark.sql(VIEWS[name], **{table: base(table) for table in base_tables_of(name)})

    return remembered(load)
