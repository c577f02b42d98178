"""Every query against its SQL on small random tables full of awkward values.

The sample views cannot hold repeated order numbers, cards or articles, NULL order numbers,
broken lists and the like; these tables do, and the SQL runs on the very same rows.
"""

import random
from datetime import datetime, timedelta

import duckdb
import pytest

from conftest import collected
from oracle import METRIC_SQL, PARTS_OF_PROFILE, profile_sql
from tagloom import Settings
from tagloom.plans.metrics import METRICS
from tagloom.plans.profiles import PROFILES
from tagloom.settings import DETAIL_PAGE_NAMES
from tagloom.sources.schemas import schema

PAGES = [
    "/VirtualCard-v6/restaurant/detail",
    "/VirtualCard-en/restaurant/detail",
    "/VirtualCard-v6/lounge/buttonShow",
    "/VirtualCard-v5/shop/getNearbyShare",
    "/VirtualCard-v6/parking/items",
    "/VirtualCard-v6/trafficsite/list/parking",
    "/VirtualCard-v5/orderCip/getCips",
    "/VirtualCard-v6/trafficsite/listHot/limousine",
    "/VirtualCard-v5/share/getVvipShare",
    "/elsewhere",
    None,
]
PARAMS = [
    '{"userId":"1","code":"R1","shopCode":"F1","parkingCode":"P1"}',
    '{"userId":"2","code":"N1"}',
    '{"code":"R2","userId":"2","extra":{"userId":"9"}}',
    '{"userId":3,"code":"R1","shopCode":7}',
    '{"userId":"","code":"R1"}',
    '{"userId":" ","code":"R1"}',
    '{"userId":"1","code":null}',
    '{"code":"R3"}',
    "{}",
    "[]",
    "bad",
    "",
    None,
]
URLS = [
    "https://m.example.org/institute/1?src=feed",
    "https://m.example.org/institute/2/part",
    "https://m.example.org/institute/3",
    "https://m.example.org/institute/9",
    "https://m.example.org/institute/",
    "https://m.example.org/institute",
    "https://activity.example.org/newest",
    "https://activity.example.org/newest/more",
    "https://activity.example.org/lucky/x",
    "https://activity.example.org/lucky",
    "",
    None,
]
LABELS = ["商旅出行,十一", "十一,家庭出行", "学生/背包客", "人群标签", "其他", "", None]
LISTS = ["N1,N2", "N1,", ",N2,,N1", ",", "", "N3", "N1,N1,N1", None]
LINES = ["(1,R1,5)", "(1,R1,7)", "2,R2,0", "(3,R1,x)", "(,R1,4)", "(4,R1)", "", "(5,,3)", None]
DATES = ["2024-01-01 00:00:00", "2024-07-01 23:59:59", "not a date", "", None]


def some(rng, *values):
    return rng.choice(values)


def generators(rng):
    user = lambda: some(rng, 1, 1, 1, 2, 3, 4, 17, None)
    text_user = lambda: some(rng, "0", "1", "1", "2", "3", "", "  ", None)
    order = lambda: some(rng, *["a"] * 6, "b", "c", "d", "e", "f", "missing", None)
    codes = ["R1", "R1", "R2", "R3", "N1", "N2", "F1", "M1", "X1", None]
    code = lambda: some(rng, *codes)
    price = lambda: some(rng, 10.25, 20.5, 30.75, 41.0, -3.5, 0.0, None)
    number = lambda: some(rng, 0, 1, 2, 3, 5, None)
    card = lambda: some(rng, "k1", "k1", "k1", "k2", "k3", "lost", None)
    time = lambda: some(
        rng, *[datetime(2024, 1, 1) + timedelta(hours=6 * n) for n in range(8)], None
    )
    return {
        "tb_order": lambda: (order(), user(), price()),
        "restaurant_order_detail2": lambda: (
            order(), code(), time(), price(), price(), some(rng, "c1", "c2", "c3", None)
        ),
        "itd_restaurant": lambda: (
            code(), some(rng, "zh-cn", "zh-cn", "en", None), some(rng, "T1", "T2", None),
            number(), number(), number(),
        ),
        "td_restaurant_order": lambda: (order(), code()),
        "restaurant_class": lambda: (some(rng, "c1", "c2", None), some(rng, "0", "1", "0.5")),
        "tb_user_collect": lambda: (user(), code()),
        "customer_share": lambda: (user(), code()),
        "tb_customer_share": lambda: (user(), code(), number()),
        "tblconsumerecord": lambda: (card(), code(), number(), number()),
        "tb_bindrecord": lambda: (card(), user()),
        "tb_order_loungeserv": lambda: (order(), card(), some(rng, *LISTS), some(rng, *LISTS)),
        "tbd_url_element": lambda: (
            text_user(), some(rng, *PAGES), some(rng, *PARAMS), some(rng, *DATES)
        ),
        "tbd_visit_url": lambda: (text_user(), some(rng, *URLS)),
        "tbd_belles_lettres": lambda: (some(rng, "1", "2", "3", None), some(rng, *LABELS)),
        "tbd_lettres_favor": lambda: (text_user(), some(rng, "1", "2", None)),
        "tb_order_cip": lambda: (order(), some(rng, "C1", "C2", None)),
        "tb_order_cip_record": lambda: (order(),),
        "tb_order_vvip": lambda: (order(),),
        "tb_order_parking": lambda: (order(), some(rng, "P1", "P2", None)),
        "tb_order_limousine": lambda: (order(),),
        "tbd_app_opera_path": lambda: (
            rng.randrange(999), user(), some(rng, 1, 18, 25, 26, 33, 55, 82, 700, 701, 9999, None),
            some(rng, *DETAIL_PAGE_NAMES, "other", None), time(), number(),
        ),
        "browse_hours": lambda: (some(rng, *LINES),),
    }


@pytest.fixture(scope="module", params=[1, 2])
def both(spark, request):
    """The same random rows in Spark and in DuckDB."""
    rng = random.Random(request.param)
    duck = duckdb.connect()
    frames = {}
    for name, make in generators(rng).items():
        rows = [make() for _ in range(rng.choice([25, 60]))]
        frames[name] = spark.createDataFrame(rows, schema(name)).coalesce(2).cache()
        types = {"string": "varchar", "double": "double", "bigint": "bigint"}
        ddl = ", ".join(f"{n} {types.get(t, 'timestamp')}" for n, t in frames[name].dtypes)
        duck.execute(f"create table {name} ({ddl})")
        holes = ", ".join("?" * len(frames[name].columns))
        duck.executemany(f"insert into {name} values ({holes})", rows)
    yield frames.__getitem__, duck
    for frame in frames.values():
        frame.unpersist()


@pytest.mark.parametrize("name", [*METRIC_SQL, *PARTS_OF_PROFILE])
def test_random_tables(both, name):
    tables, duck = both
    ours = {**METRICS, **PROFILES}[name](tables, Settings())
    columns = sorted(ours.columns)
    result = duck.execute(profile_sql(name) if name in PROFILES else METRIC_SQL[name])
    names = [d[0] for d in result.description]
    expected = sorted(
        (tuple(row[names.index(c)] for c in columns) for row in result.fetchall()), key=repr
    )
    assert collected(ours.select(*columns)) == expected
