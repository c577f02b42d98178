"""The quiet rules of the metric definitions, one small frame per rule."""

from datetime import datetime

import pytest
from conftest import collected
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from tagloom import Settings
from tagloom.functions import exprs
from tagloom.plans.metrics import METRICS
from tagloom.plans.profiles import PROFILES

NOON = datetime(2024, 5, 1, 12)
EVENING = datetime(2024, 5, 1, 20)
NEXT_DAY = datetime(2024, 5, 2, 12)


def result(name, tables, **settings):
    return collected({**METRICS, **PROFILES}[name](tables, Settings(**settings)))


def restaurant(code, language="zh-cn", place="T2", coupon=None, flash=None, discount=None):
    return (code, language, place, coupon, flash, discount)


def test_null_and_blank_users_are_dropped(tables):
    log = tables(
        tbd_visit_url=[
            (None, "https://m.example.org/institute/1"),
            ("", "https://m.example.org/institute/1"),
            ("  ", "https://m.example.org/institute/1"),
            ("7", "https://m.example.org/institute/1"),
        ],
        tb_user_collect=[(None, "R1"), (7, "R1")],
    )
    assert result("article_browse", log) == [("7", "1", 1)]
    assert result("article_browse_tag", log) == [("7", 1)]
    assert result("rest_collection", log) == [("7", "R1", 1)]


def test_text_user_ids_in_the_orders_are_checked_for_blanks(spark, tables):
    others = tables(tb_order_vvip=[("a",), ("b",), ("c",)])
    orders = spark.createDataFrame(
        [("a", " ", 5.0), ("b", "u", 5.0), ("c", None, 5.0)],
        "order_no string, user_id string, actual_amount double",
    )
    mixed = lambda name: orders if name == "tb_order" else others(name)
    assert result("vvip_consumption_tag", mixed) == [("u", 1)]


def test_every_selected_order_column_must_be_present(tables):
    detail = ("o1", "R1", NOON, 10.0, 9.0, "cls")
    broken = [
        detail,
        (*detail[:2], None, *detail[3:]),
        (*detail[:3], None, *detail[4:]),
        (*detail[:3], float("nan"), *detail[4:]),
        (*detail[:5], None),
        ("unknown", *detail[1:]),
        ("o1", "R2", *detail[2:]),
        ("o1", "R3", *detail[2:]),
        ("o1", "R4", *detail[2:]),
        ("o2", *detail[1:]),
    ]
    t = tables(
        restaurant_order_detail2=broken,
        itd_restaurant=[restaurant("R1"), restaurant("R2", "en"), restaurant("R3", place=None)],
        tb_order=[("o1", 1, 9.0), ("o2", None, 9.0)],
    )
    assert result("rest_consumption", t) == [("1", "R1", 1)]
    assert result("rest_consumption_tag", t) == [("1", 1)]


def test_prices_are_required_one_by_one(tables):
    t = tables(
        restaurant_order_detail2=[
            ("o1", "R1", NOON, 10.0, None, "c"),
            ("o1", "R1", NOON, 10.0, 4.0, "c"),
            ("o1", "R1", EVENING, None, 9.0, "c"),
            ("o2", "R1", NOON, None, 3.0, "c"),
            ("o3", "R1", NOON, 3.0, None, "c"),
        ],
        itd_restaurant=[restaurant("R1")],
        tb_order=[("o1", 1, 9.0), ("o2", 2, 9.0), ("o3", 3, 9.0)],
    )
    assert result("rest_consumption", t) == [("1", "R1", 2), ("3", "R1", 1)]
    assert result("rest_avg_amount", t) == [("1", "R1", 6.5), ("2", "R1", 3.0)]
    assert result("rest_multitime", t) == [("1", "R1", True), ("3", "R1", False)]
    profile = PROFILES["profile_rest"](t, Settings()).select(
        "user_id", "consumption_num", "average_order_amount", "multitime_consumption"
    )
    assert collected(profile) == [
        ("1", 2, 6.5, True),
        ("2", None, 3.0, None),
        ("3", 1, None, False),
    ]
    tags = PROFILES["profile_user_tags"](t, Settings()).select(
        "user_id",
        "rest_consumption_num",
        "rest_average_order_amount_int",
        "rest_multitime_consumption_num",
    )
    assert collected(tags) == [("1", 2, 6, 1), ("2", None, 3, None), ("3", 1, None, 0)]


def test_second_counted_row_of_a_restaurant_doubles_its_orders(tables):
    t = tables(
        restaurant_order_detail2=[("o1", "R1", NOON, 10.0, 9.0, "c")],
        itd_restaurant=[restaurant("R1"), restaurant("R1", place="T3"), restaurant("R1", "en")],
        tb_order=[("o1", 1, 9.0)],
    )
    assert result("rest_consumption", t) == [("1", "R1", 2)]
    assert result("rest_multitime", t) == [("1", "R1", True)]
    assert result("rest_avg_amount", t) == [("1", "R1", 9.0)]


def test_repeat_orders_need_one_day_and_one_restaurant(tables):
    def detail(order, code, time):
        return (order, code, time, 1.0, 1.0, "c")

    t = tables(
        restaurant_order_detail2=[
            detail("o1", "R1", NOON),
            detail("o1", "R1", EVENING),
            detail("o1", "R1", NEXT_DAY),
            detail("o1", "R2", NOON),
            detail("o2", "R1", NOON),
            detail("o2", "R1", NEXT_DAY),
            detail("o3", "R1", NOON),
            detail("o3", "R1", NOON),
            detail("o3", "R2", NOON),
            detail("o3", "R2", EVENING),
        ],
        itd_restaurant=[restaurant("R1"), restaurant("R2")],
        tb_order=[("o1", 1, 1.0), ("o2", 2, 1.0), ("o3", 3, 1.0)],
    )
    assert result("rest_multitime", t) == [
        ("1", "R1", True),
        ("1", "R2", False),
        ("2", "R1", False),
        ("3", "R1", True),
        ("3", "R2", True),
    ]
    assert result("rest_multitime_tag", t) == [("1", 1), ("2", 0), ("3", 2)]


def test_amounts_lose_their_fraction_before_they_are_added(tables):
    t = tables(
        tb_order=[("a", 1, 10.9), ("b", 1, 11.9), ("c", 2, -3.7), ("d", 2, -4.2), ("e", 3, None)],
        tb_order_cip=[(o, "C1") for o in "abcde"],
        tb_order_parking=[("a", "P1"), ("b", None)],
    )
    assert result("cip_avg_amount", t) == [("1", "C1", 10.5), ("2", "C1", -3.5)]
    assert result("cip_avg_amount_tag", t) == [("1", 10), ("2", -3)]
    assert result("cip_consumption_tag", t) == [("1", 2), ("2", 2), ("3", 1)]
    assert result("parking_avg_amount", t) == [("1", "P1", 10.0)]
    assert result("parking_avg_amount_tag", t) == [("1", 10)]
    assert result("parking_consumption", t) == [("1", "P1", 1)]
    assert result("parking_consumption_tag", t) == [("1", 2)]
    tags = PROFILES["profile_user_tags"](t, Settings()).select(
        "user_id", "cip_consumption_num", "cip_average_order_amount", "parking_consumption_num"
    )
    assert collected(tags) == [("1", 2, 10, 2), ("2", 2, -3, None), ("3", 1, None, None)]


def test_item_lists_ignore_empty_parts(tables):
    t = tables(
        tb_order=[("a", 1, 1.0), ("b", 1, 1.0), ("c", 2, 1.0)],
        tb_bindrecord=[("card", 1), ("void", None)],
        tb_order_loungeserv=[
            ("a", "card", "N1,N2,,", "x,"),
            ("b", "card", ",", ","),
            ("c", "void", "N1", ""),
            ("c", None, "N1", None),
            ("c", "card", None, "y,z"),
        ],
    )
    assert result("lounge_consumption", t) == [("1", "N1", 1), ("1", "N2", 1)]
    assert result("lounge_consumption_tag", t) == [("1", 1), ("2", 2)]


def test_lounge_visits_need_the_lounge_letter_and_a_bound_card(tables):
    t = tables(
        tb_bindrecord=[("c1", 1), ("c2", None)],
        tblconsumerecord=[
            ("c1", "N1", 3, 2),
            ("c1", "N1", 4, None),
            ("c1", "N2", None, 1),
            ("c1", "X1", 9, 9),
            ("c1", None, 9, 9),
            ("c2", "N1", 9, 9),
            ("c3", "N1", 9, 9),
        ],
    )
    assert result("lounge_usage", t) == [("1", "N1", 2.0), ("1", "N2", 1.0)]
    assert result("lounge_people", t) == [("1", "N1", 2), ("1", "N2", 1)]
    assert result("lounge_avg_amount", t) == [("1", "N1", 3.5), ("1", "N2", None)]
    assert result("lounge_avg_amount_tag", t) == [("1", 3)]
    assert result("lounge_people_tag", t) == [("1", 3)]


def test_broken_json_counts_nowhere(tables):
    page = "/VirtualCard-v6/restaurant/detail"
    good = '{"userId":"1","code":"R1"}'
    t = tables(
        tbd_url_element=[
            ("1", page, good, "2024-01-01 00:00:00"),
            ("1", page, "bad", "2024-01-01 00:00:00"),
            ("1", page, None, "2024-01-01 00:00:00"),
            ("1", page, "null", "2024-01-01 00:00:00"),
            ("1", page, "[]", "2024-01-01 00:00:00"),
            ("1", page, '{"userId":"1","code":', "2024-01-01 00:00:00"),
            ("1", page, '{"userId":"1"}', "2024-01-01 00:00:00"),
            ("1", page, '{"userId":" ","code":"R1"}', "2024-01-01 00:00:00"),
            ("1", page + "/other", good, "2024-01-01 00:00:00"),
        ]
    )
    assert result("rest_browse", t) == [("1", "R1", 1)]
    # The tag needs no item code.
    assert result("rest_browse_tag", t) == [("1", 2)]


def test_each_parking_metric_has_its_own_pages(tables):
    param = '{"userId":"1","parkingCode":"P1"}'
    t = tables(
        tbd_url_element=[
            ("1", "/VirtualCard-v6/parking/index", param, None),
            ("1", "/VirtualCard-v6/parking/items", param, None),
            ("1", "/VirtualCard-v6/trafficsite/list/parking", param, None),
        ]
    )
    assert result("parking_browse", t) == [("1", "P1", 1)]
    assert result("parking_browse_tag", t) == [("1", 3)]


def test_restaurant_favourites_tag_counts_every_type(tables):
    t = tables(tb_user_collect=[(1, "R1"), (1, "N1"), (1, "F1"), (1, "M1"), (1, None), (2, "R1")])
    assert result("rest_collection", t) == [("1", "R1", 1), ("2", "R1", 1)]
    assert result("rest_collection_tag", t) == [("1", 5), ("2", 1)]
    assert result("vvip_collection_tag", t) == [("1", 1)]


def test_comments(tables):
    t = tables(
        customer_share=[(1, "R1"), (1, None), (1, "N1")],
        tb_customer_share=[(1, "N1", 3), (1, "N1", 2), (1, "N1", None), (1, "R1", 5), (1, None, 5)],
    )
    assert result("rest_comment", t) == [("1", "R1", 1)]
    assert result("lounge_comment", t) == [("1", "N1", 1)]
    assert result("lounge_comment_tag", t) == [("1", 1)]


def test_article_pages_without_an_id_are_no_reads(tables):
    t = tables(
        tbd_visit_url=[
            ("1", "https://m.example.org/institute/"),
            ("1", "https://m.example.org/institute/?src=feed"),
            ("1", "https://m.example.org/institute/12?src=feed"),
            ("1", "https://m.example.org/institute/12/more"),
            ("1", "https://m.example.org/institute"),
            ("1", None),
        ]
    )
    assert result("article_browse", t) == [("1", "12", 2)]
    assert result("article_browse_tag", t) == [("1", 2)]
    assert [row[:2] for row in result("profile_article", t)] == [("1", "12")]


def test_first_label_wins_and_readers_without_one_stay(tables):
    url = "https://m.example.org/institute/"
    t = tables(
        tbd_visit_url=[("1", url + "a"), ("1", url + "b"), ("2", url + "c"), ("3", url + "d")],
        tbd_belles_lettres=[
            ("a", "十一,商旅出行"),
            ("b", "家庭出行,十一"),
            ("c", None),
            (None, "十一"),
        ],
    )
    assert result("article_labels", t) == [
        ("1", 1, 0, 1, 0, 0),
        ("2", 0, 0, 0, 0, 0),
        ("3", 0, 0, 0, 0, 0),
    ]


def test_longer_banner_prefix_wins(tables):
    t = tables(
        tbd_visit_url=[
            ("1", "https://a/x/y"),
            ("1", "https://a/x"),
            ("1", "https://b"),
            (None, "https://a/x"),
        ]
    )
    banners = {"wide": "https://a/", "narrow": "https://a/x/"}
    assert result("banner_browse", t, banners=banners) == [("1", "narrow", 1), ("1", "wide", 1)]
    assert result("banner_browse_tag", t, banners=banners) == [("1", 2)]


def test_likes_need_user_and_article(tables):
    t = tables(tbd_lettres_favor=[("1", "a"), ("1", None), (None, "a"), ("", "a"), ("1", "b")])
    assert result("article_favor", t) == [("1", "a", 1), ("1", "b", 1)]
    assert result("article_favor_tag", t) == [("1", 2)]


def test_preference_at_exactly_half_is_chinese(tables):
    t = tables(
        restaurant_order_detail2=[
            ("o1", "R1", None, None, None, "east"),
            ("o1", "R1", None, None, None, "west"),
            ("o2", "R1", None, None, None, "west"),
            ("o3", "R1", None, None, None, "odd"),
            ("o3", "R1", None, None, None, None),
        ],
        restaurant_class=[("east", "1"), ("west", "0"), ("odd", "?")],
        tb_order=[("o1", 1, None), ("o2", 2, None), ("o3", 3, None)],
    )
    assert result("rest_preference", t) == [("1", "中餐"), ("2", "西餐")]
    tags = PROFILES["profile_user_tags"](t, Settings()).select("user_id", "restaurant_preferences")
    assert collected(tags) == [("1", "中餐"), ("2", "西餐")]


def test_priority_order_and_null_flags(tables):
    t = tables(
        itd_restaurant=[
            restaurant("R1", coupon=1, flash=1, discount=1),
            restaurant("R2", coupon=1, discount=1),
            restaurant("R3", discount=1),
            restaurant("R4"),
            restaurant("R5", coupon=0, flash=2, discount=0),
            restaurant("R6", "en", flash=1),
            restaurant("R7", None, flash=1),
        ]
    )
    assert result("restaurant_priority", t) == [
        ("R1", 3),
        ("R2", 2),
        ("R3", 1),
        ("R4", 0),
        ("R5", 0),
    ]


def test_cip_uses_multiply_records_and_lines(tables):
    t = tables(
        tb_order=[("a", 1, 1.0), ("b", None, 1.0), ("c", 1, 1.0)],
        tb_order_cip=[("a", "C1"), ("a", "C1"), ("a", "C2"), ("b", "C1"), ("c", None)],
        tb_order_cip_record=[("a",), ("a",), ("a",), ("b",), ("c",), (None,), ("d",)],
    )
    assert result("cip_usage", t) == [("1", "C1", 6.0), ("1", "C2", 3.0)]
    assert result("cip_usage_tag", t) == [("1", 9)]


def test_redemptions(tables):
    t = tables(
        tb_order=[("a", 1, None), ("b", None, None)],
        td_restaurant_order=[("a", "R1"), ("a", "R1"), ("a", None), ("b", "R1"), ("c", "R1")],
    )
    assert result("rest_usage", t) == [("1", "R1", 2.0)]
    assert result("rest_usage_tag", t) == [("1", 3)]


def test_browse_hours_text(tables):
    t = tables(
        browse_hours=[
            ("(1,R1,5)",),
            ("1,R1,2",),
            ("(1,R2,x)",),
            ("(1,R2)",),
            ("",),
            (None,),
            ("(,R1,3)",),
            ("(2,R1,4)",),
        ]
    )
    assert result("rest_browse_hour", t) == [("1", "R1", 2), ("1", "R1", 5), ("2", "R1", 4)]
    assert result("rest_browse_hour_tag", t) == [("1", 7), ("2", 4)]
    profile = PROFILES["profile_rest"](t, Settings()).select("user_id", "item_code", "browse_hour")
    assert collected(profile) == [("1", "R1", 5), ("2", "R1", 4)]


def test_url_visits(tables):
    page = "/VirtualCard-v5/restaurant/detail"
    code = '{"code":"R1"}'
    t = tables(
        tbd_url_element=[
            ("1", page, code, "1970-01-01 00:01:00"),
            ("1", page, code, "1970-01-01 00:01:00.5"),
            ("1", page, code, "yesterday"),
            ("1", page, code, "1970-13-01 00:00:00"),
            ("1", page, code, None),
            ("0", page, code, "1970-01-01 00:01:00"),
            (None, page, code, "1970-01-01 00:01:00"),
            ("1", page, '{"code":"N1"}', "1970-01-01 00:01:00"),
            ("1", page, "bad", "1970-01-01 00:01:00"),
        ]
    )
    assert result("url_visit_extract", t) == [("1", "R1", 60), ("1", "R1", 60)]
    shifted = result("url_visit_extract", t, log_time_zone="Asia/Shanghai")
    assert shifted == [("1", "R1", 60 - 8 * 3600)] * 2


def test_visit_seconds_do_not_depend_on_the_session_zone(spark, conf):
    frame = spark.createDataFrame([("2024-07-01 12:00:00",)], "t string")
    expected = frame.select(exprs.epoch_seconds("t", "UTC")).first()[0]
    conf(spark__sql__session__timeZone="America/New_York")
    assert frame.select(exprs.epoch_seconds("t", "UTC")).first()[0] == expected == 1719835200


def test_path_extracts(tables):
    def path(number, page, name="other"):
        return (number, 1, page, name, NOON, number - 1)

    t = tables(
        tbd_app_opera_path=[
            path(1, 1, "RestaurantDetailViewController"),
            path(2, 17, "NetworkRestaurantActivity"),
            path(3, 18),
            path(4, 25),
            path(5, 26),
            path(6, 700),
            path(7, 701),
            path(8, 5000),
        ]
    )

    def ids(name, **settings):
        return sorted(r["id"] for r in METRICS[name](t, Settings(**settings)).collect())

    assert ids("path_detail_extract") == [1, 2]
    assert ids("path_page_extract") == [1]
    assert ids("path_page_extract", page_order=18) == [3]
    assert ids("path_range_extract") == [3, 4]
    tail = METRICS["path_tail_extract"](t, Settings()).select("id", "path_bucket")
    assert collected(tail) == [(5, 0), (6, 6), (7, 7), (8, 7)]


@hypothesis_settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="ab,", max_size=8), min_size=1, max_size=20))
def test_item_lists_match_plain_splitting(spark, lists):
    frame = spark.createDataFrame([(text,) for text in lists], "items string")
    got = [row[0] for row in frame.select(exprs.csv_items("items")).collect()]
    assert got == [[part for part in text.split(",") if part] for text in lists]


def test_averages_survive_keys_without_amounts(spark):
    frame = spark.createDataFrame([(1, None, 0), (2, 7, 1), (2, 8, 1)], "k int, v bigint, n bigint")
    means = frame.groupBy("k").agg(
        exprs.truncated_mean("v", "n").alias("whole"), exprs.mean("v", "n").alias("mean")
    )
    assert collected(means) == [(1, None, None), (2, 7, 7.5)]


@pytest.mark.parametrize(
    "amount, whole", [(2.9, 2), (-2.9, -2), (float("nan"), None), (1e300, None)]
)
def test_whole_amounts(spark, amount, whole):
    frame = spark.createDataFrame([(amount,)], "v double")
    assert frame.select(exprs.whole_amount("v")).first()[0] == whole
