"""Table resolvers and scans."""

import pytest

from conftest import SAMPLE_DIR, collected
from tagloom import Settings
from tagloom.plans.metrics import METRICS
from tagloom.settings import TAIL_RANGES
from tagloom.sources import jdbc
from tagloom.sources.samples import VIEWS, sample_tables
from tagloom.sources.schemas import SCHEMAS, columns, schema
from tagloom.sources.tables import (
    catalog_tables,
    given_tables,
    parquet_tables,
    text_lines,
    with_browse_hours,
)


class FakeReader:
    """Stands in for ``spark.read`` and remembers how a JDBC scan was asked for."""

    def __init__(self, frames):
        self.frames = frames
        self.calls = []

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self.frames[table]


class FakeSpark:
    def __init__(self, frames):
        self.read = FakeReader(frames)


def test_sample_views_have_the_declared_columns(spark):
    sample = sample_tables(spark, SAMPLE_DIR)
    assert set(VIEWS) == set(SCHEMAS)
    for name in SCHEMAS:
        assert sample(name).columns == columns(name), name
        assert sample(name).limit(1).count() == 1, name


def test_declared_sample_schemas_match_the_files(spark):
    from tagloom.sources.samples import BASE_SCHEMAS

    for name, ddl in BASE_SCHEMAS.items():
        found = spark.read.parquet(f"{SAMPLE_DIR}/{name}.parquet").schema
        declared = spark.read.schema(ddl).parquet(f"{SAMPLE_DIR}/{name}.parquet").schema
        assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in found]


def test_tables_are_resolved_once(spark):
    sample = sample_tables(spark, SAMPLE_DIR)
    assert sample("tb_order") is sample("tb_order")


def test_parquet_tables(spark, tmp_path):
    rows = [("1", "/VirtualCard-v6/restaurant/detail", '{"userId":"1","code":"R1"}', None)]
    frame = spark.createDataFrame(rows, schema("tbd_url_element"))
    frame.selectExpr("'x' as other", "*").write.parquet(f"{tmp_path}/tbd_url_element")
    tables = parquet_tables(spark, f"{tmp_path}/")
    assert tables("tbd_url_element").columns == columns("tbd_url_element")
    assert collected(METRICS["rest_browse"](tables, Settings())) == [("1", "R1", 1)]


def test_missing_columns_are_named(spark, tmp_path):
    spark.createDataFrame([("a",)], "order_no string").write.parquet(f"{tmp_path}/tb_order")
    with pytest.raises(ValueError, match="tb_order lacks columns .*user_id.*actual_amount"):
        parquet_tables(spark, str(tmp_path))("tb_order")


def test_catalog_tables(spark):
    spark.sql("create database if not exists stored")
    spark.createDataFrame([("a",)], "order_no string").write.saveAsTable("stored.tb_order_vvip")
    assert collected(catalog_tables(spark, "stored")("tb_order_vvip")) == [("a",)]
    spark.sql("drop database stored cascade")


def test_browse_hours_from_text(spark, tables, tmp_path):
    (tmp_path / "part-0").write_text("(1,R1,5)\n(1,R2,6)\n")
    resolved = with_browse_hours(tables(), text_lines(spark, str(tmp_path)))
    assert collected(METRICS["rest_browse_hour_tag"](resolved, Settings())) == [("1", 11)]
    assert resolved("tb_order").count() == 0


def test_given_tables(spark):
    frame = spark.createDataFrame([(1, "R1")], schema("tb_user_collect"))
    resolved = given_tables({"tb_user_collect": frame})
    assert collected(METRICS["rest_collection"](resolved, Settings())) == [("1", "R1", 1)]


def test_jdbc_tables_pick_connection_split_and_positions(spark):
    collect = spark.createDataFrame(
        [(9, 1, "x", "R1")], "id int, owner bigint, kind string, thing string"
    )
    path = spark.createDataFrame([], schema("tbd_app_opera_path"))
    cip = spark.createDataFrame([], schema("tb_order_cip"))
    fake = FakeSpark({"tb_user_collect": collect, "tbd_app_opera_path": path, "tb_order_cip": cip})
    connections = {n: (f"jdbc:{n}", {"user": f"u{n}"}) for n in (1, 2, 3)}
    tables = jdbc.jdbc_tables(
        fake, connections, splits={"tb_order_cip": ["order_no < 'm'", "order_no >= 'm'"]}
    )
    assert collected(METRICS["rest_collection"](tables, Settings())) == [("1", "R1", 1)]
    assert tables("tbd_app_opera_path").columns == columns("tbd_app_opera_path")
    assert tables("tb_order_cip").columns == columns("tb_order_cip")
    assert fake.read.calls == [
        ("jdbc:1", "tb_user_collect", {"properties": {"user": "u1"}}),
        (
            "jdbc:2",
            "tbd_app_opera_path",
            {
                "column": "page_order",
                "lowerBound": 1,
                "upperBound": 1500,
                "numPartitions": 8,
                "properties": {"user": "u2"},
            },
        ),
        (
            "jdbc:3",
            "tb_order_cip",
            {
                "predicates": ["order_no < 'm'", "order_no >= 'm'"],
                "properties": {"user": "u3"},
            },
        ),
    ]


def test_jdbc_settings_reach_the_scans(spark):
    fake = FakeSpark({name: spark.createDataFrame([], schema(name)) for name in SCHEMAS})
    listed = [{"url": f"jdbc:{n}", "properties": {"user": "u"}} for n in (1, 2, 3)]
    config = {
        "connections": listed,
        "splits": {
            "tbd_app_opera_path": {"column": "id", "lower": 1, "upper": 99, "partitions": 5},
            "tb_order_cip": ["order_no < 'm'", "order_no >= 'm'"],
        },
        "connection_of": {"tb_order_cip": 2},
        "fetchsize": 7,
    }
    tables = jdbc.configured_tables(fake, config, "cip_consumption")
    for name in ("tbd_app_opera_path", "tb_order_cip", "tb_order"):
        tables(name)
    (u1, _, path), (u2, _, cip), (u3, _, orders) = fake.read.calls
    assert (u1, u2, u3) == ("jdbc:2", "jdbc:2", "jdbc:3")
    assert (path["column"], path["numPartitions"]) == ("id", 5)
    assert len(cip["predicates"]) == 2
    assert orders == {"properties": {"fetchsize": "7", "user": "u"}}

    fake.read.calls.clear()
    jdbc.configured_tables(fake, listed, "path_tail_extract")("tbd_app_opera_path")
    assert fake.read.calls[0][2]["predicates"] == jdbc.tail_predicates()


@pytest.mark.parametrize(
    "config",
    [
        {"connections": [], "split": {}},
        {"connections": [], "splits": {"orders": []}},
        {"connections": [{"url": "x", "user": "u"}]},
    ],
)
def test_unknown_jdbc_settings_are_refused(spark, config):
    with pytest.raises(ValueError, match="unknown in the JDBC settings"):
        jdbc.configured_tables(spark, config, "cip_usage")


def test_jobs_choose_their_connections():
    assert jdbc.job_connections("restaurant_priority") == {"itd_restaurant": 3}
    for job in ("cip_usage_tag", "car_consumption_tag", "profile_parking", "vvip_browse_tag"):
        assert jdbc.job_connections(job) == {"tb_order": 3}
    for job in ("rest_consumption", "profile_user_tags", "lounge_usage"):
        assert jdbc.job_connections(job) == {}


def test_every_table_but_the_text_has_a_connection():
    assert set(jdbc.CONNECTION_OF_TABLE) == set(SCHEMAS) - {"browse_hours"}


def test_predicates_cover_their_pages_once(spark):
    pages = spark.range(1, 6000).toDF("page_order")

    def hits(predicates):
        matches = " + ".join(f"cast({p} as int)" for p in predicates)
        return pages.selectExpr("page_order", f"{matches} as hits")

    single = hits([f"({p})" for p in jdbc.page_predicates()])
    assert single.filter("hits != cast(page_order between 18 and 25 as int)").count() == 0
    tail = hits([f"({p})" for p in jdbc.tail_predicates()])
    assert tail.filter("hits != cast(page_order >= 26 as int)").count() == 0
    assert len(jdbc.tail_predicates()) == len(TAIL_RANGES) == 8
