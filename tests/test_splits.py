"""JDBC scans split by equal depth, against a reader that runs the database's part in Spark."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from conftest import collected
from tagloom.sources import jdbc


class RunningReader:
    """Runs the SQL that a JDBC read would send, over temporary views."""

    def __init__(self, spark):
        self.spark, self.calls = spark, []

    def jdbc(self, url, table, predicates=None, properties=None, **options):
        self.calls.append((url, table, predicates))
        rows = self.spark.sql(f"select * from {table}")
        if predicates is None:
            return rows
        parts = [rows.filter(p).withColumn("_part", F.lit(n)) for n, p in enumerate(predicates)]
        for part in parts[1:]:
            parts[0] = parts[0].union(part)
        return parts[0]


class RunningSpark:
    def __init__(self, spark):
        self.read = RunningReader(spark)


def read_parts(spark, values, kind, split):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"id long, place {kind}")
    rows.createOrReplaceTempView("path_log")
    fake = RunningSpark(spark)
    found = jdbc.scan(fake, "jdbc:x", "path_log", {"user": "u"}, split)
    assert len(fake.read.calls) == 2 and fake.read.calls[0][1].startswith("(select")
    return found, fake.read.calls[1][2]


def skewed(n=6000):
    rng = random.Random(2)
    return [min(int(rng.paretovariate(0.6)), 1500) for _ in range(n)] + [None] * 50


@pytest.mark.parametrize("parts", [1, 2, 8, 40])
def test_every_row_is_in_one_part_and_none_is_large(spark, parts):
    values = skewed()
    found, predicates = read_parts(spark, values, "long", jdbc.DepthScan("place", parts))
    assert collected(found.select("id")) == [(n,) for n in sorted(range(len(values)), key=lambda n: repr((n,)))]
    sizes = {r["_part"]: r["count"] for r in found.groupBy("_part").count().collect()}
    assert len(predicates) == len(sizes) < 2 * parts + 1
    heavy = max(values.count(v) for v in set(values) if v is not None)
    assert max(sizes.values()) <= max(2 * len(values) / parts, heavy + 50)
    even = spark.createDataFrame([(v,) for v in values], "place long")
    stride = even.filter("place is not null").groupBy(F.floor((F.col("place") - 1) * 8 / 1500)).count()
    if parts == 8:  # equal strides put nearly all rows into one part
        assert max(r["count"] for r in stride.collect()) > 2.5 * max(sizes.values()) * 0.6


def test_rows_outside_the_counted_values_are_in_the_open_ends(spark):
    predicates = jdbc.depth_predicates("place", jdbc.depth_bounds([(5, 10), (6, 10), (9, 10)], 3))
    assert predicates == ["(place < 6 or place is null)", "(place >= 6 and place < 9)", "place >= 9"]
    rows = spark.createDataFrame([(v,) for v in (-10**9, 5, 6, 7, 8, 9, 10**9, None)], "place long")
    hits = rows.selectExpr(" + ".join(f"cast(coalesce({p}, false) as int)" for p in predicates) + " as hits")
    assert {r["hits"] for r in hits.collect()} == {1}


@pytest.mark.parametrize(
    "kind,values",
    [
        ("string", ["a", "b'c", "b'c", "d", None, ""]),
        ("date", [datetime.date(2024, 1, 1 + n % 9) for n in range(50)]),
        ("double", [n / 7 for n in range(100)] + [None]),
        ("long", [3] * 70),
        ("long", [None, None]),
        ("long", []),
    ],
)
def test_other_types_ties_and_empty_columns(spark, kind, values):
    found, predicates = read_parts(spark, values, kind, jdbc.DepthScan("place", 4))
    assert found.count() == len(values) == found.select("id").distinct().count()
    assert predicates == ["1 = 1"] if len({v for v in values if v is not None}) < 2 else len(predicates) > 1


def test_cells_of_a_width_for_columns_with_many_values(spark):
    values = [n * n % 100_003 for n in range(4000)]
    split = jdbc.DepthScan("place", 8, width=500.0, cells=300)
    found, predicates = read_parts(spark, values, "long", split)
    assert found.count() == 4000
    sizes = [r["count"] for r in found.groupBy("_part").count().collect()]
    assert max(sizes) <= 2 * 4000 / 8 and len(predicates) < 17
    with pytest.raises(ValueError, match="give a width"):
        read_parts(spark, values, "long", jdbc.DepthScan("place", 8, cells=300))


def test_settings_choose_the_split():
    assert jdbc.split_from({"column": "id", "partitions": 9}) == jdbc.DepthScan("id", 9)
    assert jdbc.split_from({"column": "id", "partitions": 9, "width": 10}).width == 10
    strides = {"column": "id", "lower": 1, "upper": 9, "partitions": 3}
    assert jdbc.split_from(strides) == jdbc.RangeScan(**strides)
    assert jdbc.split_from(["a = 1"]) == ["a = 1"]


def test_the_path_log_follows_its_data_from_the_command_line(spark):
    spark.createDataFrame([(n, 1, n % 40, "x", None, 0) for n in range(400)], "id long, user_id long, page_order long, page_name string, page_time timestamp, page_parent_id long").createOrReplaceTempView("tbd_app_opera_path")
    fake = RunningSpark(spark)
    config = [{"url": f"jdbc:{n}"} for n in (1, 2, 3)]
    rows = jdbc.configured_tables(fake, config, "path_detail_extract")("tbd_app_opera_path")
    assert rows.count() == 400
    assert [p for _, _, p in fake.read.calls][1][0] == "(page_order < 5 or page_order is null)"
