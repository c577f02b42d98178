"""What the physical plans must and must not contain, at the scale the jobs are meant for."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from conftest import SAMPLE_DIR, collected
from tagloom import Settings
from tagloom.operators import restaurants as restaurants_module
from tagloom.operators import services
from tagloom.plans.metrics import METRICS
from tagloom.plans.profiles import PROFILES, order_tags
from tagloom.sinks.files import save_bucketed
from tagloom.sources.samples import sample_tables
from tagloom.sources.schemas import columns, schema


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans_of(df):
    """The plan with the full, unshortened details of every scan."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def run_plan_of(df):
    """The plan after adaptive execution has run."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_of(df)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The sample views written out as plain Parquet tables, so scans look as in production."""
    root = tmp_path_factory.mktemp("stored")
    derive = sample_tables(spark, SAMPLE_DIR)
    for name in ("tbd_url_element", "tbd_visit_url", "tb_order", "restaurant_order_detail2"):
        derive(name).write.parquet(f"{root}/{name}")
    derive("itd_restaurant").write.parquet(f"{root}/itd_restaurant")
    return lambda name: spark.read.parquet(f"{root}/{name}")


@pytest.mark.parametrize("name", sorted({**METRICS, **PROFILES}))
def test_only_declarative_steps_and_wanted_joins(spark, name):
    plan = plan_of(queries()[name](spark, SAMPLE_DIR))
    for step in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHash"):
        assert step not in plan, step
    # Only the optional labels need an outer join.
    assert ("LeftOuter" in plan) == (name in ("article_labels", "profile_user_tags"))
    assert "FullOuter" not in plan


@pytest.mark.parametrize("name", sorted(PROFILES))
def test_profiles_close_with_a_hash_aggregate_and_no_exchange(spark, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(queries()[name](spark, SAMPLE_DIR))
    assert "SortAggregate" not in plan
    above_union = plan[: plan.index("Union")]
    assert "HashAggregate" in above_union
    assert "Exchange" not in above_union


def test_filters_and_columns_reach_the_scan(stored):
    plan = scans_of(METRICS["rest_browse"](stored, Settings()))
    assert re.search(r"PushedFilters: \[In\(url", plan)
    assert "ReadSchema: struct<url:string,param:string>" in plan

    plan = scans_of(METRICS["article_browse"](stored, Settings()))
    assert "StringStartsWith(url" in plan

    plan = scans_of(METRICS["banner_browse"](stored, Settings()))
    assert re.search(r"PushedFilters: \[Or\(StringStartsWith", plan)

    plan = scans_of(METRICS["rest_consumption"](stored, Settings()))
    assert "ReadSchema: struct<order_no:string,user_id:bigint>" in plan
    assert "IsNotNull(cprice)" in plan


def test_json_is_parsed_once_per_row(stored):
    plan = plan_of(METRICS["rest_browse"](stored, Settings()))
    assert plan.count("Generate json_tuple") == 1
    assert "get_json_object" not in plan


@pytest.mark.parametrize(
    "name", ["rest_consumption", "lounge_usage", "cip_usage", "article_labels"]
)
def test_results_do_not_depend_on_broadcasting(spark, conf, name):
    expected = collected(queries()[name](spark, SAMPLE_DIR))
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    df = queries()[name](spark, SAMPLE_DIR)
    assert "SortMergeJoin" in plan_of(df)
    assert collected(df) == expected


@pytest.mark.parametrize("name", sorted(PROFILES))
def test_profiles_are_right_when_partitions_are_not_merged_alike(spark, conf, name):
    expected = collected(queries()[name](spark, SAMPLE_DIR))
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="23",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
    )
    assert collected(queries()[name](spark, SAMPLE_DIR)) == expected


ROWS = 60000


def hot_text(prefix=""):
    """A key of which one value owns a third of the rows."""
    number = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return F.concat(F.lit(prefix), number.cast("string"))


def every_key(spark, prefix=""):
    return spark.range(ROWS).select(
        F.concat(F.lit(prefix), F.col("id").cast("string")).alias("key"),
        (F.col("id") % 100).alias("user_id"),
    )


def hot_orders(spark):
    lines = spark.range(ROWS).select(
        hot_text().alias("fd_code"),
        F.concat(F.lit("R"), (F.col("id") % 5).cast("string")).alias("fd_restaurant_code"),
        F.lit("2024-05-01 10:00:00").cast("timestamp").alias("ordertime"),
        F.lit(1.0).alias("cprice"),
        F.lit("c").alias("fd_class"),
    )
    places = spark.range(5).select(
        F.concat(F.lit("R"), F.col("id").cast("string")).alias("fd_code"),
        F.lit("zh-cn").alias("fd_lg"),
        F.lit("T2").alias("fd_inspection"),
    )
    tables = {
        "restaurant_order_detail2": lines,
        "tb_order": every_key(spark).withColumnRenamed("key", "order_no"),
        "itd_restaurant": places,
    }
    return METRICS["rest_consumption_tag"](tables.__getitem__, Settings())


def hot_card(spark):
    records = spark.range(ROWS).select(
        hot_text().alias("dragoncode"),
        F.concat(F.lit("N"), (F.col("id") % 5).cast("string")).alias("loungecode"),
        F.lit(1).cast("bigint").alias("point"),
        F.lit(1).cast("bigint").alias("personcount"),
    )
    cards = every_key(spark).withColumnRenamed("key", "dragoncode")
    tables = {"tblconsumerecord": records, "tb_bindrecord": cards}
    return METRICS["lounge_usage_tag"](tables.__getitem__, Settings())


def hot_article(spark):
    prefix = Settings().article_prefix
    reads = spark.range(ROWS).select(
        (F.col("id") % 100).cast("string").alias("user_id"), hot_text(prefix).alias("url")
    )
    articles = spark.range(ROWS).select(
        F.col("id").cast("string").alias("id"), F.lit("十一").alias("person_labels")
    )
    tables = {"tbd_visit_url": reads, "tbd_belles_lettres": articles}
    labels = METRICS["article_labels"](tables.__getitem__, Settings())
    return labels.select("user_id", F.col("eleven").alias("n"))


def shuffled(conf):
    """No broadcasts, and skewed partitions count as such on small data."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
    )


@pytest.mark.parametrize("define, key", [(hot_orders, "order_no"), (hot_card, "dragoncode")])
def test_a_hot_join_key_is_combined_before_its_shuffle(spark, conf, define, key):
    expected = collected(define(spark))
    assert sum(n for _, n in expected) == ROWS
    shuffled(conf)
    df = define(spark)
    assert collected(df) == expected
    plan = plan_of(define(spark))
    side = rf"Exchange hashpartitioning\({key}#\d+, \d+\)"
    # One exchange per side; the lines are added up on both ends of theirs.
    assert len(re.findall(side, plan)) == 2
    added = rf"HashAggregate\(keys=\[{key}#\d+\]"
    line = r"[^\n]*\n[^\n]*"
    assert re.search(line.join([rf"Sort \[{key}", added, side, added]), plan)


def test_a_hot_article_is_split_across_tasks(spark, conf):
    expected = collected(hot_article(spark))
    assert sum(n for _, n in expected) == ROWS
    shuffled(conf)
    df = hot_article(spark)
    assert collected(df) == expected
    assert "skew=true" in plan_of(df)


def test_cip_records_and_lines_are_each_one_row_at_the_join(conf, tables):
    shuffled(conf)
    t = tables(
        tb_order=[("a", 1, 1.0)],
        tb_order_cip=[("a", "C1")] * 20,
        tb_order_cip_record=[("a",)] * 5000,
    )
    assert collected(services.cip_usage_tag(t)) == [("1", 100000)]
    plan = plan_of(services.cip_use_lines(t))
    assert plan.count("Exchange") == 2


def test_order_tags_shuffle_only_the_orders_for_their_join(spark, conf):
    shuffled(conf)
    plan = plan_of(order_tags(sample_tables(spark, SAMPLE_DIR)))
    join = plan[plan.index("SortMergeJoin [order_no") :].splitlines()
    # Join, sort, union: no exchange between them.
    assert "Sort [order_no" in join[1] and "Union" in join[2]


def test_bucketed_orders_join_without_a_shuffle(spark, conf, tables):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.sql("create database if not exists bucketed")
    rows = {
        "tb_order": [(str(n), n % 7, 1.0) for n in range(200)],
        "tb_order_vvip": [(str(n),) for n in range(0, 200, 2)],
    }
    expected = collected(METRICS["vvip_consumption_tag"](tables(**rows), Settings()))
    for name, values in rows.items():
        frame = spark.createDataFrame(values, schema(name))
        save_bucketed(frame, f"bucketed.{name}", "order_no", 4)
    df = METRICS["vvip_consumption_tag"](
        lambda name: spark.table(f"bucketed.{name}").select(*columns(name)), Settings()
    )
    plan = plan_of(df)
    assert "SortMergeJoin" in plan
    # Only the closing aggregate shuffles.
    assert plan.count("Exchange") == 1
    assert collected(df) == expected
    spark.sql("drop database bucketed cascade")


def test_profile_shares_the_shuffle_of_the_orders(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    assert "ReusedExchange" in run_plan_of(queries()["profile_user_tags"](spark, SAMPLE_DIR))


@pytest.mark.parametrize("limit, shuffled", [("1MB", False), ("-1", True)])
def test_restaurants_are_broadcast_by_measured_size(spark, conf, limit, shuffled):
    """Catalyst's estimate of a table that is a join is the product of both sides, far above the limit."""
    conf(spark__sql__autoBroadcastJoinThreshold=limit)
    tables = sample_tables(spark, SAMPLE_DIR)
    wide = spark.range(1).withColumn("pad", F.repeat(F.lit("x"), 9)).distinct()
    restaurants = tables("itd_restaurant").crossJoin(wide).drop("id", "pad")
    lines = restaurants_module.order_lines(lambda t: restaurants if t == "itd_restaurant" else tables(t), "cprice")
    assert bool(re.search(r"hashpartitioning\(item_code#", plan_of(lines))) == shuffled
