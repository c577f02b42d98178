"""Heavy hitters of join keys, and joins that spread them."""

import itertools

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_DIR, collected
from tagloom import Settings
from tagloom.operators import restaurants, services, skew
from tagloom.plans.metrics import METRICS
from tagloom.plans.profiles import PROFILES
from tagloom.session import batch_conf
from tagloom.sources.samples import sample_tables
from tagloom.sources.tables import given_tables


def keyed_rows(spark, hot, cold, start=0):
    frame = spark.range(start, start + hot + cold)
    key = F.when(F.col("id") < start + hot, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    return frame.select(key.alias("key"), "id")


def test_sketches_of_parts_find_what_one_sketch_finds(spark):
    parts = [keyed_rows(spark, 900, 5000, 0), keyed_rows(spark, 0, 4000, 10**6), keyed_rows(spark, 100, 3000, 2 * 10**6)]
    whole = skew.key_sketch(parts[0].union(parts[1]).union(parts[2]), "key")
    sketches = [skew.key_sketch(p, "key") for p in parts]
    together = skew.combined(sketches[0].union(sketches[1]).union(sketches[2]))
    assert skew.heavy_hitters(whole) == skew.heavy_hitters(together) == ["hot"]
    assert together.first()["rows"] == 13000
    assert skew.heavy_hitters(sketches[1]) == []
    assert skew.heavy_hitters(skew.key_sketch(parts[0].limit(0), "key")) == []


def test_every_heavy_hitter_of_a_zipf_column_is_found(spark):
    rows = spark.range(300_000).select(F.floor(1 / (F.rand(5) + 1e-6)).cast("string").alias("key"))
    rows = spark.createDataFrame(rows.toPandas())
    counts = {r["key"]: r["count"] for r in rows.groupBy("key").count().collect()}
    found = skew.heavy_hitters(skew.key_sketch(rows, "key"))
    needed = {k for k, n in counts.items() if n * skew.SHARE > 300_000 * 1.05 and n > skew.SPREAD}
    assert needed <= set(found) and len(found) < skew.SHARE
    assert all(counts[k] * skew.SHARE > 300_000 * 0.9 for k in found)


def test_spread_join_equals_a_join_and_splits_the_hot_key(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    many = keyed_rows(spark, 6000, 3000).unionByName(spark.createDataFrame([(None, 1)], "key string, id long"))
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k6001", 3), ("k9999999", 4), (None, 5)], "key string, user long")
    plain, spread = skew.spread_join(many, few, "key", []), skew.spread_join(many, few, "key", ["hot"])
    assert spread.columns == plain.columns == ["key", "id", "user"]
    assert collected(spread) == collected(plain) and spread.count() == 12001
    largest = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    assert largest(plain) >= 12000 and largest(spread) < 4000


def hot_tables(spark, lines=6000):
    """One order with two thirds of all lines, over many restaurants."""
    rows = spark.range(lines * 3 // 2)
    order = F.when(F.col("id") < lines, "hot").otherwise(F.concat(F.lit("o"), F.col("id")))
    details = rows.select(
        order.alias("fd_code"), F.concat(F.lit("R"), F.col("id") % 9).alias("fd_restaurant_code"),
        F.lit("2020-01-02").cast("timestamp").alias("ordertime"), F.lit(2.0).alias("cprice"), F.lit(1.5).alias("xfprice"), F.lit("A").alias("fd_class"),
    )
    every = spark.range(lines - 1, lines * 3 // 2).select(F.when(F.col("id") < lines, "hot").otherwise(F.concat(F.lit("o"), F.col("id"))).alias("order_no"))
    orders = every.select("order_no", F.lit(7).alias("user_id"), F.lit(10.5).alias("actual_amount"))
    items = spark.range(9).select(F.concat(F.lit("R"), F.col("id")).alias("fd_code"), F.lit("zh-cn").alias("fd_lg"), F.lit("x").alias("fd_inspection"))
    frames = {
        "restaurant_order_detail2": details, "tb_order": orders, "itd_restaurant": items,
        "td_restaurant_order": details.select("fd_code", "fd_restaurant_code"),
        "tb_order_cip": details.select(F.col("fd_code").alias("order_no"), F.col("fd_restaurant_code").alias("pro_code")),
        "tb_order_cip_record": details.select(F.col("fd_code").alias("order_no")),
        "tb_order_parking": details.select(F.col("fd_code").alias("order_no"), F.col("fd_restaurant_code").alias("parking_code")),
    }
    return given_tables(frames)


JOINED = ["rest_consumption", "rest_avg_amount", "rest_multitime", "rest_usage", "cip_consumption", "cip_avg_amount", "cip_usage", "parking_consumption", "parking_avg_amount"]


@pytest.mark.parametrize("name", JOINED)
def test_a_hot_order_gives_the_same_result_however_it_is_joined(spark, conf, monkeypatch, name):
    for key, value in batch_conf(0).items():
        conf(**{key.replace(".", "__"): value})
    t = hot_tables(spark)
    assert skew.hot_keys(t, "tb_order_cip", "order_no") == ["hot"]
    spread = collected(METRICS[name](t, Settings()))
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    assert collected(METRICS[name](t, Settings())) == spread
    monkeypatch.setattr(skew, "hot_keys", lambda *a: [])
    for module in (restaurants, services):
        monkeypatch.setattr(module, "hot_keys", lambda *a: [])
    assert collected(METRICS[name](t, Settings())) == spread and len(spread) == 9


@pytest.mark.parametrize("name", JOINED)
def test_the_facts_are_shuffled_once_for_their_join(spark, conf, name):
    """One exchange a side and one for the result (a multi-time day is one more); restaurants are broadcast by their size."""
    conf(spark__sql__autoBroadcastJoinThreshold="4096", spark__sql__adaptive__enabled="false")
    plan = METRICS[name](hot_tables(spark), Settings())._jdf.queryExecution().executedPlan().toString()
    # Uses join three tables: the records are added up in their own join's shuffle.
    assert plan.count("Exchange hashpartitioning") <= {"rest_multitime": 4, "cip_usage": 5}.get(name, 3)
    assert "_salt" in plan and "CartesianProduct" not in plan


def test_the_largest_join_task_stays_small(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    t = hot_tables(spark, 60_000)
    lines = restaurants.order_lines(t, "cprice").select("order_no", "item_code")
    found = restaurants.user_lines(t, lines).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in found) == 90_000
    assert max(r["count"] for r in found) < 90_000 / 8 * 2


@pytest.mark.parametrize("order", list(itertools.permutations(["0.2", "0.6", "0.7"])))
def test_the_preference_does_not_depend_on_the_order_of_the_rows(tables, order):
    """Flags whose mean is exactly one half; a sum of doubles misses it for some orders."""
    t = tables(
        tb_order=[(f"o{n}", 1, 1.0) for n in range(3)],
        restaurant_order_detail2=[(f"o{n}", "R1", None, 1.0, 1.0, f"c{n}") for n in range(3)],
        restaurant_class=[(f"c{n}", flag) for n, flag in enumerate(order)],
    )
    assert collected(METRICS["rest_preference"](t, Settings())) == [("1", "中餐")]
    assert [r["restaurant_preferences"] for r in PROFILES["profile_user_tags"](t, Settings()).collect()] == ["中餐"]


def test_a_resolver_is_sketched_once(spark, monkeypatch):
    t = sample_tables(spark, SAMPLE_DIR)
    calls = []
    sketch = skew.key_sketch
    monkeypatch.setattr(skew, "key_sketch", lambda *a: calls.append(a) or sketch(*a))
    for name in ("rest_consumption", "rest_avg_amount", "rest_multitime"):
        METRICS[name](t, Settings())
    assert len(calls) == 1
