"""Relations between metrics that must hold on any data."""

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_DIR
from tagloom import Settings
from tagloom.operators.base import BY_ITEM, BY_USER
from tagloom.plans.metrics import METRICS
from tagloom.plans.profiles import PROFILES, assemble
from tagloom.sources.samples import sample_tables

PARTS = {
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
    "profile_parking": ["parking_consumption", "parking_avg_amount", "parking_browse"],
    "profile_cip": ["cip_consumption", "cip_avg_amount", "cip_usage"],
}

# Tag = sum of the metric over the user's items, for the pairs whose definitions agree.
SUMS = {
    "rest_consumption_tag": "rest_consumption",
    "rest_usage_tag": "rest_usage",
    "rest_browse_tag": "rest_browse",
    "rest_browse_hour_tag": "rest_browse_hour",
    "lounge_people_tag": "lounge_people",
    "lounge_usage_tag": "lounge_usage",
    "lounge_browse_tag": "lounge_browse",
    "lounge_collection_tag": "lounge_collection",
    "lounge_comment_tag": "lounge_comment",
    "shop_browse_tag": "shop_browse",
    "shop_collection_tag": "shop_collection",
    "banner_browse_tag": "banner_browse",
    "article_browse_tag": "article_browse",
    "article_favor_tag": "article_favor",
    "cip_consumption_tag": "cip_consumption",
    "cip_usage_tag": "cip_usage",
    "vvip_collection_tag": "vvip_collection",
}


@pytest.fixture(scope="module")
def sample(spark):
    return sample_tables(spark, SAMPLE_DIR)


@pytest.mark.parametrize("tag, metric", sorted(SUMS.items()))
def test_tag_is_the_sum_over_items(sample, tag, metric):
    per_user = METRICS[tag](sample, Settings()).toDF("user_id", "tag")
    per_item = METRICS[metric](sample, Settings()).toDF("user_id", "item_code", "value")
    summed = per_item.groupBy("user_id").agg(F.sum("value").cast("bigint").alias("total"))
    both = per_user.join(summed, "user_id", "full_outer")
    assert both.filter(~F.col("tag").eqNullSafe(F.col("total"))).count() == 0
    assert both.count() > 0


@pytest.mark.parametrize("profile", sorted(PARTS))
def test_profile_equals_its_metrics_put_together(sample, profile):
    wide = PROFILES[profile](sample, Settings())
    parts = [METRICS[name](sample, Settings()) for name in PARTS[profile]]
    expected = assemble(parts, BY_ITEM).select(*wide.columns)
    assert wide.exceptAll(expected).count() == 0
    assert expected.exceptAll(wide).count() == 0
    assert wide.count() == wide.select(*BY_ITEM).distinct().count()


def test_assemble_keeps_every_key_once(spark):
    left = spark.createDataFrame([("1", 5), ("2", 6)], "user_id string, a bigint")
    right = spark.createDataFrame([("2", True), ("3", False)], "user_id string, b boolean")
    rows = assemble([left, right], BY_USER).orderBy("user_id").collect()
    assert [tuple(r) for r in rows] == [("1", 5, None), ("2", 6, True), ("3", None, False)]
