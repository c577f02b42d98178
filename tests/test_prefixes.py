"""Longest-prefix lookup against brute force, and banners from a table."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_DIR, collected
from tagloom import Settings
from tagloom.operators.prefixes import lengths_of, longest_prefix, prefix_index, prefix_table
from tagloom.plans.metrics import METRICS
from tagloom.plans.profiles import PROFILES
from tagloom.sources.samples import sample_tables

NESTED = {f"B{n:02d}": "https://a/" + "x/" * n for n in range(12)}


def by_force(texts, prefixes):
    out = []
    for number, text in enumerate(texts):
        fits = [(len(p), i) for i, p in prefixes.items() if text is not None and p and text.startswith(p)]
        if fits:
            longest = max(n for n, _ in fits)
            out.append((number, text, min(i for n, i in fits if n == longest)))
    return out


def looked_up(spark, texts, prefixes):
    rows = spark.createDataFrame(list(enumerate(texts)), "n long, url string")
    return collected(longest_prefix(rows, "url", prefix_table(spark, prefixes), "banner"))


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_twelve_nested_prefixes(spark, conf, broadcast):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast, spark__sql__adaptive__autoBroadcastJoinThreshold=broadcast)
    texts = ["https://a/" + "x/" * n + tail for n in range(15) for tail in ("", "y", "x", "?q=1")]
    texts += [None, "", "https://a", "http://a/x/", "https://a/x/", "https://a/x/"]
    assert looked_up(spark, texts, NESTED) == sorted(by_force(texts, NESTED), key=repr)


def test_many_prefixes_of_many_lengths(spark):
    rng = random.Random(4)
    made = {f"P{n}": "".join(rng.choice("abé/") for _ in range(rng.randint(1, 14))) for n in range(100_000)}
    texts = ["".join(rng.choice("abé/c") for _ in range(rng.randint(0, 20))) for _ in range(400)]
    by_text = {}
    for i, p in made.items():
        by_text[p] = min(i, by_text.get(p, i))
    expected = []
    for n, t in enumerate(texts):
        best = next((by_text[t[:k]] for k in range(len(t), 0, -1) if t[:k] in by_text), None)
        if best:
            expected.append((n, t, best))
    assert looked_up(spark, texts, made) == sorted(expected, key=repr) and expected


def test_odd_prefix_tables(spark):
    rows = spark.createDataFrame([("1", "abc", "old")], "user_id string, url string, id string")
    odd = spark.createDataFrame([("b", "ab"), ("a", "ab"), ("x", ""), (None, "abc"), ("y", None)], "id string, prefix string")
    assert lengths_of(odd) == [2] and prefix_index(odd).count() == 1
    assert collected(longest_prefix(rows, "url", odd)) == [("1", "abc", "a")]
    none = longest_prefix(rows, "url", odd.limit(0))
    assert none.columns == ["user_id", "url", "id"] and none.count() == 0


def test_the_plan_has_equi_joins_only(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = spark.range(10).select(F.col("id").cast("string").alias("url"))
    plan = longest_prefix(rows, "url", prefix_table(spark, NESTED))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [hash_a" in plan and "NestedLoop" not in plan and "Cartesian" not in plan and "StartsWith" not in plan


def test_banners_from_a_table_count_as_those_of_the_settings(spark):
    given, views = Settings(), sample_tables(spark, SAMPLE_DIR)
    table = prefix_table(spark, given.banners)
    tables = lambda name: table if name == "banner_prefixes" else views(name)
    listed = Settings(banner_table="banner_prefixes")
    for name in ("banner_browse", "banner_browse_tag"):
        expected = collected(METRICS[name](tables, given))
        assert collected(METRICS[name](tables, listed)) == expected and expected
    seen = {r["item_code"] for r in METRICS["banner_browse"](tables, given).collect()}
    assert seen == set(given.banners) and len(seen) == 12
    profile = "profile_user_tags"
    columns = ["user_id", "banner_browse_num", "article_browse_num"]
    assert collected(PROFILES[profile](tables, listed).select(columns)) == collected(PROFILES[profile](tables, given).select(columns))
