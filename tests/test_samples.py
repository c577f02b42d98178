"""The sample views read the whole tables, and price averages do not depend on the rows' order."""

import random

from tagloom.functions.exprs import exact, mean
from tagloom.sources.samples import sample_tables


def test_every_page_and_article_occurs(spark):
    sf_dir = "/root/testdata/sf0.01"
    tables = sample_tables(spark, sf_dir)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    visited = tables("tbd_visit_url").select("url").distinct()
    assert pages.join(visited, "url", "left_anti").count() == 0
    articles = visited.filter("url like 'https://m.example.org/institute/%'")
    assert articles.count() == pages.count()


def test_price_means_are_exact(spark):
    prices = [17.04, 23.6, 26.33, 77.35, 95.68]
    for seed in range(4):
        random.Random(seed).shuffle(prices)
        frame = spark.createDataFrame([(p, 1) for p in prices], "price double, n long").repartition(1 + seed)
        paid = frame.withColumn("price", exact("price"))
        assert paid.agg(mean("price", "n").alias("m")).first()["m"] == 48.0
