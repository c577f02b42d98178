"""Profile upserts, documents, tuple text and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_DIR, collected
from tagloom import Settings, jobs, session
from tagloom.plans.metrics import EXTRACTS, METRICS
from tagloom.plans.profiles import PROFILES
from tagloom.session import batch_conf
from tagloom.sinks.files import save_bucketed, tuple_lines, write_extract, write_tuples
from tagloom.sinks.profile import as_documents, document_field, merge_profile, upsert_profile
from tagloom.sources.samples import sample_tables
from tagloom.sources.tables import parquet_tables


def test_merge_keeps_what_the_fresh_rows_do_not_set(spark):
    stored = spark.createDataFrame(
        [("1", "R1", 5, True), ("2", "R1", 6, None)],
        "user_id string, item_code string, browse_num bigint, multitime_consumption boolean",
    )
    fresh = spark.createDataFrame(
        [("1", "R1", None, 2.0), ("2", "R1", 9, 3.0), ("3", "R1", 1, 1.0)],
        "user_id string, item_code string, browse_num bigint, usage_counter double",
    )
    merged = merge_profile(stored, fresh, ["user_id", "item_code"])
    rows = merged.select(
        "user_id", "item_code", "browse_num", "multitime_consumption", "usage_counter"
    )
    assert collected(rows) == [
        ("1", "R1", 5, True, 2.0),
        ("2", "R1", 9, None, 3.0),
        ("3", "R1", 1, None, 1.0),
    ]


def test_order_of_upserts_does_not_reset_other_metrics(spark, tmp_path):
    keys = ["user_id"]
    flags = spark.createDataFrame([("1", True)], "user_id string, flag boolean")
    counts = spark.createDataFrame([("1", 4), ("2", 5)], "user_id string, n bigint")
    upsert_profile(spark, flags, keys, None, f"{tmp_path}/a1")
    one = upsert_profile(spark, counts, keys, f"{tmp_path}/a1", f"{tmp_path}/a2")
    upsert_profile(spark, counts, keys, None, f"{tmp_path}/b1")
    two = upsert_profile(spark, flags, keys, f"{tmp_path}/b1", f"{tmp_path}/b2")
    expected = [("1", True, 4), ("2", None, 5)]
    assert collected(one.select("user_id", "flag", "n")) == expected
    assert collected(two.select("user_id", "flag", "n")) == expected


def test_a_profile_is_never_rewritten_in_place(spark, tmp_path):
    fresh = spark.createDataFrame([("1", 4)], "user_id string, n bigint")
    path = f"{tmp_path}/p"
    upsert_profile(spark, fresh, ["user_id"], None, path)
    with pytest.raises(ValueError, match="in place"):
        upsert_profile(spark, fresh, ["user_id"], path, path + "/")
    assert spark.read.parquet(path).count() == 1


def test_documents(spark):
    profile = spark.createDataFrame(
        [("1", "R1", 5)], "user_id string, item_code string, multitime_consumption int"
    )
    documents = as_documents(profile, ["user_id", "item_code"])
    assert documents.columns == ["id", "userId", "restaurantCode", "multitimeConsumption"]
    assert collected(documents) == [("1R1", "1", "R1", 5)]


@pytest.mark.parametrize(
    "column, field",
    [
        ("rest_average_order_amount_int", "restAverageOrderAmountInt"),
        ("restaurant_preferences", "restaurantPreferences"),
        ("vvip_collection_num", "VVIPCollectionNum"),
        ("cip_usage_counter", "CIPUsageCounter"),
        ("business", "business"),
        ("favor_num", "favorNum"),
    ],
)
def test_document_fields(column, field):
    assert document_field(column) == field


def test_tuple_text_can_be_read_back(spark, tables, tmp_path):
    frame = spark.createDataFrame([("1", "R1", 5), ("2", None, 6)], "u string, i string, h bigint")
    assert collected(tuple_lines(frame)) == [("(1,R1,5)",), ("(2,null,6)",)]
    write_tuples(frame, f"{tmp_path}/t")
    assert spark.read.text(f"{tmp_path}/t").count() == 2


def test_extracts_are_laid_out_by_page(spark, tmp_path):
    frame = spark.createDataFrame([(1, 18), (2, 19)], "id bigint, page_order bigint")
    write_extract(frame, f"{tmp_path}/x", "page_order")
    assert sorted(p.name for p in (tmp_path / "x").glob("page_order=*")) == [
        "page_order=18",
        "page_order=19",
    ]


def test_extract_files_follow_the_bytes(spark, conf, tmp_path):
    log = spark.range(0, 40000, 1, 8).selectExpr("xxhash64(id) id", "if(id % 10 = 0, 19L, 18L) page_order")

    def files(path):
        return [len(list((tmp_path / path / f"page_order={p}").glob("*.parquet"))) for p in (18, 19)]

    write_extract(log, f"{tmp_path}/few", "page_order")
    assert files("few") == [1, 1]
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64k")
    write_extract(log, f"{tmp_path}/hot", "page_order")
    assert files("hot")[0] > 1
    assert spark.read.parquet(f"{tmp_path}/hot").count() == 40000


def test_one_key_is_written_to_its_bucket_by_several_tasks(spark):
    spark.sql("create database if not exists placed")
    hot = spark.range(0, 4000, 1, 8).select(F.lit("a").alias("order_no"), "id")
    save_bucketed(hot, "placed.hot", "order_no", 4, spread=4)
    stored = spark.table("placed.hot")
    names = {path.rsplit("_", 1)[1].split(".")[0] for path in stored.inputFiles()}
    assert len(names) == 1
    assert 1 < len(stored.inputFiles()) <= 4
    assert stored.count() == 4000
    spark.sql("drop database placed cascade")


def test_page_extracts_read_only_their_partitions(spark, tmp_path):
    sample = sample_tables(spark, SAMPLE_DIR)
    log = sample("tbd_app_opera_path").filter("page_order < 40")
    write_extract(log, f"{tmp_path}/tbd_app_opera_path", "page_order")
    tables = parquet_tables(spark, str(tmp_path))
    page = METRICS["path_page_extract"](tables, Settings(page_order=20))
    assert collected(page.select("id")) == collected(
        METRICS["path_page_extract"](sample, Settings(page_order=20)).select("id")
    )
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(page_order" in plan


def test_shuffles_are_cut_to_their_size():
    sized = batch_conf(shuffle_bytes=5 * 1024**4)
    assert sized["spark.sql.shuffle.partitions"] == str(5 * 1024**4 // (128 * 1024**2))
    assert batch_conf(0)["spark.sql.shuffle.partitions"] == "8"
    assert batch_conf(100 * 1000**4)["spark.sql.shuffle.partitions"] == "200000"
    assert batch_conf(zone="Asia/Shanghai")["spark.sql.session.timeZone"] == "Asia/Shanghai"


def test_shuffles_follow_what_the_plan_reads(spark, conf, tmp_path, monkeypatch):
    conf(spark__sql__shuffle__partitions="77")
    spark.range(0, 100000, 1, 4).write.parquet(f"{tmp_path}/t")
    read = spark.read.parquet(f"{tmp_path}/t")
    one = session.read_bytes(read)
    assert one > 100000
    assert session.read_bytes(read.join(read.filter("id > 5"), "id")) >= 2 * one
    monkeypatch.setattr(session, "PIECE", one // 20)
    session.size_shuffles(spark, read.groupBy("id").count())
    assert 20 <= int(spark.conf.get("spark.sql.shuffle.partitions")) <= 22
    monkeypatch.setattr(session, "NO_ESTIMATE", 1)
    assert session.read_bytes(read) is None


@pytest.fixture(autouse=True)
def small_shuffles(monkeypatch):
    """The command line sizes its session for a cluster; the tests run on a few rows."""
    monkeypatch.setattr(session, "DEFAULT_PARTITIONS", 8)


def test_every_job_has_keys_and_a_document_type():
    for job in jobs.JOBS:
        keys = jobs.keys_of(job)
        assert bool(keys) == (job not in EXTRACTS)
        if keys:
            assert jobs.document_type(job)
    assert jobs.document_type("profile_rest") == jobs.document_type("rest_usage") == "userRest"
    assert jobs.document_type("vvip_collection") == "userVvip"
    assert jobs.document_type("cip_usage_tag") == "userTags"
    assert jobs.document_type("restaurant_priority") == "restaurant"


@pytest.mark.parametrize("job", ["shop_browse", "rest_usage_tag", "restaurant_priority"])
def test_command_line_updates_a_profile(spark, tmp_path, job):
    first, second = f"{tmp_path}/v1", f"{tmp_path}/v2"
    jobs.main([job, "--sample", SAMPLE_DIR, "--out", first])
    once = spark.read.parquet(first)
    expected = {**METRICS, **PROFILES}[job](jobs.sample_tables(spark, SAMPLE_DIR), jobs.Settings())
    assert collected(once) == collected(expected)
    jobs.main([job, "--sample", SAMPLE_DIR, "--current", first, "--out", second])
    assert collected(spark.read.parquet(second).select(*once.columns)) == collected(once)


def test_command_line_folds_repeated_keys(spark, tmp_path):
    jobs.main(["rest_browse_hour", "--sample", SAMPLE_DIR, "--out", f"{tmp_path}/h"])
    stored = spark.read.parquet(f"{tmp_path}/h")
    assert stored.count() == stored.select("user_id", "item_code").distinct().count()


def test_command_line_extracts(spark, tmp_path):
    jobs.main(["path_tail_extract", "--sample", SAMPLE_DIR, "--out", f"{tmp_path}/tail"])
    assert any((tmp_path / "tail").glob("path_bucket=*"))
    jobs.main(["url_visit_extract", "--sample", SAMPLE_DIR, "--out", f"{tmp_path}/u", "--text"])
    line = spark.read.text(f"{tmp_path}/u").first()[0]
    assert line.startswith("(") and line.endswith(")") and line.count(",") == 2


def test_command_line_settings(spark, tmp_path):
    chosen = tmp_path / "settings.json"
    chosen.write_text(json.dumps({"banners": {"only": "https://activity.example.org/newest"}}))
    jobs.main(
        ["banner_browse", "--sample", SAMPLE_DIR, "--settings", str(chosen)]
        + ["--out", f"{tmp_path}/b"]
    )
    codes = spark.read.parquet(f"{tmp_path}/b").select("item_code").distinct()
    assert collected(codes) == [("only",)]


def test_extracts_have_no_index_documents(spark):
    with pytest.raises(SystemExit, match="no key"):
        jobs.main(["path_page_extract", "--sample", SAMPLE_DIR, "--index", "user"])
