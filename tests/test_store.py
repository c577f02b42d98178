"""The bucketed profile store: what an upsert rewrites, and what a reader sees meanwhile."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_DIR, collected
from tagloom import Settings, jobs
from tagloom.plans.metrics import METRICS
from tagloom.sinks.profile import merge_profile
from tagloom.sinks.store import Conflict, ProfileStore
from tagloom.sources.samples import sample_tables

KEYS = ["user_id", "item_code"]


def files_of(store):
    """Path, size and time of every data file of the newest version, by bucket."""
    out = {}
    for bucket, folder in store.manifest().folders.items():
        names = sorted(Path(store.root.removeprefix("file:"), folder).glob("*.parquet"))
        out[bucket] = [(str(p), p.stat().st_size, p.stat().st_mtime_ns) for p in names]
    return out


def users(spark, ids, **columns):
    made = [F.lit(v).alias(k) for k, v in columns.items()]
    frame = spark.createDataFrame([(str(i),) for i in ids], "user_id string")
    return frame.select("user_id", F.lit("R1").alias("item_code"), *made)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    store = ProfileStore(spark, f"{tmp_path}/p", KEYS, buckets=16)
    store.upsert(users(spark, range(200), n=1))
    before = files_of(store)
    assert len(before) == 16
    store.upsert(users(spark, [3], n=7, flag=True))
    after = files_of(store)
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1 and before[changed[0]] != after[changed[0]]
    rows = store.read()
    assert rows.count() == 200 and rows.columns == [*KEYS, "n", "flag"]
    assert collected(rows.filter("n = 7")) == [("3", "R1", 7, True)]
    assert rows.filter("flag is null").count() == 199


def test_new_keys_in_an_empty_bucket_need_no_merge(spark, tmp_path):
    store = ProfileStore(spark, f"{tmp_path}/p", KEYS, buckets=64)
    store.upsert(users(spark, [1], n=1))
    first = files_of(store)
    other = next(i for i in range(2, 50) if store.upsert(users(spark, [i], m=i)).folders.keys() != first.keys())
    assert collected(store.read().filter(F.col("user_id") == str(other))) == [(str(other), "R1", None, other)]
    assert collected(store.read().filter("user_id = '1'"))[0][:3] == ("1", "R1", 1)


def test_a_crash_before_the_swap_leaves_the_old_version(spark, tmp_path, monkeypatch):
    store = ProfileStore(spark, f"{tmp_path}/p", KEYS, buckets=4)
    store.upsert(users(spark, range(20), n=1))
    expected, before = collected(store.read()), files_of(store)

    def dies(self, manifest):
        raise OSError("the driver dies here")

    with monkeypatch.context() as patch:
        patch.setattr(ProfileStore, "_publish", dies)
        with pytest.raises(OSError, match="dies"):
            store.upsert(users(spark, range(10), n=2))
    again = ProfileStore(spark, f"{tmp_path}/p", KEYS)
    assert again.versions() == [1] and again.buckets == 4
    assert collected(again.read()) == expected and files_of(again) == before
    again.upsert(users(spark, range(10), n=3))
    assert again.read().groupBy("n").count().orderBy("n").collect() == [(1, 10), (3, 10)]
    left = again.vacuum(keep=1)
    assert left and again.versions() == [2] and again.read().count() == 20
    named = {f"{again.root}/{f}" for f in again.manifest().folders.values()}
    on_disk = {os.path.dirname(p) for p in map(str, Path(tmp_path, "p").rglob("*.parquet"))}
    assert on_disk == named


def test_of_two_writers_one_is_refused(spark, tmp_path, monkeypatch):
    store = ProfileStore(spark, f"{tmp_path}/p", KEYS, buckets=4)
    store.upsert(users(spark, range(20), n=1))
    late = ProfileStore(spark, f"{tmp_path}/p", KEYS)
    publish = ProfileStore._publish

    def other_first(self, manifest):
        monkeypatch.setattr(ProfileStore, "_publish", publish)
        store.upsert(users(spark, [1], n=5))
        publish(self, manifest)

    monkeypatch.setattr(ProfileStore, "_publish", other_first)
    with pytest.raises(Conflict):
        late.upsert(users(spark, [2], n=6))
    assert collected(store.read().filter("n > 1")) == [("1", "R1", 5)]
    assert not [n for n in os.listdir(f"{tmp_path}/p/manifests") if n.startswith("_")]


def test_older_versions_stay_readable_and_users_are_found_in_their_buckets(spark, tmp_path):
    store = ProfileStore(spark, f"{tmp_path}/p", KEYS, buckets=16)
    store.upsert(users(spark, range(100), n=1))
    store.upsert(users(spark, range(50), n=2))
    assert store.read(1).filter("n = 1").count() == 100
    assert store.read(2).filter("n = 1").count() == 50
    found = store.rows_of(["7", "77", "absent"])
    assert collected(found) == [("7", "R1", 2), ("77", "R1", 1)]
    assert {p.split("_bucket=")[1].split("/")[0] for p in found.inputFiles()} <= set(store.manifest().folders)
    assert len(found.inputFiles()) <= 6 < len(store.read().inputFiles())


def test_refusals(spark, tmp_path):
    with pytest.raises(ValueError, match="no profile"):
        ProfileStore(spark, f"{tmp_path}/none", KEYS).read()
    store = ProfileStore(spark, f"{tmp_path}/p", KEYS)
    with pytest.raises(ValueError, match="all their keys"):
        store.upsert(users(spark, [1], n=1).withColumn("item_code", F.lit(None).cast("string")))
    store.upsert(users(spark, [1], n=1))
    with pytest.raises(ValueError, match="has the keys"):
        ProfileStore(spark, f"{tmp_path}/p", ["user_id"])
    empty = store.upsert(users(spark, [1], n=1).limit(0))
    assert empty.version == 2 and store.read().count() == 1


def test_same_rows_as_the_whole_merge(spark, tmp_path):
    """Jobs one after another give what full merges of the same results give."""
    tables = sample_tables(spark, SAMPLE_DIR)
    names = ["rest_consumption", "rest_browse", "rest_avg_amount"]
    store, whole = ProfileStore(spark, f"{tmp_path}/p", KEYS, buckets=8), None
    for name in names:
        fresh = METRICS[name](tables, Settings())
        store.upsert(fresh)
        whole = fresh if whole is None else merge_profile(whole, fresh, KEYS)
    assert collected(store.read().select(whole.columns)) == collected(whole)


def test_job_writes_into_a_store(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "batch_session", lambda *a: spark)
    monkeypatch.setattr(jobs, "size_shuffles", lambda *a: None)
    for job in ("rest_collection", "rest_comment"):
        jobs.main([job, "--sample", SAMPLE_DIR, "--store", f"{tmp_path}/rest", "--buckets", "4"])
    store = ProfileStore(spark, f"{tmp_path}/rest", KEYS)
    assert store.versions() == [1, 2] and store.buckets == 4
    tables = sample_tables(spark, SAMPLE_DIR)
    assert store.read().filter("comment_num is not null").count() == METRICS["rest_comment"](tables, Settings()).count()
    with pytest.raises(SystemExit):
        jobs.main(["path_page_extract", "--sample", SAMPLE_DIR, "--store", f"{tmp_path}/x"])
