"""Metrics made of days: any split of the rows folds to the full result."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_DIR, collected
from tagloom import Settings, jobs
from tagloom.plans.daily import daily_metrics
from tagloom.plans.metrics import ITEM_METRICS, METRICS, USER_TAGS
from tagloom.sinks.days import DayStates
from tagloom.sinks.store import Conflict
from tagloom.sources.samples import sample_tables
from tagloom.sources.tables import parquet_tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The sample views as Parquet, each row with the number of a made-up day."""
    root = str(tmp_path_factory.mktemp("tables"))
    derive = sample_tables(spark, SAMPLE_DIR)
    for name in {d.table for d in daily_metrics().values()} | {"tb_order", "tb_bindrecord", "itd_restaurant", "restaurant_class", "tbd_belles_lettres"}:
        rows = derive(name)
        rows.withColumn("_day", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(4)).cast("int")).write.parquet(f"{root}/{name}")
    return root


def of_days(spark, root, table, days):
    """The tables with some days of ``table`` and all of the others."""
    whole = parquet_tables(spark, root)
    some = spark.read.parquet(f"{root}/{table}").filter(F.col("_day").isin(days))
    return lambda name: some.drop("_day") if name == table else whole(name)


def test_every_metric_and_tag_has_a_state(spark):
    assert set(daily_metrics()) == {*ITEM_METRICS, *USER_TAGS} and len(daily_metrics()) == 27 + 35


@pytest.mark.parametrize("name", sorted({**ITEM_METRICS, **USER_TAGS}))
def test_any_split_folds_to_the_full_result(spark, stored, name):
    daily, settings = daily_metrics()[name], Settings()
    full = METRICS[name](parquet_tables(spark, stored), settings)
    states = [daily.of_day(of_days(spark, stored, daily.table, days), settings) for days in ([0], [1, 3], [2], [9])]
    every = states[0].unionByName(states[1]).unionByName(states[2]).unionByName(states[3])
    folded = daily.folded(every)
    assert folded.dtypes == full.dtypes
    expected = collected(full)
    assert collected(folded) == expected and expected
    assert "Python" not in folded._jdf.queryExecution().executedPlan().toString()


def test_states_of_states_are_states(spark, stored):
    daily, settings = daily_metrics()["rest_multitime"], Settings()
    parts = [daily.of_day(of_days(spark, stored, daily.table, [d]), settings) for d in range(4)]
    early = daily.merged(parts[0].union(parts[1]))
    assert early.dtypes == parts[0].dtypes
    late = daily.merged(parts[2].union(parts[3]))
    assert collected(daily.folded(early.union(late))) == collected(METRICS["rest_multitime"](parquet_tables(spark, stored), settings))


def test_a_corrected_day_takes_the_place_of_its_old_one(spark, stored, tmp_path):
    daily, settings = daily_metrics()["rest_avg_amount"], Settings()
    states = DayStates(spark, f"{tmp_path}/s")
    state = lambda days: daily.of_day(of_days(spark, stored, daily.table, days), settings)
    for day, rows in [("2024-01-01", [0]), ("2024-01-02", [1, 2]), ("2024-01-03", [3])]:
        states.put(day, state(rows))
    states.put("2024-01-02", state([1]))
    expected = METRICS["rest_avg_amount"](of_days(spark, stored, daily.table, [0, 1, 3]), settings)
    assert collected(daily.folded(states.read())) == collected(expected)
    states.put("2024-01-02", state([1, 2]))
    full = collected(METRICS["rest_avg_amount"](parquet_tables(spark, stored), settings))
    assert collected(daily.folded(states.read())) == full
    states.compact("2024-01-02", daily.merged)
    assert states.days() == ["2024-01-03"] and collected(daily.folded(states.read())) == full
    with pytest.raises(ValueError, match="can't be replaced"):
        states.put("2024-01-01", state([0]))
    states.vacuum()
    assert len(os.listdir(f"{tmp_path}/s/states")) == 2 and states.versions() == [6]
    assert collected(daily.folded(states.read())) == full


def test_a_failed_put_changes_nothing(spark, tmp_path, monkeypatch):
    states = DayStates(spark, f"{tmp_path}/s")
    with pytest.raises(ValueError, match="no days"):
        states.read()
    states.put("1", spark.createDataFrame([("u", 1)], "user_id string, n long"))
    with pytest.raises(ValueError, match="other columns"):
        states.put("2", spark.createDataFrame([("u", 1)], "user_id string, m long"))
    with monkeypatch.context() as patch:
        patch.setattr(DayStates, "_publish", lambda self, content: (_ for _ in ()).throw(Conflict()))
        with pytest.raises(Conflict):
            states.put("1", spark.createDataFrame([("u", 5)], "user_id string, n long"))
    assert collected(states.read()) == [("u", 1)] and states.days() == ["1"]


def test_a_run_reads_the_new_day_only(spark, stored, tmp_path, monkeypatch):
    """Through the command line; the second run's tables hold nothing of the first day."""
    monkeypatch.setattr(jobs, "batch_session", lambda *a: spark)
    monkeypatch.setattr(jobs, "size_shuffles", lambda *a: None)
    for day, days in (("2024-01-01", [0, 1]), ("2024-01-02", [2, 3])):
        monkeypatch.setattr(jobs, "tables_from", lambda s, a, d=days: of_days(spark, stored, "tb_user_collect", d))
        jobs.main(["rest_collection", "--sample", "x", "--states", f"{tmp_path}/states", "--day", day, "--store", f"{tmp_path}/rest"])
    from tagloom.sinks.store import ProfileStore

    found = ProfileStore(spark, f"{tmp_path}/rest", ["user_id", "item_code"]).read()
    assert collected(found) == collected(METRICS["rest_collection"](parquet_tables(spark, stored), Settings()))
    with pytest.raises(SystemExit, match="--day"):
        jobs.main(["rest_collection", "--sample", "x", "--states", "s", "--store", "p"])
