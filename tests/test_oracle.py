"""Every registered query against its SQL twin, value by value."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SAMPLE_DIR
from tagloom.plans.metrics import LOOKUPS, METRICS
from tagloom.plans.profiles import PROFILES

#: The queries of this library proper; the training-data operators have tests of their own.
OWN = sorted({**METRICS, **PROFILES, **LOOKUPS})

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ALL_TABLES:
        connection.execute(
            f"create view {name} as select * from '{SAMPLE_DIR}/{name}.parquet'"
        )
    return connection


def test_every_query_has_a_twin():
    assert set(OWN) <= set(queries()) and set(OWN) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())
    assert len(OWN) == 27 + 35 + 1 + 5 + 7 + len(LOOKUPS)


@pytest.mark.parametrize("name", OWN)
def test_matches_sql(spark, duck, name):
    ours = queries()[name](spark, SAMPLE_DIR)
    columns = sorted(ours.columns)
    theirs = duck.execute(oracle_sql()[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in at) for row in theirs.fetchall()), key=repr)
    actual = sorted((tuple(row[c] for c in columns) for row in ours.collect()), key=repr)
    assert actual == expected
    assert actual or name == "path_page_extract"


def test_entry_is_the_user_profile(spark):
    df = entry(spark)
    assert df.columns[0] == "user_id"
    assert len(df.columns) == 1 + 39
    assert df.count() == df.select("user_id").distinct().count() > 0
