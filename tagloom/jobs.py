"""Command line: run one job or profile and store its result.

    spark-submit run_tagloom.py JOB --tables ROOT --out PATH
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.base import BY_ITEM, BY_USER
from tagloom.plans.daily import daily_metrics
from tagloom.plans.metrics import EXTRACTS, ITEM_FACTS, ITEM_METRICS, METRICS, USER_TAGS
from tagloom.plans.profiles import PROFILES, assemble
from tagloom.session import batch_session, size_shuffles
from tagloom.settings import Settings
from tagloom.sinks.days import DayStates
from tagloom.sinks.files import write_extract, write_tuples
from tagloom.sinks.profile import as_documents, upsert_profile, write_index
from tagloom.sinks.store import BUCKETS, ProfileStore
from tagloom.sources.jdbc import configured_tables
from tagloom.sources.samples import sample_tables
from tagloom.sources.tables import catalog_tables, parquet_tables, text_lines, with_browse_hours

JOBS = {**METRICS, **PROFILES}

# Index document type that each job updates.
DOCUMENT_TYPES: dict[str, str] = {
    "rest": "userRest",
    "lounge": "userLounge",
    "shop": "userShop",
    "parking": "userParking",
    "cip": "userCIP",
    "vvip": "userVvip",
    "banner": "userBanner",
    "article": "userArticle",
}

# Jobs whose result may hold several rows per key; a stored profile keeps the largest value.
SEVERAL_ROWS_PER_KEY = ("rest_browse_hour", "restaurant_priority")

# Column that the files of an extract are laid out by.
EXTRACT_LAYOUT = {"path_range_extract": "page_order", "path_tail_extract": "path_bucket"}


def keys_of(job: str) -> list[str]:
    """Key columns of a job's result; extracts have none."""
    if job in EXTRACTS:
        return []
    if job in ITEM_FACTS:
        return ["restaurant_code"]
    if job in USER_TAGS or job == "profile_user_tags":
        return list(BY_USER)
    return list(BY_ITEM)


def document_type(job: str) -> str:
    """Index document type of a job's result."""
    if job in ITEM_FACTS:
        return "restaurant"
    if job in USER_TAGS or job == "profile_user_tags":
        return "userTags"
    return DOCUMENT_TYPES[job.removeprefix("profile_").split("_")[0]]


def run(job: str, tables: Callable[[str], DataFrame], settings: Settings) -> DataFrame:
    """The result of a job as a lazy DataFrame."""
    return JOBS[job](tables, settings)


def run_day(
    spark: SparkSession,
    job: str,
    day: str,
    root: str,
    tables: Callable[[str], DataFrame],
    settings: Settings,
) -> DataFrame:
    """Put a day's rows into the states of a metric and fold all days to its result.

    The metric's own table holds the day's rows, all others are whole. A day that is given again
    replaces what it had.
    """
    daily = daily_metrics()[job]
    states = DayStates(spark, f"{root.rstrip('/')}/{job}")
    states.put(day, daily.of_day(tables, settings))
    return daily.folded(states.read())


def settings_from(path: str | None) -> Settings:
    return Settings(**json.loads(Path(path).read_text())) if path else Settings()


def tables_from(spark: SparkSession, args: argparse.Namespace) -> Callable[[str], DataFrame]:
    if args.tables:
        tables = parquet_tables(spark, args.tables)
    elif args.database:
        tables = catalog_tables(spark, args.database)
    elif args.sample:
        tables = sample_tables(spark, args.sample)
    else:
        tables = configured_tables(spark, json.loads(Path(args.jdbc).read_text()), args.job)
    if args.browse_hours:
        tables = with_browse_hours(tables, text_lines(spark, args.browse_hours))
    return tables


def store(spark: SparkSession, job: str, result: DataFrame, args: argparse.Namespace) -> None:
    keys = keys_of(job)
    if job in SEVERAL_ROWS_PER_KEY and not args.text:
        result = assemble([result], tuple(keys))
    if (args.index or args.store) and not keys:
        raise SystemExit(f"{job} has no key, so it cannot update a profile")
    if args.store:
        ProfileStore(spark, args.store, keys, args.buckets).upsert(result)
    elif args.index:
        resource = f"{args.index}/{document_type(job)}"
        write_index(as_documents(result, keys), resource, json.loads(args.index_options))
    elif args.text:
        write_tuples(result, args.out)
    elif keys:
        upsert_profile(spark, result, keys, args.current, args.out)
    else:
        write_extract(result, args.out, EXTRACT_LAYOUT.get(job))


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="tagloom", description=__doc__)
    options.add_argument("job", choices=sorted(JOBS))
    source = options.add_mutually_exclusive_group(required=True)
    source.add_argument("--tables", help="root folder of Parquet tables")
    source.add_argument("--database", help="metastore database")
    source.add_argument("--jdbc", help="JSON file: connections, splits (see configured_tables)")
    source.add_argument("--sample", help="folder with the star-schema test data")
    options.add_argument("--browse-hours", help="tuple text with the browse hours")
    options.add_argument("--settings", help="JSON file with Settings fields")
    options.add_argument("--shuffle-bytes", type=int, help="expected size of the largest shuffle")
    options.add_argument("--zone", default="UTC", help="session time zone: the day of an order")
    sink = options.add_mutually_exclusive_group(required=True)
    sink.add_argument("--out", help="target folder, must not exist")
    sink.add_argument("--index", help="search index to upsert into")
    sink.add_argument("--store", help="profile store: only buckets with fresh keys are rewritten")
    options.add_argument("--buckets", type=int, default=BUCKETS, help="buckets of a new store")
    options.add_argument("--index-options", default="{}", help="JSON connector options")
    options.add_argument("--current", help="stored profile to merge the result into")
    options.add_argument("--states", help="folder of the states by day, for metrics and tags")
    options.add_argument("--day", help="the day whose rows the metric's table holds")
    options.add_argument("--text", action="store_true", help="write (a,b,c) lines to --out")
    return options


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = batch_session(f"tagloom {args.job}", args.shuffle_bytes, args.zone)
    tables, settings = tables_from(spark, args), settings_from(args.settings)
    if args.states:
        if args.job not in {**ITEM_METRICS, **USER_TAGS} or not args.day:
            raise SystemExit("--states needs a metric or tag, and --day")
        result = run_day(spark, args.job, args.day, args.states, tables, settings)
    else:
        result = run(args.job, tables, settings)
    if args.shuffle_bytes is None:
        size_shuffles(spark, result)
    store(spark, args.job, result, args)
