"""Table resolver over JDBC: whole-table, predicate-partitioned and range-partitioned scans.

Column projections and filters of the operators are pushed into the generated SQL by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.settings import TAIL_RANGES
from tagloom.sources.tables import only_declared, remembered

# Which of the three connections serves a table when a job does not say otherwise.
CONNECTION_OF_TABLE: dict[str, int] = {
    "restaurant_order_detail2": 1,
    "tb_order": 1,
    "itd_restaurant": 1,
    "td_restaurant_order": 1,
    "restaurant_class": 1,
    "tb_user_collect": 1,
    "customer_share": 1,
    "tb_customer_share": 1,
    "tblconsumerecord": 1,
    "tb_bindrecord": 1,
    "tb_order_loungeserv": 1,
    "tbd_url_element": 2,
    "tbd_visit_url": 2,
    "tbd_app_opera_path": 2,
    "banner_prefixes": 2,
    "tb_order_cip": 3,
    "tb_order_cip_record": 3,
    "tb_order_vvip": 3,
    "tb_order_parking": 3,
    "tb_order_limousine": 3,
    "tbd_lettres_favor": 3,
    "tbd_belles_lettres": 3,
}

# Zero-based positions of columns that are read by position, not by name.
COLUMN_POSITIONS: dict[str, dict[str, int]] = {
    "tb_user_collect": {"user_id": 1, "code": 3},
    "customer_share": {"user_id": 1, "code": 5},
}


@dataclass(frozen=True)
class RangeScan:
    """Split a scan into ``partitions`` ranges of a numeric column; rows outside stay included."""

    column: str
    lower: int
    upper: int
    partitions: int


def by_position(df: DataFrame, positions: Mapping[str, int]) -> DataFrame:
    """Columns picked by position under new names."""
    names = df.columns
    return df.select(*[F.col(f"`{names[at]}`").alias(name) for name, at in positions.items()])


@dataclass(frozen=True)
class DepthScan:
    """Split a scan into about ``partitions`` parts of equally many rows, by the values of a column.

    The database counts the rows per cell of ``width`` values (one value each by default) in one
    query; the bounds are taken from these counts. ``width`` is for columns of numbers with very many
    values: ``cells`` counts are read at most, and more are refused.
    """

    column: str
    partitions: int
    width: float | None = None
    cells: int = 1_000_000


def histogram_query(table: str, split: DepthScan) -> str:
    """The one aggregate over the split column, as a table expression for a JDBC read."""
    column = split.column
    cell = column if split.width is None else f"floor({column} / {split.width}) * {split.width}"
    counted = f"select {cell} as cell, count(*) as n from {table} where {column} is not null"
    return f"({counted} group by {cell}) histogram"


def depth_bounds(counts: Sequence[tuple], partitions: int) -> list:
    """Lower bounds of the parts but the first, from (cell, rows) pairs.

    A part takes cells while it has no more than an N-th of the rows; only a cell that has more than
    that is a part with more, by itself. Two neighbours have more than an N-th together, so there
    are fewer than 2 N + 1 parts.
    """
    share = sum(n for _, n in counts) / partitions
    bounds, filled = [], 0
    for cell, n in sorted(counts):
        if filled and filled + n > share:
            bounds.append(cell)
            filled = 0
        filled += n
    return bounds


def sql_value(value) -> str:
    """A bound as a SQL literal: numbers as they are, dates and texts quoted."""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def depth_predicates(column: str, bounds: Sequence) -> list[str]:
    """Predicates of which every row meets exactly one: below the first bound or NULL, between two, from the last on.

    Rows that come in after the count, whatever their values, are in one of them as well.
    """
    if not bounds:
        return ["1 = 1"]
    shown = [sql_value(b) for b in bounds]
    first = f"({column} < {shown[0]} or {column} is null)"
    between = [f"({column} >= {low} and {column} < {high})" for low, high in pairwise(shown)]
    return [first, *between, f"{column} >= {shown[-1]}"]


def depth_split(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], split: DepthScan
) -> list[str]:
    """The predicates of ``split`` for the table as it is now."""
    found = spark.read.jdbc(url, histogram_query(table, split), properties=dict(properties))
    counts = [(cell, int(n)) for cell, n in found.limit(split.cells + 1).collect()]
    if len(counts) > split.cells:
        raise ValueError(f"{table}.{split.column} has more than {split.cells} cells: give a width")
    return depth_predicates(split.column, depth_bounds(counts, split.partitions))


def scan(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    split: RangeScan | DepthScan | Sequence[str] | None = None,
) -> DataFrame:
    """One table: a single query, one query per range, or one query per predicate."""
    options = dict(properties)
    if isinstance(split, DepthScan):
        split = depth_split(spark, url, table, options, split)
    if split is None:
        return spark.read.jdbc(url, table, properties=options)
    if isinstance(split, RangeScan):
        return spark.read.jdbc(
            url,
            table,
            column=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.partitions,
            properties=options,
        )
    return spark.read.jdbc(url, table, predicates=list(split), properties=options)


def page_predicates(first: int = 18, last: int = 25) -> list[str]:
    """One partition per page position."""
    return [f"page_order = {page}" for page in range(first, last + 1)]


def tail_predicates(ranges=TAIL_RANGES) -> list[str]:
    """One partition per range of page positions, the last one open-ended."""
    return [
        f"page_order >= {low}" + ("" if high is None else f" and page_order <= {high}")
        for low, high in ranges
    ]


# The range-partitioned scan of the page-path log.
PATH_SCAN = RangeScan("page_order", 1, 1500, 8)

# The same scan for jobs run from the command line: by the page positions as they are distributed.
PATH_DEPTH = DepthScan("page_order", 8)


def jdbc_tables(
    spark: SparkSession,
    connections: Mapping[int, tuple[str, Mapping[str, str]]],
    splits: Mapping[str, RangeScan | DepthScan | Sequence[str]] | None = None,
    connection_of: Mapping[str, int] = CONNECTION_OF_TABLE,
) -> Callable[[str], DataFrame]:
    """Tables read from up to three connections, each a (url, properties) pair.

    A table without an entry in ``splits`` is read by one task, so big tables need one.
    """
    scans = {"tbd_app_opera_path": PATH_SCAN, **(splits or {})}

    def load(name: str) -> DataFrame:
        url, properties = connections[connection_of[name]]
        df = scan(spark, url, name, properties, scans.get(name))
        if name in COLUMN_POSITIONS:
            df = by_position(df, COLUMN_POSITIONS[name])
        return only_declared(name, df)

    return remembered(load)


# Jobs that read a table through another connection than the table's usual one.
SERVICES = ("cip", "vvip", "parking", "car")
SERVICE_CONNECTIONS = {"tb_order": 3}
PRIORITY_CONNECTIONS = {"itd_restaurant": 3}

# Scans of the page-path log that fetch just the pages a job keeps, one query per part.
JOB_SPLITS: dict[str, dict[str, list[str]]] = {
    "path_range_extract": {"tbd_app_opera_path": page_predicates()},
    "path_tail_extract": {"tbd_app_opera_path": tail_predicates()},
}

# Rows fetched at once, so that a driver does not hold a whole result.
FETCH_SIZE = 10_000


def job_connections(job: str) -> dict[str, int]:
    """Connections that a job uses instead of ``CONNECTION_OF_TABLE``."""
    if job == "restaurant_priority":
        return dict(PRIORITY_CONNECTIONS)
    if job.removeprefix("profile_").split("_")[0] in SERVICES:
        return dict(SERVICE_CONNECTIONS)
    return {}


def split_from(given: Mapping | Sequence[str]) -> RangeScan | DepthScan | list[str]:
    """A split as JSON has it: {column, partitions}, with lower and upper for fixed strides, or predicates."""
    if not isinstance(given, Mapping):
        return list(given)
    return RangeScan(**given) if "lower" in given else DepthScan(**given)


def configured_tables(
    spark: SparkSession, config: Mapping | Sequence[Mapping], job: str
) -> Callable[[str], DataFrame]:
    """``jdbc_tables`` for one job from parsed JSON.

    ``config`` is a list of {url, properties}, or an object with that list as ``connections``
    and, as wanted, ``splits`` and ``connection_of`` by table and ``fetchsize``. What it says
    goes before the job's own splits and connections. Unknown keys and tables are refused.
    """
    if not isinstance(config, Mapping):
        config = {"connections": config}
    splits, chosen = config.get("splits", {}), config.get("connection_of", {})
    unknown = set(config) - {"connections", "splits", "connection_of", "fetchsize"}
    unknown |= (set(splits) | set(chosen)) - set(CONNECTION_OF_TABLE)
    for entry in config["connections"]:
        unknown |= set(entry) - {"url", "properties"}
    if unknown:
        raise ValueError(f"unknown in the JDBC settings: {', '.join(sorted(unknown))}")
    fetch = {"fetchsize": str(config.get("fetchsize", FETCH_SIZE))}
    connections = {
        number: (entry["url"], {**fetch, **entry.get("properties", {})})
        for number, entry in enumerate(config["connections"], start=1)
    }
    scans = {"tbd_app_opera_path": PATH_DEPTH, **JOB_SPLITS.get(job, {})}
    scans = {**scans, **{name: split_from(s) for name, s in splits.items()}}
    return jdbc_tables(
        spark, connections, scans, {**CONNECTION_OF_TABLE, **job_connections(job), **chosen}
    )
