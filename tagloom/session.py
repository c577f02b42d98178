"""Session settings for the batch jobs. Operators never change a session themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024

# Splits a hot join key, merges small shuffle partitions and re-plans joins from real sizes.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}

# A join side is broadcast only while Spark's own size estimate stays below this.
BROADCAST_LIMIT = 32 * MIB


# Where no size is known the shuffles start wide; AQE merges what turns out small.
DEFAULT_PARTITIONS = 2000
LEAST_PARTITIONS = 8

# Beyond this many pieces the pieces grow instead: 100 TB are cut into pieces of 0.5 GB.
MOST_PARTITIONS = 200_000
PIECE = 128 * MIB

# A plan without a better estimate (a JDBC table) claims to be this large or larger.
NO_ESTIMATE = 1 << 62


def partitions_for(shuffle_bytes: int) -> int:
    """Pieces of about ``PIECE`` bytes, at least 8 and at most ``MOST_PARTITIONS``."""
    return min(MOST_PARTITIONS, max(LEAST_PARTITIONS, -(-shuffle_bytes // PIECE)))


def batch_conf(shuffle_bytes: int | None = None, zone: str = "UTC") -> dict[str, str]:
    """Settings for one run.

    ``shuffle_bytes`` is the expected size of the largest shuffle, which is cut into partitions
    of about 128 MiB, so that one fits the memory of a task. ``zone`` decides which day an order
    time with a zone belongs to; times without a zone are taken as they are.
    """
    partitions = DEFAULT_PARTITIONS if shuffle_bytes is None else partitions_for(shuffle_bytes)
    return {
        **ADAPTIVE,
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * MIB),
        "spark.sql.session.timeZone": zone,
    }


def read_bytes(result: DataFrame) -> int | None:
    """Catalyst's estimate of what a plan reads, each scan counted; None where a scan has none."""
    leaves = result._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(size >= NO_ESTIMATE for size in sizes) else sum(sizes)


def size_shuffles(spark: SparkSession, result: DataFrame) -> None:
    """Cut the shuffles of ``result`` by the bytes its plan reads, before it runs."""
    expected = read_bytes(result)
    if expected is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions_for(expected)))


def batch_session(
    name: str, shuffle_bytes: int | None = None, zone: str = "UTC"
) -> SparkSession:
    """Session with ``batch_conf``; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(name)
    for key, value in batch_conf(shuffle_bytes, zone).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
