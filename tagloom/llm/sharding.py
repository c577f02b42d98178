"""Sharding by a permutation-filled lookup table.

Every shard has its own order of the slots of a prime-sized table: an offset and a step from a hash
of its name. The shards take turns; at its turn each claims the first slot of its order that is still
free, until all slots are taken. The table is a small constant whatever the data: rows find their shard
by one lookup, and a shard that joins or leaves moves few other slots.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime; shards get shares that differ by about shards / SLOTS.
SLOTS = 65537


def _number(text: str) -> int:
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big")


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard. ``slots`` is a prime above the number of shards."""
    if not shards:
        raise ValueError("no shards")
    if len(set(shards)) != len(shards):
        raise ValueError("shard names repeat")
    if slots < max(2, len(shards)) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots is a prime and not below the number of shards")
    orders = [(_number("offset:" + name) % slots, _number("step:" + name) % (slots - 1) + 1) for name in shards]
    table, turns, taken = [-1] * slots, [0] * len(shards), 0
    while taken < slots:
        for shard, (offset, step) in enumerate(orders):
            if taken == slots:
                break
            while table[slot := (offset + turns[shard] * step) % slots] >= 0:
                turns[shard] += 1
            table[slot] = shard
            turns[shard] += 1
            taken += 1
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """60 bits of the key's MD5, modulo the table; null keys have the slot of the empty text."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long") % slots).cast("int")


def placed(rows: DataFrame, key: Column, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``; columns of these names are replaced.

    Every row has one shard, the same for equal keys, null and repeated ones included. An empty table
    stays empty. The table is broadcast: ``slots`` rows, however large the data.
    """
    spark: SparkSession = rows.sparkSession
    table = lookup_table(shards, slots)
    known = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(table)], "slot int, shard string")
    return rows.drop("shard").withColumn("slot", slot_of(key, slots)).join(F.broadcast(known), "slot")


def write_shards(rows: DataFrame, key: Column, shards: list[str], path: str, slots: int = SLOTS) -> None:
    """Writes each shard's rows below ``path``, several tasks to a large shard."""
    placed(rows, key, shards, slots).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
