"""A broadcast bitmap of key hashes, which tells most rows that are not among some keys without a join.

Its size is bounded, so with very many keys it lets more rows through; an exact join must follow for those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits a key, up to ``MOST`` bits in all (8 MB), in rows of ``ROW`` bits.
PER_KEY, MOST, ROW = 16, 1 << 26, 1 << 15


def marked(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: false only where ``key`` is surely not among the ``key`` values of ``keys``."""
    bits = min(MOST, max(ROW, PER_KEY * keys.count()))
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    row, bit = F.floor(place / ROW).alias("_row"), (place % ROW).alias("_bit")
    bitmap = keys.select(row, bit).groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("shiftright(_byte, cast(_bit % 8 as int)) % 2 = 1")
    found = rows.select("*", row, bit).join(F.broadcast(bitmap), "_row", "left").withColumn("_byte", byte)
    return found.withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("_row", "_bit", "_bits", "_byte")
