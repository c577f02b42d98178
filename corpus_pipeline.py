"""Documents to token ids, in five stages: each takes what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tagloom.llm import decontaminate, minhash, pieces, quality, repeats, sieve
from tagloom.llm.scratch import saved
from tagloom.llm.ship import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PIECE_BPE = "piece_bpe_32k.model"


def _rewritten(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the count of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the distribution limits reject go."""
    ship(spark)
    return quality.accepted(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group of near duplicates stays.

    Groups are made of rows, so of a row that is there twice one stays, and rows without a doc_id are linked by
    their texts like others; they stay only where no row of their group has a doc_id. Of equal doc_ids any one row
    stays. Null, empty and blank texts are in no group and stay.
    """
    ship(spark)
    rows = saved(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), width=5, percent=80)
    groups = found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    first = groups.join(rows.select("row", "doc_id"), "row").groupBy("group").agg(F.min(rank).alias("first"))
    lost = saved(groups.select("row").join(first.select("first.row"), "row", "left_anti"), "near")
    # Only texts that the bitmap can't tell from lost ones are dealt out for the join.
    told = sieve.marked(rows, "row", lost)
    stay = told.filter("not maybe").unionByName(told.filter("maybe").join(lost, "row", "left_anti"))
    return stay.select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that start more than once are cut out, by whole characters; no document goes."""
    ship(spark)
    kept = repeats.without_repeats(docs.select(*COLUMNS), length=200, whole_characters=True, carry=("doc_id", "lang", "source"))
    return _rewritten(kept.withColumn("text", F.decode("kept_bytes", "utf-8")))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Occurrences of ten-word windows of benchmark items are cut out; no document goes."""
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _rewritten(decontaminate.decontaminated(docs.select(*COLUMNS), benchmark, window=10))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, their number and whether they decode to the text."""
    ship(spark)
    path = public_tokenizers.path(PIECE_BPE)
    rows = pieces.decoded(pieces.encoded(docs.select("doc_id", "text"), path), path)
    return rows.select(
        "doc_id", pieces.count(F.col("ids")).alias("n_tokens"), pieces.round_trip(F.col("text"), F.col("decoded")).alias("round_trip"), F.crc32("ids").alias("ids_crc32"), "ids"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: No SQL is given. Tests hold near_duplicates against all pairs and the last stage's round trip; the other stages through their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
