"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z in lower case; 128 bits of two hashes stand
for it. Keys of at least ``shortest`` code points that at least ``least_docs`` documents hold lose all
their lines but those of the largest doc_id that holds them.

Documents come in batches of falling doc_ids. A run is a table of keys, bucketed and sorted by key, with the
number of documents, the largest of them (the keeper) and whether the key is frequent. Each batch adds up its
keys, merge-anti-joins the runs - a key that a run already finds in enough documents has its keeper, for later
batches hold smaller doc_ids - and adds what is left as its own run. When a level holds ``fanout`` runs they
are merged into one run of the next level, so a key is rewritten once a level, and a new batch meets a few
runs per level, however many batches there were.

Buckets are as many as shuffle partitions, so runs join and merge without being shuffled again. Keys are
added up per task and document first: a line that a third of all documents hold reaches its bucket as one
row a task. A key with more than a 2**-14 share of all lines has that share in some batch, so frequent keys
are at most 2**14 a batch; their lines are found by broadcast, all others, which no key dominates, by
shuffle. Everything is column expressions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.scratch import delete, fresh_path, saved

KEY = ["line_a", "line_b"]
SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCHES, FANOUT = 4, 2
#: A key is frequent in a batch with more than one line in so many.
SHARE = 1 << 14


def line_key(line: Column) -> Column:
    """The stripped line with A-Z, and nothing else, in lower case; ``lower`` is the same for ASCII and faster."""
    key = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(key) == F.char_length(key), F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def split_lines(text: Column | str) -> Column:
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n")


def keyed_lines(docs: DataFrame, shortest: int = 20) -> DataFrame:
    """``doc_id, text_a, pos, line_a, line_b`` of every line whose key is long enough; rows without doc_id have none."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    lines = texts.select("doc_id", F.xxhash64("text").alias("text_a"), F.posexplode(split_lines("text")).alias("pos", "line"))
    keys = lines.filter(F.char_length("line") >= shortest).select("doc_id", "text_a", "pos", line_key(F.col("line")).alias("key"))
    return keys.filter(F.char_length("key") >= shortest).select(
        "doc_id", "text_a", "pos", F.xxhash64("key").alias("line_a"), F.xxhash64(F.lit(1), F.col("key")).alias("line_b")
    )


class LineRuns:
    """The runs, by level; ``add`` takes batches in falling order of doc_ids."""

    def __init__(self, spark: SparkSession, least_docs: int = 3, fanout: int = FANOUT) -> None:
        self.spark, self.least_docs, self.fanout = spark, least_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def add(self, lines: DataFrame, total: int) -> None:
        """Adds the keys of a batch of ``total`` lines, ``doc_id, line_a, line_b``."""
        held = lines.groupBy(*KEY, "doc_id").agg(F.count("*").alias("n"))
        keys = held.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"), (F.sum("n") * SHARE > total).alias("frequent"))
        for level in self.levels:
            for table, _ in level:
                decided = self.spark.table(table).filter(F.col("n_docs") >= self.least_docs).select(*[F.col(c).alias(f"old_{c}") for c in KEY])
                same = [F.col(c) == F.col(f"old_{c}") for c in KEY]
                keys = keys.join(decided, [*same, ~F.col("frequent")], "left_anti")
        self._keep(keys, 0)

    def merged(self, tables: list[str]) -> DataFrame:
        every = self.spark.table(tables[0])
        for table in tables[1:]:
            every = every.unionByName(self.spark.table(table))
        return every.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"), F.max("frequent").alias("frequent"))

    def _keep(self, run: DataFrame, level: int) -> None:
        name, path = f"line_run_{uuid.uuid4().hex}", fresh_path(self.spark, "run")
        run.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))
        if len(self.levels[level]) == self.fanout:
            old = self.levels[level]
            self._keep(self.merged([name for name, _ in old]), level + 1)
            self.levels[level] = []
            self._drop(old)

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"drop table {name}")
            delete(self.spark, path)

    def repeated(self) -> DataFrame:
        """``line_a, line_b, keeper, frequent`` of the keys that enough documents hold; saved, and the runs are gone."""
        runs = [run for level in self.levels for run in level]
        every = self.merged([name for name, _ in runs]).filter(F.col("n_docs") >= self.least_docs)
        rows = saved(every.select(*KEY, "keeper", "frequent"), "repeated")
        self._drop(runs)
        self.levels = []
        return rows


def _batches(docs: DataFrame, batches: int) -> Column:
    """Number of the batch of a doc_id, 0 for the largest; about as many rows in each."""
    shares = [1 - (i + 1) / batches for i in range(batches - 1)]
    bounds = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, 1000).alias("at")).first()["at"] if shares else None
    number = F.lit(0)
    for bound in bounds or []:
        number = number + (F.col("doc_id") < F.lit(bound)).cast("int")
    return number


def without_repeated_lines(docs: DataFrame, shortest: int = 20, least_docs: int = 3, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text``, one row per row of ``docs``.

    A null or empty text is one empty line. Rows of one doc_id are one document: they count once and, if it is
    the largest, keep their lines all. Rows without doc_id count for nothing and lose no line. Of ties there
    are none, for a key has one largest doc_id. An empty table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    path = fresh_path(spark, "lines")
    numbered = keyed_lines(docs, shortest).withColumn("batch", _batches(docs, batches))
    numbered.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc_id long, text_a long, pos int, line_a long, line_b long, batch int").parquet(path)
    sizes = {r["batch"]: r["count"] for r in lines.groupBy("batch").count().collect()}
    runs = LineRuns(spark, least_docs, fanout)
    for batch in range(batches):
        if batch in sizes or not batch:
            runs.add(lines.filter(F.col("batch") == batch), sizes.get(batch, 0))
    repeated = runs.repeated()
    lines = lines.drop("batch")
    frequent, others = F.broadcast(repeated.filter("frequent").drop("frequent")), repeated.filter("not frequent").drop("frequent")
    gone = (
        lines.join(frequent, KEY)
        .unionByName(lines.join(frequent.select(*KEY), KEY, "left_anti").join(others, KEY))
        .filter("doc_id <> keeper")
        .groupBy("doc_id", "text_a")
        .agg(F.collect_set("pos").alias("gone"))
    )
    found = docs.withColumn("text_a", F.xxhash64("text")).join(gone, ["doc_id", "text_a"], "left").withColumn("lines", split_lines("text"))
    size = F.size("lines")
    kept = F.array_except(F.sequence(F.lit(0), size - 1), "gone")
    text = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return found.select(
        "doc_id",
        size.cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(text).alias("kept_text"),
    )
