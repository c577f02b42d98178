"""Benchmark decontamination: an FM-index per shard of training text, searched for test phrases.

Each task turns a few megabytes of documents into a shard of word symbols. Words that no phrase
contains become separators. Every phrase is searched backward through the wavelet ranks, its
occurrences are located by sampled suffix positions, and their spans are merged.

Phrases go to the tasks in blocks of bounded size; a larger benchmark takes more passes over the
text. Which items hold a found phrase is a join, so neither items nor finds pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.fmindex import FMIndex
from tagloom.llm.hashing import by_bytes, packs, word_bounds, word_hashes
from tagloom.llm.repeats import text_keys
from tagloom.llm.scratch import saved

WINDOW = 10
#: Phrases of one pass; each takes about a hundred bytes in every task.
BLOCK = 200_000
#: Bytes of text and symbols of one index.
SHARD_BYTES = 1 << 22
SHARD_SYMBOLS = 1 << 20
BREAKS = np.ones(256, dtype=bool)
BREAKS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

SPAN = "array<struct<first: int, last: int, low: int, high: int>>"
FOUND = f"doc_id long, text_a long, text_b long, n_words long, spans {SPAN}, phrases array<long>"


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of all words, the first word and the first byte of each text."""
    flat = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    starts, ends = word_bounds(flat, BREAKS)
    begins = np.concatenate(([0], np.cumsum([len(x) + 1 for x in texts]))).astype(np.int64)
    return word_hashes(flat, starts, ends), starts, ends, np.searchsorted(starts, begins), begins


def phrases_of(window: int):
    """Per item and window: its words' hashes and a number for the phrase."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column("data").to_pylist()]
            ids = batch.column("item_id").to_pylist()
            for i, j in packs(texts):
                hashes, _, _, first, _ = _words(texts[i:j])
                hashes = hashes.view(np.int64)
                items, words = [], []
                for k in range(j - i):
                    own = hashes[first[k] : first[k + 1]]
                    for s in range(max(1, len(own) - window + 1) if len(own) else 0):
                        items.append(ids[i + k])
                        words.append(own[s : s + window].tolist())
                yield pa.record_batch({"item_id": pa.array(items, pa.string()), "words": pa.array(words, pa.list_(pa.int64()))})

    return work


class Phrases:
    """One block of phrases for the tasks: the alphabet, the symbols of each and their numbers."""

    def __init__(self, numbers: list[int], words: list[list[int]]) -> None:
        self.numbers = np.array(numbers, dtype=np.int64)
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.array([x for w in words for x in w], dtype=np.int64).view(np.uint64)
        self.alphabet = np.unique(flat)
        self.bits = max(1, int(len(self.alphabet)).bit_length())
        self.symbols = np.zeros((len(words), int(self.sizes.max(initial=1))), dtype=np.int64)
        row = np.repeat(np.arange(len(words)), self.sizes)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.symbols[row, column] = np.searchsorted(self.alphabet, flat) + 1

    def occurrences(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first word) of every occurrence in a shard of whole texts."""
        if not len(self.alphabet) or not len(hashes):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        symbol = np.minimum(np.searchsorted(self.alphabet, hashes), len(self.alphabet) - 1)
        symbol = np.where(self.alphabet[symbol] == hashes, symbol + 1, 0)
        # A separator before each text; of neighbouring separators the last one stays.
        heads = first[:-1][first[:-1] < first[1:]]
        word = np.insert(np.arange(len(symbol)), heads, -1)
        symbol = np.insert(symbol, heads, 0)
        stays = (symbol > 0) | np.append(symbol[1:] > 0, False)
        word, symbol = word[stays], symbol[stays]
        longest = self.symbols.shape[1]
        found = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))]
        for begin in range(0, len(symbol), SHARD_SYMBOLS):
            stretch = slice(begin, begin + SHARD_SYMBOLS + longest - 1)
            index = FMIndex(np.concatenate(([0], symbol[stretch], [0])), self.bits)
            low, high = index.ranges(self.symbols, self.sizes)
            counts = high - low
            phrase = np.repeat(np.arange(len(counts)), counts)
            rows = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(len(phrase))
            found.append((phrase, word[stretch][index.places(rows) - 1]))
        return np.concatenate([p for p, _ in found]), np.concatenate([w for _, w in found])


def search(phrases):
    """Per document: its number of words, the merged spans of hits and the phrases found."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Phrases = phrases.value
        for batch in by_bytes(batches, "data"):
            texts = [x or b"" for x in batch.column("data").to_pylist()]
            for i, j in packs(texts, SHARD_BYTES):
                hashes, starts, ends, first, begins = _words(texts[i:j])
                phrase, word = block.occurrences(hashes, first)
                order = np.argsort(word, kind="stable")
                phrase, word = phrase[order], word[order]
                doc = np.searchsorted(first, word, side="right") - 1
                spans: list[list] = [[] for _ in range(j - i)]
                names: list[list] = [[] for _ in range(j - i)]
                cuts = np.searchsorted(doc, np.arange(j - i + 1))
                for k in np.unique(doc):
                    lo, hi = cuts[k], cuts[k + 1]
                    names[k] = np.unique(block.numbers[phrase[lo:hi]]).tolist()
                    spans[k] = [
                        {"first": a - first[k], "last": b - first[k], "low": starts[a] - begins[k], "high": ends[b] - begins[k]}
                        for a, b in _joined(word[lo:hi], block.sizes[phrase[lo:hi]])
                    ]
                part = batch.slice(i, j - i)
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("text_a"),
                        part.column("text_b"),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.array(spans, pa.list_(pa.struct([(n, pa.int32()) for n in ("first", "last", "low", "high")]))),
                        pa.array(names, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_a", "text_b", "n_words", "spans", "phrases"],
                )

    return work


def _joined(word: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """Merged word ranges (both ends included) of occurrences in order of their first word."""
    out: list[list[int]] = []
    for a, n in zip(word.tolist(), size.tolist()):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], a + n - 1)
        else:
            out.append([a, a + n - 1])
    return [(a, b) for a, b in out]


def test_phrases(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(phrase, words) once each, and the (phrase, item_id) that hold them."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("data")).filter("item_id is not null")
    held = saved(rows.mapInArrow(phrases_of(window), "item_id string, words array<long>").withColumn("phrase", F.xxhash64("words")), "held")
    return held.select("phrase", "words").dropDuplicates(["phrase"]), held.select("phrase", "item_id").distinct()


def hits(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """``doc_id, text_a, text_b, n_words, spans, phrases`` for every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_keys(), F.col("text").cast("binary").alias("data"))
    count = phrases.count()
    blocks = max(1, -(-count // BLOCK))
    passes = []
    for b in range(blocks):
        block = phrases.filter(F.pmod(F.col("phrase"), F.lit(blocks)) == b).collect()
        shared = spark.sparkContext.broadcast(Phrases([r["phrase"] for r in block], [r["words"] for r in block]))
        passes.append(saved(rows.mapInArrow(search(shared), FOUND), "hits"))
    if blocks == 1:
        return passes[0]
    keys = ["text_a", "text_b"]
    every = passes[0].select(*keys, "spans", "phrases")
    for other in passes[1:]:
        every = every.unionByName(other.select(*keys, "spans", "phrases"))
    every = saved(
        every.filter(F.size("phrases") > 0)
        .groupBy(keys)
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("phrases")))).alias("phrases")),
        "hits",
    )
    empty = passes[0].drop("spans", "phrases").join(every, keys, "left")
    return empty.withColumn("spans", F.coalesce("spans", F.array().cast(SPAN))).withColumn("phrases", F.coalesce("phrases", F.array().cast("array<long>")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, contaminated``, one row per row of ``docs``.

    A window is ``window`` consecutive words of an item, or a shorter item whole. Null and empty texts
    have no words, items without words no window; rows without item_id name no item. Repeated rows and
    doc_ids are counted each by itself. Either table may be empty. Further columns are ignored.
    """
    phrases, held = test_phrases(benchmark, window)
    found = hits(docs, phrases)
    sets = [F.xxhash64("phrases").alias("set_a"), F.xxhash64(F.lit(1), F.col("phrases")).alias("set_b")]
    found = found.select("*", *sets)
    items = (
        found.filter(F.size("phrases") > 0)
        .select("set_a", "set_b", F.explode("phrases").alias("phrase"))
        .distinct()
        .join(held, "phrase")
        .groupBy("set_a", "set_b")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return (
        found.join(saved(items, "items"), ["set_a", "set_b"], "left")
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("n_hit", hit_words())
        .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))
    )


def hit_words():
    """Words under the spans, which are in order but may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end"))
    total = F.aggregate(
        "spans",
        start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"] - 1, acc["end"]))).cast("long").alias("n"),
            F.greatest(acc["end"], s["last"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    return F.coalesce(total, F.lit(0).cast("long"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans, which are the last column."""
    for batch in by_bytes(batches, "text"):
        texts = []
        for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            if spans:
                parts, end = [], 0
                for s in spans:
                    parts.append(text[end : s["low"]] if s["low"] > end else b"")
                    end = max(end, s["high"])
                text = b"".join([*parts, text[end:]])
            texts.append(text)
        names = batch.schema.names[:-1]
        columns = [pa.array(texts, pa.binary()).cast(pa.string()) if n == "text" else batch.column(i) for i, n in enumerate(names)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with every hit cut out of its text, from its first word's first byte to its last word's last.

    Rows and columns stay as they are; null texts stay null, a text that was all hit becomes empty.
    """
    phrases, _ = test_phrases(benchmark, window)
    name_a, name_b, name_spans = free_names(docs, "a", "b", "spans")
    found = hits(docs, phrases).filter(F.size("phrases") > 0).select(F.col("text_a").alias(name_a), F.col("text_b").alias(name_b), F.col("spans").alias(name_spans))
    found = saved(found.dropDuplicates([name_a, name_b]), "spans")
    a, b = text_keys()
    cut = docs.select("*", a.alias(name_a), b.alias(name_b)).join(found, [name_a, name_b], "left")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return cut.select(*docs.columns, name_spans).mapInArrow(_without, schema)


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Column names that begin like ``names`` and that ``docs`` doesn't have, whatever their case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
