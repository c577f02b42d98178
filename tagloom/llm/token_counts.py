"""Token counts without ids: pieces are counted once per distinct pre-token of the corpus.

A pre-token is a stretch between ASCII white space; the tokenizer drops white space and joins nothing
across it. A first pass finds the frequent pre-tokens: tasks tally stretches of the corpus and hand out the
names with more than a 2**-20 share of their stretch, and a name whose tallies add up to more than that share
of the corpus is frequent. There are at most 2**20 of those whatever the corpus, so the counts of their pieces
are broadcast. A name with twice the share is always among them: in some stretch it passes the share, and what
stretches held back is less than one share in all.

A second pass adds up the frequent pre-tokens of each text and saves that sum with the text's other distinct
pre-tokens. These are dealt out and sorted by name; no name dominates, so tasks meet equal shares. A task counts
a name's pieces where the name first comes up and multiplies them into the rows that follow.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.hashing import by_bytes
from tagloom.llm.scratch import discard, release, saved
from tagloom.llm.vocabulary import words_of

#: At most this many pre-tokens are broadcast; those of more bytes than this by their hash.
FREQUENT, NAME_BYTES = 1 << 20, 48
#: Distinct pre-tokens that a task holds at once; it hands out what it has and goes on.
HELD = 1 << 18
#: A long text is split by stretches of about this many bytes.
STRETCH = 1 << 22
#: Name of the row that carries a stretch's number of pre-tokens; no pre-token is empty.
TOTAL = ""


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The pre-tokens of a text; a stretch ends at white space."""
    start = 0
    while len(text) - start > STRETCH:
        end = start + STRETCH
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        yield text[start:end].split()
        start = end
    yield text[start:].split()


def _key(word: bytes) -> bytes:
    """The pre-token, or a blank and its hash if it is long; a pre-token has no blank."""
    return word if len(word) <= NAME_BYTES else b" " + hashlib.sha256(word).digest()


def _strings(tokens) -> pa.Array:
    return pa.array(tokens, pa.binary()).cast(pa.string())


def _common(counts: Counter, most: int) -> pa.RecordBatch:
    total = sum(counts.values())
    found = {w: n for w, n in counts.items() if n * most > total}
    return pa.record_batch({"name": _strings([TOTAL.encode(), *found]), "n": pa.array([total, *found.values()], pa.int64())})


def _tally(most: int):
    """Names with more than their share of a stretch of the task's texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in by_bytes(batches, "data"):
            for data in batch.column("data"):
                for words in _words(data.as_py()):
                    counts.update(words)
                    if len(counts) > HELD:
                        yield _common(counts, most)
                        counts.clear()
        if counts:
            yield _common(counts, most)

    return work


def _piece_counts(path: str, names: list[str]) -> list[int]:
    return [len(found) for found in words_of(path).tokenizer.encode_batch_fast(names, add_special_tokens=False)]


def _known(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "name"):
            names = batch.column("name").to_pylist()
            yield pa.record_batch({"key": pa.array([_key(x.encode()) for x in names], pa.binary()), "pieces": pa.array(_piece_counts(path, names), pa.int64())})

    return work


def frequent_pieces(docs: DataFrame, path: str, most: int = FREQUENT) -> dict[bytes, int]:
    """Piece counts of the frequent pre-tokens of ``docs``: at most ``most`` keys of at most 48 bytes."""
    texts = docs.filter("text is not null").select(F.col("text").cast("binary").alias("data"))
    tallied = saved(texts.mapInArrow(_tally(most), "name string, n long").groupBy("name").agg(F.sum("n").alias("n")), "tallied")
    total = tallied.filter(F.col("name") == TOTAL).agg(F.sum("n")).first()[0] or 0
    frequent = tallied.filter((F.col("name") != TOTAL) & (F.col("n") * most > total)).select("name")
    known = frequent.mapInArrow(_known(path), "key binary, pieces long").toArrow()
    discard(tallied)
    return dict(zip(known.column("key").to_pylist(), known.column("pieces").to_pylist()))


def _split(known):
    """Of each text the pieces of its frequent pre-tokens, and the others with their occurrences."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = known.value
        for batch in by_bytes(batches, "data"):
            texts = batch.column("data")
            n_bytes: list[int] = []
            sums: list[int] = []
            names: list[pa.Array] = []
            counts: list[int] = []
            ends = [0]
            for data in texts:
                text = data.as_py() or b""
                found: Counter = Counter()
                for words in _words(text):
                    found.update(words)
                total, rare = 0, []
                for word, n in found.items():
                    known_pieces = pieces.get(_key(word))
                    if known_pieces is None:
                        rare.append(word)
                    else:
                        total += n * known_pieces
                sums.append(total)
                n_bytes.append(len(text))
                names.append(_strings(rare))
                counts.extend(found[w] for w in rare)
                ends.append(len(counts))
            offsets = pa.array(ends, pa.int32())
            all_names = pa.concat_arrays(names) if names else pa.array([], pa.string())
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(n_bytes, pa.int64()),
                    "known": pa.array(sums, pa.int64()),
                    "names": pa.ListArray.from_arrays(offsets, all_names),
                    "counts": pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                }
            )

    return work


def _multiplied(path: str):
    """Rows sorted by name: each name's pieces are counted once and multiplied into its rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, int] | None = None
        for batch in by_bytes(batches, "name"):
            coded = batch.column("name").dictionary_encode()
            names = coded.dictionary.to_pylist()
            carried = [last[1]] if last and names[:1] == [last[0]] else []
            pieces = carried + _piece_counts(path, names[len(carried) :])
            if names:
                last = names[-1], pieces[-1]
            each = pa.array(pieces, pa.int64()).take(coded.indices)
            yield pa.record_batch({"row": batch.column("row"), "n": pc.multiply(each, batch.column("n"))})

    return work


def token_counts(docs: DataFrame, path: str, most: int = FREQUENT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row of ``docs``.

    Null, empty and blank texts have no tokens. Rows are counted one by one, so repeated rows and doc_ids do
    no harm. An empty table gives an empty result. Further columns are ignored. At most ``most`` pre-tokens are broadcast.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(frequent_pieces(docs, path, most))
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    split = texts.mapInArrow(_split(known), f"doc_id {kind}, n_bytes long, known long, names array<string>, counts array<long>")
    split = saved(split.withColumn("row", F.monotonically_increasing_id()), "split")
    known.unpersist()
    release(spark)
    pairs = split.select("row", F.explode(F.arrays_zip("names", "counts")).alias("x"))
    dealt = pairs.select("row", F.col("x.names").alias("name"), F.col("x.counts").alias("n")).repartition("name").sortWithinPartitions("name")
    others = dealt.mapInArrow(_multiplied(path), "row long, n long").groupBy("row").agg(F.sum("n").alias("others"))
    n_tokens = F.col("known") + F.coalesce("others", F.lit(0))
    return split.select("doc_id", "n_bytes", "known", "row").join(others, "row", "left").select("doc_id", "n_bytes", n_tokens.alias("n_tokens"))
