"""Suffix-array dedup: the strings of ``length`` bytes that start at more than one place.

Suffixes are ordered by most significant digits and only as deep as ``length`` bytes, so an equal
group at full depth is exactly a repeated string. The digits are chosen so that neighbouring
suffixes share them and one row stands for all of them:

1. the anchor, the least hash among the 32-byte strings inside the first ``length`` bytes. Neighbouring
   suffixes with the same anchor form a run; a run is about 85 suffixes long.
2. for a quarter of a run, the bytes that all its suffixes have in common;
3. the whole first ``length`` bytes.

After each pass groups of one are finished. Where all bytes that a run (or quarter) spans occur
elsewhere, all its suffixes are repeated and it is finished, too. Only what is equal in the digit
and different in the span goes on, one row for each different span.

Each pass is saved before the next begins, and the tables that it was made of are deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.hashing import FLAT_BYTES, FlatHash, by_bytes, mixed
from tagloom.llm.scratch import discard, release, saved

LENGTH = 200
GRAM = 32
QUARTERS = 4
PLACE = ("doc", "text_a", "start", "last", "anchor")
RUN = "doc long, text_a long, start int, last int, anchor int, digit long, inside long, span long, weight long"
#: Window starts of a document that are worked on at once.
PIECE = 1 << 20
_POSITION = np.uint64((1 << 22) - 1)


def text_keys() -> list[Column]:
    """128 bits that stand for a text; the repeats of a text depend on nothing else of its row."""
    return [F.xxhash64("text").alias("text_a"), F.xxhash64(F.lit(1), F.col("text")).alias("text_b")]


def _names() -> list[Column]:
    """What tells a text from all others: its document and a hash, for a doc_id may repeat."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc"), text_keys()[0]]


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring numbers, by their first."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset, bytes) of stretches that together fit a flat array; each start is in one stretch."""
    pack: list[tuple[int, int, bytes]] = []
    size = 0
    for row, text in enumerate(texts):
        for offset in range(0, len(text) - length + 1, PIECE):
            piece = text[offset : offset + PIECE + length - 1]
            if pack and size + len(piece) > FLAT_BYTES:
                yield pack
                pack, size = [], 0
            pack.append((row, offset, piece))
            size += len(piece)
    if pack:
        yield pack


def runs_of(length: int):
    """Per run of suffixes: its place, its anchor's hash and the hash of the bytes it spans."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "data"):
            texts = [x or b"" for x in batch.column("data").to_pylist()]
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "text_a")]
            for pack in _pieces(texts, length):
                flat = np.frombuffer(b"".join(p for _, _, p in pack), dtype=np.uint8)
                hashes = FlatHash(flat)
                grams = hashes.of_length(GRAM)
                marked = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
                anchors = (sliding_least(marked, length - GRAM + 1) & _POSITION).astype(np.int64)
                bounds = np.concatenate(([0], np.cumsum([len(p) for _, _, p in pack])))
                valid = np.zeros(len(flat), dtype=bool)
                for lo, hi in zip(bounds[:-1], bounds[1:]):
                    valid[lo : hi - length + 1] = True
                starts = np.flatnonzero(valid)
                anchors = anchors[starts]
                new = np.ones(len(starts), dtype=bool)
                new[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)
                first = starts[new]
                last = starts[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))]
                anchor = anchors[new]
                item = np.searchsorted(bounds, first, side="right") - 1
                rows = np.array([r for r, _, _ in pack])[item]
                shift = np.array([o for _, o, _ in pack])[item] - bounds[item]
                span = mixed(hashes.of(first, last + length) + (anchor - first).astype(np.uint64))
                yield pa.record_batch(
                    {
                        **{c: pa.array(k[rows]) for c, k in zip(("doc", "text_a"), keys)},
                        "start": pa.array((first + shift).astype(np.int32)),
                        "last": pa.array((last + shift).astype(np.int32)),
                        "anchor": pa.array((anchor + shift).astype(np.int32)),
                        "digit": pa.array(grams[anchor].view(np.int64)),
                        "inside": pa.array(np.zeros(len(first), dtype=np.int64)),
                        "span": pa.array(span.view(np.int64)),
                        "weight": pa.array(np.ones(len(first), dtype=np.int64)),
                    }
                )

    return work


def _contexts(batch: pa.RecordBatch) -> tuple[FlatHash, np.ndarray, dict[str, np.ndarray]]:
    """Hashes over the joined contexts of a batch, where each begins, and its number columns."""
    context = [x for x in batch.column("context").to_pylist()]
    begins = np.concatenate(([0], np.cumsum([len(x) for x in context])[:-1])).astype(np.int64)
    columns = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.schema.names if c != "context"}
    return FlatHash(np.frombuffer(b"".join(context), dtype=np.uint8)), begins, columns


def quarters_of(length: int):
    """Per quarter of a run: the hash of what its suffixes share and of what they span."""
    reach = length - GRAM
    width = reach // QUARTERS + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "context"):
            hashes, begins, c = _contexts(batch)
            for q in range(QUARTERS):
                near, far = q * width, min(q * width + width - 1, reach)
                low = np.maximum(c["start"], c["anchor"] - far)
                high = np.minimum(c["last"], c["anchor"] - near)
                some = low <= high
                low, high = low[some], high[some]
                anchor, at = c["anchor"][some], (begins - c["start"])[some]
                inside = mixed(hashes.of(at + anchor - near, at + anchor - far + length) + np.uint64(q))
                span = mixed(hashes.of(at + low, at + high + length) + (anchor - low).astype(np.uint64))
                yield pa.record_batch(
                    {
                        **{n: pa.array(c[n][some]) for n in ("doc", "text_a")},
                        "start": pa.array(low.astype(np.int32)),
                        "last": pa.array(high.astype(np.int32)),
                        "anchor": pa.array(anchor.astype(np.int32)),
                        "digit": pa.array(c["digit"][some]),
                        "inside": pa.array(inside.view(np.int64)),
                        "span": pa.array(span.view(np.int64)),
                        "weight": pa.array(c["weight"][some]),
                        "run": pa.array(c["start"][some].astype(np.int32)),
                    }
                )

    return work


def suffixes_of(length: int):
    """Per suffix: the hash of its first ``length`` bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "context"):
            hashes, begins, c = _contexts(batch)
            counts = c["last"] - c["start"] + 1
            row = np.repeat(np.arange(len(counts)), counts)
            start = c["start"][row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = (begins - c["run"])[row] + start
            yield pa.record_batch(
                {
                    **{n: pa.array(c[n][row]) for n in ("doc", "text_a")},
                    "start": pa.array(start.astype(np.int32)),
                    "digit": pa.array(c["digit"][row]),
                    "whole": pa.array(mixed(hashes.of(at, at + length) + (c["anchor"][row] - start).astype(np.uint64)).view(np.int64)),
                    "weight": pa.array(c["weight"][row]),
                }
            )

    return work


def _pass(items: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(items whose span occurs elsewhere, one item of each span that must go deeper)."""
    digit = ["digit", "inside"]
    spans = saved(
        items.groupBy(*digit, "span").agg(F.sum("weight").alias("weight"), F.min(F.struct(*PLACE, *_extra(items))).alias("at")),
        f"{name}-spans",
    )
    release(items.sparkSession)
    repeated = saved(items.join(spans.filter("weight > 1").select(*digit, "span"), [*digit, "span"]).select("doc", "text_a", "start", "last"), f"{name}-repeated")
    release(items.sparkSession)
    open_digits = saved(
        spans.groupBy(*digit)
        .agg(F.count("*").alias("n"), F.min("weight").alias("least"))
        .filter("n > 1 and least = 1")
        .select(*digit),
        f"{name}-open",
    )
    deeper = saved(spans.join(open_digits, digit).select("at.*", "digit", "weight"), f"{name}-deeper")
    discard(items, spans, open_digits)
    release(items.sparkSession)
    return repeated, deeper


def _extra(items: DataFrame) -> list[str]:
    return ["run"] if "run" in items.columns else []


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc, text_a, spans``: per document and text with repeats, its repeated runs as array of (start, last).

    A run stands for the strings that begin at its starts; it covers [start, last + length).
    """
    texts = docs.select(*_names(), F.col("text").cast("binary").alias("data"))
    texts = texts.filter(F.octet_length("data") >= length)
    runs = saved(texts.mapInArrow(runs_of(length), RUN), "runs")
    whole_runs, deeper = _pass(runs, "runs")
    keys = ["doc", "text_a"]
    wanted = saved(
        deeper.groupBy(keys).agg(F.collect_set(F.struct("start", "last", "anchor", "digit", "weight")).alias("runs")),
        "wanted",
    )
    discard(deeper)
    context = F.transform(
        "runs",
        lambda r: F.struct(
            r["start"].alias("start"), r["last"].alias("last"), r["anchor"].alias("anchor"), r["digit"].alias("digit"), r["weight"].alias("weight"),
            F.substring(F.col("data"), r["start"] + 1, r["last"] - r["start"] + length).alias("context"),
        ),
    )
    contexts = saved(
        texts.join(wanted, keys).select(*keys, F.explode(context).alias("r")).select(*keys, "r.*"),
        "contexts",
    )
    discard(wanted)
    release(docs.sparkSession)
    quarters = saved(contexts.mapInArrow(quarters_of(length), f"{RUN}, run int"), "quarters")
    whole_quarters, deeper = _pass(quarters, "quarters")
    base = contexts.select(*keys, F.col("start").alias("run"), "context").dropDuplicates([*keys, "run"])
    suffixes = saved(
        deeper.join(base, [*keys, "run"])
        .select(*keys, "start", "last", "anchor", "run", "digit", "weight", "context")
        .mapInArrow(suffixes_of(length), "doc long, text_a long, start int, digit long, whole long, weight long"),
        "suffixes",
    )
    discard(deeper, contexts)
    equal = saved(suffixes.groupBy("digit", "whole").agg(F.sum("weight").alias("n")).filter("n > 1").drop("n"), "equal")
    release(docs.sparkSession)
    single = saved(suffixes.join(equal, ["digit", "whole"]).select("doc", "text_a", "start", F.col("start").alias("last")), "single")
    discard(suffixes, equal)
    release(docs.sparkSession)
    found = whole_runs.unionByName(whole_quarters).unionByName(single)
    spans = saved(found.groupBy(keys).agg(F.collect_set(F.struct("start", "last")).alias("spans")), "spans")
    discard(whole_runs, whole_quarters, single)
    return spans


def merged(spans: list, length: int) -> list[tuple[int, int]]:
    """Maximal covered runs [lo, hi), in order."""
    out: list[list[int]] = []
    for lo, last in sorted((s["start"], s["last"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([lo, last + length])
    return [(lo, hi) for lo, hi in out]


def to_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the characters that they cover only in part."""
    out = []
    for lo, hi in spans:
        while lo < hi and data[lo] & 0xC0 == 0x80:
            lo += 1
        while lo < hi < len(data) and data[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            out.append((lo, hi))
    return out


def _cut(length: int, characters: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "data"):
            kept, removed, count = [], [], []
            for data, spans in zip(batch.column("data").to_pylist(), batch.column("spans").to_pylist()):
                data = data or b""
                cuts = merged(spans, length)
                if characters:
                    cuts = to_characters(data, cuts)
                edges = [0, *(x for cut in cuts for x in cut), len(data)]
                kept.append(b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
                removed.append(len(data) - len(kept[-1]))
                count.append(len(cuts))
            others = [i for i, n in enumerate(batch.schema.names) if n not in ("data", "spans")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in others), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(count, pa.int64())],
                names=[*(batch.schema.names[i] for i in others), "kept_bytes", "n_removed", "n_spans"],
            )

    return work


def without_repeats(docs: DataFrame, length: int = LENGTH, whole_characters: bool = False, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns of every row, n_bytes, ``kept_bytes`` (binary), n_removed and n_spans.

    Every byte goes that a string of ``length`` bytes covers which also starts elsewhere, in this
    text or another; strings are judged on the input. With ``whole_characters`` a character goes only
    if all its bytes do, so the rest is valid UTF-8. Null texts count as empty; texts shorter than
    ``length`` stay whole; repeated rows are copies of each other; an empty table stays empty. Columns
    outside ``carry`` are ignored, whatever their names.
    """
    spans = repeated_spans(docs, length)
    release(docs.sparkSession)
    rows = docs.select(*carry, *_names(), F.col("text").cast("binary").alias("data"))
    rows = rows.join(spans, ["doc", "text_a"], "left").select(*carry, F.coalesce(F.octet_length("data"), F.lit(0)).cast("long").alias("n_bytes"), "data", "spans")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("data", "spans")]
    return rows.mapInArrow(_cut(length, whole_characters), ", ".join([*kinds, "kept_bytes binary", "n_removed long", "n_spans long"]))
