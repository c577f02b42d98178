"""Hard negatives by exact integer scores, computed with Kronecker-packed products.

A component x becomes floor(scale * x). Candidates stay where they are, in blocks. A task biases the components
of several candidates so that none is negative and lays them side by side into separated fields of one wide
integer; one product with an anchor's component then multiplies them all, and the sum over the components
holds every candidate's score in a field of its own, which is cut out and freed of the bias. Fields are as wide
as the block's components and the anchors' need. Integers up to 2**53 are kept in doubles, where they are exact
and products of matrices are fast; wider fields go into Python's integers, which are exact at any width.

Anchors are the stated query set. They go out in rounds of a bounded number of bytes, and each round is one
pass over the blocks of all rows. A task keeps the best few candidates of each anchor of the round, so what is
shuffled is a few rows for each task and anchor, whatever a label's or a vector's share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.scratch import saved

#: Candidates of a block, anchors of a step, and bytes of the anchors of a round.
BLOCK, STEP, ROUND_BYTES = 4096, 256, 8 << 20
#: Integers up to this many bits are exact in doubles.
DOUBLE_BITS = 53
BLOCKS = "label long, ids binary, dimension int, width int, units binary"
NONE = np.iinfo(np.int64).min


def usable(rows: DataFrame, vector: str, scale: float) -> DataFrame:
    """``vec_id, label, units`` of the rows that take part; ``units`` are floor(scale * x) as doubles."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    found = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    found = found.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    # From 2**52 on a double is a whole number, and may be too large for a long.
    whole = lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)
    return found.select("vec_id", "label", F.transform("x", lambda x: whole(x * scale)).alias("units"))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """One row per list; a shorter vector has zeros for what it lacks."""
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat[offsets[0] : offsets[-1]]
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one label together, in the narrowest type that holds their components."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            ids, labels = (part.column(c).to_numpy() for c in ("vec_id", "label"))
            units = _matrix(part.column("units"))
            order = np.lexsort((ids, labels))
            cuts = np.flatnonzero(np.diff(labels[order])) + 1
            rows = []
            for own in np.split(order, cuts):
                block = units[own]
                most = np.abs(block).max(initial=0)
                width = next((w for w in (1, 2, 4) if most < 1 << (8 * w - 1)), 8)
                kind = f"<i{width}" if width < 8 else "<f8"
                rows.append((int(labels[own[0]]), ids[own].astype("<i8").tobytes(), block.shape[1], width, block.astype(kind).tobytes()))
            yield pa.record_batch([pa.array(c) for c in zip(*rows)], schema=pa.schema([("label", pa.int64()), ("ids", pa.binary()), ("dimension", pa.int32()), ("width", pa.int32()), ("units", pa.binary())]))


def kronecker_scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers, as (anchors, candidates)."""
    dimension = max(anchors.shape[1], candidates.shape[1])
    a, c = (np.pad(x, ((0, 0), (0, dimension - x.shape[1]))) for x in (anchors, candidates))
    if not a.size or not c.size:
        return np.zeros((len(a), len(c)), dtype=np.int64)
    bias_a, bias_c = (max(0, -int(x.min())) for x in (a, c))
    largest = dimension * (int(a.max()) + bias_a) * (int(c.max()) + bias_c)
    width = max(1, largest.bit_length())
    fields = DOUBLE_BITS // width
    whole = fields == 0
    if whole:  # wider than a double holds: Python's integers
        fields, a, c = 8, _integers(a), _integers(c)
    a, c = a + bias_a, c + bias_c
    words = -(-len(c) // fields)
    c = np.concatenate([c, np.zeros((words * fields - len(c), dimension), dtype=c.dtype)]) if words * fields > len(c) else c
    packed = sum(c[f * words : (f + 1) * words] * (1 << width * f) for f in range(fields))
    product = a @ packed.T
    parts = []
    for _ in range(fields):
        rest = product // (1 << width)
        parts.append(product - rest * (1 << width))
        product = rest
    scores = np.concatenate(parts, axis=1)[:, : len(candidates)]
    # (x + p)(y + q) = xy + q(x + p) + p(y + q) - pq, added up over the components.
    scores = scores - bias_c * a.sum(axis=1)[:, None] - bias_a * c.sum(axis=1)[None, : len(candidates)] + dimension * bias_a * bias_c
    return scores.astype(np.int64)


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], dtype=object)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], dtype="<i8")
            kind = f"<i{row['width']}" if row["width"] < 8 else "<f8"
            units = np.frombuffer(row["units"], dtype=kind).reshape(len(ids), row["dimension"]).astype(np.float64)
            yield row["label"], ids, units


class Best:
    """The first ``k`` candidates, by falling score and rising id, of each of ``n`` lists; an id counts once."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.scores = np.full((n, k), NONE, dtype=np.int64)
        self.ids = np.zeros((n, k), dtype=np.int64)

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` has a row for each of ``lists`` and a column for each of ``ids``, which rise; NONE takes no part."""
        if not scores.size:
            return
        # Only rows with something better than their last place change; of equal scores the first id is the least.
        top = scores.argmax(axis=1)
        most, last = scores[np.arange(len(top)), top], self.scores[lists, -1]
        rows = np.flatnonzero((most > last) | ((most == last) & (most > NONE) & (ids[top] < self.ids[lists, -1])))
        if not len(rows):
            return
        repeats = len(ids) > 1 and bool((ids[1:] == ids[:-1]).any())
        for r in rows:
            at, own = lists[r], scores[r]
            if not repeats and len(own) > 4 * self.k:
                limit = max(int(np.partition(own, len(own) - self.k)[len(own) - self.k]), int(self.scores[at, -1]), NONE + 1)
                chosen = np.flatnonzero(own >= limit)
            else:
                chosen = np.flatnonzero(own > NONE)
            held = self.scores[at] > NONE
            every = np.concatenate([self.scores[at][held], own[chosen]]), np.concatenate([self.ids[at][held], ids[chosen]])
            order = np.lexsort((every[1], -every[0]))
            _, first = np.unique(every[1][order], return_index=True)
            order = order[np.sort(first)][: self.k]
            self.scores[at], self.ids[at] = NONE, 0
            self.scores[at, : len(order)], self.ids[at, : len(order)] = every[0][order], every[1][order]


def _positives(anchors, k: int):
    """For each anchor of the round the first ``k`` other rows of its label among the task's."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_a, labels_a, units_a, _ = anchors.value
        best = Best(len(ids_a), k)
        for label, ids, units in _read(batches):
            same = np.flatnonzero(labels_a == label)
            for start in range(0, len(same), STEP):
                own = same[start : start + STEP]
                scores = kronecker_scores(units_a[own], units)
                scores[ids_a[own][:, None] == ids[None, :]] = NONE
                best.add(own, scores, ids)
        at, place = np.nonzero(best.scores > NONE)
        yield pa.record_batch({"anchor_id": pa.array(ids_a[at]), "other_id": pa.array(best.ids[at, place]), "score": pa.array(best.scores[at, place])})

    return work


def _negatives(anchors, k: int, low: int, high: int):
    """For each anchor of the round and positive the first ``k`` rows of other labels in the positive's window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_a, labels_a, units_a, positives = anchors.value
        pair_of = np.repeat(np.arange(len(ids_a)), [len(p) for p in positives])
        pair_ids = np.array([i for p in positives for i, _ in p], dtype=np.int64)
        pair_scores = [s for p in positives for _, s in p]
        least = np.array([-(-low * s // 100) for s in pair_scores], dtype=np.int64)
        most = np.array([high * s // 100 for s in pair_scores], dtype=np.int64)
        first = np.concatenate(([0], np.cumsum([len(p) for p in positives]))).astype(np.int64)
        best = Best(len(pair_of), k)
        for label, ids, units in _read(batches):
            others = np.flatnonzero(labels_a != label)
            for start in range(0, len(others), STEP):
                own = others[start : start + STEP]
                scores = kronecker_scores(units_a[own], units)
                for place in range(int((first[own + 1] - first[own]).max(initial=0))):
                    rows = np.flatnonzero(first[own] + place < first[own + 1])
                    lists = first[own[rows]] + place
                    inside = scores[rows]
                    inside = np.where((inside >= least[lists][:, None]) & (inside <= most[lists][:, None]), inside, NONE)
                    best.add(lists, inside, ids)
        at, place = np.nonzero(best.scores > NONE)
        yield pa.record_batch(
            {
                "anchor_id": pa.array(ids_a[pair_of[at]]),
                "positive_id": pa.array(pair_ids[at]),
                "negative_id": pa.array(best.ids[at, place]),
                "positive_score": pa.array(np.array(pair_scores, dtype=np.int64)[at]),
                "negative_score": pa.array(best.scores[at, place]),
            }
        )

    return work


def _rounds(anchors: DataFrame) -> int:
    """Rounds so that one has about ``ROUND_BYTES`` of anchors at most."""
    size = anchors.agg(F.sum(8 * F.size("units") + 64)).first()[0] or 0
    return max(1, -(-size // ROUND_BYTES))


def _sent(anchors: DataFrame, positives: DataFrame | None):
    """A round's anchors as arrays, broadcast."""
    rows = anchors.collect() if positives is None else anchors.join(positives, F.col("vec_id") == F.col("anchor_id")).collect()
    widest = max((len(r["units"]) for r in rows), default=0)
    units = np.zeros((len(rows), widest))
    for at, r in enumerate(rows):
        units[at, : len(r["units"])] = r["units"]
    found = [] if positives is None else [[(p["other_id"], p["score"]) for p in r["positives"]] for r in rows]
    value = np.array([r["vec_id"] for r in rows], dtype=np.int64), np.array([r["label"] for r in rows], dtype=np.int64), units, found
    return anchors.sparkSession.sparkContext.broadcast(value)


def _first(found: DataFrame, lists: list[str], score: str, id_: str, k: int) -> DataFrame:
    """The first ``k`` rows of each list with their ``rank``, an id once."""
    once = found.groupBy(*lists, id_).agg(F.max(score).alias(score))
    order = Window.partitionBy(*lists).orderBy(F.desc(score), id_)
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, vector: str = "embedding", scale: float = 256.0, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id, label`` and ``vector``; ``is_anchor`` is a condition on ``vec_id``. An anchor's
    positives are its first rows of the same label, its negatives for each positive the first rows of other
    labels with low * positive_score <= 100 * score <= high * positive_score. Higher scores come first, ties by
    smaller vec_id.

    Rows with a null vec_id or label, a null vector or a null or non-finite component take no part. A vector that
    is shorter than another has zeros for what it lacks; an empty one scores 0. Of rows with one vec_id the least
    (label, then vector) is the anchor; they are not each other's partners, and an id that several rows hold is
    an anchor's partner once, with its best score. Scores must fit 64 bits. An empty table, or one without
    anchors, gives an empty result; further columns are ignored.
    """
    cleaned = usable(rows, vector, scale)
    blocks = saved(cleaned.mapInArrow(_blocks, BLOCKS), "vectors")
    chosen = cleaned.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "units")).alias("row"))
    anchors = saved(chosen.select("vec_id", "row.label", "row.units"), "anchors")
    rounds = _rounds(anchors)
    parts = []
    for number in range(rounds):
        own = anchors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == number)
        sent = _sent(own, None)
        near = blocks.mapInArrow(_positives(sent, positives), "anchor_id long, other_id long, score long")
        best = _first(near, ["anchor_id"], "score", "other_id", positives)
        listed = saved(best.groupBy("anchor_id").agg(F.collect_list(F.struct("other_id", "score")).alias("positives")), "positives")
        sent.destroy()
        sent = _sent(own, listed)
        found = blocks.mapInArrow(_negatives(sent, negatives, low, high), "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
        parts.append(saved(_first(found, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives), "negatives"))
        sent.destroy()
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
