"""MinHash near-dedup with b-bit signatures.

Documents with equal shingle sets form one class. Each class has 128 minima; 32 bands of four
of them give candidate buckets, and the low four bits of each minimum, packed into eight longs,
estimate the similarity of a candidate pair, corrected for chance collisions. Pairs that can reach
the threshold are confirmed on their full shingle sets.

A bucket is never expanded into all its pairs. Its members meet one leader first; what the links
join is one component. Where a bucket then still holds several components, the members that
resemble the root of its largest component become that root's family. The others, strangers, meet
the members of their buckets where they share one of their rarest shingles: a set of n has at least
need = percent * n / 100 shingles in common with a linked one, so both hold one of all but the need - 1
most frequent of their shared ones. A passage that many documents share brings nobody together.

In a family a set is its difference D from the shingles that most members have. Two sets are linked
exactly if E(a) + E(b) <= 2 * (100 + percent) * |D(a) & D(b)|, with E = (100 + percent) * |D| -
(100 - percent) * n_shingles. Pairs without a common difference therefore need E(a) + E(b) <= 0, and
then both are linked with the member of least E; the other pairs share a difference and are found
by a join on the rarest differences of each. So a group of near copies costs its differences, not its pairs.
Two classes at the threshold share no band with a probability under 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.hashing import by_bytes, mixed, packs, word_bounds, word_hashes
from tagloom.llm.links import anew, components
from tagloom.llm.scratch import discard, release, saved

BANDS, ROWS, BITS = 32, 4, 4
MINIMA = BANDS * ROWS
_random = np.random.default_rng(8)
FACTORS = _random.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
BAND_FACTORS = _random.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Five standard errors of an estimate from 128 minima at similarity 0.8.
SLACK = 0.18
#: Estimated similarity to a root from which a set is compared by its differences; both ways lose nothing.
FAMILY = 0.4

SETS = "node long, members array<long>"
SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles of ``width`` words."""
    for i, j in packs(texts):
        flat = np.frombuffer(b"\n".join(texts[i:j]).lower(), dtype=np.uint8)
        starts, ends = word_bounds(flat)
        words = word_hashes(flat, starts, ends)
        shingles = words[: max(0, len(words) - width + 1)].copy()
        for k in range(1, width):
            shingles = mixed(shingles * np.uint64(3) + words[k : k + len(shingles)])
        sizes = np.fromiter((len(x) + 1 for x in texts[i:j]), dtype=np.int64, count=j - i)
        bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo >= width:
                yield np.unique(shingles[lo : hi - width + 1])
            elif hi > lo:  # shorter than a shingle: the whole sequence, told apart by its length
                one = words[lo : lo + 1]
                for k in range(lo + 1, hi):
                    one = mixed(one * np.uint64(3) + words[k : k + 1])
                yield mixed(one + np.uint64(hi - lo))
            else:
                yield words[:0]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]


def _longs(x: np.ndarray, per_row: int) -> pa.ListArray:
    flat = np.ascontiguousarray(x).view(np.int64).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, per_row, dtype=np.int32)), pa.array(flat))


def signatures(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            texts = _texts(batch)
            done = 0
            for i, j in packs(texts):
                sets = list(shingle_sets(texts[i:j], width))
                yield _signed(batch.column("doc_id").slice(done, j - i), sets)
                done += j - i

    return work


def _signed(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    full = np.flatnonzero(sizes)
    minima = np.zeros((len(sets), MINIMA), dtype=np.uint64)
    sums = np.zeros((len(sets), 2), dtype=np.uint64)
    if len(full):
        flat = np.concatenate([sets[k] for k in full])
        offsets = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
        turned = np.empty_like(flat)
        for p in range(MINIMA):
            np.multiply(flat, FACTORS[p], out=turned)
            turned += SHIFTS[p]
            minima[full, p] = np.minimum.reduceat(turned, offsets)
        sums[full, 0] = np.add.reduceat(flat, offsets)
        sums[full, 1] = np.add.reduceat(mixed(flat + np.uint64(1)), offsets)
    minima >>= np.uint64(32)
    bands = (minima.reshape(len(sets), BANDS, ROWS) * BAND_FACTORS).sum(axis=2, dtype=np.uint64)
    bands = mixed(mixed(bands) + np.arange(BANDS, dtype=np.uint64))
    planes = [np.packbits(((minima >> np.uint64(b)) & np.uint64(1)).astype(bool), axis=1) for b in range(BITS)]
    sketch = np.concatenate(planes, axis=1)
    return pa.record_batch(
        {
            "doc_id": ids.cast(pa.int64()),
            "n_shingles": pa.array(sizes),
            "set_a": pa.array(sums[:, 0].view(np.int64)),
            "set_b": pa.array(sums[:, 1].view(np.int64)),
            "bands": _longs(bands, BANDS),
            "sketch": _longs(sketch, MINIMA * BITS // 64),
        }
    )


def full_sets(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            texts = _texts(batch)
            for i, j in packs(texts):
                sets = list(shingle_sets(texts[i:j], width))
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.record_batch(
                    {
                        "node": batch.column("doc_id").slice(i, j - i).cast(pa.int64()),
                        "members": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    }
                )

    return work


def estimate(left: Column, right: Column) -> Column:
    """Similarity from two packed sketches: equal low bits beyond those that chance gives."""
    words = MINIMA // 64
    differ = F.lit(0)
    for w in range(words):
        bits = None
        for plane in range(BITS):
            at = plane * words + w
            one = left.getItem(at).bitwiseXOR(right.getItem(at))
            bits = one if bits is None else bits.bitwiseOR(one)
        differ = differ + F.bit_count(bits)
    chance = 1 / 2**BITS
    return (1 - differ / F.lit(MINIMA) - chance) / (1 - chance)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``.

    Documents are linked at 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest doc_id that links reach, kept tells whether it is the document's own.
    A null, empty or blank text has no shingles and no links. Equal texts are linked. A repeated
    doc_id counts as one document with several texts. An empty table gives an empty result;
    further columns are ignored. Rows without a doc_id are returned unlinked and kept.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = saved(texts.mapInArrow(signatures(width), SIGNATURE), "signatures")
    linked = signed.filter("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "set_a", "set_b"]
    # Bands and sketch follow from the set, so those of any member are the class's.
    nodes = saved(linked.groupBy(same).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "nodes")
    members = saved(linked.select("doc_id", *same).join(nodes.select("node", *same), same).select("doc_id", "node"), "classes")
    met = nodes.select("node", F.explode("bands").alias("bucket"))
    leaders = met.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last").drop("last")
    shared = saved(met.join(anew(leaders, "bucket"), "bucket"), "shared")
    # The sets of all that share a bucket are made once, so texts are dealt out once.
    wanted = shared.select(F.col("node").alias("doc_id")).distinct()
    sets = saved(texts.join(wanted, "doc_id", "left_semi").mapInArrow(full_sets(width), SETS), "sets")
    release(docs.sparkSession)
    pairs = shared.filter("node <> leader").select("node", F.col("leader").alias("other")).distinct()
    sketches = nodes.select("node", "n_shingles", "sketch")
    tried = saved(_possible(pairs, sketches, percent), "pairs")
    links = saved(_confirmed(tried, sets, percent), "links")
    release(docs.sparkSession)
    # A document that holds several texts (a repeated doc_id) joins their classes.
    own = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b")
    links = links.unionByName(own.select(F.col("b").alias("node"), F.col("a").alias("other")))
    labels = components(links)
    more = saved(_rest(shared.select("node", "bucket"), nodes, labels, sets, percent), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    found = (
        members.join(labels, "node", "left")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("label", "node")).alias("component_id"))
    )
    told = signed.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    told = saved(told.withColumn("component_id", F.coalesce("component_id", "doc_id")), "told")
    discard(signed, members, nodes, shared, sets)
    release(docs.sparkSession)
    return told.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and estimate allow the threshold."""
    here = sketches.select("node", F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a"))
    there = sketches.select(F.col("node").alias("other"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b"))
    return pairs.join(here, "node").join(there, "other").filter(_near(percent)).select("node", "other").distinct()


def _near(percent: int) -> Column:
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sizes & (estimate(F.col("s_a"), F.col("s_b")) >= percent / 100 - SLACK)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach the threshold on their full shingle sets."""
    both = (
        pairs.join(sets.withColumnRenamed("members", "a"), "node")
        .join(sets.select(F.col("node").alias("other"), F.col("members").alias("b")), "other")
        .withColumn("common", F.size(F.array_intersect("a", "b")))
    )
    union = F.size("a") + F.size("b") - F.col("common")
    return both.filter(100 * F.col("common") >= percent * union).select("node", "other").distinct()


def _mixed(placed: DataFrame) -> DataFrame:
    """``bucket, main``: the buckets of ``node, bucket, label`` that hold several components, and the largest of them."""
    parts = placed.groupBy("bucket", "label").agg(F.count("*").alias("n")).groupBy("bucket")
    tops = parts.agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("parts"))
    return tops.filter("parts > 1").select("bucket", F.col("top.label").alias("main"))


def _rest(shared: DataFrame, nodes: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that share a bucket of ``shared``: ``node, bucket``."""
    placed = saved(shared.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "placed")
    met = saved(placed.join(anew(_mixed(placed), "bucket"), "bucket"), "open")
    discard(placed)
    sketches = nodes.select("node", "n_shingles", "sketch")
    roots = met.select("main").distinct().join(sketches.select(F.col("node").alias("main"), F.col("sketch").alias("root")), "main")
    seen = met.select("node", "label", "main").distinct().join(sketches.select("node", "sketch"), "node").join(roots, "main")
    seen = saved(seen.select("node", "label", "main", (estimate(F.col("sketch"), F.col("root")) >= FAMILY).alias("near")), "near")
    strangers = saved(_possible(_strangers(met, seen, sets, percent), sketches, percent), "pairs")
    family = _family_links(seen.filter("near").drop("near"), sets, percent)
    return _confirmed(strangers, sets, percent).unionByName(family).distinct()


def _strangers(met: DataFrame, seen: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a rare shingle, one of them outside the family of a bucket's root.

    Only shingles of several sets can be common, so a set with fewer than ``need`` of those has no link here.
    """
    far = seen.filter("not near").select("main", "node").distinct()
    buckets = met.join(far, ["main", "node"], "left_semi").select("bucket").distinct()
    inside = met.join(buckets, "bucket", "left_semi").select("node", "label").distinct()
    flags = saved(inside.join(far.select("node", F.lit(True).alias("far")).distinct(), "node", "left").withColumn("far", F.coalesce("far", F.lit(False))), "strangers")
    sets = sets.join(flags, "node", "left_semi")
    shingles = saved(sets.select("node", F.xxhash64("members").alias("set"), F.size("members").alias("n"), F.explode("members").alias("x")), "shingles")
    counts = shingles.groupBy("x").agg(F.count("*").alias("c")).filter("c > 1")
    parts = shingles.join(counts, "x")
    need = F.ceil(percent * F.col("n") / 100)
    own = Window.partitionBy("node", "set", "n")  # a repeated doc_id has several sets
    rank, in_common = F.row_number().over(own.orderBy("c", "x")), F.count("*").over(own)
    ranked = parts.withColumns({"left": in_common - rank, "in_common": in_common})
    rare = ranked.filter((F.col("in_common") >= need) & (F.col("left") + 1 >= need))
    rare = saved(rare.join(flags, "node").select("x", "node", "n", "left", "label", "far"), "rare")
    discard(shingles, flags)
    there = rare.select(
        "x", F.col("node").alias("other"), F.col("n").alias("n_b"), F.col("left").alias("left_b"), F.col("label").alias("label_b"), F.col("far").alias("far_b")
    )
    # From the rarest shingle of a linked pair on, both sets hold all that they have in common.
    enough = (100 + percent) * (F.least("left", "left_b") + 1) >= percent * (F.col("n") + F.col("n_b"))
    sizes = (100 * F.col("n") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n"))
    new = (F.col("label") != F.col("label_b")) & (~F.col("far_b") | (F.col("node") < F.col("other")))
    return rare.filter("far").join(there, "x").filter(new & sizes & enough).select("node", "other").distinct()


def _family_links(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components inside the families ``node, label, main``."""
    several = near.groupBy("main").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a < b").select("main")
    placed = saved(near.join(several, "main"), "families")
    roots = placed.select("main").distinct().join(sets.withColumnRenamed("node", "main"), "main").groupBy("main").agg(F.min("members").alias("root"))
    apart = saved(
        placed.join(sets, "node").join(roots, "main").select("node", "label", "main", F.size("members").cast("long").alias("n"), _difference("members", "root").alias("apart")),
        "apart",
    )
    sizes = apart.groupBy("main").agg(F.count("*").alias("members"))
    shared = apart.select("main", F.explode("apart").alias("x")).groupBy("main", "x").agg(F.count("*").alias("c"))
    most = shared.join(sizes, "main").filter("2 * c > members").groupBy("main").agg(F.sort_array(F.collect_list("x")).alias("most"))
    delta = _difference("apart", F.coalesce("most", F.array().cast("array<long>")))
    own = apart.join(most, "main", "left").select("node", "label", "main", "n", delta.alias("delta"))
    excess = (100 + percent) * F.size("delta") - (100 - percent) * F.col("n")
    own = saved(own.select("node", "label", "main", "delta", excess.alias("excess")), "deltas")
    discard(apart, placed)
    release(near.sparkSession)
    return _by_centre(own, percent).unionByName(_by_difference(own, percent))


def _difference(a: str | Column, b: str | Column) -> Column:
    return F.concat(F.array_except(a, b), F.array_except(b, a))


def _linked(percent: int) -> Column:
    """Whether the sets with ``delta, excess`` and ``delta_b, excess_b`` reach the threshold."""
    return F.col("excess") + F.col("excess_b") <= 2 * (100 + percent) * F.size(F.array_intersect("delta", "delta_b"))


def _centres(own: DataFrame) -> DataFrame:
    least = own.groupBy("main").agg(F.min(F.struct("excess", "node")).alias("least")).select("main", F.col("least.excess").alias("excess"), F.col("least.node").alias("node"))
    return own.join(least, ["main", "excess", "node"]).select(
        "main", F.col("node").alias("other"), F.col("label").alias("label_b"), F.col("excess").alias("excess_b"), F.col("delta").alias("delta_b")
    )


def _by_centre(own: DataFrame, percent: int) -> DataFrame:
    """Links with the member of least excess of each family."""
    return own.join(_centres(own), "main").filter((F.col("label") != F.col("label_b")) & _linked(percent)).select("node", "other").distinct()


def _by_difference(own: DataFrame, percent: int) -> DataFrame:
    """Links of members that share differences and need to, for their excess is above zero together.

    A member needs ``need`` shared differences at least, so two linked ones meet in the rarest of them
    but for ``need - 1``.
    """
    steps = F.lit(2 * (100 + percent))
    least = own.groupBy("main").agg(F.min("excess").alias("least"))
    need = F.greatest(F.ceil((F.col("excess") + F.col("least")) / steps), F.lit(1))
    set_ = ["main", "node", "set"]
    parts = own.join(least, "main").select("main", "node", F.xxhash64("delta").alias("set"), "label", "excess", need.alias("need"), F.explode("delta").alias("x"))
    counts = parts.groupBy("main", "x").agg(F.count("*").alias("c")).filter("c > 1")
    order = Window.partitionBy(*set_).orderBy("c", "x")
    parts = parts.join(counts, ["main", "x"]).withColumn("rank", F.row_number().over(order))
    parts = parts.withColumn("shared", F.count("*").over(Window.partitionBy(*set_))).filter("rank <= shared - need + 1")
    parts = parts.withColumn("left", F.col("shared") - F.col("rank"))
    parts = saved(parts.select("main", "x", "node", "label", "excess", "left"), "differences")
    pairs = _sharing(parts, percent)
    there = own.select("main", F.col("node").alias("other"), F.col("excess").alias("excess_b"), F.col("delta").alias("delta_b"))
    return pairs.join(own.select("main", "node", "excess", "delta"), ["main", "node"]).join(there, ["main", "other"]).filter(_linked(percent)).select("node", "other").distinct()


def _sharing(parts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``main, node, other`` that meet in a difference ``x`` of ``parts`` and can have enough in common.

    ``left`` counts the differences that a set has after this one. From the rarest difference of a linked pair
    on, both hold all that they have in common.
    """
    other = parts.select("main", "x", F.col("node").alias("other"), F.col("label").alias("label_b"), F.col("excess").alias("excess_b"), F.col("left").alias("left_b"))
    both = F.col("excess") + F.col("excess_b")
    enough = both <= 2 * (100 + percent) * (F.least("left", "left_b") + 1)
    new = (F.col("node") < F.col("other")) & (F.col("label") != F.col("label_b")) & (both > 0) & enough
    return parts.join(other, ["main", "x"]).filter(new).select("main", "node", "other").distinct()
