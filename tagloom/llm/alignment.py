"""Alignment of two tokenizers' tokens over the same bytes, by merge-path partitioning.

Both tokenizers' tokens of " " + text end at rising byte offsets. Merging the two lists of ends gives everything:
each distinct end closes one link, the pair of tokens that overlap just before it, and each common end closes a
group. A merge path cuts the merge into independent pieces of equal work: binary searches along the diagonals of
the (A, B) grid find how many ends of either list lie before each cut. A piece emits its overlaps; a group that
is open at a cut, or a common end whose two tokens lie on both sides of it, is stitched from the neighbours.

Where a blank or line feed follows a character that is no white space, no token of either tokenizer crosses, so
a text of any length is encoded and worked on a stretch at a time.

Ids of a pair that are linked are counted over the corpus. Documents keep their distinct pairs, packed. Pairs with
more than a 2**-20 share of all links are at most 2**20; their counts are broadcast, whatever the corpus. The
occurrences of the others, which no key dominates, are joined by shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import discard, saved

#: Characters that are encoded in one go, and that are worked on at a time.
STRETCH, WORKED = 1 << 14, 1 << 19
#: Ends of both lists that one piece of a merge has.
PIECE = 1 << 16
#: Pairs broadcast at most; distinct pairs a task holds while it counts.
FREQUENT, HELD = 1 << 20, 1 << 21
#: All that any tokenizer may take for white space, and what stands for a blank in pieces.
_BLANK = r"\s\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿▁"
_BREAK = re.compile(f"(?<=[^{_BLANK}])(?=[ \n])")

# Fixed value: how byte-level tokenizers files with ``use_regex`` cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, counts binary"


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable bytes stand for themselves, others follow from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(others)}}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the ids of units."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as file:
            described = json.load(file)
        alphabet = byte_alphabet()
        ids = {i: bytes(alphabet[c] for c in entry) for entry, i in described["model"]["vocab"].items()}
        ids.update({t["id"]: t["content"].encode() for t in described["added_tokens"]})
        self.ranked = self._ranked(described, alphabet)
        self.bytes_a = [ids.get(i, b"") for i in range(max(ids) + 1)]
        self.b = sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any(re.search("[^▁]▁|[^\n]\n|\n[^\n]", p) for i, p in enumerate(pieces) if not sp.is_byte(i)):
            raise ValueError("pieces of this model cross a word's start")
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.bytes_a, self.bytes_b))

    @staticmethod
    def _ranked(described: dict, alphabet: dict[str, int]):
        """The same vocabulary for tiktoken, several times as fast, where merges are in the order of their ids; else None."""
        model, cut = described["model"], described["pre_tokenizer"] or {}
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and described["normalizer"] is None
        alike = not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        ordered = [model["vocab"][m] for m in merges] == list(range(256, 256 + len(merges))) and len(model["vocab"]) == 256 + len(merges)
        if not (plain and alike and ordered):
            return None
        import tiktoken

        ranks = {bytes(alphabet[c] for c in entry): i for entry, i in model["vocab"].items()}
        return tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def _ids_a(self, parts: list[str]) -> list[list[int]]:
        if self.ranked is not None:
            return [self.ranked.encode_ordinary(p) for p in parts]
        return [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]

    def encoded(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of stretches that begin with a blank or line feed; None where the joined bytes of one side aren't the stretch's."""
        in_a = self._ids_a(parts)
        # The library puts a blank in front: a stretch's own, or one that a line feed keeps apart. A blank alone needs the second way.
        own = [len(p) > 1 and p[0] == " " for p in parts]
        in_b = self.b.encode([p[1:] if o else "\n" + p for p, o in zip(parts, own)], num_threads=1)
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for part, o, ids_a, b in zip(parts, own, in_a, in_b):
            ids_b, data = b if o else b[2:], part.encode()
            same = b"".join(map(self.bytes_a.__getitem__, ids_a)) == data == b"".join(map(self.bytes_b.__getitem__, ids_b))
            out.append((np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)) if same else None)
        return out


def stretches(text: str) -> Iterator[str]:
    """The text in parts of ``STRETCH`` characters or a word more, between which no token reaches."""
    start = 0
    while start < len(text):
        cut = _BREAK.search(text, start + STRETCH) if len(text) - start > STRETCH else None
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def merge_path(ends_a: np.ndarray, ends_b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """For every ``piece`` steps of the merge, how many ends of A and B come before; A's first of equal ends."""
    steps = np.append(np.arange(0, len(ends_a) + len(ends_b), piece), len(ends_a) + len(ends_b))
    low, high = np.maximum(0, steps - len(ends_b)), np.minimum(steps, len(ends_a))
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        # More of A belongs before the cut while A's next end is no later than B's last before it.
        more = np.zeros(len(steps), dtype=bool)
        more[open_] = ends_a[middle[open_]] <= ends_b[steps[open_] - middle[open_] - 1]
        low, high = np.where(open_ & more, middle + 1, low), np.where(open_ & ~more, middle, high)
    return low, steps - low


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, a: tuple[int, int], b: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one piece, ends ``a`` and ``b`` of the two lists: its links as places in A and B, and the common ends it closes."""
    own_a, own_b = ends_a[a[0] : a[1]], ends_b[b[0] : b[1]]
    place_a, place_b = np.arange(*a), np.arange(*b)
    # The other list's token that is open at an end; the next piece's first one, if this piece has none left.
    beside_a = b[0] + np.searchsorted(own_b, own_a, side="left")
    beside_b = a[0] + np.searchsorted(own_a, own_b, side="right")
    # A common end is A's to report; its token of B may be the first of the next piece, its token of A the last of the piece before.
    common = ends_b[np.minimum(beside_a, len(ends_b) - 1)] == own_a
    single = (beside_b == 0) | (ends_a[np.maximum(beside_b - 1, 0)] != own_b)
    return np.concatenate([place_a, beside_b[single]]), np.concatenate([beside_a, place_b[single]]), place_a[common], beside_a[common]


def aligned(ends_a: np.ndarray, ends_b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (place in A, place in B) and, per group, how many tokens of A and B end with it or before it."""
    cuts_a, cuts_b = merge_path(ends_a, ends_b, piece)
    parts = [overlaps(ends_a, ends_b, a, b) for a, b in zip(zip(cuts_a[:-1], cuts_a[1:]), zip(cuts_b[:-1], cuts_b[1:]))]
    link_a, link_b, last_a, last_b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (zip(*parts) if parts else [()] * 4))
    return link_a, link_b, last_a + 1, last_b + 1


class Digits:
    """Decimal ids with a separator after each, as one run of bytes."""

    def __init__(self, largest: int) -> None:
        self.width = len(str(largest))
        text = np.char.zfill(np.arange(largest + 1).astype(str), self.width).astype(f"S{self.width}")
        self.digits = np.zeros((largest + 1, self.width + 1), dtype=np.uint8)
        self.digits[:, :-1] = np.frombuffer(text.tobytes(), dtype=np.uint8).reshape(-1, self.width)
        self.sizes = np.maximum(1, np.ceil(np.log10(np.arange(largest + 1) + 1)).astype(np.int64))
        self.shown = np.arange(self.width + 1) >= self.width - self.sizes[:, None]

    def joined(self, ids: np.ndarray, separators: np.ndarray) -> np.ndarray:
        out = self.digits[ids]
        out[:, -1] = separators
        return out[self.shown[ids]]


def group_order(groups_a: np.ndarray, groups_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each token of A and B stands when the groups are written one after another, A's tokens first."""
    sizes_a, sizes_b = np.diff(groups_a, prepend=0), np.diff(groups_b, prepend=0)
    at_a = np.arange(groups_a[-1]) + np.repeat(groups_b - sizes_b, sizes_a)
    at_b = np.arange(groups_b[-1]) + np.repeat(groups_a, sizes_b)
    return at_a, at_b


class Report:
    """What is known of one document so far."""

    def __init__(self, row: int, doc_id: int | None) -> None:
        self.row, self.doc_id = row, doc_id
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.differs = False  # a stretch's joined bytes differ: the document has no tokens
        self.hash = hashlib.sha256()
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def values(self) -> tuple:
        if self.differs:
            return Report(self.row, self.doc_id).values()
        pairs, counts = summed(self.pairs)
        shown = self.hash.hexdigest() if self.n_a else ""
        return self.row, self.doc_id, self.n_a, self.n_b, self.n_groups, self.n_links, shown, packed(np.diff(pairs, prepend=0)), packed(counts)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted pairs with their counts added up."""
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pairs, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[first], np.add.reduceat(counts, first) if len(first) else counts


def packed(numbers: np.ndarray) -> bytes:
    """Numbers by byte planes, in the fewest planes that hold them all; planes of zeros compress to nothing."""
    planes = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    return bytes([planes]) + numbers.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = data[0]
    raw = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(planes, -1)
    out = np.zeros((raw.shape[1], 8), dtype=np.uint8)
    out[:, :planes] = raw.T
    return out.view("<i8").reshape(-1)


def _work_on(pair: Pair, digits: Digits, parts: list[tuple[Report, str]]) -> None:
    """Aligns stretches of several documents in one merge; all of them end at common ends."""
    found: list[tuple[Report, np.ndarray, np.ndarray]] = []
    for (report, _), ids in zip(parts, pair.encoded([text for _, text in parts])):
        report.differs |= ids is None
        if ids is not None:
            found.append((report, *ids))
    if not found:
        return
    ids_a, ids_b = np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found])
    ends_a, ends_b = np.cumsum(pair.sizes_a[ids_a]), np.cumsum(pair.sizes_b[ids_b])
    link_a, link_b, groups_a, groups_b = aligned(ends_a, ends_b)
    bounds_a = np.cumsum([len(f[1]) for f in found])
    size = len(pair.bytes_a) * len(pair.bytes_b)
    keys = np.searchsorted(bounds_a, link_a, side="right") * size + ids_a[link_a] * len(pair.bytes_b) + ids_b[link_b]
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(first, append=len(keys))
    owner, keys = keys[first] // size, keys[first] % size
    held = np.searchsorted(owner, np.arange(len(found) + 1))

    at_a, at_b = group_order(groups_a, groups_b)
    ids = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    ids[at_a], ids[at_b] = ids_a, ids_b
    separators = np.full(len(ids), ord(","), dtype=np.uint8)
    separators[at_a[groups_a - 1]], separators[at_b[groups_b - 1]] = ord("|"), ord(";")
    text = digits.joined(ids, separators)
    written = np.cumsum(digits.sizes[ids] + 1)

    before = np.searchsorted(groups_a, bounds_a, side="right")  # groups up to the end of each document
    token = text_at = group = 0
    for n, (report, own_a, own_b) in enumerate(found):
        token += len(own_a) + len(own_b)
        end = int(written[token - 1])
        if report.n_a:
            report.hash.update(b";")
        report.hash.update(memoryview(text[text_at : end - 1]))
        lo, hi = held[n], held[n + 1]
        report.n_a += len(own_a)
        report.n_b += len(own_b)
        report.n_groups += int(before[n]) - group
        report.n_links += int(counts[lo:hi].sum())
        report.pairs.append((keys[lo:hi], counts[lo:hi]))
        if len(report.pairs) > 1:
            report.pairs = [summed(report.pairs)]
        text_at, group = end, int(before[n])


_loaded: dict[tuple[str, str], Pair] = {}


def _pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Pair(path_a, path_b)
    return _loaded[path_a, path_b]


def _rows(reports: list[Report]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]
    columns = zip(*[r.values() for r in reports])
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in ALIGNED.split(", ")])


def _align(path_a: str, path_b: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        digits = Digits(max(len(pair.bytes_a), len(pair.bytes_b)))
        for batch in batches:
            rows, ids, texts = (batch.column(c) for c in ("row", "doc_id", "text"))
            reports: list[Report] = []
            parts: list[tuple[Report, str]] = []
            size = 0
            for at in range(batch.num_rows):
                reports.append(Report(rows[at].as_py(), ids[at].as_py()))
                text = texts[at].as_py()
                for part in stretches(" " + text) if text else ():
                    parts.append((reports[-1], part))
                    size += len(part)
                    if size >= WORKED:
                        _work_on(pair, digits, parts)
                        parts, size = [], 0
                if size == 0 or at + 1 == batch.num_rows:
                    _work_on(pair, digits, parts)
                    parts, size = [], 0
                    yield _rows(reports)
                    reports = []

    return work


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's distinct pairs with their links, in parts."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    for batch in batches:
        for at in range(batch.num_rows):
            held.append((np.cumsum(unpacked(batch.column("pairs")[at].as_py())), unpacked(batch.column("counts")[at].as_py())))
            waiting += len(held[-1][0])
            if waiting > HELD:
                held = [summed(held)]
                waiting = 0
                if len(held[0][0]) > HELD:
                    yield pa.record_batch([pa.array(x) for x in held[0]], names=["pair", "n"])
                    held = []
    pairs, counts = summed(held)
    yield pa.record_batch([pa.array(pairs), pa.array(counts)], names=["pair", "n"])


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows [i, j) of a batch with their pairs, counts and row numbers, a bounded number of pairs at a time."""
    start, parts, sizes, total = 0, [], [], 0
    for at in range(batch.num_rows):
        parts.append((np.cumsum(unpacked(batch.column("pairs")[at].as_py())), unpacked(batch.column("counts")[at].as_py())))
        sizes.append(len(parts[-1][0]))
        total += sizes[-1]
        if total > HELD // 4 or at + 1 == batch.num_rows:
            yield start, at + 1, *(np.concatenate(x) for x in zip(*parts)), np.repeat(np.arange(len(sizes)), sizes)
            start, parts, sizes, total = at + 1, [], [], 0


def _looked_up(frequent, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known = frequent.value[0]
    at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
    return at, known[at] == pairs if len(known) else np.zeros(len(pairs), dtype=bool)


def _score(frequent):
    """Rows with the sums over their frequent pairs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, pairs, counts, owner in _stretches(batch):
                at, hit = _looked_up(frequent, pairs)
                at, counts, owner = at[hit], counts[hit], owner[hit]
                total, best = np.zeros(j - i, dtype=np.int64), np.zeros(j - i, dtype=np.int64)
                np.add.at(total, owner, counts * frequent.value[1][at])
                np.add.at(best, owner, counts * frequent.value[2][at])
                part = batch.slice(i, j - i).drop_columns(["pairs", "counts"])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(best), pa.array(total)], names=[*part.schema.names, "best", "total"])

    return work


def _rare(frequent):
    """Row and links of the pairs that are not frequent."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for i, j, pairs, counts, owner in _stretches(batch):
                hit = _looked_up(frequent, pairs)[1]
                yield pa.record_batch({"row": pa.array(rows[i:j][owner[~hit]]), "pair": pa.array(pairs[~hit]), "links": pa.array(counts[~hit])})

    return work


def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256`` and the packed pairs of every row of ``docs``; saved."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return saved(rows.mapInArrow(_align(path_a, path_b), ALIGNED), "aligned")


def linked_pairs(aligned_rows: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: links of each id pair over the corpus, and whether no pair with its B id has more; saved.

    A pair is A's id times ``size_b`` plus B's id.
    """
    counted = saved(aligned_rows.select("pairs", "counts").mapInArrow(_count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    # One row for each id of B's vocabulary at most.
    tops = counted.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("top"))
    marked = counted.join(F.broadcast(tops), F.col("pair") % size_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    rows = saved(marked, "pairs")
    discard(counted)
    return rows


def alignment(docs: DataFrame, path_a: str, path_b: str, frequent_pairs: int = FREQUENT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per row of ``docs``.

    ``path_a`` is a byte-level tokenizers file, ``path_b`` a sentencepiece file that puts a blank in front and has no
    piece across a word's start. Null and empty texts, and texts whose joined tokens differ from " " + text (one with
    U+2581), have no tokens: zeros and ''. Every row is a document of its own, so repeated rows and doc_ids count each;
    a null doc_id stays null. Pairs with equal counts are all best. An empty table gives an empty result; further
    columns are ignored.
    """
    rows = aligned_documents(docs, path_a, path_b)
    pairs = linked_pairs(rows, len(_pair(path_a, path_b).bytes_b))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    common = F.col("n") * frequent_pairs > total
    known = pairs.filter(common).toArrow().sort_by("pair")
    frequent = docs.sparkSession.sparkContext.broadcast(
        (known["pair"].to_numpy(), known["n"].to_numpy(), known["best"].to_numpy(zero_copy_only=False).astype(np.int64))
    )
    kept = [c for c in rows.columns if c not in ("pairs", "counts")]
    by_kind = ", ".join(c for c in ALIGNED.split(", ") if c.split()[0] in kept)
    scored = rows.mapInArrow(_score(frequent), f"{by_kind}, best long, total long")
    others = rows.select("row", "pairs", "counts").mapInArrow(_rare(frequent), "row long, pair long, links long").join(pairs.filter(~common), "pair")
    more = others.groupBy("row").agg(F.sum(F.col("links") * F.col("n")).alias("total_more"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("best_more"))
    return scored.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("best") + F.coalesce("best_more", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("total_more", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
