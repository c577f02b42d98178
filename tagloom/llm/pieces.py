"""SentencePiece encoding in a streaming window, and decoding.

The ids are those of the library for the model's kind. A BPE file's pieces are merged in the order of their
scores; a boundary between two characters that no piece holds side by side is never merged over, so the
ids before it are final. A unigram file's are found by a streaming Viterbi search:

The best segmentation has the largest sum of piece scores. The search keeps only the characters that
a piece may still reach back to: as soon as all surviving back pointers lead through one boundary, the
ids before it are final, are given out and forgotten. A text of any length needs a window of a few
pieces, except where no boundary is common, which lasts as long as the text leaves it open.

No piece continues past a word's end with another word, so every word start is such a boundary,
and the ids of a word are remembered within bounds.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import cached_property
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.hashing import give_back

SPACE = "▁"
#: Words, and stretches of words, whose ids a task remembers, and once more as many from before.
REMEMBERED = 1 << 16
#: Longer words are not remembered, so that the bytes of all are bounded.
WORD_CHARS = 64
#: Bytes of input after which a task hands out its rows; a longer text goes alone.
HANDED_BYTES = 1 << 22
#: Characters after which the search looks for a common boundary, if none has shown by itself.
WINDOW = 64
#: The score of a pair that is no piece.
NEVER = float("-inf")
#: Longer stretches are merged with a heap.
SHORT = 32
#: A character that no piece holds costs this much more than the rarest piece.
UNKNOWN = 10.0


class Model:
    """Pieces, scores and bytes of a SentencePiece file."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kinds = proto.SentencePiece
        self.merges = proto.trainer_spec.model_type == proto.trainer_spec.BPE
        if not self.merges and proto.trainer_spec.model_type != proto.trainer_spec.UNIGRAM:
            raise ValueError("only BPE and unigram models have a search here")
        # For merges: score and id by piece, pieces that are merged on only, whole pieces, neighbours inside of pieces.
        normal = {p.piece: (p.score, i) for i, p in enumerate(proto.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED)}
        self.score_of = {piece: score for piece, (score, _) in normal.items()}
        self.id_of = {piece: i for piece, (_, i) in normal.items()}
        self.unused = {p.piece for p in proto.pieces if p.type == kinds.UNUSED}
        given = sorted((p.piece for p in proto.pieces if p.type == kinds.USER_DEFINED), key=len, reverse=True)
        self.given = re.compile("(" + "|".join(map(re.escape, given)) + ")") if given else None
        self.beside = {piece[i : i + 2] for piece in normal for i in range(len(piece) - 1)}

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        least, self.crosses = 0.0, False
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.bytes_of.append(piece.replace(SPACE, " ").encode())
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
            elif sp.is_control(i):
                self.bytes_of[i] = b""
            elif sp.is_unknown(i):
                self.bytes_of[i], self.unknown = " ⁇ ".encode(), i
            elif not sp.is_unused(i):
                if sp.get_score(i) > -1e8:
                    least = min(least, sp.get_score(i))
                self.crosses |= bool(re.search(f"[^{SPACE}]{SPACE}", piece))
        self.penalty = least - UNKNOWN
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.parts_before: dict[str, bytes] = {}
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.DOTALL)

    @cached_property
    def trie(self) -> dict:
        """Pieces by their characters, for the search; a node is its children, its piece's score and id."""
        root: dict = {}
        sp = self.processor
        for i in range(sp.get_piece_size()):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                node = root
                for c in sp.id_to_piece(i):
                    entry = node.setdefault(c, [{}, None, None])
                    node = entry[0]
                entry[1:] = sp.get_score(i), i
        return root

    def fallback(self, c: str) -> list[int]:
        if self.byte_ids:
            return [self.byte_ids[b] for b in c.encode()]
        return [self.unknown]

    def segments(self, text: str) -> Iterator[list[int]]:
        """Ids of the best segmentation, as they become final; of equal ones that whose last piece is longest."""
        trie, penalty, n = self.trie, self.penalty, len(text)
        origin = given = reach = 0  # lists begin at origin; what lies before given is given out
        best: list = [0.0]
        back: list = [None]
        for i in range(n):
            here, node, j = best[i - origin], trie, i
            while j < n:
                entry = node.get(text[j])
                if entry is None:
                    break
                j += 1
                node, score, name = entry
                if score is not None:
                    score, at = here + score, j - origin
                    while len(best) <= at:
                        best.append(None)
                        back.append(None)
                    if best[at] is None or score > best[at]:
                        best[at], back[at] = score, (i, name)
                    if j > reach:
                        reach = j
            at = i + 1 - origin
            if len(best) <= at:
                best.append(None)
                back.append(None)
            if best[at] is None:  # no piece ends here
                best[at], back[at] = here + penalty, (i, None)
                reach = max(reach, i + 1)
            if reach == i + 1:
                final = i + 1
            elif i - given >= WINDOW and i % WINDOW == 0:
                final = self._common(back, origin, i + 1, given)
            else:
                continue
            if final > given:
                yield self._ids(back, origin, given, final, text)
                given = final
                if given - origin > WINDOW:
                    del best[: given - origin], back[: given - origin]
                    origin = given

    @staticmethod
    def _common(back: list, origin: int, at: int, given: int) -> int:
        """The last boundary on the paths of all open positions."""
        frontier = {k for k in range(at, origin + len(back)) if back[k - origin]}
        while len(frontier) > 1:
            last = max(frontier)
            frontier.remove(last)
            frontier.add(max(back[last - origin][0], given))
        return frontier.pop()

    def _ids(self, back: list, origin: int, given: int, at: int, text: str) -> list[int]:
        out: list[int] = []
        while at > given:
            begin, piece = back[at - origin]
            if piece is None:
                out.extend(reversed(self.fallback(text[begin])))
            else:
                out.append(piece)
            at = begin
        return out[::-1]

    def one_window(self, text: str) -> list[int]:
        """``segments`` of a text no longer than the window, which is final at its end only."""
        trie, penalty, n = self.trie, self.penalty, len(text)
        least = float("-inf")
        best, begin, piece = [least] * (n + 1), [0] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here, node = best[i], trie
            j = i
            for c in text[i:]:
                j += 1
                entry = node.get(c)
                if entry is None:
                    break
                node, score, name = entry
                if score is not None and here + score > best[j]:
                    best[j], begin[j], piece[j] = here + score, i, name
            if best[i + 1] == least:
                best[i + 1], begin[i + 1] = here + penalty, i
        out = []
        while n:
            if piece[n] is None:
                out.extend(reversed(self.fallback(text[begin[n]])))
            else:
                out.append(piece[n])
            n = begin[n]
        return out[::-1]

    def _stretches(self, text: str) -> list[str]:
        """Parts of the text that no merge crosses."""
        inside = list(map(self.beside.__contains__, map(add, text, text[1:])))
        out, begin = [], 0
        for _ in range(inside.count(False)):
            end = inside.index(False, begin) + 1
            out.append(text[begin:end])
            begin = end
        if text:
            out.append(text[begin:])
        return out

    def merged(self, text: str) -> list[int]:
        """Ids of the text by the model's merges: the best score first, of equal ones the leftmost."""
        out: list[int] = []
        for k, part in enumerate(self.given.split(text) if self.given else [text]):
            if k % 2:  # a user's piece is whole from the start
                out.append(self.id_of[part])
                continue
            for stretch in self._stretches(part):
                own: dict[str, tuple[str, str]] = {}
                symbols = self._merged_short(stretch, own) if len(stretch) <= SHORT else self._merged_long(stretch, own)
                symbols.reverse()
                while symbols:
                    piece = symbols.pop()
                    if piece in self.unused and piece in own:
                        symbols += own[piece][::-1]
                    elif piece in self.id_of:
                        out.append(self.id_of[piece])
                    else:
                        out.extend(self.fallback(piece))
        return out

    def _merged_short(self, text: str, own: dict) -> list[str]:
        score, none, unused = self.score_of.get, NEVER, self.unused
        symbols = list(text)
        scores = list(map(score, map(add, text, text[1:]), repeat(none)))
        while scores:
            best = max(scores)
            if best == none:
                break
            i = scores.index(best)
            whole = symbols[i] + symbols.pop(i + 1)
            if whole in unused:
                own[whole] = symbols[i], whole[len(symbols[i]) :]
            symbols[i] = whole
            del scores[i]
            if i:
                scores[i - 1] = score(symbols[i - 1] + whole, none)
            if i < len(scores):
                scores[i] = score(whole + symbols[i + 1], none)
        return symbols

    def _merged_long(self, text: str, own: dict) -> list[str]:
        """``_merged_short`` with a heap of pairs; a pair whose parts have been merged since is passed over."""
        score_of, n = self.score_of, len(text)
        symbols: list = list(text)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(-score_of[a + b], i, i + 1, 2) for i, (a, b) in enumerate(zip(text, text[1:])) if a + b in score_of]
        heapq.heapify(heap)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != size:
                continue
            whole = symbols[i] + symbols[j]
            if whole in self.unused:
                own[whole] = symbols[i], symbols[j]
            symbols[i], symbols[j] = whole, ""
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    pair = symbols[x] + symbols[y]
                    if pair in score_of:
                        heapq.heappush(heap, (-score_of[pair], x, y, len(pair)))
        return [x for x in symbols if x]

    def _remembered(self, text: str) -> bytes:
        """``_packed`` of a word from the ids of its stretches, of which many words are made."""
        if len(self.parts) > REMEMBERED:
            self.parts_before, self.parts = self.parts, {}
        parts, out = self.parts, []
        for stretch in self._stretches(text):
            packed = parts.get(stretch)
            if packed is None:
                packed = parts[stretch] = self.parts_before.get(stretch) or self._short(stretch)
            out.append(packed)
        return b"".join(out)

    def _short(self, stretch: str) -> bytes:
        symbols = self._merged_short(stretch, {})
        try:
            ids = [self.id_of[x] for x in symbols]
        except KeyError:
            ids = [i for x in symbols for i in ([self.id_of[x]] if x in self.id_of else self.fallback(x))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _packed(self, text: str) -> bytes:
        if self.merges and len(text) <= SHORT and not self.given and not self.unused:
            return self._remembered(text)
        if self.merges:
            ids = self.merged(text)
            return struct.pack(f"<{len(ids)}I", *ids)
        if len(text) <= WINDOW:
            ids = self.one_window(text)
            return struct.pack(f"<{len(ids)}I", *ids)
        return np.array([i for ids in self.segments(text) for i in ids], dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        packed = self._encode(self.processor.normalize(text))
        if self.byte_ids:
            return packed
        ids = np.frombuffer(packed, dtype="<u4")  # a run of unknown characters is one id
        again = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
        return ids[np.concatenate(([True], ~again))].tobytes() if again.any() else packed

    def _encode(self, text: str) -> bytes:
        if self.crosses:
            return self._packed(text)
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        if text[:1] == SPACE and SPACE * 2 not in text and text[-1:] != SPACE:
            words, head = text[1:].split(SPACE), SPACE
        else:
            words, head = self.words.findall(text), ""
        known = self.known
        if head:
            long = {}
            for word in set(words).difference(known):
                (known if len(word) <= WORD_CHARS else long)[word] = self.before.get(word) or self._packed(head + word)
            if long:
                return b"".join([long[w] if len(w) > WORD_CHARS else known[w] for w in words])
            return b"".join(map(known.__getitem__, words))
        return b"".join([known[w[1:]] if w[1:] in known and w[:1] == SPACE and w[1:2] != SPACE else self._packed(w) for w in words])

    def decode(self, packed: bytes) -> bytes:
        out = b"".join([self.bytes_of[i] for i in np.frombuffer(packed, dtype="<u4").tolist()])
        return out[1:] if out[:1] == b" " else out


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def _mapped(path: str, source: str, target: str, work) -> object:
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column(source)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            parts = np.flatnonzero(np.diff(np.cumsum(sizes) // HANDED_BYTES, prepend=-1)).tolist()
            for i, j in zip(parts, [*parts[1:], len(sizes)]):
                batch = whole.slice(i, j - i)
                values = (x.as_py() for x in batch.column(source))
                done = pa.array([None if v is None else work(own, v) for v in values], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, done], names=[*batch.schema.names, target])
        give_back()

    return over


def _schema(frame: DataFrame, target: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema), f"`{target}` binary"])


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids``, packed little-endian 32-bit; null texts have no ids. ``ids`` in docs is replaced."""
    rows = docs.drop("ids").withColumn("text", F.coalesce("text", F.lit("")))
    return rows.mapInArrow(_mapped(path, "text", "ids", Model.encode), _schema(rows, "ids"))


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded``, the bytes that ``ids`` stand for; null ids decode to null."""
    rows = rows.drop("decoded")
    return rows.mapInArrow(_mapped(path, "ids", "decoded", Model.decode), _schema(rows, "decoded"))


def count(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def round_trip(text: Column, back: Column) -> Column:
    """Whether decoding gave the text; the model's sign for a space is a space to it."""
    return F.replace(text, F.lit(SPACE), F.lit(" ")).cast("binary") == back
