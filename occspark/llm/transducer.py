"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The parts are compiled from a model file of merges with byte fallback:

* the normaliser, one state that maps a blank to the piece mark and every other character to itself, and puts
  one mark before the text, as far as the file says so;
* each piece is an arc from its characters to its id, with minus its score as weight;
* a character that no piece has is an arc to the ids of its bytes, with the sum of minus their scores;
* two neighbouring arcs weigh nothing more if merging their joined characters by the model gives
  just these two pieces, and infinity otherwise.

Composed with an input this is a lattice of (place, last piece) states, whose paths have the tropical sum of their
weights. Segmentations all of whose neighbours agree are the ones that merging yields, and merging yields one: all
other paths weigh infinity, so the shortest path is the library's encoding itself, not an approximation by
scores. The composition is lazy: states are made as the search reaches them, and an arc of infinite weight is not followed.
No piece has a mark after another character: inputs are cut before marks, and each distinct stretch is composed once.
Models that normalise by tables, do without merges or without byte fallback are refused.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .bpe import default_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Characters of stretches remembered in each of two generations, and of pairs of pieces; they only save time.
REMEMBERED = 18_000_000

# Kinds of pieces and of models, and the numbers of fields, in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2
_PIECES, _TRAINER, _NORMALISER = 1, 2, 3
_PIECE, _SCORE, _KIND = 1, 2, 3
_MODEL_TYPE, _MARK_BEHIND, _BYTE_FALLBACK = 3, 24, 35
_CHARACTER_MAP, _MARK_FIRST, _ONE_BLANK, _MARKS, _RULES = 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value, at, shift = value | (byte & 127) << shift, at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = (8, at) if key & 7 == 1 else (4, at) if key & 7 == 5 else varint(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass(frozen=True)
class Model:
    """What a model file says: its pieces (text, score, kind) by id, and what its normaliser does."""

    pieces: list[tuple[str, float, int]]
    mark_first: bool
    marks: bool

    @classmethod
    def read(cls, path: str) -> Model:
        with open(path, "rb") as f:
            found = list(_fields(f.read()))
        trainer, rules = (dict(x for n, v in found if n == number for x in _fields(v)) for number in (_TRAINER, _NORMALISER))
        if trainer.get(_MODEL_TYPE, 1) != MERGES or not trainer.get(_BYTE_FALLBACK) or trainer.get(_MARK_BEHIND):
            raise ValueError(f"{path} is not a model of merges with byte fallback and marks before words")
        if rules.get(_CHARACTER_MAP) or rules.get(_RULES) or rules.get(_ONE_BLANK, 1):
            raise ValueError(f"{path} normalises characters or blanks by more than marks")
        pieces = []
        for number, piece in found:
            if number == _PIECES:
                own = dict(_fields(piece))
                pieces.append((own.get(_PIECE, b"").decode(), struct.unpack("<f", own.get(_SCORE, bytes(4)))[0], own.get(_KIND, NORMAL)))
        if any(kind == USER_DEFINED for _, _, kind in pieces):
            raise ValueError(f"{path} has pieces defined by hand")
        return cls(pieces, bool(rules.get(_MARK_FIRST, 1)), bool(rules.get(_MARKS, 1)))


class Remembered:
    """Values by text in two generations: when the young one holds too many characters it becomes the old one."""

    def __init__(self, limit: int):
        self.limit, self.held = limit, 0
        self.young: dict = {}
        self.old: dict = {}

    def put(self, key, value, size: int):
        self.held += size
        if self.held > self.limit:
            self.old, self.young, self.held = self.young, {}, size
        self.young[key] = value
        return value


class PieceTransducer:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        model = Model.read(path)
        self.width = "<u2" if len(model.pieces) <= 1 << 16 else "<u4"
        self.unknown = next(i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN)
        self.byte_id, self.byte_score = {}, {}
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.said: list[bytes] = []
        for i, (piece, score, kind) in enumerate(model.pieces):
            if kind == BYTE:
                byte = int(piece[3:5], 16)
                self.byte_id[byte], self.byte_score[byte] = i, score
                self.said.append(bytes([byte]))
            elif kind == CONTROL:
                self.said.append(b"")
            elif kind == UNKNOWN:
                self.said.append(" ⁇ ".encode())
            else:
                self.said.append((piece.replace(MARK, " ") if model.marks else piece).encode())
                if kind != UNUSED:
                    self.id[piece], self.score[piece] = i, score
        # The normaliser: what is put first, and what a blank becomes.
        self.first, self.blank = (MARK if model.marks else " ") if model.mark_first else "", MARK if model.marks else " "
        self.pairs = {p[k : k + 2] for p in self.id for k in range(len(p) - 1)}
        self.heads = {p[:k] for p in self.id for k in range(1, len(p) + 1)}
        # Pieces that merging never makes out of their own characters have no arc.
        self.arcs = {p for p in self.id if len(p) == 1 or self._merge(p) == [p]}
        self.cost = {p: -self.score[p] for p in self.arcs}
        self.agree = Remembered(remembered)
        self.stretches = Remembered(remembered)
        # Words with the marks before them; a line end, or any character in no piece of two, stands alone.
        alone = "".join(re.escape(c) for c in "\n\r\t" if not any(c in p for p in self.pairs))
        self.words = re.compile(f"{self.blank}*[^{self.blank}{alone}]+|[{alone}]|{self.blank}+" if alone else f"{self.blank}*[^{self.blank}]+|{self.blank}+").findall
        if any(p[0] != self.blank and self.blank in p for p in self.id):
            raise ValueError(f"{path} has pieces with marks within")

    def _merge(self, text: str) -> list[str]:
        """The pieces that merging the best neighbours first (the left ones of equals) arrives at."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def agrees(self, a: str, b: str) -> bool:
        """Whether arc ``b`` after arc ``a`` weighs nothing more; else it weighs infinity."""
        found = self.agree.young.get((a, b))
        if found is None:
            found = self.agree.old.get((a, b))
            if found is None:
                found = a[-1] + b[0] not in self.pairs or self._merge(a + b) == [a, b]
            self.agree.put((a, b), found, len(a) + len(b) + 8)
        return found

    def leaving(self, text: str, i: int) -> list[str]:
        """The arcs that leave a place, long ones last."""
        arcs, heads, out, j = self.arcs, self.heads, [], i + 1
        while (piece := text[i:j]) in heads and j <= len(text):
            if piece in arcs:
                out.append(piece)
            j += 1
        return out or [text[i]]

    def weight(self, piece: str) -> float:
        """Of an arc: minus the score of its piece, or of its bytes."""
        if piece in self.arcs:
            return self.cost[piece]
        return -sum(self.byte_score.get(b, 0.0) for b in piece.encode("utf-8", "replace"))

    def shortest_path(self, text: str) -> tuple[float, list[str]]:
        """(weight, arcs) of the tropical shortest path over (place, last piece) of a stretch.

        Since one path alone has finite weight, the first that arrives is the shortest. States are entered depth
        first, long arcs before short ones; one that led nowhere is not entered twice.
        """
        known, cost, path, places, choices, dead = self.agree.young.get, self.cost.get, [""], [0], [self.leaving(text, 0)], set()
        weights, end = [0.0], len(text)
        while places[-1] < end:
            before, at, choice = path[-1], places[-1], choices[-1]
            while choice:
                piece = choice.pop()
                if (not before or known((before, piece)) or self.agrees(before, piece)) and (not dead or (at, piece) not in dead):
                    path.append(piece)
                    places.append(at + len(piece))
                    weight = cost(piece)
                    weights.append(weights[-1] + (self.weight(piece) if weight is None else weight))
                    choices.append(self.leaving(text, places[-1]) if places[-1] < end else [])
                    break
            else:
                choices.pop()
                places.pop()
                weights.pop()
                dead.add((places[-1], path.pop()))
        return weights[-1], path[1:]

    def _ids(self, text: str) -> bytes:
        ids: list[int] = []
        for piece in self.shortest_path(text)[1]:
            ids += [self.id[piece]] if piece in self.arcs else self._bytes(piece)
        return np.array(ids, dtype=self.width).tobytes()

    def _bytes(self, char: str) -> list[int]:
        return [self.byte_id.get(b, self.unknown) for b in char.encode("utf-8", "replace")]

    def _word(self, word: str) -> bytes:
        found = self.stretches.young.get(word)
        if found is None:
            found = self.stretches.old.get(word)
            if found is None:
                end = len(word)
                while end > 1 and word[end - 1] in ",.;:!?)|" and word[end - 2 : end] not in self.pairs:
                    end -= 1  # no piece spans these two
                if end < len(word):
                    return b"".join([self._word(w) for w in (word[:end], *word[end:])])
                found = self._ids(word)
            self.stretches.put(word, found, len(word) + 16)
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as 16-bit numbers, or 32-bit ones of a vocabulary that needs them."""
        if not text:
            return np.empty(0, dtype=self.width)
        young = self.stretches.young.get
        said = self.words(self.first + text.replace(" ", self.blank))
        return np.frombuffer(b"".join([young(w) or self._word(w) for w in said]), dtype=self.width)

    def decode(self, ids: np.ndarray) -> str:
        """The text that the inverse transducer reads from ids, without the mark put before it."""
        said = self.said
        out = b"".join([said[i] for i in ids.tolist()])
        return (out[1:] if self.first and out.startswith(b" ") else out).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def transducer(path: str | None = None) -> PieceTransducer:
    return PieceTransducer(path or default_path(MODEL))


def encode_pieces(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``piece_ids`` (array of int); null texts have null, empty ones none. Clashing columns are replaced.

    Whole texts are encoded, of any length; repeated rows come back as often; an empty table gives no rows.
    """
    kept = [c for c in docs.columns if c != "piece_ids"]
    shape = docs.select(*kept).schema.add("piece_ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            ids = [None if t is None else machine.encode(t) for t in batch[text].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(ids, pa.list_(pa.int32()))], names=[*kept, "piece_ids"])

    return docs.select(*kept).mapInArrow(run, shape)


def decode_pieces(rows: DataFrame, ids: str = "piece_ids", path: str | None = None) -> DataFrame:
    """``rows`` with ``decoded`` (string), the inverse of ``encode_pieces``; null ids give null. Rows come back as often as they are."""
    kept = [c for c in rows.columns if c != "decoded"]
    shape = rows.select(*kept).schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            said = [machine.decode(np.array(x.as_py())) if x.is_valid else None for x in batch[ids]]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(said, pa.string())], names=[*kept, "decoded"])

    return rows.select(*kept).mapInArrow(run, shape)


def piece_digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``n_pieces``, ``n_byte_pieces``, ``ids_crc32`` (of 32-bit ids) and ``round_trip``.

    ``round_trip`` tells whether decoding the ids gives the text back. A null text has no pieces and
    a null ``round_trip``. Ids may be of any type; repeated rows come back as often; an empty table gives no rows; other
    columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        is_byte = np.zeros(len(machine.said), dtype=bool)
        is_byte[list(machine.byte_id.values())] = True
        for batch in batches:
            rows = []
            for t in batch["text"].to_pylist():
                ids = machine.encode(t or "")
                rows.append((len(ids), int(is_byte[ids].sum()), zlib.crc32(ids.astype("<u4").tobytes()), None if t is None else machine.decode(ids) == t))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "round_trip"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_pieces long, n_byte_pieces long, ids_crc32 long, round_trip boolean")
