"""Packing of documents into sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import checked, cut, is_small
from .bpe import encoder

SEQUENCE = 2048
END_ID = 0


def _pieces(size: int, json_path: str | None, ranks_path: str | None):
    fields = [("doc_id", None), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(json_path, ranks_path)
        part = TaskContext.get().partitionId()
        so_far = [0] * (size + 1)  # pieces of each length in this task
        for batch in batches:
            rows: list[list] = [[] for _ in fields]
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array(ids_of(text.as_py() or "") + [END_ID], dtype="<u4")
                first = len(ids) % size or size
                edges = [0, *range(first, len(ids) + 1, size)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    n = b - a
                    for column, x in zip(rows, (doc.as_py(), k, a, n, zlib.crc32(ids[a:b].tobytes()), part, so_far[n]), strict=True):
                        column.append(x)
                    so_far[n] += 1
            kinds = [batch["doc_id"].type, *(k for _, k in fields[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=[f for f, _ in fields])

    return run


def _fullest(counts: list[int], room: int) -> dict[int, int]:
    """A multiset of available lengths with the largest sum up to ``room``; long pieces are tried first.

    Subset sums are the bits of one integer: offering a length shifts it. Each offered group of a
    length (1, 2, 4, ... pieces of it) keeps the bits before it, to walk back from the best sum.
    """
    reach, mask, offered = 1, (1 << (room + 1)) - 1, []
    for n in range(min(room, len(counts) - 1), 0, -1):
        left, take = min(counts[n], room // n), 1
        while left > 0 and not reach >> room & 1:
            take = min(take, left)
            offered.append((n, take, reach))
            reach |= reach << n * take & mask
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for n, take, before in reversed(offered):
        if not before >> at & 1:
            at -= n * take
            chosen[n] = chosen.get(n, 0) + take
    return chosen


def plan_bins(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, dict[int, int]]]:
    """[(times, {length: pieces})]: bins of minimum slack, the longest piece left going into each.

    The state is how many pieces of each length are left, ``size`` numbers whatever the corpus.
    A bin's combination is as full as any, so it is taken as often as its pieces last; each
    entry of the result leaves some length with fewer pieces than the entry used of it, which
    bounds their number by the sum of ``size`` / n over lengths n (some 17,000 for 2048).
    """
    left = [0] * (size + 1)
    for n, c in counts.items():
        left[n] = c
    out = []
    longest = size
    while True:
        while longest and not left[longest]:
            longest -= 1
        if not longest:
            return out
        left[longest] -= 1
        chosen = _fullest(left, size - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[n] // k for n, k in chosen.items())
        for n, k in chosen.items():
            left[n] -= k * times
        out.append((times, chosen))


def _slots(plan: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """For each length: rows (first rank, pieces in one sequence, first sequence, offset) by rank."""
    ranks: dict[int, int] = {}
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for times, chosen in plan:
        offset = 0
        for n in sorted(chosen, reverse=True):
            found.setdefault(n, []).append((ranks.get(n, 0), chosen[n], sequence, offset))
            ranks[n] = ranks.get(n, 0) + chosen[n] * times
            offset += n * chosen[n]
        sequence += times
    return {n: np.array(x, dtype=np.int64) for n, x in found.items()}


def _place(slots_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = slots_of.value
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.empty(len(length), dtype=np.int64), np.empty(len(length), dtype=np.int64)
            for n in np.unique(length):
                of = length == n
                row = slots[int(n)][np.searchsorted(slots[int(n)][:, 0], rank[of], side="right") - 1]
                nth = rank[of] - row[:, 0]
                sequence[of] = row[:, 2] + nth // row[:, 1]
                offset[of] = row[:, 3] + nth % row[:, 1] * n
            kept = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", size: int = SEQUENCE, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """One row per piece: where it stands in its document and in which sequence of ``size`` tokens.

    A document is its ids and an end id. Longer ones than ``size`` are cut into full pieces, what is
    over coming first. A null or empty text is the end id alone. Repeated rows and rows
    without an id are packed like others, ids may be of any type; an empty table gives no rows.

    Tasks number the pieces of each length among their own; these numbers are written down with the
    pieces, so nothing depends on recomputing a task. Totals by (length, task) then turn
    them into ranks over the corpus, and the driver sees one count per length. The plan it
    makes of them is as small as that, whatever the input, and is sent to all tasks, which look
    ranks up in it.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    pieces = cut(rows.mapInArrow(_pieces(size, json_path, ranks_path), made))
    totals = cut(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = docs.sparkSession.sparkContext.broadcast(_slots(plan_bins(counts, size)))
    before = totals.selectExpr("length as __length", "part as __part", "sum(n) over (partition by length order by part) - n as __before")
    ranked = pieces.join(checked(before, is_small(totals)), (F.col("length") == F.col("__length")) & (F.col("part") == F.col("__part")))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("__before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(_place(slots), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
