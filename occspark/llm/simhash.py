"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.components import connected_components
from ..plans.shared import checked, cut, fresh
from .text import let, shingles, words

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RADIUS = 3
#: Fingerprints that share a variant up to which they are compared in memory.
GROUP = 4096


def _majority(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Per run of 64-bit hashes: the bits that over half of them have."""
    out = np.zeros(len(offsets) - 1, dtype=np.int64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for i in range(len(out)):
        lo, hi = offsets[i], offsets[i + 1]
        if hi > lo:
            ones = np.zeros(64, dtype=np.int64)
            for at in range(lo, hi, 65536):  # 4 MB of bits at once, however long the text
                part = octets[at : min(at + 65536, hi)]
                ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(2 * ones > hi - lo, bitorder="little").view(np.int64)[0]
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = batch["hashes"]
        offsets = hashes.offsets.to_numpy().astype(np.int64)
        prints = _majority(offsets - offsets[0], hashes.flatten().to_numpy())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints)], names=["doc_id", "fingerprint"])


def shingle_hashes(text: Column) -> Column:
    """XXH64 (seed 42) of the 3-word shingles, repeats kept; a shorter text is one shingle, a blank one none."""
    found = words(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER))
    blank = F.lit(" ")
    many = lambda w: shingles(w, 3, lambda x: F.xxhash64(F.concat(x[0], blank, x[1], blank, x[2])))
    few = lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.array_join(w, " "))))
    return let(found, lambda w: F.when(F.size(w) >= 3, many(w)).otherwise(few(w)))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint): 64 bits as a long in two's complement; zero for null and blank texts.

    Hashing stays in the JVM; only ids and arrays of hashes go to Python, as Arrow buffers.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), shingle_hashes(F.col(text)).alias("hashes"))
    return rows.mapInArrow(_fingerprint, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint long")


def _variants(points: DataFrame) -> DataFrame:
    """(key, near, fp): every variant within one flip of either 32-bit half of a fingerprint.

    Three differing bits leave one half with one of them at most, so two linked fingerprints
    meet at a variant that is the very half (``near`` false) of one of them.
    """
    flips = [F.struct(F.lit(0 if i < 0 else 1 << i).cast("long").alias("x"), F.lit(i >= 0).alias("near")) for i in range(-1, 32)]
    halves = [F.struct(F.lit(h << 32).cast("long").alias("base"), F.shiftrightunsigned("fp", 32 * h).bitwiseAND(F.lit(0xFFFFFFFF)).alias("half")) for h in (0, 1)]
    out = points.select("fp", F.explode(F.array(*halves)).alias("h")).select("fp", "h", F.explode(F.array(*flips)).alias("v"))
    return out.select((F.col("h.half").bitwiseXOR(F.col("v.x")) + F.col("h.base")).alias("key"), F.col("v.near").alias("near"), "fp")


def _links(fp: np.ndarray, near: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between the centres and all members of one variant."""
    label = np.arange(len(fp))
    for c in np.flatnonzero(~near):
        joined = np.unique(label[np.bitwise_count(fp[c] ^ fp) <= radius])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _compare(radius: int, limit: int):
    """Batches sorted by key to links (a, b); members of a variant with over ``limit`` of them go out as (a, null, key, near)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("near", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # the last key so far, at most ``limit`` rows
        spilling: int | None = None

        def over(key, near, fp):
            return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.nulls(len(fp), pa.int64()), pa.array(key), pa.array(near)], schema=schema)

        def done(key, near, fp):
            """Links of the whole groups in these rows."""
            cuts = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(key)]
            left, right = [], []
            for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
                if not near[s]:  # sorted: a group's centres come first
                    x, y = _links(fp[s:e], near[s:e], radius)
                    left.append(x)
                    right.append(y)
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                n = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), n, pa.nulls(len(a), pa.bool_())], schema=schema)

        for batch in batches:
            key = batch["key"].to_numpy()
            near, fp = batch["near"].to_numpy(zero_copy_only=False), batch["fp"].to_numpy().view(np.uint64)
            if not len(key):
                continue
            if kept:
                key, near, fp = (np.concatenate([*(k[i] for k in kept), x]) for i, x in enumerate((key, near, fp)))
                kept = []
            if spilling is not None:
                n = int(np.searchsorted(key, spilling, side="right"))
                if n:
                    yield over(key[:n], near[:n], fp[:n])
                key, near, fp = key[n:], near[n:], fp[n:]
                if not len(key):
                    continue
                spilling = None
            cuts = np.flatnonzero(np.diff(key)) + 1
            starts = np.r_[0, cuts]
            sizes = np.diff(np.r_[starts, len(key)])
            for s, n in zip(starts[sizes > limit], sizes[sizes > limit], strict=True):
                yield over(key[s : s + n], near[s : s + n], fp[s : s + n])
            large = np.repeat(sizes > limit, sizes)
            last = starts[-1]
            if sizes[-1] > limit:
                spilling = int(key[-1])
            else:
                kept = [(key[last:], near[last:], fp[last:])]
                large[last:] = True
            if not large.all():
                yield from done(key[~large], near[~large], fp[~large])
        if kept:
            yield from done(*kept[0])

    return run


def _crowded_links(members: DataFrame) -> DataFrame:
    """Links within variants that too many share, without comparing: the ball meets over the other half too.

    Centres of a variant share one half, so their other halves may differ in three bits: they
    emit them within one flip and within two. Others differ in one bit of the first half
    already and emit within one flip. Whatever meets a one-flip ball of a centre is
    within the radius of it, so the least centre takes them all as links.
    """
    one = [0, *(1 << i for i in range(32))]
    two = sorted({x ^ y for x in one for y in one} - set(one))
    masks = lambda xs: F.array(*(F.lit(x).cast("long") for x in xs))
    first = F.shiftright("key", 32) == 0
    other = F.when(first, F.shiftrightunsigned("a", 32)).otherwise(F.col("a").bitwiseAND(F.lit(0xFFFFFFFF)))
    ball = members.select("a", "key", "near", other.alias("o"))
    close = ball.select("a", "key", F.explode(masks(one)).alias("x"), "o", (~F.col("near")).alias("centre"))
    far = ball.filter(~F.col("near")).select("a", "key", F.explode(masks(two)).alias("x"), "o", F.lit(False).alias("centre"))
    rows = close.union(far).select("a", "key", F.col("o").bitwiseXOR(F.col("x")).alias("w"), "centre")
    hubs = rows.filter("centre").groupBy("key", "w").agg(F.min("a").alias("b"))
    return rows.select("a", "key", "w").join(hubs, ["key", "w"]).filter("a <> b").select("a", "b").distinct()


def fingerprint_links(points: DataFrame, group: int = GROUP) -> DataFrame:
    """Links (a, b) that connect whatever fingerprints (column ``fp``, distinct) within three bits connect.

    Each fingerprint emits 66 variants, half the radius around each of its halves; one shuffle
    on variants brings candidates together in key order, and each variant's members are verified
    by their whole 64 bits. A variant passes on a spanning forest of its links, at most one
    row per member, never all pairs. One with over ``group`` members is emitted a second time over
    the other half instead, which needs no comparison, so that memory stays bounded.
    """
    rows = _variants(points).repartition("key").sortWithinPartitions("key", "near", "fp")
    found = cut(rows.mapInArrow(_compare(RADIUS, group), "a long, b long, key long, near boolean"))
    links = found.filter("b is not null").select("a", "b")
    crowded = found.filter("b is null")
    return links.union(_crowded_links(crowded)) if crowded.limit(1).count() else links


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", group: int = GROUP) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (columns ``doc_id``, ``text``).

    Fingerprints link at three or fewer differing bits; ``component_id`` is the least id that
    links lead to; ids may be of any type that has an order. Null and blank texts have fingerprint zero and link like any other. Copies
    meet as one fingerprint before anything is emitted, so a group of them costs one row. A
    row without an id takes its group's least id, or null if none has one. Repeated rows come
    back as often; an empty table gives an empty result.
    """
    prints = cut(fingerprints(docs, doc_id))
    points = cut(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")))
    roots = connected_components(fingerprint_links(points.select("fp"), group), "a", "b")
    rooted = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    out = prints.join(named, prints["fingerprint"] == named["fp"], "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", group: int = GROUP) -> DataFrame:
    """``docs`` without the documents whose component has a smaller id; rows without an id stay."""
    found = simhash_components(docs, doc_id, group)
    own = fresh("__gone", docs)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(checked(cut(gone)), docs[doc_id] == F.col(own), "left_anti")
