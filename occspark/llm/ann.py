"""Nearest neighbours by an inverted file with product-quantised residuals and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import cut


@dataclass(frozen=True)
class AnnParameters:
    k: int = 20
    #: Vectors, about so many taken by a hash of their id, that centroids are fitted on; codebooks are on ``book_sample`` of them.
    sample: int = 65_536
    book_sample: int = 20_480
    #: Cells: this times the square root of the number of vectors, one to 8 of the sample at most.
    cells: float = 2.0
    #: A query reads its best cells until they hold a share of the vectors, and ``least_rows``. The share is the least that has
    #: ``recall`` of the true neighbours of about ``trials`` queries, which are searched exactly; or it is given.
    recall: float = 0.97
    trials: int = 256
    probe: float | None = None
    least_rows: int = 400
    #: Parts of a vector with a codebook of up to 256 entries each.
    parts: int = 16
    #: Candidates of each shard that a query reranks exactly, and all whose approximate score is within
    #: ``slack`` of the spread of its errors: near copies of one vector are told apart only exactly.
    rerank: int = 128
    slack: float = 0.5
    #: Vectors, and queries at a time, that one task holds.
    shard_rows: int = 4096
    query_rows: int = 4096
    rounds: int = 8
    seed: int = 11


def valid_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v) with v an array of doubles: ids given, vectors neither null, empty, zero nor with null or non-finite parts.

    Only the commonest length takes part (the shorter of equals): others have no inner product with it.
    """
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (most["d"] if most else 0))


def _distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(rep_id, vec_id, v): the ``k + 1`` least ids of each distinct vector, under the least of them.

    A query's ``k`` nearest hold no others: ties go to smaller ids, and it leaves out its own alone.
    Rows that repeat are one before they shuffle, and Spark keeps the first ids of each vector in every task before it shuffles these.
    """
    by = Window.partitionBy("h", "v").orderBy("vec_id")
    once = rows.groupBy(F.xxhash64("v").alias("h"), "v", "vec_id").agg(F.lit(1).alias("one"))
    ranked = once.withColumn("nth", F.row_number().over(by)).filter(F.col("nth") <= k + 1)
    least = F.first("vec_id").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ranked.withColumn("rep_id", least).select("rep_id", "vec_id", "v")


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        n = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, weights=x[:, j], minlength=k) for j in range(x.shape[1])], axis=1)
        centres[n > 0] = (sums[n > 0] / n[n > 0, None]).astype(x.dtype)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    norms = (centres * centres).sum(axis=1)
    return np.concatenate([(norms - 2 * x[i : i + 4096] @ centres.T).argmin(axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.empty(0, dtype=np.int64)


@dataclass
class AnnModel:
    #: Centroids of two levels: a vector goes to the nearest of ``tops``, then to the nearest of its own ``centroids``.
    tops: np.ndarray
    firsts: np.ndarray
    centroids: np.ndarray
    bounds: list[tuple[int, int]]
    books: list[np.ndarray]
    #: Spread of the error of an approximate score for a query of length one.
    error: float = 0.0

    def cells(self, x: np.ndarray) -> np.ndarray:
        top, out = _nearest(x, self.tops), np.empty(len(x), dtype=np.int64)
        for t in np.unique(top):
            of, first = top == t, self.firsts[t]
            out[of] = first + _nearest(x[of], self.centroids[first : self.firsts[t + 1]])
        return out

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = self.cells(x)
        rest = x - self.centroids[cell]
        return cell, np.stack([_nearest(rest[:, a:b], book) for (a, b), book in zip(self.bounds, self.books, strict=True)], axis=1).astype(np.uint8)


def fit(sample: np.ndarray, total: int, p: AnnParameters) -> AnnModel:
    """Coarse centroids and a codebook of residuals for each part."""
    rng = np.random.default_rng(p.seed)
    x = sample.astype(np.float32)
    k = max(1, min(-(-len(x) // 8), round(p.cells * total**0.5)))
    tops = _kmeans(x, max(1, round(k**0.5)), p.rounds, rng)
    top = _nearest(x, tops)
    inner = [x[top == t] for t in range(len(tops))]
    leaves = [_kmeans(y, max(1, min(len(y), round(k * len(y) / len(x)))), p.rounds, rng) if len(y) else tops[t : t + 1] for t, y in enumerate(inner)]
    model = AnnModel(tops, np.r_[0, np.cumsum([len(c) for c in leaves])], np.concatenate(leaves), [], [])
    y = x[: p.book_sample]
    rest = y - model.centroids[model.cells(y)]
    edges = np.linspace(0, x.shape[1], min(p.parts, x.shape[1]) + 1).astype(int)
    model.bounds = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
    model.books = [_kmeans(rest[:, a:b], min(256, len(y)), p.rounds, rng) for a, b in model.bounds]
    codes = model.codes(y)[1]
    lost = rest - np.concatenate([book[codes[:, m]] for m, book in enumerate(model.books)], axis=1)
    model.error = float(np.sqrt((lost * lost).sum(axis=1).mean() / x.shape[1]))
    return model


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _shards(sizes: dict[int, int], rows: int) -> dict[int, tuple[int, int]]:
    """Cell to (first shard, shards): small cells share one, cells with more than ``rows`` vectors have several."""
    out, shard, held = {}, 0, 0
    for cell, n in sorted(sizes.items()):
        if n > rows:
            many = -(-n // rows)
            out[cell] = (shard + bool(held), many)
            shard, held = shard + bool(held) + many, 0
            continue
        if held + n > rows:
            shard, held = shard + 1, 0
        out[cell] = (shard, 1)
        held += n
    return out


_FOUND = pa.schema([("query_id", pa.int64()), ("rep_id", pa.int64()), ("score", pa.float64())])


def _best_of_shard(model: AnnModel, p: AnnParameters, shard: tuple, queries: np.ndarray, q: np.ndarray, probed: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The ``k + 1`` best of a shard's vectors for each query among the cells that it reads."""
    ids, cell, v, codes = shard
    for at in range(0, len(queries), 128):
        some = slice(at, min(at + 128, len(queries)))
        qs = q[some].astype(np.float32)
        reads = np.zeros((len(qs), len(model.centroids)), dtype=bool)
        for i, cells in enumerate(probed[some]):
            reads[i, cells] = True
        near = (qs @ model.centroids.T)[:, cell]
        for m, ((a, b), book) in enumerate(zip(model.bounds, model.books, strict=True)):
            near += (qs[:, a:b] @ book.T)[:, codes[:, m]]
        near[~reads[:, cell]] = -np.inf
        width = min(p.rerank, len(ids))
        least = -np.partition(-near, width - 1, axis=1)[:, width - 1] - p.slack * model.error * np.sqrt((qs * qs).sum(axis=1))
        row, column = np.nonzero((near >= least[:, None]) & (near > -np.inf))
        exact = np.concatenate([np.empty(0), *(np.einsum("nd,nd->n", v[column[i : i + 8192]], q[at + row[i : i + 8192]]) for i in range(0, len(row), 8192))])
        order = np.lexsort((ids[column], -exact, row))
        row, column, exact = row[order], column[order], exact[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) <= p.k
        yield pa.RecordBatch.from_arrays([pa.array(queries[at + row[kept]]), pa.array(ids[column[kept]]), pa.array(exact[kept])], schema=_FOUND)


def _search(model_of, p: AnnParameters):
    """Over rows in the order of (shard, vectors before queries): a shard's vectors are held while its queries stream past."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: AnnModel = model_of.value
        held: list[pa.RecordBatch] = []
        at, shard = None, None
        for batch in batches:
            shards, kind = batch["shard"].to_numpy(), batch["asked"].to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(shards) != 0) | (np.diff(kind.astype(np.int8)) != 0)) + 1
            for i, j in zip(np.r_[0, edges], np.r_[edges, len(shards)], strict=True):
                if i == j:
                    continue
                if at != shards[i]:
                    at, held, shard = shards[i], [], None
                if not kind[i]:
                    held.append(batch.slice(i, j - i))
                    continue
                if shard is None and held:
                    parts = [(x["id"].to_numpy(), x["cell"].to_numpy(), _matrix(x["v"]), np.frombuffer(b"".join(x["code"].to_pylist()), dtype=np.uint8).reshape(len(x), -1)) for x in held]
                    shard, held = tuple(np.concatenate(c) for c in zip(*parts, strict=True)), []
                if shard is not None:
                    for n in range(i, j, p.query_rows):
                        some = batch.slice(n, min(p.query_rows, j - n))
                        yield from _best_of_shard(model, p, shard, some["id"].to_numpy(), _matrix(some["v"]), [x.values.to_numpy() for x in some["cells"]])

    return run


def _exact(trials_of, k: int):
    """Of the vectors in a task, the ``k`` nearest to each trial query but itself, with their cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = trials_of.value
        score, cell = np.full((len(ids), k), -np.inf), np.full((len(ids), k), -1)
        for batch in batches:
            v, reps, cells = _matrix(batch["v"]), batch["rep_id"].to_numpy(), batch["cell"].to_numpy()
            for i in range(0, len(v), 4096):
                near = q @ v[i : i + 4096].T
                near[ids[:, None] == reps[None, i : i + 4096]] = -np.inf
                both, of = np.concatenate([score, near], axis=1), np.concatenate([cell, np.broadcast_to(cells[i : i + 4096], near.shape)], axis=1)
                best = np.argpartition(-both, k - 1, axis=1)[:, :k]
                score, cell = np.take_along_axis(both, best, axis=1), np.take_along_axis(of, best, axis=1)
        trial, column = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(trial), pa.array(score[trial, column]), pa.array(cell[trial, column])], names=["trial", "score", "cell"])

    return run


def shares_needed(index: DataFrame, queries: DataFrame, n_queries: int, model: AnnModel, held: np.ndarray, p: AnnParameters) -> np.ndarray:
    """For each true neighbour of the trial queries, the share of all vectors that its query reads until it meets the neighbour's cell."""
    spark = index.sparkSession
    found = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(n_queries)) < p.trials).select("query_id", "v").toArrow()
    if not len(found):
        found = queries.select("query_id", "v").limit(1).toArrow()
    q = _matrix(found["v"].combine_chunks())
    trials = spark.sparkContext.broadcast((found["query_id"].to_numpy(), q))
    near = index.select("rep_id", "v", "cell").mapInArrow(_exact(trials, p.k), "trial long, score double, cell long")
    by = Window.partitionBy("trial").orderBy(F.desc("score"))
    near = near.withColumn("nth", F.row_number().over(by)).filter(F.col("nth") <= p.k).select("trial", "cell").toArrow()
    trial, cell = near["trial"].to_numpy(), near["cell"].to_numpy()
    order = np.argsort(-(q.astype(np.float32) @ model.centroids.T), axis=1, kind="stable")
    read = np.empty(order.shape)
    np.put_along_axis(read, order, np.cumsum(held[order], axis=1), axis=1)
    return read[trial, cell] / held.sum()


def nearest_neighbours(table: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", p: AnnParameters = AnnParameters()) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``p.k`` largest inner products found for each query among all other rows.

    ``is_query`` is a condition on ``vec_id``. See ``valid_vectors`` for the rows that take part. Rows
    that repeat an id and vector count once; ids are taken as the rows' own. Scores are sums of
    products in double precision of the vectors as given; ties go to smaller ids. A query with
    fewer other rows gets them all; an empty table gives no rows. Other columns are ignored.

    Fitting sees a bounded sample; every vector is indexed. Copies of a vector are one entry of
    the index, whatever their number. Entries go once to shards of bounded size, made of whole cells or,
    for a crowded cell, of a part of it; each query goes to the shards of the cells that it reads, and streams
    past their vectors there. How much a query reads is measured on exact searches (see ``AnnParameters``), so it is
    little where vectors cluster and much where they do not.
    """
    spark = table.sparkSession
    rows = cut(valid_vectors(table, vec_id, vector))
    members = cut(_distinct_vectors(rows, p.k))
    entries = members.filter("rep_id = vec_id").select("rep_id", "v")
    total = entries.count()
    empty = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], empty)
    sample = entries.filter(F.pmod(F.xxhash64("rep_id"), F.lit(total)) < p.sample).select("v").toArrow()
    if not len(sample):
        sample = entries.select("v").limit(1).toArrow()
    model = fit(_matrix(sample["v"].combine_chunks()), total, p)
    model_of = spark.sparkContext.broadcast(model)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, codes = model_of.value.codes(_matrix(batch["v"]).astype(np.float32))
            yield pa.RecordBatch.from_arrays([batch["rep_id"], batch["v"], pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())], names=["rep_id", "v", "cell", "code"])

    index = cut(entries.mapInArrow(assign, "rep_id long, v array<double>, cell int, code binary"))
    sizes = {r["cell"]: r["count"] for r in index.groupBy("cell").count().collect()}
    shards = _shards(sizes, p.shard_rows)
    held = np.array([sizes.get(c, 0) for c in range(len(model.centroids))])
    first, many = (np.array([shards.get(c, (0, 0))[i] for c in range(len(held))]) for i in (0, 1))
    queries = cut(rows.filter(is_query).withColumnRenamed("vec_id", "query_id").dropDuplicates(["query_id", "v"]))
    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], empty)
    share = p.probe
    if share is None:
        needed = shares_needed(index, queries, n_queries, model, held, p)
        share = float(np.quantile(needed, p.recall, method="higher")) if len(needed) else 1.0
    enough = max(share * total, p.least_rows)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch["v"]) if len(batch) else np.empty((0, 1))
            rows_of, shard_of, cells_of = [], [], []
            for i in range(len(q)):
                order = np.argsort(-(q[i].astype(np.float32) @ model_of.value.centroids.T), kind="stable")
                order = order[: int(np.searchsorted(np.cumsum(held[order]), enough)) + 1]
                at: dict[int, list[int]] = {}
                for c in order[held[order] > 0].tolist():
                    for s in range(first[c], first[c] + many[c]):
                        at.setdefault(s, []).append(c)
                for s, cells in at.items():
                    rows_of.append(i)
                    shard_of.append(s)
                    cells_of.append(cells)
            taken = pa.array(rows_of, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["query_id"].take(taken), batch["v"].take(taken), pa.array(shard_of, pa.int32()), pa.array(cells_of, pa.list_(pa.int32()))], names=["query_id", "v", "shard", "cells"])

    asked = queries.select("query_id", "v").mapInArrow(probe, "query_id long, v array<double>, shard int, cells array<int>")
    places = spark.createDataFrame([(c, s, n) for c, (s, n) in shards.items()], "cell int, first int, many int")
    dealt = index.join(F.broadcast(places), "cell").withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("rep_id"), F.col("many"))).cast("int"))
    dealt = dealt.select("shard", F.lit(False).alias("asked"), F.col("rep_id").alias("id"), "v", "cell", "code", F.lit(None).cast("array<int>").alias("cells"))
    both = dealt.unionByName(asked.select("shard", F.lit(True).alias("asked"), F.col("query_id").alias("id"), "v", F.lit(0).alias("cell"), F.lit(None).cast("binary").alias("code"), "cells"))
    near = both.repartition("shard").sortWithinPartitions("shard", "asked").mapInArrow(_search(model_of, p), "query_id long, rep_id long, score double")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep_id")
    best = near.withColumn("nth", F.row_number().over(by_score)).filter(F.col("nth") <= p.k + 1).select("query_id", "rep_id", "score")
    out = best.join(members.select("rep_id", "vec_id"), "rep_id").filter("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= p.k).select("query_id", "rank", "vec_id", "score")
