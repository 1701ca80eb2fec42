"""Masked pseudo-likelihood scores of tokens, from a bidirectional window network trained in numpy and counts of windows.

Tokens are the ids of a public byte-level vocabulary, all of which the network knows and predicts. It sees
``window`` tokens on either side of a masked one: their embeddings, side by side, go through a tanh
layer, and a hierarchical softmax over the Huffman tree of the corpus counts gives the probability of every
token of the vocabulary. Training starts from the counts alone (the unigram model) and runs over all documents:
tasks train copies on their own documents, and the changes are averaged by the rows of the parameters they touched.

How often each two and three tokens in a row stand in all documents is counted, without a least count or a
cap. These tables grow with the corpus, stay distributed and never come to the driver. A token's probability
is the mean of its share after the two tokens before it and its share before the two after it, each smoothed
by the network: (times it stands there + ``prior`` times the network's probability) over (times that anything, or
the end, stands there + ``prior``), without the occurrence scored.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import cut
from .bpe import encoder, vocabulary_size

_WORD = re.compile("[^\x20\x09-\x0d]")


@dataclass(frozen=True)
class LmParameters:
    #: Tokens that the network sees on either side.
    window: int = 3
    #: Entries of an embedding and of the hidden layer.
    width: int = 16
    #: Times that the copies are averaged; over all of them every place is trained on once.
    rounds: int = 4
    rate: float = 0.2
    batch: int = 4096
    seed: int = 5
    #: Occurrences beside two tokens that the network weighs as much as.
    prior: float = 20.0
    #: Tokens of a chunk of documents, which one task holds at once.
    chunk_tokens: int = 1_500_000


def _squeezed(x: np.ndarray) -> bytes:
    """Bytes of one significance together, compressed."""
    return zstandard.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), 1)


def _loosened(x: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(x), dtype=np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


# Documents as chunks of tokens ------------------------------------------------------------------------


def token_chunks(rows: DataFrame, p: LmParameters, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """(chunk, doc_ids, lengths, ids): documents (doc_id, text) as tokens, some ``chunk_tokens`` in a row; a document is never split."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, nth = encoder(json_path, ranks_path), TaskContext.get().partitionId(), 0
        docs: list = []
        said: list[np.ndarray] = []
        held = 0

        def full(id_type: pa.DataType) -> pa.RecordBatch:
            lengths = [[len(x) for x in said]]
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 33 | nth]), pa.array([docs], pa.list_(id_type)), pa.array(lengths, pa.list_(pa.int64())), pa.array([_squeezed(np.concatenate(said))], pa.binary())],
                names=["chunk", "doc_ids", "lengths", "ids"],
            )

        id_type = None
        for batch in batches:
            id_type = batch["doc_id"].type
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                t = text.as_py()
                said.append(np.frombuffer(array("I", ids_of(t) if t and _WORD.search(t) else []), dtype=np.uint32))
                docs.append(doc.as_py())
                held += len(said[-1])
                if held >= p.chunk_tokens:
                    yield full(id_type)
                    docs, said, held, nth = [], [], 0, nth + 1
        if docs:
            yield full(id_type)

    return rows.mapInArrow(run, f"chunk long, doc_ids array<{kind}>, lengths array<long>, ids binary")


@dataclass(frozen=True)
class Chunk:
    """The tokens of a chunk's documents, each document between marks of its start and of its stop."""

    stream: np.ndarray
    at: np.ndarray  # the places of tokens
    lengths: np.ndarray


def _chunk(lengths: np.ndarray, ids: bytes, window: int, start: int) -> Chunk:
    """``start`` is the mark before a document, the next number the one behind it; both stand ``window`` times, twice at least."""
    found, pad = _loosened(ids, np.uint32), max(window, 2)
    nth = np.arange(len(lengths))
    at = np.repeat(pad * (1 + 2 * nth), lengths)
    at += np.arange(len(found))
    stream = np.full(len(found) + 2 * pad * len(lengths), start, dtype=np.int32)
    stream[at] = found
    stream[(np.cumsum(lengths) + pad * (1 + 2 * nth))[:, None] + np.arange(pad)] = start + 1
    return Chunk(stream, at, lengths)


def _chunks(batch: pa.RecordBatch, window: int, start: int) -> Iterator[Chunk]:
    for lengths, ids in zip(batch["lengths"], batch["ids"], strict=True):
        yield _chunk(np.array(lengths.as_py(), dtype=np.int64), ids.as_py(), window, start)


def token_totals(chunks: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each token of the vocabulary stands in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for ids in batch["ids"]:
                n += np.bincount(_loosened(ids.as_py(), np.uint32), minlength=vocabulary)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], names=["token", "n"])

    found = chunks.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(vocabulary, dtype=np.int64)
    out[found["token"].to_numpy()] = found["n"].to_numpy()
    return out


# The network ------------------------------------------------------------------------------------------


#: Steps from the root down to where a branch begins.
_TOP = 5


@dataclass(frozen=True)
class Tree:
    """The Huffman tree of a vocabulary: of each token, the inner nodes above it, the root last, and the side that it is on.

    A branch is what lies below a node ``_TOP`` steps from the root, or a leaf no farther from it. Inner nodes are numbered
    from the root on, those above all branches first, then branch by branch. Leaves are ranked from left to right, so
    that those below a node are neighbours.
    """

    starts: np.ndarray
    depth: np.ndarray
    nodes: np.ndarray
    sides: np.ndarray  # 1 or -1
    odds: np.ndarray  # of each inner node, the log odds of side 1 by the counts
    ranks: np.ndarray  # of each token
    spans: np.ndarray  # of each inner node, the ranks where side -1 begins, where side 1 does and where it ends
    levels: np.ndarray  # of each inner node, the steps from the root
    branches: np.ndarray  # of each token, its branch
    branch_starts: np.ndarray  # the first inner node of each branch, and the number of inner nodes
    above: np.ndarray  # of each branch, the nodes above it, the root first
    above_sides: np.ndarray  # the side that it is on, or 0 where there are no more nodes


def huffman(counts: np.ndarray) -> Tree:
    """Ties go by the order of tokens; one is added to every count, so that no token is impossible."""
    n = len(counts)
    heap = [(int(c) + 1, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    odds, kids = np.zeros(n - 1), []
    for k in range(n - 1):
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        kids.append((i, j))
        odds[k] = np.log(b / a)
        heapq.heappush(heap, (a + b, n + k))
    leaves, first, level, branch = [1] * n + [0] * (n - 1), [0] * (2 * n - 1), [0] * (2 * n - 1), [-1] * (2 * n - 1)
    for k, (i, j) in enumerate(kids):
        leaves[n + k] = leaves[i] + leaves[j]
    branches = int(n == 1)
    for k in range(n - 2, -1, -1):  # from the root on
        i, j = kids[k]
        first[i], first[j] = first[n + k], first[n + k] + leaves[i]
        for x in (i, j):
            level[x], branch[x] = level[n + k] + 1, branch[n + k]
            if branch[x] < 0 and (x < n or level[x] == _TOP):
                branch[x], branches = branches, branches + 1
    number = np.empty(n - 1, dtype=np.int64)
    number[np.lexsort((level[n:], branch[n:]))] = np.arange(n - 1)
    up, side = np.full(2 * n - 1, -1), np.zeros(2 * n - 1, dtype=np.int8)
    for k, (i, j) in enumerate(kids):
        up[i] = up[j] = n + k
        side[i], side[j] = -1, 1
    at, steps = np.arange(n), []
    while (up[at] >= 0).any():
        steps.append((np.where(up[at] >= 0, np.take(number, up[at] - n, mode="clip"), -1), side[at]))
        at = np.where(up[at] >= 0, up[at], at)
    over, sides = (np.array([s[k] for s in steps]).T.reshape(n, -1) for k in (0, 1))
    there = over >= 0
    depth = there.sum(axis=1)
    starts, nodes, sides = np.cumsum(depth) - depth, over[there], sides[there]
    of = np.maximum(branch[:n], 0)
    has = np.arange(_TOP) < np.minimum(depth, _TOP)[:, None]
    token, kth = np.nonzero(has)
    above, above_sides = np.zeros((branches, _TOP), dtype=np.int64), np.zeros((branches, _TOP), dtype=np.float32)
    above[of[token], kth] = nodes[(starts + depth - 1)[token] - kth]
    above_sides[of[token], kth] = sides[(starts + depth - 1)[token] - kth]
    spans, levels, by_number = np.zeros((n - 1, 3), dtype=np.int64), np.zeros(n - 1, dtype=np.int64), np.zeros(n - 1)
    for k, (i, j) in enumerate(kids):
        spans[number[k]] = first[i], first[j], first[j] + leaves[j]
        levels[number[k]], by_number[number[k]] = level[n + k], odds[k]
    branch_starts = np.searchsorted(np.sort(branch[n:]), np.arange(branches + 1))
    return Tree(
        starts.astype(np.int32), depth.astype(np.int32), nodes.astype(np.int32), sides.astype(np.float32), by_number.astype(np.float32),
        np.array(first[:n], dtype=np.int32), spans, levels, of.astype(np.uint16), branch_starts, above, above_sides,
    )


@dataclass
class Network:
    """All parameters as rows of one matrix: embeddings (the two marks' last), inner nodes, the layer's weights and its bias."""

    tree: Tree
    window: int
    width: int
    theta: np.ndarray

    @property
    def vocabulary(self) -> int:
        return len(self.tree.depth)

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        v = self.vocabulary
        return self.theta[: v + 2], self.theta[v + 2 : 2 * v + 1], self.theta[2 * v + 1 : -1], self.theta[-1]

    def log_probabilities(self, stream: np.ndarray, at: np.ndarray, block: int = 4096) -> np.ndarray:
        """The log-probability of the token at each place by those around it.

        Products of matrices round a row by its place among the others; here each place is summed up by itself, so that
        like places have the same value wherever they stand. Places go by the ranks of their tokens' leaves, so that
        those below a node are neighbours.
        """
        out, tree, (embeddings, nodes, weights, bias) = np.empty(len(at)), self.tree, self.parts()
        # What each token adds to the layer from each of the places around.
        offsets = [*range(-self.window, 0), *range(1, self.window + 1)]
        adds = [embeddings @ weights[k * self.width : (k + 1) * self.width] for k in range(len(offsets))]
        ranks = np.take(tree.ranks, np.take(stream, at))
        order = np.argsort(ranks.astype(np.uint16) if self.vocabulary <= 1 << 16 else ranks, kind="stable")
        at, spans = np.take(at, order), np.take(np.r_[0, np.cumsum(np.bincount(ranks, minlength=self.vocabulary))], tree.spans)
        below = np.flatnonzero(spans[:, 2] > spans[:, 0])
        nodes, levels, spans = nodes[below], tree.levels[below], spans[below]
        for i in range(0, len(at), block):
            some = at[i : i + block]
            n = len(some)
            x = np.take(adds[0], np.take(stream, some + offsets[0]), axis=0)
            for add, offset in zip(adds[1:], offsets[1:], strict=True):
                x += np.take(add, np.take(stream, some + offset), axis=0)
            x += bias
            # Two columns at least: numpy would add up a single one in another order.
            h = np.zeros((self.width, max(n, 2)), dtype=np.float32)
            h[:, :n] = np.tanh(x, out=x).T
            h[-1] = 1
            passed = np.flatnonzero((spans[:, 0] < i + n) & (spans[:, 2] > i))
            level = levels[passed]
            z = np.full((level.max(initial=0) + 1, h.shape[1]), np.inf, dtype=np.float32)  # for leaves above a level
            for node, k, (begin, middle, end) in zip(nodes[passed], level.tolist(), np.clip(spans[passed] - i, 0, n).tolist(), strict=True):
                if end - begin > 1:
                    np.einsum("d,dn->n", node, h[:, begin:end], out=z[k, begin:end])
                else:
                    first = min(begin, h.shape[1] - 2)
                    z[k, begin] = np.einsum("d,dn->n", node, h[:, first : first + 2])[begin - first]
                np.negative(z[k, begin:middle], out=z[k, begin:middle])
            chances = np.multiply.reduce(1 + np.exp(-np.abs(z)), axis=0)
            out[order[i : i + block]] = (np.add.reduce(np.minimum(z, 0), axis=0) - np.log(chances))[:n]
        return out

    def train(self, stream: np.ndarray, at: np.ndarray, p: LmParameters, rate: float, squares: np.ndarray, touched: np.ndarray) -> None:
        """Steps of Adagrad up the log-probability of the tokens at ``at``; ``squares`` and ``touched`` go on from call to call."""
        v, width = self.vocabulary, self.width
        embeddings, nodes, weights, bias = self.parts()
        half = self.window * width
        layer = np.arange(2 * v + 1, len(self.theta))
        for i in range(0, len(at), p.batch):
            some = at[i : i + p.batch]
            # The tokens between two places are read once, as those right of the one and left of the other.
            left = np.arange(len(some))
            left[1:] += np.cumsum(np.diff(some) != self.window + 1)
            gaps = np.empty(left[-1] + 2, dtype=some.dtype)
            gaps[left + 1], gaps[left] = some + 1, some - self.window
            around = np.take(stream, gaps[:, None] + np.arange(self.window)).reshape(-1)
            x = np.take(embeddings, around, axis=0).reshape(len(gaps), half)
            both = np.concatenate([weights[:half], weights[half:]], axis=1)
            # Of each gap, what it adds to the place behind it and to that before it.
            sums, behind, before = (x @ both).reshape(-1, width), 2 * left, 2 * left + 3
            beside = np.full(len(sums), len(some))
            beside[behind] = beside[before] = np.arange(len(some))
            h = np.take(sums, behind, axis=0)
            h += np.take(sums, before, axis=0)
            h += bias
            np.tanh(h, out=h)
            h[:, -1] = 1  # stands by the nodes' own odds
            back, own, up = self._up(h, np.take(stream, some))
            back[:-1, -1] = 0
            back[:-1] *= 1 - h * h
            sides = np.take(back, beside, axis=0).reshape(len(gaps), -1)
            seen, up_x, n_x = _by_row(around, (sides @ both.T).reshape(-1, width))
            touched[seen] += 2 * n_x
            alone = (beside[::2] == len(some)) | (beside[1::2] == len(some))  # gaps with a place on one side only
            np.subtract.at(touched, around.reshape(-1, self.window)[alone], 1)
            up_weights = (x.T @ sides).reshape(half, 2, width).transpose(1, 0, 2).reshape(-1, width)
            rows = np.concatenate([v + 2 + own, seen, layer])
            grad = np.concatenate([up, up_x, up_weights, np.ones((1, len(back)), dtype=np.float32) @ back])
            so_far = np.take(squares, rows, axis=0)
            so_far += grad * grad
            squares[rows] = so_far
            grad *= np.float32(rate)
            grad /= np.sqrt(so_far) + np.float32(1e-6)
            grad += np.take(self.theta, rows, axis=0)
            self.theta[rows] = grad
        spans = np.take(np.r_[0, np.cumsum(np.bincount(np.take(self.tree.ranks, np.take(stream, at)), minlength=v))], self.tree.spans)
        touched[v + 2 : 2 * v + 1] += spans[:, 2] - spans[:, 0]
        touched[layer] += len(at)

    def _up(self, h: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(up the layers ``h`` of the places of ``tokens`` and a row of zeros, nodes, up these) of the sum of log-probabilities.

        The places on a branch meet the nodes above it and those nodes of it that any of them passes, as products of matrices.
        """
        tree, nodes = self.tree, self.parts()[1]
        branch = np.take(tree.branches, tokens)
        order = np.argsort(branch, kind="stable")
        branch, tokens, h = np.take(branch, order), np.take(tokens, order), np.take(h, order, axis=0)
        own, path = np.arange(len(tokens)), np.arange(_TOP)
        # The nodes of paths that are on a branch, the last one first.
        low = np.maximum(np.take(tree.depth, tokens) - _TOP, 0)
        last = np.cumsum(low)
        step = np.arange(last[-1]) + np.repeat(np.take(tree.starts, tokens) - (last - low), low)
        node = np.take(tree.nodes, step)
        passed = np.zeros(len(nodes), dtype=bool)
        passed[node] = True
        seen = np.flatnonzero(passed)
        # Of each branch with places: its places, its nodes among those seen, and the slopes of the ones by the nodes above and the others.
        rows, columns = np.searchsorted(branch, np.arange(len(tree.above) + 1, dtype=np.uint16)), np.searchsorted(seen, tree.branch_starts)
        some = np.flatnonzero(rows[1:] > rows[:-1])
        i, j, k, m = rows[some], rows[some + 1], columns[some], columns[some + 1]
        wide = m - k + _TOP
        first, begin = np.cumsum(wide) - wide, np.cumsum((j - i) * wide) - (j - i) * wide
        above = first[:, None] + path
        below = np.arange(len(seen)) + np.repeat(first + _TOP - k, m - k)
        place = np.empty(len(nodes), dtype=np.int64)
        place[seen] = below - np.repeat(first, m - k)
        ids = np.empty(len(seen) + above.size, dtype=np.int64)
        ids[above], ids[below] = tree.above[some], seen
        over = np.take(nodes, ids, axis=0)
        start = np.repeat(begin - i * wide, j - i) + own * np.repeat(wide, j - i)
        at_above, at_below = start[:, None] + path, np.repeat(start, low) + np.take(place, node)
        z, up, back = np.empty(int(((j - i) * wide).sum()), dtype=np.float32), np.empty_like(over), np.zeros((len(h) + 1, self.width), dtype=np.float32)
        met = []
        for i_, j_, a, w, b in zip(i.tolist(), j.tolist(), first.tolist(), wide.tolist(), begin.tolist(), strict=True):
            met.append((h[i_:j_], over[a : a + w], z[b : b + (j_ - i_) * w].reshape(-1, w), up[a : a + w], back[i_:j_]))
            np.matmul(met[-1][0], met[-1][1].T, out=met[-1][2])
        g_above = _slopes(np.take(z, at_above), np.take(tree.above_sides, branch, axis=0))
        g_below = _slopes(np.take(z, at_below), np.take(tree.sides, step))
        z.fill(0)
        z[at_above], z[at_below] = g_above, g_below
        for layers, others, slopes, up_others, up_layers in met:
            np.matmul(slopes.T, layers, out=up_others)
            np.matmul(slopes, others, out=up_layers)
        tops = tree.branch_starts[0]
        up_tops = np.zeros((tops, self.width), dtype=np.float32)
        np.add.at(up_tops, ids[above], up[above])
        places = np.full(len(back), len(own))
        places[order] = own
        return np.take(back, places, axis=0), np.concatenate([np.arange(tops), seen]), np.concatenate([up_tops, np.take(up, below, axis=0)])


def _slopes(z: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Of the log-probability of ``side`` by its log odds ``z``, or 0 for no side."""
    z = z * side
    np.exp(np.minimum(z, 30, out=z), out=z)
    z += 1
    return np.divide(side, z, out=z)


def _paired(x: np.ndarray) -> np.ndarray:
    """Pairs of columns as complex numbers, which take half as many additions, where columns come in pairs."""
    return x.view(np.complex64) if x.shape[1] % 2 == 0 else x


def _by_row(at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, sum, n) of the rows of ``x`` that share an entry of ``at``."""
    order = np.argsort(at.astype(np.uint16) if at.max(initial=0) < 1 << 16 else at, kind="stable")
    at, new = np.take(at, order), np.ones(len(at) + 1, dtype=bool)
    np.not_equal(at[1:], at[:-1], out=new[1:-1])
    first = np.flatnonzero(new)
    sums = np.add.reduceat(_paired(np.take(x, order, axis=0)), first[:-1], axis=0).view(np.float32)
    return np.take(at, first[:-1]), sums, first[1:] - first[:-1]


def unigram_network(counts: np.ndarray, p: LmParameters) -> Network:
    """The network before training, whose probabilities are the shares of the counts."""
    v, rng = len(counts), np.random.default_rng(p.seed)
    tree = huffman(counts)
    theta = np.zeros((2 * v + 2 + 2 * p.window * p.width, p.width), dtype=np.float32)
    theta[: v + 2] = rng.normal(0, 0.3, (v + 2, p.width))
    theta[v + 2 : 2 * v + 1, -1] = tree.odds
    theta[2 * v + 1 : -1] = rng.normal(0, 1 / np.sqrt(2 * p.window * p.width), (2 * p.window * p.width, p.width))
    return Network(tree, p.window, p.width, theta)


def _places(at: np.ndarray, nth: int, p: LmParameters) -> np.ndarray:
    """Those of the places ``at`` that the ``nth`` round trains on."""
    return at[nth :: p.rounds]


def fit_network(chunks: DataFrame, vocabulary: int, p: LmParameters) -> Network:
    """The network trained over all documents of ``chunks``, ``rounds`` times averaged.

    In each round every document gives other places to train on, and over all rounds each of its places once. What comes to the
    driver is bounded by the parameters: changes are added up by row before and after the shuffle.
    """
    network = unigram_network(token_totals(chunks, vocabulary), p)
    spark, width = chunks.sparkSession, p.width
    for nth in range(p.rounds):
        sent = spark.sparkContext.broadcast(network)

        def run(batches: Iterator[pa.RecordBatch], nth: int = nth, sent=sent) -> Iterator[pa.RecordBatch]:
            start = sent.value
            own = Network(start.tree, start.window, start.width, start.theta.copy())
            squares, touched = np.full_like(own.theta, 1e-8), np.zeros(len(own.theta))
            for batch in batches:
                for chunk in _chunks(batch, own.window, own.vocabulary):
                    own.train(chunk.stream, _places(chunk.at, nth, p), p, p.rate / (1 + nth), squares, touched)
            rows = np.flatnonzero(touched)
            for i in range(0, len(rows), 10_000):
                some = rows[i : i + 10_000]
                moved = ((own.theta[some] - start.theta[some]) * touched[some, None]).astype(np.float32)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, moved.size + 1, width, dtype=np.int32)), pa.array(moved.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(touched[some]), vectors], names=["row", "n", "v"])

        moved = chunks.select("lengths", "ids").mapInArrow(run, "row long, n double, v array<float>")
        found = moved.groupBy("row").agg(F.sum("n").alias("n"), *(F.sum(F.get("v", F.lit(i))).alias(f"v{i}") for i in range(width))).toArrow()
        rows, n = found["row"].to_numpy(), found["n"].to_numpy()
        theta = network.theta.copy()
        theta[rows] += np.stack([found[f"v{i}"].to_numpy() for i in range(width)], axis=1).reshape(len(rows), width) / n[:, None]
        network = Network(network.tree, network.window, network.width, theta)
        sent.unpersist()
    return network


# Counts of tokens in a row ------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _run_keys(chunk: Chunk, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, keys of ``bits`` bits) of the two, and of the three, tokens in a row that end at each place that counts.

    Runs count from the two marks before a document's first token to the two behind its last one.
    """
    s, shift = chunk.stream.astype(np.uint64), np.uint64(64 - bits)
    counts = np.zeros(len(s), dtype=bool)
    for step in range(3):
        counts[chunk.at + step] = True
    three = np.flatnonzero(counts)
    counts[chunk.at - 1] = True
    two = np.flatnonzero(counts)
    # Of each place but the first, the key of the two that end there; a longer run's is made of the one before it.
    both = np.concatenate([np.zeros(1, dtype=np.uint64), _mixed(s[:-1] << np.uint64(32) | s[1:])])
    longer = _mixed(np.take(both, three - 1) + np.take(s, three) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))
    return [(two, np.take(both, two) >> shift), (three, longer >> shift)]


def key_bits(tokens: int) -> int:
    """Bits of a key such that fewer than one in 65,536 keys of the corpus share theirs with another."""
    return min(64, max(tokens, 1).bit_length() + 16)


def _cuts(keys: np.ndarray, bits: int, n: int) -> np.ndarray:
    """Where the ``n`` equal ranges of all keys begin and end among sorted ones."""
    bounds = np.array([(k << bits) // n for k in range(1, n)], dtype=np.uint64)
    return np.r_[0, np.searchsorted(keys, bounds), len(keys)]


def run_counts(chunks: DataFrame, n: int, bits: int, window: int, start: int) -> DataFrame:
    """(chunk, part, totals): for the sorted distinct keys of each chunk, how often each stands in all documents.

    Each chunk sends its keys and counts to the parts, which are ranges of keys, as one row for each; a
    part adds up its keys and answers with totals in the order of the keys that were sent. Chunks and parts
    grow in number with the corpus, not in size, and there are never more rows than keys. Even parts are of two in a row, odd ones of three.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, chunk in zip(batch["chunk"].to_pylist(), _chunks(batch, window, start), strict=True):
                rows = []
                for kind, (_, keys) in enumerate(_run_keys(chunk, bits)):
                    found, times = np.unique(keys, return_counts=True)
                    at = _cuts(found, bits, n)
                    rows += [(number, 2 * k + kind, _squeezed(np.diff(found[i:j], prepend=np.uint64(0))), _squeezed(times[i:j].astype(np.int32))) for k, (i, j) in enumerate(zip(at[:-1], at[1:], strict=True)) if j > i]
                columns = list(zip(*rows, strict=True)) or [[]] * 4
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "part", "keys", "counts"])

    def add(table: pa.Table) -> pa.Table:
        sent = [np.cumsum(_loosened(x, np.uint64), dtype=np.uint64) for x in table["keys"].to_pylist()]
        _, place = np.unique(np.concatenate(sent), return_inverse=True)
        totals = np.bincount(place, weights=np.concatenate([_loosened(x, np.int32) for x in table["counts"].to_pylist()])).astype(np.int64)[place]
        answers = np.split(totals, np.cumsum([len(x) for x in sent])[:-1])
        return pa.table({"chunk": table["chunk"], "part": table["part"], "totals": pa.array([_squeezed(x) for x in answers], pa.binary())})

    sent = chunks.select("chunk", "lengths", "ids").mapInArrow(count, "chunk long, part long, keys binary, counts binary")
    return sent.groupBy("part").applyInArrow(add, "chunk long, part long, totals binary")


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", p: LmParameters = LmParameters(), network: Network | None = None, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, pseudo_log_likelihood, mean_log_probability) of every row's whole text.

    Each token is predicted from those on both sides; a document's score is the sum of these log-probabilities
    (see the module on how the network and the counts make them). Beyond a text's ends stand marks.
    Null, empty and blank texts have no tokens, a sum of 0 and a null mean. Repeated rows count and come
    back as often; ids may be of any type, and null; an empty table gives no rows. Other columns are left
    out. A given ``network`` is used as it is. The token table is written to the shared folder once; a task holds one
    chunk, or a longer single document.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_tokens long, pseudo_log_likelihood double, mean_log_probability double"
    chunks = cut(token_chunks(rows, p, json_path, ranks_path))
    held = chunks.agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("tokens")).first()
    if not held["chunks"]:
        return docs.sparkSession.createDataFrame([], shape)
    network = network or fit_network(chunks, vocabulary_size(json_path), p)
    sent, bits, n = docs.sparkSession.sparkContext.broadcast(network), key_bits(held["tokens"]), held["chunks"]
    totals = run_counts(chunks, n, bits, network.window, network.vocabulary)

    def run(docs_: pa.Table, totals_: pa.Table) -> pa.Table:
        model: Network = sent.value
        chunk = _chunk(docs_["lengths"][0].values.to_numpy(), docs_["ids"][0].as_py(), model.window, model.vocabulary)
        part, answers = totals_["part"].to_numpy(), totals_["totals"].to_pylist()
        times, at = [], chunk.at
        for k, (places, keys) in enumerate(_run_keys(chunk, bits)):
            found = np.concatenate([np.empty(0, np.int64), *(_loosened(answers[i], np.int64) for i in np.argsort(part) if part[i] % 2 == k)])
            times.append(np.zeros(len(chunk.stream)))
            times[k][places] = np.take(found, np.unique(keys, return_inverse=True)[1])
        two, three = times
        prior = p.prior * np.exp(model.log_probabilities(chunk.stream, at))
        # The occurrence that is scored is left out of all counts.
        by_left = (np.take(three, at) - 1 + prior) / (np.take(two, at - 1) - 1 + p.prior)
        by_right = (np.take(three, at + 2) - 1 + prior) / (np.take(two, at + 2) - 1 + p.prior)
        log = np.log((by_left + by_right) / 2)
        ends = np.cumsum(chunk.lengths)
        total = [float(log[j - k : j].sum()) for j, k in zip(ends, chunk.lengths, strict=True)]
        mean = [s / k if k else None for s, k in zip(total, chunk.lengths.tolist(), strict=True)]
        return pa.table({"doc_id": docs_["doc_ids"].chunk(0).flatten() if docs_["doc_ids"].num_chunks else pa.array([]), "n_tokens": pa.array(chunk.lengths), "pseudo_log_likelihood": pa.array(total, pa.float64()), "mean_log_probability": pa.array(mean, pa.float64())})

    return chunks.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(run, shape)
