"""Sites as arrays in every task: which of them hold a place, and how far their boundaries are, a block of places at a time.

Says what the expressions of ``functions.geo`` say, by the same arithmetic in the same order. Tiles are halved where
boundaries run. A tile lists the sites that it lies wholly within, which are not tested, and those whose boundary touches it, each
with the edges that decide there, so that a place meets neither other sites nor other edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Pairs of sites and tiles, and edges that decide in them, up to which an index is made.
MOST_TILES = 28_000_000
MOST_EDGES = 60_000_000
#: Of how many sides the first tiles are, how often tiles of one side are halved at most, and how near to an edge rounding may matter.
FIRST = 8
HALVINGS = 2
_NEAR = 1e-9
#: Share of the numbers that a distance in single precision is made of, within which it is right; some ten roundings are.
_ROUGH = 4e-6
#: Pairs that are taken together when tiles are halved from one side on.
_GROUP = 100_000
#: Pairs, or edges of pairs, that are held at once.
_BLOCK = 32_000


def _coordinates(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, edges) of an array column of edges: the edges of all rows and where each row's begin."""
    lists = column.combine_chunks()
    flat = lists.flatten()
    starts = lists.offsets.to_numpy().astype(np.int64)
    return starts - starts[0], np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in ("x1", "y1", "x2", "y2")])


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, nth): each row number as often as its size says, and the how-manieth of its row each is."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _blocks(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of rows of some ``_BLOCK`` in all, of one row at least."""
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - sizes[i] + _BLOCK, side="right")))
        yield slice(i, j)
        i = j


def _closed(first: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Of each site, whether edges end wherever edges begin: only then what is inside changes nowhere but at an edge."""
    mixed = lambda x, y: ((x + 0.0).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ ((y + 0.0).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    spun = lambda v: (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    ends = spun(mixed(edges[0], edges[1])) - spun(mixed(edges[2], edges[3]))
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(ends)]
    return sums[first[1:]] == sums[first[:-1]]


def _rough(starts: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``rough`` and ``middles`` of a ``SiteIndex``."""
    sizes = np.diff(starts)
    middles = np.zeros((3, len(sizes)))
    at = starts[:-1][sizes > 0]
    site = np.repeat(np.arange(len(sizes)), sizes)
    if len(at):
        low, high = (f.reduceat(np.stack([f(x1, x2), f(y1, y2)]), at, axis=1) for f in (np.minimum, np.maximum))
        middles[:2, sizes > 0] = (low + high) / 2
        middles[2, sizes > 0] = (high - low).sum(axis=0)
    dx, dy, length = x2 - x1, y2 - y1, np.hypot(x2 - x1, y2 - y1)
    ux, uy = np.where(length > 0, dx, 1.0) / np.where(length > 0, length, 1.0), dy / np.where(length > 0, length, 1.0)
    mx, my = (x1 + x2) / 2 - middles[0, site], (y1 + y2) / 2 - middles[1, site]
    rough, at = np.empty(5 * len(dx), np.float32), 4 * starts[:-1][site] + np.arange(len(dx))
    for k, values in enumerate((ux, uy, ux * my - uy * mx, ux * mx + uy * my, length / 2)):
        rough[at + k * sizes[site]] = values
    return rough, middles


@dataclass(frozen=True)
class _Tiles:
    """Pairs of a tile and a site that may hold places of it; the edges that decide there, and whether edges that a ray from anywhere in the tile meets are odd."""

    side: float
    x: np.ndarray
    y: np.ndarray
    site: np.ndarray
    odd: np.ndarray
    sizes: np.ndarray
    edges: np.ndarray

    @classmethod
    def joined(cls, parts: list[_Tiles]) -> _Tiles:
        return cls(parts[0].side, *(np.concatenate([getattr(p, k) for p in parts]) for k in ("x", "y", "site", "odd", "sizes", "edges")))

    def blocks(self) -> Iterator[_Tiles]:
        ends = np.r_[0, np.cumsum(self.sizes)]
        for some in _blocks(self.sizes):
            yield _Tiles(self.side, self.x[some], self.y[some], self.site[some], self.odd[some], self.sizes[some], self.edges[ends[some.start] : ends[some.stop]])

    def sorted_out(self, edges: np.ndarray, closed: np.ndarray) -> tuple[_Tiles, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The pairs whose tile a boundary touches, with no other edges than decide, and (x, y, site) of those whose tile is wholly inside."""
        n, e = len(self.site), self.edges
        pair = np.repeat(np.arange(n), self.sizes)
        x1, y1, x2, y2 = np.take(edges, e, axis=1)
        half = self.side / 2 + _NEAR
        mx, my = ((self.x + 0.5) * self.side)[pair], ((self.y + 0.5) * self.side)[pair]
        low, high = np.minimum(y1, y2), np.maximum(y1, y2)
        decides = np.flatnonzero((high >= my - half) & (low <= my + half) & (np.maximum(x1, x2) >= mx - half))
        e, pair, x1, y1, x2, y2, mx, my, low, high = (c[decides] for c in (e, pair, x1, y1, x2, y2, mx, my, low, high))
        dx, dy, up = x2 - x1, y2 - y1, my - y1
        touches = (np.minimum(x1, x2) <= mx + half) & (np.abs(dx * up - dy * (mx - x1)) <= (np.abs(dx) + np.abs(dy)) * (half * (1 + _NEAR)))
        with np.errstate(divide="ignore", invalid="ignore"):
            crossed = ((y1 > my) != (y2 > my)) & (mx < dx * up / dy + x1)
        # An edge beside the tile that begins below and ends above it is met from all of its places or from none.
        passes = (low < my - half) & (high > my + half) & ~touches & closed[self.site][pair]
        odd = self.odd ^ (np.bincount(pair[crossed & passes], minlength=n) % 2 == 1)
        inside = odd ^ (np.bincount(pair[crossed & ~passes], minlength=n) % 2 == 1)
        sizes = np.bincount(pair[~passes], minlength=n).astype(np.int32)
        touched = (np.bincount(pair[touches], minlength=n) > 0) | (~closed[self.site] & (sizes > 0))
        whole = inside & ~touched
        return _Tiles(self.side, self.x[touched], self.y[touched], self.site[touched], odd[touched], sizes[touched], e[~passes & touched[pair]]), (self.x[whole], self.y[whole], self.site[whole])

    def halved(self, boxes: np.ndarray) -> _Tiles:
        """With four tiles for each, but for those beside the site's box."""
        side, parts = self.side / 2, []
        starts = np.cumsum(self.sizes) - self.sizes
        x0, y0, x1, y1 = boxes[:, self.site]
        for i, j in ((0, 0), (0, 1), (1, 0), (1, 1)):
            x, y = 2 * self.x + i, 2 * self.y + j
            met = np.flatnonzero((x1 >= x * side - _NEAR) & (x0 <= (x + 1) * side + _NEAR) & (y1 >= y * side - _NEAR) & (y0 <= (y + 1) * side + _NEAR))
            row, nth = _spread(self.sizes[met])
            parts.append(_Tiles(side, x[met], y[met], self.site[met], self.odd[met], self.sizes[met], self.edges[starts[met][row] + nth]))
        return _Tiles.joined(parts)


def _sorted_out(tiles: _Tiles, edges: np.ndarray, closed: np.ndarray, boxes: np.ndarray | None = None) -> tuple[_Tiles, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``_Tiles.sorted_out``, of halved tiles if there are ``boxes``, some at a time."""
    none = np.empty(0, np.int32)
    side = tiles.side / (1 if boxes is None else 2)
    found, whole = [_Tiles(side, none, none, none, none.astype(bool), none, none)], [(none, none, none)]
    for some in tiles.blocks():
        kept, inner = (some if boxes is None else some.halved(boxes)).sorted_out(edges, closed)
        found.append(kept)
        whole.append(inner)
    return _Tiles.joined(found), tuple(np.concatenate(c) for c in zip(*whole, strict=True))


def _quartered(x: np.ndarray, y: np.ndarray, site: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.concatenate([2 * x, 2 * x, 2 * x + 1, 2 * x + 1]), np.concatenate([2 * y, 2 * y + 1, 2 * y, 2 * y + 1]), np.tile(site, 4)


@dataclass(frozen=True)
class SiteIndex:
    side: float
    tiles: np.ndarray  # sorted codes of tiles
    slots: np.ndarray  # where each tile is in what follows
    whole_starts: np.ndarray  # of the sites that each tile lies wholly within
    whole: np.ndarray
    starts: np.ndarray  # of the sites whose boundary touches each tile
    sites: np.ndarray
    odd: np.ndarray  # whether a ray from the tile meets edges beside it that are odd in number
    edge_starts: np.ndarray  # of the edges of each of these sites that decide in the tile
    edge_list: np.ndarray
    boxes: np.ndarray  # (4, sites)
    edges: np.ndarray  # (edges, 4) in degrees
    metric_starts: np.ndarray
    metric: np.ndarray  # (edges, 5) in metres: x1, y1, how far it goes in x and in y, and the sum of their squares
    rough: np.ndarray  # site by site in single precision, from its middle: directions of its edges in x, in y, how far their middles are across and along them, half their lengths
    middles: np.ndarray  # (3, sites): x and y, and the greatest distance of a vertex in x and y

    @classmethod
    def of(cls, table: pa.Table, side: float) -> SiteIndex | None:
        """The index of ``bbox``, ``edges`` and ``metric_edges``, or none if it would be large even with tiles of ``side``.

        Tiles begin ``FIRST`` times as large, and are halved for as long as the index stays small.
        """
        first, edges = _coordinates(table["edges"])
        metric_starts, (x1, y1, x2, y2) = _coordinates(table["metric_edges"])
        box = table["bbox"].combine_chunks()
        boxes = np.stack([box.field(k).to_numpy(zero_copy_only=False) for k in ("min_x", "min_y", "max_x", "max_y")])
        there = np.flatnonzero(np.isfinite(boxes).all(axis=0) & (np.diff(first) > 0))
        found = cls._first_tiles(boxes, there, first, side * FIRST)
        if found is None:
            return None
        closed = _closed(first, edges)
        found, whole = _sorted_out(found, edges, closed)
        while found.side > side:
            if 4 * len(whole[0]) + 3.2 * len(found.site) > MOST_TILES or 2.5 * len(found.edges) > MOST_EDGES:
                return None
            found, more = _sorted_out(found, edges, closed, boxes)
            whole = tuple(np.concatenate(c) for c in zip(_quartered(*whole), more, strict=True))
        # Of halving come some 2.2 times as many boundary tiles, and as many that are wholly inside as there were boundary tiles.
        inner, outer, times = len(whole[0]), len(found.site), 0
        while times < HALVINGS and 4 * inner + 3.2 * outer <= MOST_TILES and 2 ** (times + 1) * len(found.edges) <= MOST_EDGES:
            inner, outer, times = 4 * inner + 0.8 * outer, 2.1 * outer, times + 1
        parts = [cls._leaves(*some, times, edges, closed, boxes) for some in cls._groups(found, whole, int(_GROUP / 2.2**times) + 1)]
        columns = [*zip(*parts, strict=True)]
        del found, whole, parts
        tiles, whole_sizes, whole, sizes, site, odd, edge_sizes, edge_list = (np.concatenate(columns.pop(0)) for _ in range(8))
        order, starts = np.argsort(tiles), lambda n: np.r_[0, np.cumsum(n)].astype(np.int32)
        return cls(side / 2**times, tiles[order], order, starts(whole_sizes), whole, starts(sizes), site, odd, starts(edge_sizes), edge_list, boxes, np.ascontiguousarray(edges.T), metric_starts, np.stack([x1, y1, x2 - x1, y2 - y1, (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)], axis=1), *_rough(metric_starts, x1, y1, x2, y2))

    @staticmethod
    def _first_tiles(boxes: np.ndarray, there: np.ndarray, first: np.ndarray, side: float) -> _Tiles | None:
        """Each site of ``there`` in each tile that its box touches, with all its edges."""
        low, high = np.floor(boxes[:2, there] / side), np.floor(boxes[2:, there] / side)
        across, up = high - low + 1
        if (across * up).sum() > MOST_TILES or (across * up * np.diff(first)[there]).sum() > MOST_EDGES:
            return None
        low, across, up = low.astype(np.int32), across.astype(np.int32), up.astype(np.int32)
        row, nth = _spread(across * up)
        sizes = np.diff(first)[there[row]].astype(np.int32)
        pair, each = _spread(sizes)
        return _Tiles(side, (low[0, row] + nth // up[row]).astype(np.int32), (low[1, row] + nth % up[row]).astype(np.int32), there[row].astype(np.int32), np.zeros(len(row), bool), sizes, (first[there[row]][pair] + each).astype(np.int32))

    @classmethod
    def _groups(cls, found: _Tiles, whole: tuple[np.ndarray, np.ndarray, np.ndarray], most: int) -> Iterator[tuple[_Tiles, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Runs of whole tiles of some ``most`` pairs; an empty one if there is none."""
        order, inner = np.argsort(cls._code(found.x, found.y), kind="stable"), np.argsort(cls._code(*whole[:2]), kind="stable")
        code, inner_code, whole = cls._code(found.x, found.y)[order], cls._code(*whole[:2])[inner], tuple(c[inner] for c in whole)
        firsts = (np.cumsum(found.sizes) - found.sizes)[order]
        tiles, n = np.unique(np.r_[code, inner_code], return_counts=True)
        cuts = tiles[np.unique(np.searchsorted(np.cumsum(n), np.arange(0, n.sum(), most), side="left"))] if len(tiles) else np.zeros(1, np.int64)
        at, inner_at = (np.r_[np.searchsorted(c, cuts), len(c)] for c in (code, inner_code))
        at[0] = inner_at[0] = 0
        for i in range(len(cuts)):
            some = order[at[i] : at[i + 1]]
            row, nth = _spread(found.sizes[some])
            tiles = _Tiles(found.side, *(c[some] for c in (found.x, found.y, found.site, found.odd, found.sizes)), found.edges[firsts[at[i] : at[i + 1]][row] + nth])
            yield tiles, tuple(c[inner_at[i] : inner_at[i + 1]] for c in whole)

    @classmethod
    def _leaves(cls, found: _Tiles, whole: tuple[np.ndarray, np.ndarray, np.ndarray], times: int, edges: np.ndarray, closed: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(tiles, sites within which each lies wholly, those, sites whose boundary touches each, those, odd, edges of each of these, those), halved ``times``."""
        for _ in range(times):
            found, more = _sorted_out(found, edges, closed, boxes)
            whole = tuple(np.concatenate(c) for c in zip(_quartered(*whole), more, strict=True))
        code, inner_code = cls._code(found.x, found.y), cls._code(*whole[:2])
        order, inner = np.argsort(code, kind="stable"), np.argsort(inner_code, kind="stable")
        tiles = np.unique(np.r_[code, inner_code])
        sizes = found.sizes[order]
        row, nth = _spread(sizes)
        count = lambda codes: np.bincount(np.searchsorted(tiles, codes), minlength=len(tiles)).astype(np.int32)
        return tiles, count(inner_code), whole[2][inner], count(code), found.site[order], found.odd[order], sizes, found.edges[(np.cumsum(found.sizes) - found.sizes)[order][row] + nth]

    @staticmethod
    def _code(tx: np.ndarray, ty: np.ndarray) -> np.ndarray:
        return (tx.astype(np.int64) << 32) + ty

    def holding(self, x: np.ndarray, y: np.ndarray, boundary: bool) -> tuple[np.ndarray, np.ndarray]:
        """(place, site) of each place and each site that holds it, by place; with ``boundary`` also those whose boundary it is on."""
        known = np.flatnonzero(np.isfinite(x) & np.isfinite(y))
        code = self._code(np.floor(x[known] / self.side).astype(np.int64), np.floor(y[known] / self.side).astype(np.int64))
        tile = np.searchsorted(self.tiles, code)
        met = tile < len(self.tiles)
        met[met] = self.tiles[tile[met]] == code[met]
        known, tile = known[met], self.slots[tile[met]]
        found = [(np.empty(0, np.int64), np.empty(0, np.int32))]
        inner, sizes = self.whole_starts[tile + 1] - self.whole_starts[tile], self.starts[tile + 1] - self.starts[tile]
        for some in _blocks(inner + sizes):
            at = tile[some]
            row, nth = _spread(sizes[some])
            entry, row = self._tested(x, y, known[some], self.starts[at][row] + nth, row, boundary)
            site, tested = self.sites[entry], np.bincount(row, minlength=len(at))
            n = inner[some] + tested
            ends, out = np.cumsum(n), np.empty(n.sum(), np.int32)
            begins = ends - n
            of, nth = _spread(inner[some])
            out[begins[of] + nth] = self.whole[self.whole_starts[at][of] + nth]
            out[np.arange(len(site)) + np.repeat(begins + inner[some] - (np.cumsum(tested) - tested), tested)] = site
            found.append((np.repeat(known[some], n), out))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def _tested(self, x: np.ndarray, y: np.ndarray, known: np.ndarray, entry: np.ndarray, row: np.ndarray, boundary: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of an entry and a row of ``known``, those whose site holds the place."""
        n = self.edge_starts[entry + 1] - self.edge_starts[entry]
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for part in _blocks(n):
            e, r = entry[part], row[part]
            inside = self._inside(x[known[r]], y[known[r]], e, n[part], boundary)
            found.append((e[inside], r[inside]))
        entry, row = (np.concatenate(c) for c in zip(*found, strict=True))
        x0, y0, x1, y1 = np.take(self.boxes, self.sites[entry], axis=1)
        px, py = x[known[row]], y[known[row]]
        near = (px >= x0) & (px <= x1) & (py >= y0) & (py <= y1)
        return entry[near], row[near]

    def _inside(self, x: np.ndarray, y: np.ndarray, entry: np.ndarray, n: np.ndarray, boundary: bool) -> np.ndarray:
        pair, nth = _spread(n)
        e = self.edge_list[self.edge_starts[entry][pair] + nth]
        x1, y1, x2, y2 = np.take(self.edges, e, axis=0).T
        x, y = x[pair], y[pair]
        dx, dy, across, up = x2 - x1, y2 - y1, x - x1, y - y1
        with np.errstate(divide="ignore", invalid="ignore"):
            crossed = ((y1 > y) != (y2 > y)) & (x < dx * up / dy + x1)
        on = np.flatnonzero(dx * up - dy * across == 0)
        on = on[(np.minimum(x1, x2)[on] <= x[on]) & (x[on] <= np.maximum(x1, x2)[on]) & (np.minimum(y1, y2)[on] <= y[on]) & (y[on] <= np.maximum(y1, y2)[on])]
        inside = np.add.reduceat(crossed.view(np.int8), np.cumsum(n) - n) % 2 == 1
        inside ^= self.odd[entry]
        inside[pair[on]] = boundary
        return inside

    def to_boundary(self, x: np.ndarray, y: np.ndarray, site: np.ndarray) -> np.ndarray:
        """Metres from each place, in metres, to the boundary of its site."""
        out = np.empty(len(site))
        n = np.diff(self.metric_starts)[site]
        for some in _blocks(n):
            sizes = n[some]
            same = sizes.min() == sizes.max()
            for size in sizes[:1] if same else np.unique(sizes):
                which = some if same else some.start + np.flatnonzero(sizes == size)
                out[which] = self._nearest_edge(x[which], y[which], site[which], size)
        return out

    def _nearest_edge(self, x: np.ndarray, y: np.ndarray, site: np.ndarray, size: int) -> np.ndarray:
        """Metres from each place to the nearest of its site's edges, ``size`` in number.

        They are compared in single precision; those that can be the nearest, mostly one, are measured in double.
        """
        first, (mx, my, extent) = self.metric_starts[site], np.take(self.middles, site, axis=1)
        px, py = x - mx, y - my
        slack = (_ROUGH * (np.abs(px) + np.abs(py) + extent)).astype(np.float32)
        px, py = px.astype(np.float32)[:, None], py.astype(np.float32)[:, None]
        rough = np.lib.stride_tricks.sliding_window_view(self.rough, 5 * size)[5 * first]
        ux, uy, across, along, half = (rough[:, k * size : (k + 1) * size] for k in range(5))
        squares = ux * py
        squares -= uy * px
        squares -= across
        squares *= squares
        ux *= px
        uy *= py
        ux += uy
        ux -= along
        np.abs(ux, out=ux)
        ux -= half
        np.maximum(ux, 0, out=ux)
        ux *= ux
        squares += ux
        least = squares
        while least.shape[1] > 1:  # numpy takes the least of short rows one row at a time
            middle = (least.shape[1] + 1) // 2
            least = np.minimum(least[:, :middle], least[:, least.shape[1] - middle :])
        least = np.sqrt(least[:, 0]) + slack
        at = np.flatnonzero(~(squares > (least * least)[:, None]))
        row = at // size
        x1, y1, dx, dy, norm = np.take(self.metric, first[row] + (at - row * size), axis=0).T
        x, y = x[row], y[row]
        t = np.maximum(0.0, np.minimum(1.0, ((x - x1) * dx + (y - y1) * dy) / np.where(norm > 0, norm, 1.0)))
        ex, ey = x - (x1 + t * dx), y - (y1 + t * dy)
        return np.sqrt(np.minimum.reduceat(ex * ex + ey * ey, np.flatnonzero(np.r_[True, row[1:] != row[:-1]])))
