"""Figures of a surface as PNG images: maps of cells and histograms.

A map is a raster: each pixel's cell is found by arithmetic, and a join looks its value up, so what comes to the driver
is as many rows as the image has pixels, whatever the size of the grid.
"""

from __future__ import annotations

import struct
import zlib
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import checked, cut
from .hexgrid import axial, centre

# Colours (red, green, blue) of figures; a value between two of a ramp lies between their colours.
WHITE, BLACK = (255, 255, 255), (0, 0, 0)
UNIT, EMPTY, COVERED, HOTSPOT, BAR = (173, 216, 230), (211, 211, 211), (65, 105, 225), (220, 20, 60), (31, 119, 180)
RAMP = ((20, 20, 60), (40, 80, 140), (40, 150, 140), (130, 200, 90), (250, 230, 60))


def raster(cells: DataFrame, a: float, column: str, width: int) -> DataFrame:
    """(px, py, q, r, value): the pixels of an image of ``width`` that lie in a cell of the table, rows of pixels from the north on."""
    c = centre(F.col("q"), F.col("r"), a)
    ends = cells.agg(F.min(c["x"]).alias("x0"), F.max(c["x"]).alias("x1"), F.min(c["y"]).alias("y0"), F.max(c["y"]).alias("y1")).first()
    if ends["x0"] is None:
        return cells.select(F.lit(0).cast("long").alias("px"), F.lit(0).cast("long").alias("py"), "q", "r", F.col(column).alias("value")).limit(0)
    left, top = ends["x0"] - a, ends["y1"] + a
    step = (ends["x1"] - ends["x0"] + 2 * a) / width
    height = max(1, int(np.ceil((ends["y1"] - ends["y0"] + 2 * a) / step)))
    pixels = cells.sparkSession.range(width * height).select((F.col("id") % width).alias("px"), F.floor(F.col("id") / width).alias("py"))
    x, y = F.lit(left) + (F.col("px") + F.lit(0.5)) * F.lit(step), F.lit(top) - (F.col("py") + F.lit(0.5)) * F.lit(step)
    at = pixels.withColumn("c", axial(x, y, a)).select("px", "py", F.col("c.q").alias("q"), F.col("c.r").alias("r"))
    values = cells.select("q", "r", F.col(column).alias("value"))
    return at.join(checked(cut(values)), ["q", "r"]).select("px", "py", "q", "r", "value")


def write_png(path: str, pixels: np.ndarray) -> None:
    """An array (height, width, 3) of bytes as a PNG file."""
    height, width, _ = pixels.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.concatenate([np.zeros((height, 1), dtype=np.uint8), pixels.astype(np.uint8).reshape(height, -1)], axis=1)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 9)) + chunk(b"IEND", b""))


def _shades(values: np.ndarray) -> np.ndarray:
    """Numbers as colours of the ramp, from the least to the greatest."""
    low, high = (values.min(), values.max()) if len(values) else (0.0, 0.0)
    share = (values - low) / (high - low) * (len(RAMP) - 1) if high > low else np.zeros(len(values))
    return np.stack([np.interp(share, range(len(RAMP)), [c[k] for c in RAMP]) for k in range(3)], axis=1)


def map_image(cells: DataFrame, a: float, path: str, column: str, kind: str = "sequential", width: int = 1000) -> tuple[int, int]:
    """A map of cells (columns q, r); returns its width and height.

    ``kind``: "sequential" shades numbers; "flag" has cells above zero in one colour and others grey; "hotspot" likewise in red;
    "units" has all cells alike with their edges. Null values are left white.
    """
    found = raster(cells, a, column, width).select("px", "py", "q", "r", F.col("value").cast("double").alias("value")).toArrow()
    px, py, q, r = (found[c].to_numpy().astype(int) for c in ("px", "py", "q", "r"))
    value = found["value"].to_numpy()
    height = py.max() + 1 if len(py) else 1
    image = np.full((height, width, 3), WHITE, dtype=float)
    there = ~np.isnan(value.astype(float)) if kind != "units" else np.ones(len(px), dtype=bool)
    if kind == "sequential":
        image[py[there], px[there]] = _shades(value[there].astype(float))
    else:
        above = COVERED if kind == "flag" else HOTSPOT
        image[py[there], px[there]] = UNIT if kind == "units" else np.where((value[there] > 0)[:, None], above, EMPTY)
    if kind == "units":
        cell = np.full((height + 1, width + 1), -1, dtype=np.int64)
        cell[py, px] = np.unique(np.stack([q, r], axis=1), axis=0, return_inverse=True)[1].reshape(-1) if len(q) else 0
        image[(cell[:-1, :-1] != cell[1:, :-1]) | (cell[:-1, :-1] != cell[:-1, 1:])] = BLACK
    write_png(path, image)
    return width, height


def histogram_image(histogram: DataFrame, path: str, width: int = 800, height: int = 500, log: bool = False) -> None:
    """The bars of a histogram (as ``surface.histogram``); ``log`` draws the logarithm of their counts, as for skewed ones."""
    n = np.array([row["n"] for row in histogram.orderBy("bin").collect()], dtype=float)
    tall = np.log1p(n) if log else n
    image = np.full((height, width, 3), WHITE, dtype=float)
    edges = np.linspace(10, width - 10, len(n) + 1).astype(int)
    for left, right, share in zip(edges, edges[1:], tall / max(tall.max(initial=0), 1e-12), strict=False):
        image[height - 10 - round(share * (height - 20)) : height - 10, left : max(right - 1, left + 1)] = BAR
    image[height - 10, 10 : width - 10] = BLACK
    image[10 : height - 9, 9] = BLACK
    write_png(path, image)
