"""GeoPackage layers (SQLite files) as tables with polygon rings, and back."""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

Ring = list[tuple[float, float]]
_HEADER_BOXES = (0, 32, 48, 48, 64)
_SQL_TYPES = {"INTEGER": "long", "INT": "long", "MEDIUMINT": "long", "SMALLINT": "long", "TINYINT": "long", "BOOLEAN": "long", "REAL": "double", "DOUBLE": "double", "FLOAT": "double"}


def parse_wkb(data: bytes, at: int = 0) -> tuple[str, list[Ring], list[int], int]:
    """(kind, rings, parts, end) of a point, polygon or multipolygon; extra dimensions are dropped, a point is a ring of one.

    ``parts`` has the number of each ring's polygon, whose first ring is the outer one.
    """
    order = "<" if data[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    if code & 0x20000000:  # an extended code carries a reference system
        at += 4
    base = code & 0xFFFF
    dims = 2 + ((base // 1000 in (1, 2)) + 2 * (base // 1000 == 3)) + bool(code & 0x80000000) + bool(code & 0x40000000)
    kind = base % 1000

    def points(n: int, at: int) -> tuple[Ring, int]:
        flat = struct.unpack_from(f"{order}{n * dims}d", data, at)
        return [(flat[i], flat[i + 1]) for i in range(0, n * dims, dims)], at + 8 * n * dims

    if kind == 1:
        ring, at = points(1, at)
        return "POINT", [ring], [0], at
    (n,) = struct.unpack_from(order + "I", data, at)
    at += 4
    rings: list[Ring] = []
    if kind == 3:
        for _ in range(n):
            (m,) = struct.unpack_from(order + "I", data, at)
            ring, at = points(m, at + 4)
            rings.append(ring)
        return "POLYGON", rings, [0] * n, at
    if kind == 6:
        parts: list[int] = []
        for k in range(n):
            _, part, _, at = parse_wkb(data, at)
            rings += part
            parts += [k] * len(part)
        return "MULTIPOLYGON", rings, parts, at
    raise ValueError(f"geometry type {kind} is not supported")


def parse_blob(blob: bytes | None) -> tuple[int | None, str | None, list[Ring] | None, list[int] | None]:
    """(srid, kind, rings, parts) of a GeoPackage geometry; null for null and empty ones."""
    if not blob:
        return None, None, None, None
    if blob[:2] != b"GP":
        return None, *parse_wkb(blob)[:3]
    flags = blob[3]
    (srid,) = struct.unpack_from("<i" if flags & 1 else ">i", blob, 4)
    if flags & 16:
        return srid, "EMPTY", [], []
    return srid, *parse_wkb(blob, 8 + _HEADER_BOXES[flags >> 1 & 7])[:3]


def polygon_wkb(rings: Sequence[Ring]) -> bytes:
    out = [struct.pack("<BII", 1, 3, len(rings))]
    for ring in rings:
        out.append(struct.pack("<I", len(ring)))
        out += [struct.pack("<dd", *p) for p in ring]
    return b"".join(out)


def _holds(ring: Ring, x: float, y: float) -> bool:
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def polygons_of(rings: Sequence[Ring], parts: Sequence[int] | None = None) -> list[list[Ring]]:
    """Rings as polygons, each an outer ring and its holes.

    Without ``parts`` a ring within an odd number of others, told by the middle of its first edge, is a hole of the
    innermost outer ring around it, whatever way it is wound.
    """
    if parts is not None:
        return [[r for r, k in zip(rings, parts, strict=True) if k == part] for part in dict.fromkeys(parts)]
    middle = [((r[0][0] + r[1][0]) / 2, (r[0][1] + r[1][1]) / 2) if len(r) > 1 else r[0] for r in rings]
    around = [[j for j, o in enumerate(rings) if j != i and _holds(o, *middle[i])] for i in range(len(rings))]
    outer = {i: [rings[i]] for i, over in enumerate(around) if len(over) % 2 == 0}
    for i, over in enumerate(around):
        if i not in outer:
            outer[max((j for j in over if j in outer), key=lambda j: len(around[j]))].append(rings[i])
    return list(outer.values())


def to_wkb(rings: Sequence[Ring], parts: Sequence[int] | None = None) -> bytes:
    """A ring of one place as a point, one polygon as such, more as a multipolygon."""
    if len(rings) == 1 and len(rings[0]) == 1:
        return struct.pack("<BIdd", 1, 1, *rings[0][0])
    polygons = polygons_of(rings, parts)
    if len(polygons) == 1:
        return polygon_wkb(polygons[0])
    return struct.pack("<BII", 1, 6, len(polygons)) + b"".join(map(polygon_wkb, polygons))


def to_blob(rings: Sequence[Ring] | None, srid: int, parts: Sequence[int] | None = None) -> bytes | None:
    """A GeoPackage geometry; null for null, marked as empty without rings."""
    if rings is None:
        return None
    if not rings:
        return b"GP\x00\x11" + struct.pack("<i", srid) + struct.pack("<BII", 1, 6, 0)
    return b"GP\x00\x01" + struct.pack("<i", srid) + to_wkb(rings, parts)


def _layer(db: sqlite3.Connection, layer: str | None) -> tuple[str, str, int]:
    """(table, geometry column, srid) of a layer; the first one where none is named."""
    rows = db.execute("SELECT c.table_name, g.column_name, g.srs_id FROM gpkg_contents c JOIN gpkg_geometry_columns g USING (table_name) WHERE c.data_type = 'features' ORDER BY c.rowid").fetchall()
    for row in rows:
        if layer in (None, row[0]):
            return row
    raise ValueError(f"no layer {layer or ''} in the file")


class GeoPackage(DataSource):
    """``spark.read.format("geopackage").option("path", ...).option("layer", ...)``.

    Columns: ``index_right`` (position in the layer), the attributes, ``srid``, ``geometry_type``, ``rings`` and ``ring_parts``
    (the number of each ring's polygon, whose first ring is the outer one).
    Ranges of row ids are read by separate tasks. The path must be readable on executors.
    """

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def _fields(self) -> list[tuple[str, str]]:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            table, geometry, _ = _layer(db, self.options.get("layer"))
            info = db.execute(f'PRAGMA table_info("{table}")').fetchall()
        return [(c[1], _SQL_TYPES.get(c[2].split("(")[0].upper(), "string")) for c in info if c[1] != geometry and not c[5]]

    def schema(self) -> str:
        fields = "".join(f"`{n}` {k}, " for n, k in self._fields())
        return f"index_right long, {fields}srid int, geometry_type string, rings array<array<struct<x: double, y: double>>>, ring_parts array<int>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _LayerReader(dict(self.options), [n for n, _ in self._fields()])


class _LayerReader(DataSourceReader):
    def __init__(self, options: dict, fields: list[str]):
        self.options, self.fields = options, fields

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True)

    def partitions(self) -> Sequence[InputPartition]:
        with self._open() as db:
            table, _, _ = _layer(db, self.options.get("layer"))
            step = int(self.options.get("rows", 5000))
            starts = [r for (r,) in db.execute(f'SELECT r FROM (SELECT rowid AS r, row_number() OVER (ORDER BY rowid) - 1 AS k FROM "{table}") WHERE k % {step} = 0 ORDER BY r')]
        return [InputPartition((k * step, r, starts[k + 1] if k + 1 < len(starts) else None)) for k, r in enumerate(starts)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        position, first, stop = partition.value
        with self._open() as db:
            table, geometry, srid = _layer(db, self.options.get("layer"))
            columns = "".join(f'"{f}", ' for f in self.fields)
            rows = db.execute(f'SELECT {columns}"{geometry}" FROM "{table}" WHERE rowid >= ? AND (? IS NULL OR rowid < ?) ORDER BY rowid', (first, stop, stop))
            for k, row in enumerate(rows):
                own, kind, rings, parts = parse_blob(row[-1])
                yield (position + k, *row[:-1], own if own is not None else srid, kind, rings, parts)


def read_layer(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    spark.dataSource.register(GeoPackage)
    reader = spark.read.format("geopackage").option("path", path)
    return (reader.option("layer", layer) if layer else reader).load()


def write_layer(df: DataFrame, path: str, layer: str, srid: int = 4326, geometry: str | tuple[str, str] = "rings") -> int:
    """A table as a layer of a GeoPackage on the driver, row by row; returns the rows.

    ``geometry`` is a column of rings (polygons or multipolygons, parted by ``ring_parts`` if there is such a column), or a
    pair of columns, longitude and latitude, of points; a row without a coordinate has a null geometry. The layer's type is
    that of its geometries, or GEOMETRY where they differ.
    """
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "float": "REAL", "boolean": "INTEGER"}
    fields = [(n, kinds.get(k, "TEXT")) for n, k in df.dtypes if n != geometry and not k.startswith(("array", "struct", "map"))]
    with_parts = isinstance(geometry, str) and "ring_parts" in df.columns
    n, types, box = 0, set(), [float("inf"), float("inf"), float("-inf"), float("-inf")]
    with sqlite3.connect(path) as db:
        db.execute("PRAGMA application_id = 1196444487")
        db.execute("CREATE TABLE IF NOT EXISTS gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT)")
        db.execute("CREATE TABLE IF NOT EXISTS gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT, description TEXT DEFAULT '', last_change TEXT DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now')), min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER)")
        db.execute("CREATE TABLE IF NOT EXISTS gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL)")
        db.execute("INSERT OR IGNORE INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srid}", srid, srid))
        db.execute(f'DROP TABLE IF EXISTS "{layer}"')
        db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, geom BLOB{"".join(f", {chr(34)}{f}{chr(34)} {k}" for f, k in fields)})')
        marks = ", ".join("?" * (len(fields) + 1))
        names = "".join(f', "{f}"' for f, _ in fields)
        for row in df.toLocalIterator():
            if isinstance(geometry, str):
                rings = None if row[geometry] is None else [[(p["x"], p["y"]) for p in r] for r in row[geometry]]
            else:
                place = tuple(row[c] for c in geometry)
                rings = None if None in place else [[tuple(map(float, place))]]
            blob = to_blob(rings, srid, row["ring_parts"] if with_parts else None)
            for x, y in (p for r in rings or () for p in r):
                box = [min(box[0], x), min(box[1], y), max(box[2], x), max(box[3], y)]
            if blob is not None:
                types.add(parse_blob(blob)[1])
            db.execute(f'INSERT INTO "{layer}" (geom{names}) VALUES ({marks})', (blob, *(row[f] for f, _ in fields)))
            n += 1
        extent = box if box[0] <= box[2] else [None] * 4
        db.execute("INSERT OR REPLACE INTO gpkg_contents (table_name, data_type, identifier, min_x, min_y, max_x, max_y, srs_id) VALUES (?, 'features', ?, ?, ?, ?, ?, ?)", (layer, layer, *extent, srid))
        kind = types.pop() if len(types - {"EMPTY"}) == len(types) == 1 else "GEOMETRY"
        db.execute("INSERT OR REPLACE INTO gpkg_geometry_columns VALUES (?, 'geom', ?, ?, 0, 0)", (layer, kind, srid))
    db.close()
    return n
