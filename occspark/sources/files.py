"""Readers and writers of delimited files, also inside ZIP archives."""

from __future__ import annotations

import csv
import io
import os
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import RAW_COLUMNS

BATCH = 50_000

SPECIES_LIST = "occurrenceId string, verbatimScientificName string, scientificName string, key string, matchType string, confidence string, status string, rank string, kingdom string, phylum string, class string, `order` string, family string, genus string, species string, canonicalName string, authorship string, usageKey long, acceptedUsageKey long"


def _open(path: str):
    """A seekable file of any store that pyarrow knows; plain paths are local."""
    if "://" not in path and not path.startswith("file:"):
        return open(path, "rb")
    store, at = pafs.FileSystem.from_uri(path)
    return store.open_input_file(at)


class ZipTable(DataSource):
    """``spark.read.format("zip_table").option("path", ...)``: a delimited member of each ZIP, columns as text.

    Options: ``path`` (comma-separated for several archives), ``member`` (default: the only or the first
    file ending in .csv, .tsv or .txt), ``sep``, ``quote`` (empty: none), ``columns``. One task reads one
    archive as a stream in batches of bounded size, since ZIP members cannot be split: store the result
    as Parquet once.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_table"

    def _header(self) -> list[str]:
        o = self.options
        with _open(_paths(o)[0]) as f, zipfile.ZipFile(f) as z, z.open(_member(z, o)) as raw:
            return next(csv.reader(io.TextIOWrapper(raw, "utf-8"), **_dialect(o)))

    def schema(self) -> StructType:
        header = self._header()
        wanted = [c for c in self.options.get("columns", "").split(",") if c]
        # Columns that the file lacks are silently absent.
        return StructType([StructField(c, StringType()) for c in header if not wanted or c in wanted])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ZipReader(dict(self.options), schema)


def _paths(options) -> list[str]:
    return [p for p in options["path"].split(",") if p]


def _member(z: zipfile.ZipFile, options) -> str:
    names, wanted = z.namelist(), options.get("member")
    if wanted:
        if wanted not in names:
            raise FileNotFoundError(f"{wanted} is not in the archive")
        return wanted
    found = [n for n in names if n.lower().endswith((".csv", ".tsv", ".txt"))]
    if not found:
        raise FileNotFoundError("the archive has no delimited file")
    return found[0]


def _dialect(options) -> dict:
    quote = options.get("quote", '"')
    common = {"delimiter": options.get("sep", ",").replace("\\t", "\t")}
    return common | ({"quotechar": quote} if quote else {"quoting": csv.QUOTE_NONE})


class _ZipReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.options, self.names = options, schema.fieldNames()

    def partitions(self) -> Sequence[InputPartition]:
        return [InputPartition(p) for p in _paths(self.options)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(1 << 30)
        with _open(partition.value) as f, zipfile.ZipFile(f) as z, z.open(_member(z, self.options)) as raw:
            rows = csv.reader(io.TextIOWrapper(raw, "utf-8", newline=""), **_dialect(self.options))
            header = next(rows)
            places = [header.index(n) if n in header else -1 for n in self.names]
            columns: list[list] = [[] for _ in self.names]
            for row in rows:
                for column, k in zip(columns, places, strict=True):
                    column.append(row[k] if 0 <= k < len(row) and row[k] != "" else None)
                if columns and len(columns[0]) >= BATCH:
                    yield self._batch(columns)
                    columns = [[] for _ in self.names]
            if columns and columns[0]:
                yield self._batch(columns)

    def _batch(self, columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=self.names)


def read_zip(spark: SparkSession, path: str, member: str | None = None, sep: str = ",", quote: str = '"', columns: Sequence[str] = ()) -> DataFrame:
    spark.dataSource.register(ZipTable)
    reader = spark.read.format("zip_table").option("path", path).option("sep", sep).option("quote", quote).option("columns", ",".join(columns))
    return (reader.option("member", member) if member else reader).load()


def read_archive(spark: SparkSession, path: str, member: str = "occurrence.txt") -> DataFrame:
    """The raw records of a download archive: an unquoted tab-separated member, projected to the known columns."""
    return read_zip(spark, path, member, "\t", "", RAW_COLUMNS)


def read_species_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=SPECIES_LIST, quote='"', escape='"')


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Unpacked raw records: text columns, no quoting, so a stray quote does not swallow lines."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=False, quote="")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_file(path: str) -> str:
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return path


def write_csv(df: DataFrame, path: str) -> None:
    """A result table as one CSV file with a header in a folder."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_zip_csv(df: DataFrame, path: str, member: str = "occurrences.csv", sep: str = ",") -> int:
    """A table as a delimited file inside a ZIP on the driver; rows come partition by partition. Returns their number."""
    n = 0
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open(member, "w", force_zip64=True) as raw:
        out = io.TextIOWrapper(raw, "utf-8", newline="")
        writer = csv.writer(out, delimiter=sep, lineterminator="\n")
        writer.writerow(df.columns)
        for row in df.toLocalIterator(prefetchPartitions=True):
            writer.writerow(["" if v is None else v for v in row])
            n += 1
        out.flush()
    return n
