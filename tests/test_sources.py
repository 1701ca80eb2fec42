import zipfile

import pytest

from occspark.operators import clean, profile, readiness, report, summaries
from occspark.operators.predicates import FilterSpec
from occspark.schemas import RAW_COLUMNS
from occspark.sources import download, files, geopackage
from occspark.streaming.counters import stored_counters, stream_counters

ROWS = [
    ["1", "2", 'A "quoted b', "50", "5", "DE", "HUMAN_OBSERVATION", "10", "2000", "1", "2000-01-01"],
    ["2", "3", "C d", "51", "6", "FR", "PRESERVED_SPECIMEN", "", "2001", "2", "2001-02"],
    ["3", "3", "C d", "bad", "6", "FR", "PRESERVED_SPECIMEN", "", "2001", "2", ""],
]


def tsv(rows=ROWS):
    return "\n".join("\t".join(r) for r in [[*RAW_COLUMNS, "more"], *([*r, "x"] for r in rows)]) + "\n"


@pytest.fixture
def archive(tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("occurrence.txt", tsv())
        z.writestr("meta.xml", "<x/>")
    return path


def test_archive(spark, archive):
    raw = files.read_archive(spark, archive)
    assert raw.columns == RAW_COLUMNS and raw.count() == 3
    assert raw.filter("gbifID = '1'").first()["scientificName"] == 'A "quoted b'
    assert clean.filter_occurrences(raw).count() == 2
    with pytest.raises(Exception, match="not in the archive"):
        files.read_zip(spark, archive, "nope.txt").count()


def test_zip_round_trip(spark, archive, tmp_path):
    kept = clean.filter_occurrences(files.read_archive(spark, archive)).orderBy("gbifID")
    out = str(tmp_path / "out.zip")
    assert files.export_zip_csv(kept, out) == 2
    back = files.read_zip(spark, out)
    assert [r["scientificName"] for r in back.orderBy("gbifID").collect()] == ['A "quoted b', "C d"]
    assert back.columns == RAW_COLUMNS


def test_geopackage_round_trip(spark, tmp_path):
    rings = [[(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)], [(0.1, 0.2), (0.1, 0.3), (0.2, 0.3), (0.1, 0.2)]]
    df = spark.createDataFrame([("A", 1, rings), ("B", 2, None)], "SITECODE string, n long, rings array<array<struct<x double, y double>>>")
    path = str(tmp_path / "x.gpkg")
    assert geopackage.write_layer(df, path, "sites") == 2
    for layer in ("sites", None):
        back = {r["SITECODE"]: r for r in geopackage.read_layer(spark, path, layer).collect()}
        assert [[tuple(p) for p in r] for r in back["A"]["rings"]] == rings
        assert back["A"]["srid"] == 4326 and back["A"]["geometry_type"] == "POLYGON" and back["B"]["rings"] is None and back["B"]["n"] == 2
    with pytest.raises(Exception, match="no layer"):
        geopackage.read_layer(spark, path, "other").count()


def test_wkb_kinds():
    import struct

    ring = [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0)]
    one = geopackage.polygon_wkb([ring])
    multi = struct.pack("<BII", 1, 6, 2) + one + one
    assert geopackage.parse_wkb(multi)[:2] == ("MULTIPOLYGON", [ring, ring])
    big = struct.pack(">BI", 0, 1) + struct.pack(">dd", 2.0, 3.0)
    assert geopackage.parse_wkb(big)[:2] == ("POINT", [[(2.0, 3.0)]])
    z = struct.pack("<BII", 1, 1003, 1) + struct.pack("<I", 2) + struct.pack("<6d", 1, 2, 9, 3, 4, 9)
    assert geopackage.parse_wkb(z)[1] == [[(1.0, 2.0), (3.0, 4.0)]]
    with pytest.raises(ValueError):
        geopackage.parse_wkb(struct.pack("<BII", 1, 2, 0))


def test_download(tmp_path):
    said = iter(["PREPARING", "RUNNING", "SUCCEEDED"])
    calls, slept = [], []

    def transport(method, url, body):
        calls.append((method, url))
        if method == "POST":
            return 201, b"key-1\n"
        return 200, b"x" * 20000 if url.endswith(".zip") else b'{"status": "%s"}' % next(said).encode()

    client = download.DownloadClient("https://example.org/download", transport, slept.append)
    key = client.submit(download.request_document(download.Credentials("u", "p", "e"), download.request_predicate([5, 7])))
    client.wait(key)
    path = client.fetch(key, str(tmp_path), "IAS")
    assert key == "key-1" and slept == [20, 20] and len(open(path, "rb").read()) == 20000
    busy = download.DownloadClient("https://example.org", lambda *a: (420, b""))
    with pytest.raises(RuntimeError, match="too many"):
        busy.submit("{}")


def test_geopackage_types(spark, tmp_path):
    sq = lambda x, y, w: [(x, y), (x, y + w), (x + w, y + w), (x + w, y), (x, y)]
    rows = [("two", [sq(0.0, 0.0, 1.0), sq(5.0, 5.0, 1.0)[::-1]]), ("holes", [sq(0.0, 0.0, 9.0), sq(20.0, 0.0, 9.0), sq(1.0, 1.0, 5.0), sq(2.0, 2.0, 1.0), sq(21.0, 1.0, 1.0)[::-1]]), ("none", None), ("empty", [])]
    df = spark.createDataFrame(rows, "SITECODE string, rings array<array<struct<x double, y double>>>")
    path = str(tmp_path / "m.gpkg")
    assert geopackage.write_layer(df, path, "areas") == 4
    back = {r["SITECODE"]: r for r in geopackage.read_layer(spark, path).collect()}
    assert [back[k]["geometry_type"] for k in ("two", "holes", "none", "empty")] == ["MULTIPOLYGON", "MULTIPOLYGON", None, "EMPTY"]
    assert back["two"]["ring_parts"] == [0, 1] and [[tuple(p) for p in r] for r in back["two"]["rings"]] == rows[0][1]
    said = dict(zip((tuple(map(tuple, r)) for r in back["holes"]["rings"]), back["holes"]["ring_parts"], strict=True))
    part = [said[tuple(r)] for r in rows[1][1]]
    assert part[0] == part[2] and part[1] == part[4] and len({part[0], part[1], part[3]}) == 3  # an island in a hole is a part
    points = spark.createDataFrame([(i, None if i == 3 else i / 2, 1.0) for i in range(12)], "gbifID long, decimalLongitude double, decimalLatitude double")
    assert geopackage.write_layer(points, path, "points", geometry=("decimalLongitude", "decimalLatitude")) == 12
    spark.dataSource.register(geopackage.GeoPackage)
    got = spark.read.format("geopackage").option("path", path).option("layer", "points").option("rows", "5").load()
    assert got.rdd.getNumPartitions() == 3
    got = {r["index_right"]: r for r in got.collect()}
    assert sorted(got) == list(range(12)) and got[3]["rings"] is None and got[3]["decimalLongitude"] is None
    assert all(got[i]["geometry_type"] == "POINT" and tuple(got[i]["rings"][0][0]) == (i / 2, 1.0) and got[i]["gbifID"] == i for i in range(12) if i != 3)
    import sqlite3

    with sqlite3.connect(path) as db:
        assert dict(db.execute("SELECT table_name, geometry_type_name FROM gpkg_geometry_columns")) == {"areas": "GEOMETRY", "points": "POINT"}
        assert db.execute("SELECT min_x, max_x FROM gpkg_contents WHERE table_name = 'points'").fetchone() == (0.0, 5.5)


def test_credentials(monkeypatch):
    monkeypatch.delenv("OCC_USER", raising=False)
    with pytest.raises(ValueError):
        download.Credentials.from_environment("OCC")


def test_reports(spark, archive, tmp_path):
    raw = files.read_archive(spark, archive)
    kept = clean.filter_occurrences(raw)
    text = report.filter_text(raw.count(), kept, "IAS", {"max_uncertainty": 1000})
    assert "Filtered records: 2 (66.67%)" in text and "C d: 1 (50.00%)" in text
    assert "No records left" in report.filter_text(3, kept.limit(0), "IAS", {})
    assert "eventDate" in report.profile_text(profile.full_profile(kept), "IAS")
    said = report.readiness_text(readiness.readiness_report(raw, "IAS"), "IAS")
    assert "[FAIL]" in said and "Final Assessment" in said
    report.write_text(report.table_text("T", ("counts", summaries.counters(kept))), str(tmp_path / "r" / "t.txt"))
    assert (tmp_path / "r" / "t.txt").read_text().startswith("T\n=")


def test_stream_counts_equal_batch_counts(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "1.tsv").write_text(tsv())
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")
    stream_counters(spark, str(inbox), store, checkpoint).awaitTermination()
    (inbox / "2.tsv").write_text(tsv([["9", *r[1:]] for r in ROWS]))
    stream_counters(spark, str(inbox), store, checkpoint).awaitTermination()
    want = summaries.counters(clean.filter_occurrences(files.read_tsv(spark, str(inbox)).select(*RAW_COLUMNS), FilterSpec()))
    assert sorted(map(tuple, stored_counters(spark, store).collect())) == sorted(map(tuple, want.collect()))


def test_daily_counts_close_when_late_rows_can_no_longer_come(spark, tmp_path):
    from pyspark.sql import functions as F

    from occspark.streaming.counters import daily_counts

    inbox, store = tmp_path / "in", str(tmp_path / "out")
    rows = [("2024-01-01 05:00:00", "a"), ("2024-01-01 23:59:59", "a"), ("2024-01-01 00:00:00", "b"), ("2024-01-02 00:00:00", "a"), ("2024-01-09 00:00:00", "z")]
    df = spark.createDataFrame(rows, "t string, kind string").select(F.to_timestamp("t").alias("t"), "kind")
    df.write.parquet(str(inbox))
    stream = spark.readStream.schema("t timestamp, kind string").parquet(str(inbox))
    out = daily_counts(stream, "t", "kind").writeStream.format("parquet").option("path", store).option("checkpointLocation", str(tmp_path / "check")).outputMode("append").trigger(availableNow=True).start()
    assert out.awaitTermination(120)
    spark.createDataFrame([("2024-01-01 12:00:00", "a"), ("2024-01-12 00:00:00", "z")], "t string, kind string").select(F.to_timestamp("t").alias("t"), "kind").write.mode("append").parquet(str(inbox))
    again = daily_counts(stream, "t", "kind").writeStream.format("parquet").option("path", store).option("checkpointLocation", str(tmp_path / "check")).outputMode("append").trigger(availableNow=True).start()
    assert again.awaitTermination(120)
    got = sorted((str(r["day"]["start"])[:10], r["kind"], r["n"]) for r in spark.read.parquet(store).collect())
    assert got == [("2024-01-01", "a", 2), ("2024-01-01", "b", 1), ("2024-01-02", "a", 1), ("2024-01-09", "z", 1)]  # the late row is left out


def test_guards(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.require_file(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        files.require_rows(spark.createDataFrame([], "a long"), "table")
    with pytest.raises(ValueError):
        files.require_columns(spark.createDataFrame([], "a long"), "b")


def test_run_log(tmp_path):
    from datetime import datetime

    from occspark.sources.runlog import run_log

    log = run_log(str(tmp_path), "readiness", datetime(2025, 1, 2, 3, 4))
    log.info("12 rows")
    assert (tmp_path / "readiness_20250102_0304.log").read_text().rstrip().endswith("- 12 rows")


def test_filters_reach_the_scan(spark, tmp_path):
    from occspark.operators.predicates import basis_filter, uncertainty_filter

    path = f"file://{tmp_path}/o"
    clean.filter_occurrences(spark.createDataFrame([tuple(r) for r in ROWS], ", ".join(f"{c} string" for c in RAW_COLUMNS))).write.parquet(path)
    df = spark.read.parquet(path).filter(basis_filter(FilterSpec()) & uncertainty_filter(FilterSpec())).select("gbifID")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "Or(IsNull(coordin" in pushed and "In(basisOfRecord" in pushed
    assert "scientificName" not in pushed
