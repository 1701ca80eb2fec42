import pytest
from pyspark.sql import functions as F

from occspark.functions.common import is_date_like, percent, to_number
from occspark.operators import clean, profile, readiness, summaries
from occspark.operators.predicates import FilterSpec, predicate
from occspark.schemas import RAW_COLUMNS

SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)


def raw(spark, *rows):
    base = dict(gbifID="1", taxonKey="2", scientificName="A b", decimalLatitude="50", decimalLongitude="5", countryCode="DE", basisOfRecord="HUMAN_OBSERVATION", coordinateUncertaintyInMeters="10", year="2000", month="1", eventDate="2000-01-01")
    return spark.createDataFrame([tuple((base | r)[c] for c in RAW_COLUMNS) for r in rows] or [], SCHEMA)


def kept(spark, *rows, **spec):
    return sorted(r["gbifID"] for r in clean.filter_occurrences(raw(spark, *rows), FilterSpec(**spec)).collect())


def test_numbers(spark):
    texts = ["12", " 12 ", "1d", "1F", "NaN", "Infinity", "-3.5e2", "abc", "", None, ".5", "0x1p3", "1e999", "５"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(to_number(F.col("t")).alias("x"))
    assert [r["x"] for r in df.collect()] == [12.0, 12.0, None, None, None, None, -350.0, None, None, None, 0.5, None, None, None]


def test_dates(spark):
    texts = ["2020", "2020-05", "2020-05-01", "2020-05-01T10:00Z", "2020-05-01T10:00:00.5+02:00", "2020-02-30", "2020-13", "a/b", None, "01.05.2020"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(is_date_like(F.col("t")).alias("x"))
    assert [r["x"] for r in df.collect()] == [True] * 5 + [False] * 5


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(1, 800), (3, 800), (0, 0)], "a long, b long").select(percent(F.col("a"), F.col("b")).alias("p"))
    assert [r["p"] for r in df.collect()] == [0.12, 0.38, 0.0]


def test_filter_edges(spark):
    rows = [
        {"gbifID": "1"},
        {"gbifID": "2", "scientificName": None},
        {"gbifID": "3", "decimalLatitude": "abc"},
        {"gbifID": "4", "decimalLatitude": " 12 "},
        {"gbifID": "5", "coordinateUncertaintyInMeters": None},
        {"gbifID": "6", "coordinateUncertaintyInMeters": "999.999"},
        {"gbifID": "7", "coordinateUncertaintyInMeters": "1000"},
        {"gbifID": "8", "coordinateUncertaintyInMeters": "-1"},
        {"gbifID": "9", "basisOfRecord": None},
        {"gbifID": "10", "basisOfRecord": "FOSSIL_SPECIMEN"},
        {"gbifID": "11", "year": None},
        {"gbifID": "12", "countryCode": "NA"},
        {"gbifID": "NA"},
    ]
    assert kept(spark, *rows) == [1, 4, 5, 6, 8, 11, 12]
    assert kept(spark, *rows, min_year=1990) == [1, 4, 5, 6, 8, 12]
    assert kept(spark, *rows, null_as_zero=False) == [1, 4, 6, 8, 11, 12]
    assert kept(spark, *rows, min_lat=50.0, max_lat=50.0, min_lon=5.0, max_lon=5.0) == [1, 5, 6, 8, 11, 12]
    assert clean.filter_occurrences(raw(spark, {"countryCode": "NA"})).first()["countryCode"] is None
    assert clean.filter_occurrences(raw(spark, {"countryCode": "NA"}), na_values=None).first()["countryCode"] == "NA"
    assert kept(spark) == []


def test_integrity(spark):
    good = clean.filter_occurrences(raw(spark, {"gbifID": "1"}, {"gbifID": "2", "decimalLatitude": "90"}))
    assert clean.check_integrity(good) is good
    with pytest.raises(ValueError, match="Latitude"):
        clean.check_integrity(clean.filter_occurrences(raw(spark, {"decimalLatitude": "90.0001"})))
    with pytest.raises(ValueError, match="duplicate"):
        clean.check_integrity(clean.filter_occurrences(raw(spark, {}, {})))
    assert clean.integrity_counts(clean.coerce_numbers(raw(spark, {"year": "1999.5"}))).first()["not_whole"] == 1


def test_predicate_tree(spark):
    df = clean.coerce_numbers(raw(spark, {"gbifID": "1"}, {"gbifID": "2", "taxonKey": "9"}, {"gbifID": "3", "countryCode": None}))
    tree = {"type": "and", "predicates": [{"type": "or", "predicates": [{"type": "equals", "key": "TAXON_KEY", "value": 2}, {"type": "equals", "key": "TAXON_KEY", "value": 3}]}, {"type": "in", "key": "COUNTRY", "values": ["DE"]}]}
    assert [r["gbifID"] for r in df.filter(predicate(tree)).collect()] == [1.0]
    assert df.filter(predicate({"type": "not", "predicate": tree})).count() == 2
    with pytest.raises(ValueError):
        predicate({"type": "equals", "key": "NOPE", "value": 1})


def test_taxon_keys(spark):
    df = spark.createDataFrame([("5", None), ("6", "5"), ("x", None)], "usageKey string, acceptedUsageKey string")
    assert clean.require_taxon_keys(df) == [5]
    with pytest.raises(ValueError):
        clean.require_taxon_keys(df.filter("usageKey = 'x'"))


def test_ties_and_duplicates(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), ("b",), ("a",), ("c",)], "scientificName string")
    assert [tuple(r) for r in summaries.group_summary(df, "scientificName").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert profile.duplicate_counts(df, "scientificName").first()["duplicates"] == 3
    assert profile.duplicate_counts(df.limit(0), "scientificName").first()["duplicates"] == 0


def test_profile_of_nothing(spark):
    empty = clean.filter_occurrences(raw(spark))
    rows = profile.full_profile(empty).collect()
    assert [r["column"] for r in rows] == RAW_COLUMNS
    assert all(r["non_null"] == 0 and r["missing_pct"] == 0.0 and r["warning_flags"] == "low_cardinality" for r in rows)


def test_readiness(spark):
    rows = {r["metric"]: r for r in readiness.readiness_report(raw(spark, {"decimalLongitude": "0"}, {"gbifID": "2", "decimalLongitude": "0", "decimalLatitude": "0"}, {"gbifID": "3", "coordinateUncertaintyInMeters": None}), "T").collect()}
    assert rows["records_at_0_0"]["status"] == "WARNING" and rows["records_with_longitude_0"]["value"] == "2"
    assert rows["lon0_top_latitudes"]["value"] == "0.0:1; 50.0:1"
    assert rows["final_status"]["value"] == "PASS WITH WARNINGS"
    missing = {r["metric"]: r for r in readiness.readiness_report(raw(spark, {}).drop("gbifID"), "T").collect()}
    assert missing["final_status"]["value"] == "FAIL" and missing["missing_required_columns"]["value"] == "gbifID"


def test_fractions_of_ids_raise(spark):
    from pyspark.sql import functions as F

    from occspark.functions.common import whole

    df = spark.createDataFrame([(1.0,), (None,), (-3.0,)], "x double")
    assert [r["x"] for r in df.select(whole(F.col("x"), "x").alias("x")).collect()] == [1, None, -3]
    with pytest.raises(Exception, match="fraction 1.5"):
        df.unionByName(spark.createDataFrame([(1.5,)], "x double")).select(whole(F.col("x"), "x").alias("x")).collect()


def test_exact_quantiles_of_many_ranges(spark):
    import random

    import numpy as np
    from pyspark.sql import functions as F

    from occspark.plans.quantiles import column_quantiles, with_places

    rng = random.Random(5)
    rows = [(float(rng.randint(0, 40)), None if i % 7 == 0 else rng.random(), None) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(6)
    qs = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    got = {r["column"]: r["quantiles"] for r in column_quantiles(df, ["a", "b", "c"], qs).collect()}
    assert set(got) == {"a", "b"}
    for k, c in ((0, "a"), (1, "b")):
        assert np.allclose(got[c], np.quantile([r[k] for r in rows if r[k] is not None], qs), atol=1e-12)
    placed = with_places(spark.range(500).select((F.col("id") * 37 % 500).alias("x")), "x", "at").collect()
    assert all(r["x"] == r["at"] for r in placed) and len(placed) == 500


@pytest.mark.parametrize("limit", [100_000, 0])
def test_components_with_a_hub(spark, monkeypatch, limit):
    """A node with most of all links; joins broadcast, or merge so that Spark can split the hub."""
    from occspark.plans import components

    checked = components.checked
    monkeypatch.setattr(components, "checked", lambda df: checked(df, small=limit > 0))
    pairs = [(5000, i) for i in range(1, 3000)] + [(7000 + i, 7001 + i) for i in range(30)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 3000)}, 5000: 1, **{7000 + i: 7000 for i in range(31)}}
    edges = spark.range(1000).select((F.col("id") + 1).alias("hi"), F.lit(0).cast("long").alias("lo"))
    plan = components._large_star(edges)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (limit > 0) and ("strategy=merge" in plan) == (limit == 0)


def test_quantiles_by_stretches(spark):
    from occspark.plans.quantiles import column_quantiles, stretch_quantiles

    values = [(float(i) ** 3 / 7, float("inf") if i == 5 else float(i % 3), None, -1e300 if i else 1e300) for i in range(997)]
    df = spark.createDataFrame([*values, (None, None, None, None)], "a double, b double, c double, d double")
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got, all_values = ({r["column"]: r["quantiles"] for r in f(df, ["a", "b", "c", "d"], qs).collect()} for f in (stretch_quantiles, column_quantiles))
    assert got == all_values and set(got) == {"a", "b", "d"}
    assert stretch_quantiles(df, ["c"], qs).count() == 0
