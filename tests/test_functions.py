"""Column expressions on hand-written rows."""

from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from leasegrid.functions import dates, geo, numbers, similarity, text


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c")).alias("r")).first()[0]


@pytest.mark.parametrize(
    "raw, rent",
    [
        ("$240 per week", 240.0),
        ("$1,950.00", 1950.0),
        ("$ 490 per Week", 490.0),
        ("$300 per week / $1,300 pm", 300.0),
        ("$2,000 per calendar month", 500.0),
        ("2000percalendarmonth", 500.0),
        ("900 PM", 225.0),
        ("$500 p.w.", 500.0),
        ("1200 pcm", None),
        ("contact agent", None),
        (None, None),
    ],
)
def test_weekly_rent(spark, raw, rent):
    assert one(spark, raw, text.weekly_rent) == rent


@pytest.mark.parametrize(
    "raw, parsed",
    [
        ("2, ,1, ,−, ,5,030m²,", (2, 1, None, 5030)),
        ("12.51ha,", (None, None, None, 125100)),
        ("3, ,2, ,1, ,1.5ha,", (3, 2, 1, 15000)),
        ("1, ,1, ,,", (1, 1, None, None)),
        ("−, ,−, ,−,", (None, None, None, None)),
        ("3, ,2, ,2, 1144,", (3, 2, None, None)),
    ],
)
def test_property_features(spark, raw, parsed):
    assert tuple(one(spark, raw, text.property_features)) == parsed


@pytest.mark.parametrize(
    "raw, address",
    [
        ("/4511-33-rose-lane-melbourne-vic-3000-16767655", "33 Rose Lane, Melbourne, VIC 3000"),
        ("//unit-1-47-53-wyndham-st-x-vic-3000-1", "53 Wyndham St, X, VIC 3000"),
        ("/x-vic-3000-1", ", X, VIC 3000"),
        ("/too-short", None),
        (None, None),
    ],
)
def test_slug_address(spark, raw, address):
    assert one(spark, raw, text.slug_address) == address


@pytest.mark.parametrize("make", [text.slug_address, text.slug_address_with_unit, text.clean_street])
def test_address_steps_are_evaluated_once(spark, make):
    """No cleaning step is written out again for every use of its result."""
    said = spark.range(1).select(make(F.col("id").cast("string")).alias("r"))._jdf.queryExecution().analyzed().toString()
    assert said.count("regexp_replace") <= 2 and said.count("split(") <= 2


@pytest.mark.parametrize(
    "raw, street",
    [
        ("unit 1 47 53 wyndham st", "53 Wyndham St"),
        ("level 2", "level 2"),
        ("penthouse the esplanade", "The Esplanade"),
        ("12a", "12a"),
        ("", ""),
    ],
)
def test_clean_street(spark, raw, street):
    assert one(spark, raw, text.clean_street) == street


def test_names(spark):
    assert one(spark, " St Mary’s  –  College, East Campus", text.normalise_name) == "st mary's - college"
    assert one(spark, None, text.normalise_name) == ""
    assert one(spark, "Brunswick West (Vic.)", text.repair_suburb) == "west brunswick"
    assert one(spark, "Carlton North (SAL20495)", text.suburb_from_code) == "Carlton North"
    assert one(spark, "Carlton", text.suburb_from_code) == "Unknown"
    assert one(spark, "apartment / unit / flat", text.property_category) == "flat"
    assert one(spark, "new house & land", text.property_category) == "house"
    assert one(spark, "new house & land", lambda c: text.property_category(c, strict_keys=True)) == "unknown"


def test_points_and_rings(spark):
    assert tuple(one(spark, "POINT (-37.27 145.71)", geo.wkt_point)) == (-37.27, 145.71)
    assert tuple(one(spark, "POINT (145.08 -37.63)", geo.wkt_point)) == (-37.63, 145.08)
    assert one(spark, "POINT EMPTY", geo.wkt_point) is None
    assert one(spark, " none ", geo.wkt_ring) is None
    ring = "POLYGON ((0 0, 2 0, 2 2, 1 1, 0 2, 0 0))"
    cases = {(1.0, 1.0): True, (1.0, 1.5): False, (0.0, 0.0): True, (2.0, 1.0): True, (0.5, 1.0): True, (3.0, 0.0): False}
    rows = [(ring, x, y) for x, y in cases]
    out = spark.createDataFrame(rows, "r string, x double, y double").select("x", "y", geo.ring_covers(geo.wkt_ring(F.col("r")), F.col("x"), F.col("y")).alias("in"))
    assert {(r.x, r.y): r["in"] for r in out.collect()} == cases


def test_geodesic_is_close_to_known_length(spark):
    # One degree of latitude at the equator on WGS84 is 110,574.389 m; of longitude 111,319.491 m.
    rows = [(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (5.0, 5.0, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").select(geo.geodesic_m("a", "b", "c", "d").alias("m"))
    got = [r.m for r in df.collect()]
    assert got[0] == pytest.approx(110574.389, abs=0.01)
    assert got[1] == pytest.approx(111319.491, abs=0.01)
    assert got[2] == 0


def test_normal_quantile(spark):
    ps = [1e-12, 1e-4, 0.02, 0.3, 0.5, 0.61, 0.975, 1 - 1e-9]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(numbers.normal_quantile(F.col("p"))).collect()
    assert [g[0] for g in got] == pytest.approx([NormalDist().inv_cdf(p) for p in ps], abs=1e-12)


def test_numbers(spark):
    assert one(spark, float("nan"), numbers.finite, "double") is None
    assert one(spark, 0.0, numbers.log_or_zero, "double") == pytest.approx(-23.02585093)
    assert one(spark, None, numbers.log_or_zero, "double") == 0.0
    assert one(spark, 1, numbers.school_goodness, "int") == 0.9999
    assert one(spark, None, numbers.school_goodness, "int") is None
    assert one(spark, "4x", numbers.to_number) is None


def test_dates(spark):
    assert str(one(spark, "20220418045210", dates.stamp14)) == "2022-04-18 04:52:10"
    assert one(spark, "2022", dates.stamp14) is None
    ends = one(spark, "2025-06-01", lambda c: dates.future_quarter_ends(F.to_date(c), 3))
    assert [str(d) for d in ends] == ["2025-09-30", "2025-12-31", "2026-03-31"]
    assert one(spark, "Sep", dates.month_name_quarter) == 3
    assert one(spark, "9 May 2021", lambda c: F.to_date(dates.mixed_timestamp(c))).isoformat() == "2021-05-09"


def test_similarity(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(similarity.edit_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([1 - 3 / 7, 1.0])
