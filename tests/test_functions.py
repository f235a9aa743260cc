from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from placeweave.functions import names as N
from placeweave.functions import normalize as Z
from placeweave.functions import scores as S


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, want",
    [("wy", "WY"), (" Ohio ", "OH"), ("WY,MT,ID", "WY"), ("u.s. virgin islands", "VI"), ("zz", "ZZ"), ("", None), (None, None), ("Q", "Q")],
)
def test_state(spark, value, want):
    assert one(spark, value, Z.normalize_state) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("1854", "1854"), ("1999-02-30", "1999-02-30"), ("3/7/1901", "1901-03-07"), ("1030683600000", "2002-08-30"), ("1030683600", "2002-08-30"),
        ("March 5, 1900", "1900-03-05"), ("Mar 5, 1900", "1900-03-05"), ("03-05-1900", "1900-03-05"), ("05-Mar-1900", "1900-03-05"), ("circa", "circa"), (None, None),
    ],
)
def test_date(spark, value, want):
    assert one(spark, value, Z.normalize_date) == want


@pytest.mark.parametrize("value, want", [("-307929600000", "1960-03-30"), ("6/1/78", "1978-06-01"), ("6/1/25", "2025-06-01"), ("x", None), (None, None)])
def test_epoch(spark, value, want):
    assert one(spark, value, Z.epoch_ms_to_iso) == want


@pytest.mark.parametrize("value, want", [("o'brien", "O'Brien"), ("st.louis", "St.Louis"), ("3rd ave", "3Rd Ave"), ("NEW YORK", "New York"), (None, None)])
def test_title(spark, value, want):
    assert one(spark, value, Z.title_case) == want


@pytest.mark.parametrize(
    "lat, lon, valid, swapped, first",
    [
        ("40.0", "-75.0", True, False, None), ("-75.0", "40.0", True, True, "swapped_lat_lon"), (None, "1", False, False, "missing_coordinates"),
        ("NaN", "-75", False, False, "nan_coordinates"), ("x", "-75", False, False, "non_numeric_coordinates: x, -75"), ("80.0", "-75.0", False, False, "latitude_out_of_bounds: 80.0"),
    ],
)
def test_coordinates(spark, lat, lon, valid, swapped, first):
    row = spark.createDataFrame([(lat, lon)], "a string, b string").select(Z.validate_coordinates(F.col("a"), F.col("b")).alias("p")).first()["p"]
    assert (row["valid"], row["swapped"], (row["warnings"] or [None])[0]) == (valid, swapped, first)


def test_address(spark):
    assert one(spark, " 12 North Main  Street, #4 ", Z.normalize_address) == "12 n main st 4"


@pytest.mark.parametrize(
    "value, want",
    [("Fort X National Historic Site", "Fort X"), ("Mill (ruins)", "Mill"), ("National Park", ""), ("Old nhs", "Old"), ("A (b) C", "A C")],
)
def test_matching_name(spark, value, want):
    assert one(spark, value, N.matching_name) == want


def lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


@pytest.mark.parametrize("a, b", [("kitten", "sitting"), ("", ""), ("", "x"), ("Fire Station No. 25", "Fire Station No. 7"), ("b a", "a b"), ("aaa", "aa a")])
def test_token_sort_ratio(spark, a, b):
    x, y = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    want = 200 * lcs(x, y) / (len(x) + len(y)) if x or y else 100.0
    got = spark.createDataFrame([(a, b)], "a string, b string").select(N.token_sort_ratio(F.col("a"), F.col("b"))).first()[0]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("a, b, want", [("Fire Station No. 25", "fire station no. 7", True), ("N 23rd St Bridge", "N 21st St Bridge", True), ("A 1", "B 1", False), ("A 1", "A 1", False)])
def test_numbers(spark, a, b, want):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(N.differ_only_by_number(F.col("a"), F.col("b"))).first()[0] is want


def test_haversine(spark):
    row = spark.range(1).select(N.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), N.distance_km(F.lit(0.0), F.lit(1.0), F.lit(1.0), F.lit(1.0))).first()
    assert row[0] == pytest.approx(111.19493, abs=1e-4) and row[1] is None


@pytest.mark.parametrize("value, want", [("GRAND HOTEL", "Grand Hotel"), ("X", "X"), ("Mixed", "Mixed"), ("12", "12")])
def test_unshout(spark, value, want):
    assert one(spark, value, N.unshout) == want


def test_pick_entry(spark):
    assert one(spark, "Old Mill (state), New Mill (NRHP)", N.pick_entry) == "New Mill"
    assert one(spark, "​Mill﻿ ", N.strip_invisible) == "Mill"


@pytest.mark.parametrize("start, end, want", [(1863, 1863, None), (1861, 1865, 0.95), (None, 1492, 0.95)])
def test_era(spark, start, end, want):
    df = spark.createDataFrame([(start, end)], "s int, e int")
    era = (None, 1492) if end == 1492 else (1861, 1865)
    got = df.select(S.era_confidence(F.col("s"), F.col("e"), F.lit(era[0]).cast("int"), F.lit(era[1]))).first()[0]
    assert got == want


def test_specificity(spark):
    for name, want in (("House #4", 0.2), ("", 0.0), ("Mill", 0.6), ("The Long Name", 1.0), (None, 0.0)):
        assert one(spark, name, S.name_specificity) == want
