"""Cleaning against its rules, written out in plain Python, on cases made from the limits."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.functions.clock import minutes_between
from kerbcast.operators import cleaning as C
from kerbcast.sources.trips import normalize_trips

MONTH = dt.date(2025, 11, 1)
MAPPED, ELSEWHERE = (11, 12), 77


def around(limit, step):
    return [limit - step, limit, limit + step]


MINUTES = [None, -3.0, 0.0, *around(S.MIN_DURATION_MIN, 0.5), 40.0, *around(S.MAX_DURATION_MIN, 0.5)]
MILES = [None, float("nan"), 0.0, *around(S.MIN_DISTANCE_MILES, 0.05), 7.0, *around(S.MAX_DISTANCE_MILES, 0.5), 400.0]
FARES = [None, float("nan"), -0.01, 0.0, 33.0]
FAST = S.MAX_SPEED_MPH / 60  # miles in a minute
SPEEDS = [(m, round(m * FAST + d, 6)) for m in (2.0, 30.0, 48.0) for d in (-0.01, 0.01)] + [(60.0, 70.0)]


def trips():
    """(second of the month, minutes, miles, pickup, dropoff, fare)"""
    places = itertools.cycle(itertools.product((*MAPPED, ELSEWHERE, None), repeat=2))
    kinds = [(m, d, f) for m in MINUTES for d in MILES for f in (None, 33.0)]
    kinds += [(m, d, f) for f in FARES for m, d in [(40.0, 7.0), (0.5, 0.0), (None, 0.0)]]
    kinds += [(m, d, 5.0) for m, d in SPEEDS]
    rows = [(60 * k, m, d, *next(places), f) for k, (m, d, f) in enumerate(kinds, 1)]
    end = (dt.date(2025, 12, 1) - MONTH).days * 86400
    return rows + [(at, 40.0, 7.0, 11, 12, 33.0) for at in (-1, 0, end - 1, end)]


def known(x):
    return x is not None and x == x


def judged(trip):
    """(minutes, miles) to trust, or None for a trip that does not count."""
    at, minutes, miles, pickup, _, fare = trip
    if not 0 <= at < 30 * 86400 or pickup not in MAPPED:
        return None
    if known(fare) and fare < 0:
        return None
    if minutes is not None and minutes < S.MIN_DURATION_MIN and miles == 0:
        return None
    fast = minutes is not None and minutes > 0 and known(miles) and miles / (minutes / 60) > S.MAX_SPEED_MPH
    long_enough = minutes is not None and S.MIN_DURATION_MIN <= minutes <= S.MAX_DURATION_MIN
    far_enough = known(miles) and S.MIN_DISTANCE_MILES <= miles <= S.MAX_DISTANCE_MILES
    return (minutes if long_enough and not fast else None, miles if far_enough and not fast else None)


def raw_rows(make_raw, rows):
    start = dt.datetime.combine(MONTH, dt.time())
    real = lambda x: None if x is None else float(x)
    return make_raw([(str(start + dt.timedelta(seconds=at)), real(m), real(d), p, q, real(f)) for at, m, d, p, q, f in rows])


@pytest.fixture(scope="module")
def cleaned(spark, make_raw):
    places = [(i, f"Place {i}", "North", 40.6 + i / 100, -73.9 - i / 100) for i in MAPPED]
    centroids = spark.createDataFrame(places, "location_id int, zone string, borough string, lat double, lng double")
    return C.clean_trips(normalize_trips(raw_rows(make_raw, trips())), MONTH, centroids)


def test_every_trip_follows_the_rules(cleaned):
    start = dt.datetime.combine(MONTH, dt.time())
    expected = {}
    for trip in trips():
        if (found := judged(trip)) is not None:
            minutes, miles = found
            km = None if miles is None else miles * S.KM_PER_MILE
            end = None if trip[4] not in MAPPED else 40.6 + trip[4] / 100
            expected[start + dt.timedelta(seconds=trip[0])] = (minutes, km, 40.6 + trip[3] / 100, end)
    rows = C.in_start_order(cleaned).collect()
    assert [r["start_time"] for r in rows] == sorted(expected)
    for r in rows:
        got = r["ride_duration_min"], r["ride_distance_km"], r["start_lat"], r["end_lat"]
        assert got == pytest.approx(expected[r["start_time"]])
        assert (r["end_lng"] is None) == (r["end_lat"] is None)


def test_month_filter_reaches_the_scan(spark, make_raw, tmp_path):
    path = str(tmp_path / "raw")
    raw_rows(make_raw, trips()[:50]).write.parquet(path)
    found = C.starts_in_period(normalize_trips(spark.read.parquet(path)), MONTH)
    plan = found.select("start_time")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan
    assert "ReadSchema: struct<tpep_pickup_datetime:timestamp_ntz>" in plan


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_durations_ignore_the_session_zone(spark, make_raw, zone):
    # In the service area's zone, 02:20 does not exist on this night.
    raw = normalize_trips(make_raw([("2025-03-09 02:20", 33, 1.0, 11, 12, 5.0)]))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = raw.select(
            minutes_between(F.col("start_time"), F.col("end_time")).alias("m"), F.hour("start_time").alias("h")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row["m"], row["h"]) == (33.0, 2)
