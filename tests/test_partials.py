import datetime as dt
import random
from calendar import monthrange
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.operators import grid
from kerbcast.operators.cleaning import clean_trips
from kerbcast.operators.partials import (
    CoverageError,
    assert_daily_coverage,
    daily_coverage_problems,
    location_hour_daily,
    merge_partials,
    partials_from_trips,
)
from kerbcast.operators.profile import zone_hour_profile
from kerbcast.sources.trips import normalize_trips


def rows_of(df):
    return sorted(tuple(row) for row in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def zone_map(spark):
    return spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "pickup_location_id int, pickup_zone int")


def random_trips(seed, n, places=6, days=3):
    """(place, start, minutes or None, km or None)"""
    rng = random.Random(seed)
    start = dt.datetime(2025, 11, 28)
    return [
        (
            rng.randint(1, places),
            start + dt.timedelta(seconds=rng.randrange(days * 86400)),
            rng.choice([None, rng.randint(60, 9000) / 60]),
            rng.choice([None, rng.randint(1, 40000) / 1000]),
        )
        for _ in range(n)
    ]


def summed(trips):
    """Counts and sums by place, date and hour, by plain addition."""
    cells = {}
    for place, at, minutes, km in trips:
        cell = cells.setdefault((place, at.date(), at.hour), [0, 0.0, 0, 0.0, 0])
        cell[0] += 1
        for k, value in ((1, minutes), (3, km)):
            if value is not None:
                cell[k] += value
                cell[k + 1] += 1
    return cells


def test_partials_equal_plain_sums(spark):
    trips = random_trips(1, 500)
    frame = spark.createDataFrame(
        trips, "pickup_location_id int, start_time timestamp_ntz, ride_duration_min double, ride_distance_km double"
    )
    found = {tuple(r)[:3]: tuple(r)[3:] for r in location_hour_daily(frame).collect()}
    expected = summed(trips)
    assert found.keys() == expected.keys()
    for key, cell in expected.items():
        assert found[key] == pytest.approx(cell, abs=1e-5)


def test_joining_after_the_aggregate_changes_nothing(spark, month_trips, grid_centroids):
    trips = normalize_trips(month_trips("2026-06-01", 30))
    known = grid_centroids.filter(F.col("location_id") % 4 != 1)
    late = partials_from_trips(trips, "2026-06", known)
    early = location_hour_daily(clean_trips(trips, "2026-06", known))
    assert rows_of(late) == rows_of(early)


def test_sums_do_not_depend_on_partitioning(month_trips, grid_centroids):
    trips = normalize_trips(month_trips("2026-06-01", 5))
    few = partials_from_trips(trips.coalesce(1), "2026-06", grid_centroids)
    many = partials_from_trips(trips.repartition(13), "2026-06", grid_centroids)
    assert rows_of(few) == rows_of(many)


def test_merging_months_equals_one_pass(month_trips, grid_centroids):
    trips = normalize_trips(month_trips("2026-06-01", 30))
    whole = partials_from_trips(trips, "2026-06", grid_centroids)
    halves = [
        partials_from_trips(trips.filter(F.minute("start_time") % 2 == part), "2026-06", grid_centroids)
        for part in (0, 1)
    ]
    assert rows_of(merge_partials(*halves)) == rows_of(whole)


def covered(make_partials, days):
    """Partials with the rides of each date, split over two places and hours."""
    rows = []
    for day, n in days.items():
        rows += [(4, str(day), 5, n // 3, 0.0, 0, 0.0, 0), (9, str(day), 22, n - n // 3, 0.0, 0, 0.0, 0)]
    return make_partials(rows)


@pytest.mark.parametrize("case", range(6))
def test_coverage_equals_its_rule(make_partials, case):
    """Months with random holes and random lulls, judged in plain Python."""
    rng = random.Random(case)
    months = [dt.date(2025, m, 1) for m in (2, 5, 11)]
    days, problems = {}, set()
    for first in months:
        dates = [first + dt.timedelta(days=k) for k in range(monthrange(first.year, first.month)[1])]
        own = {d: rng.choice([1, 4, 5, 90, 100, 110]) if rng.random() < 0.2 else 100 for d in dates}
        gone = set(rng.sample(dates, rng.choice([0, 0, 2])))
        own = {d: n for d, n in own.items() if d not in gone}
        typical = median(own.values())
        problems |= {(d, "missing") for d in gone}
        if not gone:
            problems |= {(d, "low") for d, n in own.items() if n < S.LOW_DAY_SHARE_OF_MEDIAN * typical}
        days |= own
    partials = covered(make_partials, days)
    names = [f"{m:%Y-%m}" for m in months]
    assert {(p["date"], p["problem"]) for p in daily_coverage_problems(partials, names).collect()} == problems
    if problems:
        with pytest.raises(CoverageError, match=str(min(problems)[0])):
            assert_daily_coverage(partials, names)
    else:
        assert_daily_coverage(partials, names)


def test_a_month_without_rows_is_missing_every_day(make_partials):
    partials = covered(make_partials, {dt.date(2025, 2, 1) + dt.timedelta(days=k): 50 for k in range(28)})
    assert daily_coverage_problems(partials, ["2025-02", "2025-5"]).count() == 31


def by_place(trips):
    """``trips`` as partials: one row each, places 5 and 6 without a zone."""
    return [(p, str(at.date()), at.hour, 1, m or 0.0, int(m is not None), d or 0.0, int(d is not None)) for p, at, m, d in trips]


ZONE_OF = {1: 0, 2: 0, 3: 1, 4: 2}


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(list(ZONE_OF.items()), "pickup_location_id int, pickup_zone int")


def test_zone_hour_days_equal_plain_counts(make_partials, places):
    trips = random_trips(2, 300, days=4)
    daily = grid.zone_hour_daily_from_partials(make_partials(by_place(trips)), places, 3).collect()
    counts = {(r["pickup_zone"], r["hour"], r["date"]): r["ride_count"] for r in daily}
    dates = {at.date() for _, at, *_ in trips}  # also of trips without a zone
    assert len(daily) == len(counts) == 3 * 24 * len(dates)
    expected = Counter((ZONE_OF[p], at.hour, at.date()) for p, at, *_ in trips if p in ZONE_OF)
    assert {k: n for k, n in counts.items() if n} == dict(expected)


def test_large_grids_fill_the_same_way(make_partials, zone_map, monkeypatch):
    partials = make_partials(
        [(1 + i % 3, f"2026-08-{1 + i % 5:02d}", i % 24, i, 0.0, 0, 0.0, 0) for i in range(40)]
    )
    packed = rows_of(grid.zone_hour_daily_from_partials(partials, zone_map, 3))
    monkeypatch.setattr(grid.S, "GRID_MAX_CELLS_PER_DAY", 10)
    assert rows_of(grid.zone_hour_daily_from_partials(partials, zone_map, 3)) == packed


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def test_zone_hour_totals_equal_plain_means(spark):
    trips = [(ZONE_OF[p], at, m, d) for p, at, m, d in random_trips(3, 120) if p in ZONE_OF]
    frame = spark.createDataFrame(
        [(z, at.hour, m, d) for z, at, m, d in trips],
        "zone int, hr int, ride_duration_min double, ride_distance_km double",
    )
    totals = grid.zone_hour_totals(frame, 3, 3, zone_col="zone", time_col="hr").collect()
    assert len(totals) == 3 * 24
    for r in totals:
        own = [t for t in trips if (t[0], t[1].hour) == (r["zone"], r["hr"])]
        assert (r["ride_count"], r["avg_daily_ride_count"]) == (len(own), pytest.approx(len(own) / 3))
        assert r["avg_ride_duration_min"] == pytest.approx(mean(t[2] for t in own) or 0.0, abs=1e-6)
        assert r["avg_ride_distance"] == pytest.approx(mean(t[3] for t in own) or 0.0, abs=1e-6)


def test_profiles_fall_back_from_cell_to_zone_to_all(make_partials, places):
    trips = [t for t in random_trips(4, 90, days=2) if t[0] in ZONE_OF]
    # One zone without a single measurement.
    trips = [(p, at, None, None) if p == 4 else (p, at, m, d) for p, at, m, d in trips]
    profile = zone_hour_profile(make_partials(by_place(trips)), places, 3).collect()
    assert len(profile) == 3 * 24

    def fallback(k, zone, hour):
        cell = mean(t[k] for t in trips if (ZONE_OF[t[0]], t[1].hour) == (zone, hour))
        return next(v for v in (cell, mean(t[k] for t in trips if ZONE_OF[t[0]] == zone), mean(t[k] for t in trips)) if v is not None)

    for zone, hour, minutes, km in (tuple(r) for r in profile):
        assert minutes == pytest.approx(fallback(2, zone, hour), abs=1e-6)
        assert km == pytest.approx(fallback(3, zone, hour), abs=1e-6)
