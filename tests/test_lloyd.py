"""Keyed k-means and the distance store against plain Python."""

import math
import random

import pytest

from kerbcast.operators import lloyd
from kerbcast.operators.distances import distance_store, labeling_sums, silhouettes
from kerbcast.operators.zoning import fit_centres
from tests.test_operators import CLOUD, LONELY, POINTS, brute_silhouette

FOLDED = "fold string, pickup_location_id int, start_lat double, start_lng double, weight long"


def cloud(seed, n, fold="a"):
    rng = random.Random(seed)
    return [(fold, i, round(rng.gauss(i % 3, 0.4), 3), round(rng.gauss(-(i % 3), 0.4), 3), rng.randint(1, 9)) for i in range(n)]


def plain_step(rows, centres):
    groups = {}
    total = 0
    for *_, lat, lng, w in rows:
        d2, z = min(((lat - y) ** 2 + (lng - x) ** 2, z) for z, (y, x) in enumerate(centres))
        groups.setdefault(z, []).append((lat, lng, w))
        total += round(d2 * w * 1e9)
    moved = list(centres)
    for z, own in groups.items():
        weight = sum(w for *_, w in own)
        moved[z] = tuple(sum(round(p[k] * 1e9) * p[2] for p in own) / 1e9 / weight for k in (0, 1))
    return moved, total / 1e9


def test_a_step_moves_all_settings_at_once(spark):
    rows = cloud(1, 40) + cloud(2, 25, "b")
    points = spark.createDataFrame(rows, FOLDED)
    centres = {("a", 3, 0): [(0.0, 0.0), (1.0, -1.0), (2.0, -2.0)], ("a", 2, 1): [(0.0, 0.0), (0.0, 0.0)], ("b", 1, 0): [(9.0, 9.0)]}
    moved, inertia = lloyd.lloyd_step(points, centres)
    for key, own in centres.items():
        expected, total = plain_step([r for r in rows if r[0] == key[0]], own)
        assert moved[key] == [pytest.approx(c, rel=1e-12) for c in expected]
        assert inertia[key] == pytest.approx(total, rel=1e-9)
    # The second of two equal centres gets no point and stays.
    assert moved["a", 2, 1][1] == (0.0, 0.0)


def test_settings_fitted_together_are_those_fitted_alone(spark):
    points = spark.createDataFrame(cloud(3, 50) + cloud(4, 30, "b"), FOLDED)
    settings = [("a", 2), ("a", 7), ("b", 3), ("b", 3), ("b", 30)]
    together = lloyd.fit_keyed(points, settings)
    assert list(together) == [("a", 2), ("a", 7), ("b", 3), ("b", 30)]
    for setting, centres in together.items():
        assert lloyd.fit_keyed(points.repartition(5), [setting]) == {setting: centres}
        own = [r for r in cloud(3, 50) + cloud(4, 30, "b") if r[0] == setting[0]]
        assert centres == sorted(centres) and plain_step(own, centres)[0] == [pytest.approx(c, rel=1e-9) for c in centres]
    assert fit_centres(points.filter("fold = 'b'"), 3) == together["b", 3]


def test_more_starts_are_never_worse(spark):
    points = spark.createDataFrame(cloud(5, 60), FOLDED)
    rows = cloud(5, 60)
    spread = lambda starts: plain_step(rows, lloyd.fit_keyed(points, [("a", 6)], starts=starts)["a", 6])[1]
    one, four = spread(1), spread(4)
    assert four <= one


def test_heavy_places_are_drawn_first(spark):
    rows = [("a", i, float(i), 0.0, 10**9 if i in (3, 8) else 1) for i in range(20)]
    drawn = lloyd.first_centres(spark.createDataFrame(rows, FOLDED), [("a", 2)], starts=6)
    assert all({lat for lat, _ in own} == {3.0, 8.0} for own in drawn.values())


def test_too_many_zones_and_no_settings(spark):
    points = spark.createDataFrame([("a", 1, 0.0, 0.0, 1), ("a", 2, 0.0, 0.0, 2)], FOLDED)
    with pytest.raises(ValueError, match="distinct points"):
        lloyd.fit_keyed(points, [("a", 2)])
    assert lloyd.fit_keyed(points, []) == {}


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_labelings_share_one_store(spark, block):
    labelings = {"lonely": LONELY, "cloud": CLOUD, "all one": [(*r[:4], 0) for r in CLOUD], "by parity": [(*r[:4], r[0] % 2) for r in CLOUD]}
    shift = {"lonely": 1000}
    rows = [(name, shift.get(name, 0) + r[0], *r[1:]) for name, own in labelings.items() for r in own]
    labels = spark.createDataFrame(rows, "name string, " + POINTS.replace("weight int", "weight long") + ", pickup_zone int")
    places = labels.select("pickup_location_id", "start_lat", "start_lng").distinct()
    store = distance_store(places, block_points=block)
    found = {r["name"]: r["silhouette"] for r in silhouettes(store, labels, ["name"]).collect()}
    for name, own in labelings.items():
        expected = 0.0 if name == "all one" else brute_silhouette(own)
        assert found[name] == pytest.approx(expected, abs=1e-7)
    sums = labeling_sums(store, labels.filter("name = 'cloud'"), ["name"]).filter("pickup_location_id = 4 AND cluster = 2").first()
    _, x, y, *_ = CLOUD[4]
    plain = sum(r[3] * round(math.hypot(x - r[1], y - r[2]) * 1e9) for r in CLOUD if r[4] == 2)
    assert int(sums["distance"]) == pytest.approx(plain, abs=len(CLOUD) * 5)
