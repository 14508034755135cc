"""Grids, aggregates, profiles, coverage, zones."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import (
    ev_clean,
    ev_daily,
    ev_measured,
    ev_partials,
    ev_zoned,
    ev_zoning,
    fixed_zone_map,
    or_partials,
)
from catalog.section import Section
from catalog.sql import CENTRES, N_ZONES, block, exact_mean, exact_sum, nearest, with_
from kerbcast.functions.geo import nearest_centre
from kerbcast.operators import grid, zoning
from kerbcast.operators.partials import (
    PARTIAL_KEYS,
    daily_coverage_problems,
    known_locations,
    location_hour_daily,
    merge_partials,
)
from kerbcast.operators.polygons import polygon_centroids
from kerbcast.operators.profile import zone_hour_profile, zone_hour_sums
from kerbcast.plans.forecast import feature_rows
from kerbcast.sources.standins import lattice_centroids, table

register = Section()

# --- grids and aggregates ------------------------------------------------------------

TOTALS = f"""
  SELECT CAST(z.z AS INTEGER) AS pickup_zone, CAST(h.h AS INTEGER) AS hour,
    coalesce(n, 0) AS ride_count, coalesce(dur, 0) AS avg_ride_duration_min,
    coalesce(dist, 0) AS avg_ride_distance,
    coalesce(n, 0) / (SELECT count(DISTINCT CAST(start_time AS DATE)) FROM ev_zoned)
      AS avg_daily_ride_count
  FROM range({N_ZONES}) z(z) CROSS JOIN range(24) h(h) LEFT JOIN (
    SELECT pickup_zone, hour, count(*) AS n, {exact_mean('ride_duration_min', '6e7')} AS dur,
      {exact_mean('ride_distance_km')} AS dist FROM ev_zoned GROUP BY ALL) s
    ON s.pickup_zone = z.z AND s.hour = h.h"""


def _totals(spark, sf_dir):
    trips = ev_zoned(spark, sf_dir)
    return grid.zone_hour_totals(trips, grid.distinct_days(trips), N_ZONES)


@register("e1_c9_d5_zone_hour_totals", with_("ev_zoned") + TOTALS)
def e1(spark, sf_dir):
    return _totals(spark, sf_dir)


@register(
    "e3_profile_of_totals",
    with_("ev_zoned")
    + f"SELECT pickup_zone, hour, avg_ride_duration_min, avg_ride_distance FROM ({TOTALS})",
)
def e3(spark, sf_dir):
    return grid.profile_of_totals(_totals(spark, sf_dir))


@register("e2_zone_hour_daily_from_trips", with_("ev_zhd") + "SELECT * FROM ev_zhd")
def e2(spark, sf_dir):
    return grid.zone_hour_daily(ev_zoned(spark, sf_dir), N_ZONES)


@register("e5_d6_zone_hour_daily_from_partials", with_("ev_zhd") + "SELECT * FROM ev_zhd")
def e5(spark, sf_dir):
    return ev_daily(spark, sf_dir)


@register(
    "d3_partials_with_zone",
    with_("ev_partials", "zone_map")
    + "SELECT * FROM ev_partials JOIN zone_map USING (pickup_location_id)",
)
def d3(spark, sf_dir):
    return grid.with_zone(ev_partials(spark, sf_dir), fixed_zone_map(spark))


@register("i4_d4_c10_feature_rows", with_("ev_features") + "SELECT * FROM ev_features")
def i4(spark, sf_dir):
    return feature_rows(*ev_zoning(spark, sf_dir))


@register("e6_f2_profile_with_fallback", with_("ev_profile") + "SELECT * FROM ev_profile")
def e6(spark, sf_dir):
    return zone_hour_profile(ev_partials(spark, sf_dir), fixed_zone_map(spark), N_ZONES)


# A third of the hours without usable measurements, and one zone without any.
block(
    "ev_sparse", "ev_partials", "zone_map",
    sql="""
    SELECT p.* REPLACE (CASE WHEN gone THEN 0 ELSE duration_n END AS duration_n,
                        CASE WHEN gone THEN 0 ELSE duration_sum END AS duration_sum)
    FROM (SELECT p.*, z.pickup_zone, z.pickup_zone = 3 OR hour % 3 = 0 AS gone
          FROM ev_partials p JOIN zone_map z USING (pickup_location_id)) p""",
)


@register(
    "e6_profile_fallback_levels",
    with_("ev_sparse", "zone_map") + f"""
    , s AS (SELECT pickup_zone, hour, {exact_sum('duration_sum', '6e7')} AS ds,
              sum(duration_n) AS dn FROM ev_sparse GROUP BY ALL)
    , g AS (SELECT CAST(z AS INTEGER) AS pickup_zone, CAST(h AS INTEGER) AS hour
            FROM range({N_ZONES}) a(z) CROSS JOIN range(24) b(h))
    SELECT g.pickup_zone, g.hour, coalesce(s.ds / nullif(s.dn, 0),
        zs.ds / nullif(zs.dn, 0), t.ds / nullif(t.dn, 0)) AS avg_ride_duration_min
    FROM g LEFT JOIN s USING (pickup_zone, hour)
      LEFT JOIN (SELECT pickup_zone, {exact_sum('ds', '6e7')} AS ds, sum(dn) AS dn FROM s
                 GROUP BY ALL) zs ON zs.pickup_zone = g.pickup_zone
      CROSS JOIN (SELECT {exact_sum('ds', '6e7')} AS ds, sum(dn) AS dn FROM s) t""",
)
def e6_levels(spark, sf_dir):
    zones = fixed_zone_map(spark)
    gone = (F.col("pickup_zone") == 3) | (F.col("hour") % 3 == 0)
    sparse = (
        grid.with_zone(ev_partials(spark, sf_dir), zones)
        .withColumns(
            {
                "duration_sum": F.when(~gone, F.col("duration_sum")).otherwise(0.0),
                "duration_n": F.when(~gone, F.col("duration_n")).otherwise(0),
            }
        )
        .drop("pickup_zone")
    )
    profile = zone_hour_profile(sparse, zones, N_ZONES)
    return profile.select("pickup_zone", "hour", "avg_ride_duration_min")


@register(
    "f1_zone_hour_sums",
    with_("ev_sums") + """SELECT pickup_zone, hour, duration_sum,
      CAST(duration_n AS BIGINT) AS duration_n, distance_sum,
      CAST(distance_n AS BIGINT) AS distance_n FROM ev_sums""",
)
def f1(spark, sf_dir):
    return zone_hour_sums(ev_partials(spark, sf_dir), fixed_zone_map(spark))


@register(
    "e17_distinct_days",
    with_("ev_clean") + "SELECT count(DISTINCT CAST(start_time AS DATE)) AS n_days FROM ev_clean",
)
def e17(spark, sf_dir):
    days = ev_clean(spark, sf_dir).select(F.col("start_time").cast("date").alias("d")).distinct()
    return days.agg(F.count("*").alias("n_days"))


@register(
    "h1_merge_month_partials",
    with_("or_partials") + "SELECT * FROM or_partials",
)
def h1(spark, sf_dir):
    partials = or_partials(spark, sf_dir)
    split = F.to_date(F.lit("1998-01-01"))
    older = partials.filter(F.col("date") < split)
    return merge_partials(older, partials.filter(F.col("date") >= split))


# --- coverage ------------------------------------------------------------------------


def _coverage(source: str) -> str:
    return with_(source) + f"""
    , daily AS (SELECT date, sum(ride_count) AS n FROM {source} GROUP BY date)
    , months AS (SELECT CAST(date_trunc('month', date) AS DATE) AS m, median(n) AS med,
                   count(*) AS present FROM daily GROUP BY ALL)
    , days AS (SELECT m, med, present, CAST(unnest(generate_series(m, last_day(m),
                 INTERVAL 1 DAY)) AS DATE) AS date FROM months)
    SELECT strftime(m, '%Y-%m') AS month, days.date,
      CASE WHEN n IS NULL THEN 'missing' ELSE 'low' END AS problem,
      CAST(coalesce(n, 0) AS BIGINT) AS ride_count
    FROM days LEFT JOIN daily ON daily.date = days.date
    WHERE n IS NULL OR (present = day(last_day(m)) AND n < 0.05::DOUBLE * med)"""


@register("e8_d8_h2_coverage_events", _coverage("ev_partials"))
def e8(spark, sf_dir):
    return daily_coverage_problems(ev_partials(spark, sf_dir))


@register("e8_coverage_orders", _coverage("or_partials"))
def e8_orders(spark, sf_dir):
    return daily_coverage_problems(or_partials(spark, sf_dir))


block(
    "thin", "or_partials",
    sql="""SELECT date, ride_count * CASE WHEN day(date) % 10 = 3 THEN 1 ELSE 200 END AS ride_count
           FROM or_partials""",
)


@register("e8_coverage_low_days", _coverage("thin"))
def e8_low(spark, sf_dir):
    # Most days weigh 200 times more, so complete months report the others as low.
    weight = F.when(F.dayofmonth("date") % 10 == 3, 1).otherwise(200)
    partials = or_partials(spark, sf_dir)
    return daily_coverage_problems(partials.withColumn("ride_count", F.col("ride_count") * weight))


# --- zones ---------------------------------------------------------------------------

block(
    "points", "ev_partials", "centroids",
    sql="""SELECT pickup_location_id, any_value(lat) AS start_lat, any_value(lng) AS start_lng,
      CAST(sum(ride_count) AS BIGINT) AS weight
    FROM ev_partials JOIN centroids ON location_id = pickup_location_id GROUP BY ALL""",
)
block(
    "labelled", "points", "zone_map",
    sql="SELECT points.*, pickup_zone FROM points JOIN zone_map USING (pickup_location_id)",
)


def _points(spark, sf_dir):
    return zoning.pickup_points(ev_partials(spark, sf_dir), lattice_centroids(spark))


def _labelled(spark, sf_dir):
    return zoning.assign_zones(_points(spark, sf_dir), CENTRES)


@register("e7_pickup_points", with_("points") + "SELECT * FROM points")
def e7(spark, sf_dir):
    return _points(spark, sf_dir)


@register(
    "d7_locations_with_pickups",
    with_("ev_partials", "centroids") + """SELECT * FROM centroids
      WHERE location_id IN (SELECT pickup_location_id FROM ev_partials)""",
)
def d7(spark, sf_dir):
    return zoning.locations_with_pickups(lattice_centroids(spark), ev_partials(spark, sf_dir))


@register(
    "d9_i2_nearest_zone_of_trips",
    with_("ev_clean") + f"""SELECT event_id,
      CAST({nearest('start_lat', 'start_lng', CENTRES)} AS INTEGER) AS pickup_zone,
      CASE WHEN end_lat IS NOT NULL
        THEN CAST({nearest('end_lat', 'end_lng', CENTRES)} AS INTEGER) END AS dropoff_zone
      FROM ev_clean""",
)
def d9(spark, sf_dir):
    trips = zoning.assign_zones(ev_clean(spark, sf_dir), CENTRES)
    end = nearest_centre(F.col("end_lat"), F.col("end_lng"), CENTRES)["zone"]
    return trips.select("event_id", "pickup_zone", end.alias("dropoff_zone"))


@register("i3_zone_map_all_locations", with_("zone_map", "ev_partials") + """
  SELECT pickup_location_id, pickup_zone, CAST(coalesce(n, 0) AS BIGINT) AS rides FROM zone_map
  LEFT JOIN (SELECT pickup_location_id, sum(ride_count) AS n FROM ev_partials GROUP BY ALL)
    USING (pickup_location_id)""")
def i3_map(spark, sf_dir):
    rides = ev_partials(spark, sf_dir).groupBy("pickup_location_id").agg(
        F.sum("ride_count").alias("rides")
    )
    mapped = fixed_zone_map(spark).join(rides, "pickup_location_id", "left")
    return mapped.withColumn("rides", F.coalesce("rides", F.lit(0)))


SHARES = f"""
  , z AS (SELECT CAST(z AS INTEGER) AS pickup_zone, CAST(coalesce(n, 0) AS BIGINT) AS rides
          FROM range({N_ZONES}) r(z) LEFT JOIN (
            SELECT pickup_zone, sum(ride_count) AS n FROM ev_partials
            JOIN zone_map USING (pickup_location_id) GROUP BY ALL) s ON s.pickup_zone = r.z)
  , shares AS (SELECT *, rides / (SELECT CAST(sum(rides) AS DOUBLE) FROM z) AS share FROM z)"""


def _shares(spark, sf_dir):
    return zoning.zone_rides(ev_partials(spark, sf_dir), fixed_zone_map(spark), N_ZONES)


@register("e9_zone_shares", with_("ev_partials", "zone_map") + SHARES + " SELECT * FROM shares")
def e9(spark, sf_dir):
    return _shares(spark, sf_dir)


@register(
    "e9_share_extremes",
    with_("ev_partials", "zone_map") + SHARES + """ SELECT min(share) AS smallest_zone_share,
      max(share) AS largest_zone_share FROM shares""",
)
def e9_extremes(spark, sf_dir):
    return zoning.share_extremes(_shares(spark, sf_dir))


@register(
    "j14_zone_concentration",
    with_("ev_partials", "zone_map") + SHARES + f""" SELECT max(share) AS busiest_share,
      {exact_sum('share', '1e9')} AS top_share
      FROM (SELECT share FROM shares ORDER BY share DESC, pickup_zone LIMIT 10)""",
)
def j14(spark, sf_dir):
    return zoning.concentration(_shares(spark, sf_dir))


@register(
    "e15_inertia_fixed_centres",
    with_("points") + f"""SELECT {exact_sum('''weight * list_min([''' + ", ".join(
        f"(start_lat - {a!r}::DOUBLE) * (start_lat - {a!r}::DOUBLE)"
        f" + (start_lng - ({b!r})::DOUBLE) * (start_lng - ({b!r})::DOUBLE)"
        for a, b in CENTRES) + '''])''', '1e9')} AS inertia FROM points""",
)
def e15(spark, sf_dir):
    return zoning.inertia(_points(spark, sf_dir), CENTRES)


DISTANCE = """sqrt((a.start_lat - b.start_lat) * (a.start_lat - b.start_lat)
  + (a.start_lng - b.start_lng) * (a.start_lng - b.start_lng))"""


@register(
    "d10_summed_distances",
    with_("labelled") + f"""SELECT a.pickup_location_id, a.pickup_zone, a.weight,
      b.pickup_zone AS cluster, {exact_sum('b.weight * ' + DISTANCE, '1e9')} AS distance
      FROM labelled a CROSS JOIN labelled b GROUP BY ALL""",
)
def d10(spark, sf_dir):
    return zoning.summed_distances(_labelled(spark, sf_dir))


@register(
    "e14_weighted_silhouette",
    with_("labelled") + f"""
    , pairs AS (SELECT a.pickup_location_id AS p, a.pickup_zone AS own, a.weight AS w,
        b.pickup_zone AS c, sum(b.weight * {DISTANCE}) AS d FROM labelled a CROSS JOIN labelled b
        GROUP BY ALL)
    , sizes AS (SELECT pickup_zone AS c, sum(weight) AS cw FROM labelled GROUP BY ALL)
    , per AS (SELECT p, w, max(CASE WHEN own = c THEN d / greatest(cw - 1, 1) END) AS a,
        max(CASE WHEN own = c THEN cw END) AS cw, min(CASE WHEN own <> c THEN d / cw END) AS b
        FROM pairs JOIN sizes USING (c) GROUP BY ALL)
    SELECT round(sum(w * CASE WHEN cw <= 1 OR greatest(a, b) = 0 THEN 0
                         ELSE (b - a) / greatest(a, b) END) / sum(w), 6) AS silhouette FROM per""",
)
def e14(spark, sf_dir):
    score = zoning.weighted_silhouette(_labelled(spark, sf_dir), block_points=16)
    return score.select(F.round("silhouette", 6).alias("silhouette"))


block(
    "vec", sql="""SELECT vec_id AS pickup_location_id, CAST(embedding[1] AS DOUBLE) AS start_lat,
      CAST(embedding[2] AS DOUBLE) AS start_lng, label AS pickup_zone,
      CAST(vec_id % 5 + 1 AS BIGINT) AS weight FROM embeddings""",
)


@register(
    "e14_silhouette_embeddings",
    with_("vec") + f"""
    , pairs AS (SELECT a.pickup_location_id AS p, a.pickup_zone AS own, a.weight AS w,
        b.pickup_zone AS c, sum(b.weight * {DISTANCE}) AS d FROM vec a CROSS JOIN vec b
        GROUP BY ALL)
    , sizes AS (SELECT pickup_zone AS c, sum(weight) AS cw FROM vec GROUP BY ALL)
    , per AS (SELECT p, w, max(CASE WHEN own = c THEN d / greatest(cw - 1, 1) END) AS a,
        max(CASE WHEN own = c THEN cw END) AS cw, min(CASE WHEN own <> c THEN d / cw END) AS b
        FROM pairs JOIN sizes USING (c) GROUP BY ALL)
    SELECT round(sum(w * CASE WHEN cw <= 1 OR greatest(a, b) = 0 THEN 0
                         ELSE (b - a) / greatest(a, b) END) / sum(w), 6) AS silhouette FROM per""",
)
def e14_embeddings(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("pickup_location_id"),
        F.col("embedding")[0].cast("double").alias("start_lat"),
        F.col("embedding")[1].cast("double").alias("start_lng"),
        F.col("label").alias("pickup_zone"),
        (F.col("vec_id") % 5 + 1).alias("weight"),
    )
    score = zoning.weighted_silhouette(points, block_points=128)
    return score.select(F.round("silhouette", 6).alias("silhouette"))


# Every supplier is a square; even ones have a square hole; a nation merges its suppliers.
SQUARE_X, SQUARE_Y = [0, 1, 1, 0, 0], [0, 0, 1, 1, 0]
block(
    "vertices",
    sql="""
    SELECT s_nationkey AS id, n_name AS name, s_suppkey AS shape, CAST(r AS INTEGER) AS ring,
      CAST(i AS INTEGER) AS seq,
      CAST(x0 + CASE WHEN r = 0 THEN side * [0, 1, 1, 0, 0][i + 1]
                     ELSE 2 + 2 * [0, 0, 1, 1, 0][i + 1] END AS DOUBLE) AS x,
      CAST(y0 + CASE WHEN r = 0 THEN side * [0, 0, 1, 1, 0][i + 1]
                     ELSE 2 + 2 * [0, 1, 1, 0, 0][i + 1] END AS DOUBLE) AS y
    FROM (SELECT *, floor(s_acctbal) AS x0, s_suppkey % 97 * 10 AS y0,
            6 + s_suppkey % 7 AS side FROM supplier JOIN nation ON n_nationkey = s_nationkey)
      CROSS JOIN range(2) a(r) CROSS JOIN range(5) b(i)
    WHERE r = 0 OR s_suppkey % 2 = 0""",
)


@register(
    "e16_polygon_centroids",
    with_("vertices") + """
    , edges AS (SELECT a.id, a.x * b.y - b.x * a.y AS cr, a.x + b.x AS sx, a.y + b.y AS sy
        FROM vertices a JOIN vertices b ON a.id = b.id AND a.shape = b.shape AND a.ring = b.ring
          AND b.seq = a.seq + 1)
    SELECT id, name, area, round(mx / area, 6) AS x, round(my / area, 6) AS y
    FROM (SELECT id, sum(cr) / 2 AS area, sum(sx * cr) / 6 AS mx, sum(sy * cr) / 6 AS my
          FROM edges GROUP BY id) JOIN (SELECT id, min(name) AS name FROM vertices GROUP BY id)
      USING (id)""",
)
def e16(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("name")
    )
    side = F.col("s_suppkey") % 7 + 6
    corners = F.arrays_zip(
        F.sequence(F.lit(0), F.lit(4)).alias("seq"),
        F.array(*map(F.lit, SQUARE_X)).alias("u"),
        F.array(*map(F.lit, SQUARE_Y)).alias("v"),
    )
    rings = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    vertices = (
        table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey")
        .withColumn("ring", F.explode(rings))
        .withColumn("corner", F.explode(corners))
        .select(
            F.col("s_nationkey").alias("id"),
            "name",
            F.col("s_suppkey").alias("shape"),
            "ring",
            F.col("corner.seq").alias("seq"),
            (
                F.floor("s_acctbal")
                + F.when(F.col("ring") == 0, side * F.col("corner.u")).otherwise(
                    F.col("corner.v") * 2 + 2
                )
            ).cast("double").alias("x"),
            (
                F.col("s_suppkey") % 97 * 10
                + F.when(F.col("ring") == 0, side * F.col("corner.v")).otherwise(
                    F.col("corner.u") * 2 + 2
                )
            ).cast("double").alias("y"),
        )
    )
    found = polygon_centroids(vertices)
    return found.withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@register(
    "b4_known_locations_on_partials",
    with_("ev_measured", "centroids") + """
    SELECT pickup_location_id, CAST(start_time AS DATE) AS date,
      CAST(hour(start_time) AS INTEGER) AS hour, count(*) AS ride_count FROM ev_measured
    WHERE pickup_location_id IN (SELECT location_id FROM centroids) GROUP BY ALL""",
)
def b4_partials(spark, sf_dir):
    reduced = location_hour_daily(ev_measured(spark, sf_dir))
    return known_locations(reduced, lattice_centroids(spark)).select(*PARTIAL_KEYS, "ride_count")
