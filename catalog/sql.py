"""SQL building blocks shared by the expected-answer queries.

``with_(*names)`` opens a WITH list holding the named blocks and all they build on.
"""

from __future__ import annotations

# Each block: (what it builds on, its SQL).
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {}


def block(name: str, *needs: str, sql: str) -> None:
    BLOCKS[name] = (needs, sql)


def with_(*names: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in BLOCKS[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{name} AS ({BLOCKS[name][1]})" for name in ordered) + "\n"


def exact_sum(value: str, unit: str = "1e6") -> str:
    return f"CAST(sum(CAST(round_even(({value}) * {unit}, 0) AS HUGEINT)) AS DOUBLE) / {unit}"


def exact_mean(value: str, unit: str = "1e6") -> str:
    return f"({exact_sum(value, unit)}) / nullif(count({value}), 0)"


def nearest(lat: str, lng: str, centres: list[tuple[float, float]]) -> str:
    """Index of the closest centre, the lowest on ties."""
    pairs = ", ".join(
        f"{{'d2': ({lat} - {a!r}::DOUBLE) * ({lat} - {a!r}::DOUBLE)"
        f" + ({lng} - ({b!r})::DOUBLE) * ({lng} - ({b!r})::DOUBLE), 'z': {z}}}"
        for z, (a, b) in enumerate(centres)
    )
    return f"struct_extract(list_sort([{pairs}])[1], 'z')"


# --- the stand-in trips --------------------------------------------------------------
block(
    "ev_raw",
    sql="""
    SELECT event_id, event_type, ts AS start_time,
      CASE WHEN k % 50 <> 49 THEN ts + to_minutes(k) END AS end_time,
      CAST(user_id % 60 + 1 AS INTEGER) AS pickup_location_id,
      CAST((user_id * 7 + k) % 65 + 1 AS INTEGER) AS dropoff_location_id,
      CASE WHEN event_type IN ('view', 'signup') AND k % 25 = 0 THEN 0.0::DOUBLE
           ELSE round(value / 5, 2) END AS miles,
      CASE WHEN k = 77 THEN NULL
           WHEN event_type = 'error' AND k % 10 = 0 THEN -value ELSE value END AS fare_amount
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
)
block(
    "or_raw",
    sql="""
    SELECT o_orderkey,
      o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS start_time,
      o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
        + to_minutes(CAST(o_orderkey % 37 + 4 AS INTEGER)) AS end_time,
      CAST(o_custkey % 60 + 1 AS INTEGER) AS pickup_location_id,
      CAST(o_orderkey % 65 + 1 AS INTEGER) AS dropoff_location_id,
      floor(o_totalprice / 1000) / 50 AS miles,
      o_totalprice / 1000 AS fare_amount
    FROM orders""",
)
block(
    "centroids",
    sql="""
    SELECT CAST(id AS INTEGER) AS location_id, 'Zone ' || id AS zone,
      'Borough ' || ((id - 1) % 6) AS borough,
      40.55::DOUBLE + 0.06::DOUBLE * ((id - 1) % 6) AS lat,
      -74.15::DOUBLE + 0.035::DOUBLE * floor((id - 1) / 6) AS lng
    FROM range(1, 66) t(id) WHERE id % 13 <> 0""",
)


def _measured(source: str, extra: str) -> str:
    return f"""
    SELECT {extra}, start_time, pickup_location_id, dropoff_location_id, fare_amount,
      CASE WHEN minutes BETWEEN 1 AND 180 AND NOT fast THEN minutes END AS ride_duration_min,
      CASE WHEN miles BETWEEN 0.1::DOUBLE AND 60 AND NOT fast THEN miles * 1.609344::DOUBLE END
        AS ride_distance_km
    FROM (SELECT *, coalesce(miles / (CASE WHEN minutes > 0 THEN minutes END / 60) > 70, false)
                    AS fast
          FROM (SELECT *, (epoch_us(end_time) - epoch_us(start_time)) / 6e7 AS minutes
                FROM {source}))
    WHERE NOT coalesce(fare_amount < 0, false)
      AND NOT coalesce(minutes < 1 AND miles = 0, false)"""


block("ev_measured", "ev_raw", sql=_measured("ev_raw", "event_id")
      + " AND start_time >= TIMESTAMP '2024-01-01' AND start_time < TIMESTAMP '2024-02-01'")
block("or_measured", "or_raw", sql=_measured("or_raw", "o_orderkey")
      + " AND start_time >= TIMESTAMP '1995-01-01' AND start_time < TIMESTAMP '2001-09-01'")
for _src in ("ev", "or"):
    block(
        f"{_src}_clean", f"{_src}_measured", "centroids",
        sql=f"""
    SELECT m.*, p.lat AS start_lat, p.lng AS start_lng, d.lat AS end_lat, d.lng AS end_lng
    FROM {_src}_measured m JOIN centroids p ON p.location_id = m.pickup_location_id
    LEFT JOIN centroids d ON d.location_id = m.dropoff_location_id""",
    )
    block(
        f"{_src}_partials", f"{_src}_clean",
        sql=f"""
    SELECT pickup_location_id, CAST(start_time AS DATE) AS date,
      CAST(hour(start_time) AS INTEGER) AS hour, count(*) AS ride_count,
      coalesce({exact_sum('ride_duration_min', '6e7')}, 0) AS duration_sum,
      count(ride_duration_min) AS duration_n,
      coalesce({exact_sum('ride_distance_km')}, 0) AS distance_sum,
      count(ride_distance_km) AS distance_n
    FROM {_src}_clean GROUP BY ALL""",
    )


# --- zones and dense tables ----------------------------------------------------------
def lattice_centres(n: int) -> list[tuple[float, float]]:
    """``n`` fixed zone centres over the stand-in locations."""
    return [(40.56 + 0.09 * (i % 4), -74.13 + 0.35 * (i // 4) / max(1, (n + 3) // 4)) for i in range(n)]


N_ZONES = 20
CENTRES = lattice_centres(N_ZONES)

block(
    "zone_map", "centroids",
    sql=f"""
    SELECT location_id AS pickup_location_id,
      CAST({nearest('lat', 'lng', CENTRES)} AS INTEGER) AS pickup_zone FROM centroids""",
)
for _src in ("ev", "or"):
    block(
        f"{_src}_zhd", f"{_src}_partials", "zone_map",
        sql=f"""
    SELECT CAST(z.z AS INTEGER) AS pickup_zone, CAST(h.h AS INTEGER) AS hour, d.date,
      CAST(coalesce(c.n, 0) AS BIGINT) AS ride_count
    FROM range({N_ZONES}) z(z) CROSS JOIN range(24) h(h)
      CROSS JOIN (SELECT DISTINCT date FROM {_src}_partials) d
      LEFT JOIN (SELECT pickup_zone, hour, date, sum(ride_count) AS n
                 FROM {_src}_partials JOIN zone_map USING (pickup_location_id) GROUP BY ALL) c
        ON c.pickup_zone = z.z AND c.hour = h.h AND c.date = d.date""",
    )
    block(
        f"{_src}_sums", f"{_src}_partials", "zone_map",
        sql=f"""
    SELECT pickup_zone, hour, {exact_sum('duration_sum', '6e7')} AS duration_sum,
      sum(duration_n) AS duration_n, {exact_sum('distance_sum')} AS distance_sum,
      sum(distance_n) AS distance_n
    FROM {_src}_partials JOIN zone_map USING (pickup_location_id) GROUP BY ALL""",
    )

    def _level(prefix: str, unit: str) -> str:
        total, n = f"{prefix}_sum", f"{prefix}_n"
        return f"""coalesce(s.{total} / nullif(s.{n}, 0), zs.{total} / nullif(zs.{n}, 0),
          t.{total} / nullif(t.{n}, 0))"""

    _total = f"""SELECT %s {exact_sum('duration_sum', '6e7')} AS duration_sum,
          sum(duration_n) AS duration_n, {exact_sum('distance_sum')} AS distance_sum,
          sum(distance_n) AS distance_n FROM {_src}_sums %s"""
    block(
        f"{_src}_profile", f"{_src}_sums",
        sql=f"""
    SELECT CAST(z.z AS INTEGER) AS pickup_zone, CAST(h.h AS INTEGER) AS hour,
      {_level('duration', '6e7')} AS avg_ride_duration_min,
      {_level('distance', '1e6')} AS avg_ride_distance
    FROM range({N_ZONES}) z(z) CROSS JOIN range(24) h(h)
      LEFT JOIN {_src}_sums s ON s.pickup_zone = z.z AND s.hour = h.h
      LEFT JOIN ({_total % ('pickup_zone,', 'GROUP BY pickup_zone')}) zs ON zs.pickup_zone = z.z
      CROSS JOIN ({_total % ('', '')}) t""",
    )
    block(
        f"{_src}_features", f"{_src}_zhd", f"{_src}_profile",
        sql=f"""
    SELECT date, pickup_zone, hour, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
      avg_ride_duration_min, avg_ride_distance, ride_count
    FROM {_src}_zhd LEFT JOIN {_src}_profile USING (pickup_zone, hour)""",
    )
block(
    "ev_zoned", "ev_clean", "zone_map",
    sql="""
    SELECT c.*, z.pickup_zone, CAST(hour(start_time) AS INTEGER) AS hour
    FROM ev_clean c JOIN zone_map z USING (pickup_location_id)""",
)


def metrics(truth: str = "ride_count", guess: str = "prediction") -> str:
    error = f"({truth} - {guess})"
    return f"""{exact_mean(f'abs{error}')} AS mae,
      sqrt({exact_mean(f'{error} * {error}')}) AS rmse,
      ({exact_sum(f'abs{error}')}) / nullif(CAST(sum({truth}) AS DOUBLE), 0) AS wape,
      count(*) AS n_test_rows"""
