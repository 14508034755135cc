"""K-means as SQL: the draw of first centres and every Lloyd step, replayed."""

from __future__ import annotations

from collections.abc import Sequence

from catalog.sql import exact_sum
from kerbcast import settings as S
from kerbcast.operators.lloyd import STARTS

#: Steps replayed; settings that have settled no longer move.
STEPS = 30


def steps_of(value: str) -> str:
    return f"CAST(round_even({value} * 1e9, 0) AS BIGINT)"


def hex_number(text: str) -> str:
    """The number that hexadecimal digits spell."""
    digits = f"list_transform(split({text}, ''), lambda c: CAST(strpos('0123456789abcdef', c) - 1 AS BIGINT))"
    return f"list_reduce({digits}, lambda a, b: a * 16 + b)"


def squared(a: str, b: str) -> str:
    return f"({a}.lat - {b}.lat) * ({a}.lat - {b}.lat) + ({a}.lng - {b}.lng) * ({a}.lng - {b}.lng)"


def kmeans(points: str, counts: Sequence[int]) -> str:
    """CTEs from ``points`` (fold, p, lat, lng, w) to ``km_centres`` (fold, k, z, lat, lng) and
    ``km_labels`` (fold, k, p, lat, lng, w, z, d2)."""
    parts = [
        f"""km_spots AS MATERIALIZED (SELECT fold, lat, lng, CAST(sum(w) AS BIGINT) AS w,
            {steps_of('lat')} AS lat9, {steps_of('lng')} AS lng9 FROM {points} GROUP BY fold, lat, lng)""",
        f"""km_drawn AS MATERIALIZED (SELECT fold, s, lat, lng,
            row_number() OVER (PARTITION BY fold, s ORDER BY draw, lat, lng) - 1 AS z
          FROM (SELECT *, -ln((h + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE)) / w AS draw FROM
            (SELECT *, {hex_number(f"substr(md5('{S.SEED}:' || s || ':' || lat9 || ':' || lng9), 1, 13)")} AS h
             FROM km_spots CROSS JOIN range({STARTS}) r(s))))""",
        f"""km_0 AS MATERIALIZED (SELECT fold, k, s, z, lat, lng FROM km_drawn
          JOIN (SELECT unnest({list(counts)}) AS k) ON z < k
          JOIN (SELECT fold, count(*) AS n FROM {points} GROUP BY fold) USING (fold) WHERE k < n)""",
    ]

    def near(centres: str, *columns: str) -> str:
        own = ", ".join(f"p.{c}" for c in columns)
        return f"""(SELECT c.fold, c.k, c.s, {own}, min({{'d2': {squared('p', 'c')}, 'z': c.z}}) AS near
            FROM km_spots p JOIN {centres} c ON p.fold = c.fold GROUP BY ALL)"""

    for step in range(1, STEPS + 1):
        parts.append(
            f"""km_{step} AS MATERIALIZED (SELECT c.fold, c.k, c.s, c.z, coalesce(a.lat, c.lat) AS lat, coalesce(a.lng, c.lng) AS lng
          FROM km_{step - 1} c LEFT JOIN (
            SELECT fold, k, s, near.z AS z, CAST(sum(CAST(w AS HUGEINT) * lat9) AS DOUBLE) / 1e9 / sum(w) AS lat,
              CAST(sum(CAST(w AS HUGEINT) * lng9) AS DOUBLE) / 1e9 / sum(w) AS lng
            FROM {near(f'km_{step - 1}', 'lat9', 'lng9', 'w')} GROUP BY ALL) a
          ON a.fold = c.fold AND a.k = c.k AND a.s = c.s AND a.z = c.z)"""
        )
    parts += [
        f"""km_inertia AS (SELECT fold, k, s, {exact_sum('near.d2 * w', '1e9')} AS inertia
            FROM {near(f'km_{STEPS}', 'lat', 'lng', 'w')} GROUP BY ALL)""",
        f"""km_centres AS MATERIALIZED (SELECT fold, k, lat, lng,
            CAST(row_number() OVER (PARTITION BY fold, k ORDER BY lat, lng) - 1 AS INTEGER) AS z
          FROM km_{STEPS} JOIN (SELECT fold, k, min({{'i': inertia, 's': s}}).s AS s FROM km_inertia GROUP BY ALL)
            USING (fold, k, s))""",
        f"""km_labels AS MATERIALIZED (SELECT fold, k, p, lat, lng, w, near.z AS z, near.d2 AS d2 FROM (
            SELECT c.fold, c.k, p.p, p.lat, p.lng, p.w, min({{'d2': {squared('p', 'c')}, 'z': c.z}}) AS near
            FROM {points} p JOIN km_centres c ON p.fold = c.fold GROUP BY ALL))""",
    ]
    return ",\n".join(parts)


#: Silhouette of every k over km_labels, from distances in whole steps.
SILHOUETTES = f"""sil_pairs AS (SELECT a.k, a.p, a.w, a.z AS own, b.z AS c,
        CAST(sum(CAST(b.w AS HUGEINT) * {steps_of(f'sqrt({squared("a", "b")})')}) AS DOUBLE) / 1e9 AS d
      FROM km_labels a JOIN km_labels b ON a.k = b.k GROUP BY ALL),
    sil_sizes AS (SELECT k, z AS c, CAST(sum(w) AS DOUBLE) AS cw FROM km_labels GROUP BY ALL),
    sil_points AS (SELECT k, p, w, max(CASE WHEN own = c THEN d / greatest(cw - 1, 1) END) AS a,
        max(CASE WHEN own = c THEN cw END) AS cw, min(CASE WHEN own <> c THEN d / cw END) AS b
      FROM sil_pairs JOIN sil_sizes USING (k, c) GROUP BY ALL),
    silhouettes AS (SELECT k, {exact_sum('score * w', '1e9')} / CAST(sum(w) AS DOUBLE) AS silhouette FROM (
        SELECT *, CASE WHEN cw > 1 AND greatest(a, b) > 0 AND b IS NOT NULL THEN (b - a) / greatest(a, b) ELSE 0 END AS score
        FROM sil_points) GROUP BY k)"""
