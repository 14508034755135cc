"""Inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.sql import CENTRES, N_ZONES
from kerbcast.operators.cleaning import clean_trips, measure_trips
from kerbcast.operators.grid import zone_hour_daily_from_partials
from kerbcast.operators.partials import covered_months, partials_from_trips
from kerbcast.operators.zoning import assign_zones, zone_map
from kerbcast.plans.forecast import Zoning, zoning_from_centres
from kerbcast.session import settle, shared_folder
from kerbcast.sources.standins import (
    EVENT_MONTH,
    ORDER_FIRST_MONTH,
    ORDER_MONTHS,
    event_trips,
    lattice_centroids,
    order_trips,
)
from kerbcast.sources.trips import normalize_trips

def ev_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_trips(event_trips(spark, sf_dir), keep=["event_id"])


def ev_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_trips(ev_raw(spark, sf_dir), EVENT_MONTH, keep=["event_id"])


def ev_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(
        ev_raw(spark, sf_dir), EVENT_MONTH, lattice_centroids(spark), keep=["event_id"]
    )


def ev_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = normalize_trips(event_trips(spark, sf_dir))
    return partials_from_trips(trips, EVENT_MONTH, lattice_centroids(spark))


def or_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = normalize_trips(order_trips(spark, sf_dir))
    return partials_from_trips(trips, ORDER_FIRST_MONTH, lattice_centroids(spark), ORDER_MONTHS)


def or_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partials of months without coverage problems, from one reduction of the trips."""
    return covered_months(settle(or_partials(spark, sf_dir)))


def fixed_zone_map(spark: SparkSession) -> DataFrame:
    """Locations mapped to fixed centres, so that SQL can follow."""
    return zone_map(lattice_centroids(spark), CENTRES)


def ev_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = assign_zones(ev_clean(spark, sf_dir), CENTRES)
    return trips.withColumn("hour", F.hour("start_time"))


def ev_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_hour_daily_from_partials(
        ev_partials(spark, sf_dir), fixed_zone_map(spark), N_ZONES
    )


def ev_zoning(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Zoning]:
    """The event month's partials, read several times from here on, and its zoning."""
    partials = settle(ev_partials(spark, sf_dir))
    return partials, zoning_from_centres(partials, lattice_centroids(spark), CENTRES)


def scratch(spark: SparkSession) -> str:
    """A fresh folder every executor can reach, removed when the application ends."""
    return shared_folder(spark, "run")
