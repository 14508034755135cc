import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

# One query of every kind; tools/check.py runs them all.
CHOSEN = (
    "a1_trip_scan",
    "c4_trusted_measurements",
    "d10_summed_distances",
    "e4_location_hour_day",
    "e6_profile_fallback_levels",
    "e8_coverage_orders",
    "e16_polygon_centroids",
    "f4_rolling_origin_folds",
    "g2_weekday_demand_ranking",
    "i8_e11_mean_backtest",
    "i16_comparison_cases",
    "i17_c15_promotion_decisions",
    "i19_register_new_runs",
    "j1_split_diagnosis",
    "j4_e10_baseline_scores",
    "j8_mae_interval",
    "b6_b7_b8_checked_requests",
)


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 100


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, sql, name):
    found = QUERIES[name](spark, SF_DIR)
    result = sql.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(found.columns)
    rows = rows_of(found.columns, [tuple(row) for row in found.collect()])
    assert rows == rows_of(columns, result.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 7 * 24 * 20
