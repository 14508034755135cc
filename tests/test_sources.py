import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.operators.cleaning import measure_trips
from kerbcast.operators.partials import location_hour_daily
from kerbcast.sources import ingest, records
from kerbcast.sources.centroids import centroids_present, read_centroids, write_centroids
from kerbcast.sources.trips import normalize_trips, scan_trips
from kerbcast.streaming.demand import UPDATE_SCHEMA, UpdateLog, current_partials, run_hourly_partials
from kerbcast.streaming.ingest import ingest_stream

MARCH, APRIL, MAY = (dt.date(2026, m, 1) for m in (3, 4, 5))


def land(df, landing, month):
    df.write.parquet(f"{landing}/month={month:%Y-%m}")


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "landing"), str(tmp_path / "curated")


@pytest.fixture(scope="module")
def april(month_trips):
    return month_trips("2026-04-01", 3, per_day=5)


def months(spark, path):
    return [row["month"] for row in ingest.available_months(spark, path).collect()]


def damage(path):
    """Overwrite bytes in the middle of a data file, leaving its footer alone."""
    name = glob.glob(os.path.join(path, "*.parquet"))[0]
    with open(name, "r+b") as file:
        file.seek(40)
        file.write(b"\xff" * 200)
    crc = os.path.join(path, "." + os.path.basename(name) + ".crc")
    if os.path.exists(crc):
        os.truncate(crc, 0)


def test_no_folder_means_no_months(spark, tmp_path):
    assert months(spark, str(tmp_path / "nowhere")) == []


def test_ingest_takes_new_months_and_leaves_present_ones(spark, folders, april, month_trips):
    landing, curated = folders
    land(april, landing, APRIL)
    first = ingest.ingest_months(spark, landing, curated, "2026-03", "2026-05")
    assert (first.downloaded, first.not_published) == ([APRIL], [MARCH, MAY])
    before = sorted(glob.glob(f"{curated}/month=2026-04/*.parquet"))
    land(month_trips("2026-05-01", 2, per_day=5), landing, MAY)
    second = ingest.ingest_months(spark, landing, curated, "2026-03", "2026-05")
    assert (second.already_present, second.downloaded) == ([APRIL], [MAY])
    assert sorted(glob.glob(f"{curated}/month=2026-04/*.parquet")) == before
    assert months(spark, curated) == [APRIL, MAY]
    assert scan_trips(spark, curated, ["2026-4"]).count() == april.count()


def test_published_types_do_not_depend_on_the_file(spark, folders, april):
    landing, curated = folders
    odd = april.withColumns(
        {
            "PULocationID": F.col("PULocationID").cast("double"),
            "fare_amount": F.col("fare_amount").cast("int"),
            "extra": F.lit("kept"),
        }
    )
    land(odd, landing, APRIL)
    ingest.ingest_months(spark, landing, curated, "2026-04", "2026-04")
    table = ingest.read_table(spark, curated)
    assert dict(table.dtypes)["PULocationID"] == "int" and "extra" in table.columns
    assert dict(table.dtypes)["fare_amount"] == "double"


@pytest.mark.parametrize(
    "break_it, rule",
    [
        (lambda df: df.drop("trip_distance"), "missing_column trip_distance"),
        (lambda df: df.withColumn("fare_amount", F.col("fare_amount").cast("string")), "wrong_type"),
        (
            lambda df: df.withColumn("tpep_dropoff_datetime", F.lit(5)),
            "wrong_type tpep_dropoff_datetime",
        ),
    ],
)
def test_a_broken_contract_leaves_nothing_behind(spark, folders, april, break_it, rule):
    landing, curated = folders
    land(break_it(april), landing, APRIL)
    with pytest.raises(ingest.ContractError, match=rule):
        ingest.ingest_months(spark, landing, curated, "2026-04", "2026-04")
    assert months(spark, curated) == []


def test_damaged_pages_are_found_even_in_unused_columns(spark, folders, april):
    landing, curated = folders
    unused_first = april.select(F.uuid().alias("unused"), "*").coalesce(1)
    land(unused_first, landing, APRIL)
    damage(f"{landing}/month=2026-04")
    with pytest.raises(ingest.ContractError, match="unreadable"):
        ingest.ingest_months(spark, landing, curated, "2026-04", "2026-04")
    assert months(spark, curated) == []


def test_months_before_a_broken_one_stay_published(spark, folders, april):
    landing, curated = folders
    land(april, landing, APRIL)
    land(april.drop("fare_amount"), landing, MAY)
    with pytest.raises(ingest.ContractError):
        ingest.ingest_months(spark, landing, curated, "2026-04", "2026-05")
    assert months(spark, curated) == [APRIL]


def test_every_file_of_a_month_is_checked(spark, folders, april):
    landing, curated = folders
    folder = f"{landing}/month=2026-04"
    april.coalesce(1).write.parquet(folder)
    april.drop("fare_amount").coalesce(1).write.mode("append").parquet(folder)
    found = ingest.contract_violations(spark, folder).collect()
    assert [(r["rule"], r["column_name"]) for r in found] == [("missing_column", "fare_amount")]
    with pytest.raises(ingest.ContractError, match="missing_column fare_amount"):
        ingest.ingest_months(spark, landing, curated, "2026-04", "2026-04")
    assert months(spark, curated) == []


def test_many_footers_are_read_side_by_side(spark, folders, april):
    folder = f"{folders[0]}/month=2026-04"
    april.repartition(30).write.parquet(folder)
    april.drop("fare_amount").repartition(5).write.mode("append").parquet(folder)
    for k in range(3):
        with open(f"{folder}/part-9999{k}.parquet", "wb") as broken:
            broken.write(b"no footer here")
    (groups, found), (alone, same) = (ingest.files_by_schema(spark, folder, n) for n in (8, 1))
    rules = sorted(rule for _, rule, _, _ in found)
    assert rules == ["missing_column"] * 5 + ["unreadable"] * 3
    assert [row[:3] for row in found] == [row[:3] for row in same]
    assert sorted(g.count() for g in groups) == sorted(g.count() for g in alone)


def test_files_of_a_month_may_differ_in_types_and_extras(spark, folders, april):
    landing, curated = folders
    folder = f"{landing}/month=2026-04"
    april.coalesce(1).write.parquet(folder)
    other = april.withColumn("PULocationID", F.col("PULocationID").cast("double")).withColumn("tip", F.lit(1.5))
    other.coalesce(1).write.mode("append").parquet(folder)
    ingest.ingest_months(spark, landing, curated, "2026-04", "2026-04")
    table = ingest.read_table(spark, curated)
    assert table.count() == 2 * april.count() and table.filter("tip = 1.5").count() == april.count()
    assert not glob.glob(f"{curated}_staging/*")


def test_a_pair_replaced_by_another_changes_the_checksum(spark):
    one, other = (spark.createDataFrame([(x,), (x,), (3,)], "x int") for x in (1, 2))
    assert ingest.checksum(one) != ingest.checksum(other)


def test_other_failures_are_not_violations(spark):
    with pytest.raises(PermissionError):
        ingest._unreadable("somewhere", PermissionError("denied"))


def test_a_broken_month_does_not_hold_up_the_stream(spark, folders, april, tmp_path):
    landing, curated = folders
    checkpoint = str(tmp_path / "checkpoint")
    land(april.drop("fare_amount"), landing, APRIL)
    land(april, landing, MAY)
    ingest_stream(spark, landing, curated, checkpoint).awaitTermination()
    assert months(spark, curated) == [MAY]
    april.coalesce(1).write.mode("append").parquet(f"{landing}/month=2026-05")
    ingest_stream(spark, landing, curated, checkpoint).awaitTermination()
    notes = spark.read.parquet(f"{curated}_rejected").select("month", "kind").collect()
    assert sorted(map(tuple, notes)) == [(APRIL, "violation"), (MAY, "late")]


def test_stream_ingest_reads_new_files_once(spark, folders, april, tmp_path):
    landing, curated = folders
    checkpoint = str(tmp_path / "checkpoint")
    land(april, landing, APRIL)
    ingest_stream(spark, landing, curated, checkpoint).awaitTermination()
    land(april, landing, MAY)
    ingest_stream(spark, landing, curated, checkpoint).awaitTermination()
    assert months(spark, curated) == [APRIL, MAY]
    assert ingest.read_table(spark, curated).count() == 2 * april.count()


def test_streamed_partials_equal_batch(spark, month_trips, tmp_path):
    trips = month_trips("2026-06-01", 6, per_day=40)
    path = str(tmp_path / "trips")
    for day in range(1, 7):  # files arrive in time order
        part = trips.filter(F.dayofmonth("tpep_pickup_datetime") == day)
        part.coalesce(1).write.mode("append").parquet(path)
    stream = (
        spark.readStream.schema(trips.schema).option("maxFilesPerTrigger", 1).parquet(path)
    )
    measured = measure_trips(normalize_trips(stream), "2026-06")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    # Files may be read in any order; no row is too late.
    run_hourly_partials(measured, out, checkpoint, fold_every=2).awaitTermination()
    assert UpdateLog(spark, out).folders()[0].startswith(UpdateLog(spark, out).snapshots)
    streamed = current_partials(spark, out)
    batch = location_hour_daily(measure_trips(normalize_trips(trips), "2026-06"))
    assert sorted(map(tuple, streamed.select(batch.columns).collect())) == sorted(
        map(tuple, batch.collect())
    )


def test_folding_the_update_log_changes_no_state(spark, tmp_path):
    log = UpdateLog(spark, str(tmp_path / "log"))
    columns = [c for c in UPDATE_SCHEMA.split(", ") if c != "batch bigint"]

    def batch(number):
        keys = range(number, number + 4)  # each batch changes some rows of the one before
        rows = [(k, dt.date(2026, 6, 1), 5, number, 1.0, 1, 0.5, 1) for k in keys]
        return spark.createDataFrame(rows, ", ".join(columns))

    def state():
        return sorted(map(tuple, log.state().collect()))

    expected, opened = {}, []
    assert state() == []
    log.fold()
    for number in range(12):
        log.append(batch(number), number)
        expected |= {k: number for k in range(number, number + 4)}
        before, listed = state(), log.state()
        assert [(r[0], r[-1]) for r in before] == sorted(expected.items())
        if number % 3 == 2:
            log.fold()
            # The same before the fold, by folders listed before it, and after it.
            assert state() == before == sorted(map(tuple, listed.collect()))
            log.append(batch(number), number)  # replayed
            log.fold()
            assert state() == before
        opened.append(len(log.folders()))
    assert max(opened) <= 4
    assert len(list((tmp_path / "log").glob("batch=*"))) <= 6
    # Neither an unfinished snapshot nor an unfinished batch is read.
    for name in ("_snapshots/upto=99", "batch=99"):
        batch(50).write.parquet(f"{log.out}/{name}")
        (tmp_path / "log" / name / "_SUCCESS").unlink()
    assert state() == before


def test_centroid_lookup_is_written_once(spark, grid_centroids, tmp_path):
    path = str(tmp_path / "centroids")
    assert not centroids_present(spark, path)
    assert write_centroids(grid_centroids, path)
    assert not write_centroids(grid_centroids.limit(1), path)
    found = read_centroids(spark, path)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, grid_centroids.collect()))


def test_an_unfinished_lookup_is_replaced(spark, grid_centroids, tmp_path):
    path = tmp_path / "centroids"
    (path / "_temporary").mkdir(parents=True)
    assert write_centroids(grid_centroids, str(path))


DECISION = {
    "promoted": True,
    "reason": "there is no current model",
    "candidate_version": 1,
    "previous_version": None,
    "candidate_wape": 0.25,
    "current_wape": None,
    "evaluation_wape": 0.25,
    "test_month": "2026-08",
}


def test_already_current_never_replaces_a_record(spark, tmp_path):
    path = str(tmp_path / "decision")
    bare = {**DECISION, "promoted": False, "reason": S.ALREADY_CURRENT}
    assert records.record_decision(spark, bare, path)
    assert records.record_decision(spark, DECISION, path)
    assert not records.record_decision(spark, bare, path)
    assert records.read_records(spark, path, records.DECISION_SCHEMA).first().asDict() == DECISION


def test_metrics_record(spark, tmp_path):
    path = str(tmp_path / "metrics")
    metadata = {"metrics": {}, "n_train_rows": 480, "n_test_rows": 0}
    records.save_metrics(spark, metadata, path)
    row = records.read_records(spark, path, records.METRICS_SCHEMA).first()
    assert tuple(row) == (None, None, None, 480, 0)
