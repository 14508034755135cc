"""Concurrent jobs with kept results."""

import threading
import time
from functools import partial

import pytest
from pyspark.sql import functions as F

from kerbcast.plans.pool import KeyedResults, run_all

SCHEMA = "name string, part int, total long"


def test_jobs_overlap_within_their_bound_and_keep_their_keys(spark):
    lock, now, most = threading.Lock(), [0], [0]

    def job(n):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        total = spark.range(n).agg(F.sum("id")).first()[0]
        time.sleep(0.3)
        with lock:
            now[0] -= 1
        return (total,)

    jobs = {("sum", n): partial(job, n) for n in range(1, 8)}
    found = run_all(jobs, KeyedResults(spark, SCHEMA, 2), workers=3)
    assert {(r["name"], r["part"]): r["total"] for r in found.collect()} == {("sum", n): n * (n - 1) // 2 for n in range(1, 8)}
    assert 1 < most[0] <= 3


def test_a_run_cut_short_goes_on_with_what_is_missing(spark, tmp_path):
    path, called = str(tmp_path / "results"), []

    def job(n, broken):
        called.append(n)
        if n == broken:
            raise ZeroDivisionError("job three")
        return (n * 10,)

    jobs = lambda broken: {("x", n): partial(job, n, broken) for n in range(6)}
    with pytest.raises(ZeroDivisionError, match="job three"):
        run_all(jobs(3), KeyedResults(spark, SCHEMA, 2, path), workers=1)
    first = list(called)
    assert 3 in first and KeyedResults(spark, SCHEMA, 2, path).keys() == {("x", n) for n in first if n != 3}
    found = run_all(jobs(None), KeyedResults(spark, SCHEMA, 2, path), workers=2)
    assert sorted(tuple(r) for r in found.collect()) == [("x", n, n * 10) for n in range(6)]
    assert all(called.count(n) == (2 if n == 3 else 1) for n in range(6))
    # Nothing is left to do.
    run_all(jobs(0), KeyedResults(spark, SCHEMA, 2, path))
    assert len(called) == 7


def test_no_jobs_give_no_rows(spark):
    assert run_all({}, KeyedResults(spark, SCHEMA, 2)).collect() == []
