"""The replayed event log against a plain fold over the events."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.plans import replay as replay_module
from kerbcast.plans.replay import EVENT_SCHEMA, replay

START = datetime.datetime(2026, 3, 1)


def random_events(n, seed):
    rng = random.Random(seed)
    rows = []
    for step in range(n):
        registry = rng.choice([1, 1, 1, 2, None])
        # Ties in time, some weeks apart, one registry with most events.
        at = START + datetime.timedelta(hours=6 * rng.randint(0, n // 3))
        kind = rng.choice(["logged", "registered", "decided", "decided", "pointed"])
        run = None if kind == "pointed" else f"r{rng.randint(0, n // 50)}"
        status = rng.choice(["FINISHED", "FINISHED", "FAILED"]) if kind == "logged" else None
        version = rng.choice([None, 0, 1, 2, 3, 9]) if kind == "pointed" else None
        scores = [rng.choice([None, 0.1, 0.104, 0.105, 0.2]) if kind == "decided" else None for _ in range(2)]
        rows.append((registry, at, step, kind, run, status, version, *scores))
    return rows


def fold(rows):
    """step -> (version, accepted, promoted, previous, in_service, rolled_back, written, on_record)."""
    out = {}
    for registry in {r[0] for r in rows}:
        finished, versions, serving, record = set(), {}, None, None
        for _, _, step, kind, run, status, version, candidate, current in sorted(
            (r for r in rows if r[0] == registry), key=lambda r: r[1:3]
        ):
            before, accepted, promoted, back, written = serving, True, None, False, False
            if kind == "logged":
                finished |= {run} if status == "FINISHED" else set()
            elif kind == "registered":
                accepted = run in finished
                if accepted:
                    versions.setdefault(run, len(versions) + 1)
            elif kind == "decided":
                accepted = run in versions
                if accepted:
                    bare = serving == versions[run]
                    better = candidate is not None and (current is None or candidate <= current * 1.05)
                    promoted = better and not bare
                    written = not bare or record is None
                    record = step if written else record
                    serving = versions[run] if promoted else serving
            else:
                accepted = version is not None and 1 <= version <= len(versions)
                back = accepted and before is not None and version < before
                serving = version if accepted else serving
            shown = version if kind == "pointed" else versions.get(run)
            out[step] = (shown, accepted, promoted, before, serving, back, written, record)
    return out


@pytest.mark.parametrize("period", [None, "to_date(at)", "date_trunc('month', at)"])
def test_every_state_is_that_of_a_plain_fold(spark, period):
    rows = random_events(400, 7)
    found = replay(spark.createDataFrame(rows, EVENT_SCHEMA).repartition(5), period and F.expr(period)).collect()
    names = ("version", "accepted", "promoted", "previous", "in_service", "rolled_back", "written", "on_record")
    assert {r["step"]: tuple(r[n] for n in names) for r in found} == fold(rows)
    assert any(r["rolled_back"] for r in found) and any(r["reason"] == S.ALREADY_CURRENT for r in found)
    assert any(r["kind"] == "pointed" and not r["accepted"] for r in found)


def test_no_events(spark):
    assert replay(spark.createDataFrame([], EVENT_SCHEMA), F.to_date("at")).collect() == []


def test_events_are_sent_narrow_and_without_joins(spark, monkeypatch):
    """What is written on the way holds no column that later steps do not read, and what a
    period takes over reaches its events without a join that sends them once more."""
    kept, settle = [], replay_module.settle
    monkeypatch.setattr(replay_module, "settle", lambda df: (kept.append(df), settle(df))[1])
    events = spark.createDataFrame(random_events(50, 3), EVENT_SCHEMA)
    replay(events, F.to_date("at")).collect()
    assert len(kept) == 3
    for df in kept:
        assert not {"status", "promoted", "reason"} & set(df.columns)
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
