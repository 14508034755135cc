"""The state of many registries after each event of one log.

An event is a row of ``registry, at, step, kind, run_id, status, version, candidate_wape,
current_wape``; a registry's events are ordered by ``at`` and the unique ``step``:

* ``logged``: a run with its ``status``;
* ``registered``: a run gets the next version, once; refused before it is logged as finished;
* ``decided``: a registered run meets the model in service on the recorded scores, and takes
  its place if the rule allows; refused for a run without a version;
* ``pointed``: a version is put in service by hand, a rollback where it is an older one;
  refused where there is no such version yet.

Every state is a running aggregate.  ``period`` (a column that rises with ``at``) cuts a
registry's events: each is summed up within its period and takes over what the periods before
left, so that no task orders a whole registry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.plans.lifecycle import decide
from kerbcast.session import settle

EVENT_SCHEMA = (
    "registry long, at timestamp_ntz, step long, kind string, run_id string, status string, "
    "version int, candidate_wape double, current_wape double"
)
_ORDER = ("at", "step")


def _of_run(*ties: str):
    """A run's events up to the present one; an event without a run stands alone."""
    run = F.coalesce("run_id", F.concat(F.lit("step "), "step"))
    return Window.partitionBy("registry", run).orderBy(*_ORDER, *ties).rowsBetween(Window.unboundedPreceding, 0)


def _begun(rows: DataFrame, counts: Sequence[str], lasts: Sequence[str]) -> DataFrame:
    """For each registry and period what the periods before it left: sums of ``counts`` and last
    values of ``lasts`` that are not null, under the same names."""
    at = F.struct(*_ORDER)
    totals = rows.groupBy("registry", "_period").agg(
        *[F.sum(name).alias(name) for name in counts],
        *[F.max_by(name, F.when(F.col(name).isNotNull(), at)).alias(name) for name in lasts],
    )
    earlier = Window.partitionBy("registry").orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "registry",
        "_period",
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in counts],
        *[F.last(name, ignorenulls=True).over(earlier).alias(name) for name in lasts],
    )


def _carried(rows: DataFrame, counts: Sequence[str], lasts: Sequence[str]) -> DataFrame:
    """Written ``rows`` with the running sums of the columns ``counts`` and the running last
    values of ``lasts`` in their place, the present event included; the last value before the
    event is ``before_`` and its name.

    What a period takes over is a row that comes before its events, so that they are sent to
    their period once and meet no join."""
    begun = _begun(rows, counts, lasts).withColumn("_begun", F.lit(0))
    both = rows.withColumn("_begun", F.lit(1)).unionByName(begun, allowMissingColumns=True)
    inside = Window.partitionBy("registry", "_period").orderBy("_begun", *_ORDER)
    here = inside.rowsBetween(Window.unboundedPreceding, 0)
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    running = {
        **{name: F.sum(name).over(here) for name in counts},
        **{name: F.last(name, ignorenulls=True).over(here) for name in lasts},
        **{f"before_{name}": F.last(name, ignorenulls=True).over(above) for name in lasts},
    }
    kept = [c for c in both.columns if c not in running]
    found = both.select(*kept, *[value.alias(name) for name, value in running.items()])
    return found.where("_begun = 1").drop("_begun")


def replay(
    events: DataFrame, period: Column | None = None, tolerance: float = S.PROMOTION_TOLERANCE
) -> DataFrame:
    """Each event with ``version`` (its run's, or the one pointed at), ``accepted``,
    ``promoted`` and ``reason`` of decisions, ``previous`` and ``in_service`` (the version
    before and after it), ``rolled_back``, ``written`` (whether its decision replaces the one on
    record) and ``on_record`` (the step of the decision on record after it).

    Deciding on the model in service says only that; it goes on record where nothing is.
    Events are written three times, and each time only with what later steps read.
    """
    kind, target = F.col("kind"), F.col("version")
    rows = events.withColumn("_period", F.lit(0) if period is None else period)
    finished = F.max((kind == "logged") & (F.col("status") == "FINISHED")).over(_of_run())
    rows = rows.withColumn("_fit", (kind == "registered") & F.coalesce(finished, F.lit(False)))
    rows = rows.withColumn("_new", F.col("_fit") & (F.sum(F.col("_fit").cast("int")).over(_of_run()) == 1))
    rows = settle(rows.drop("status").withColumn("_versions", F.col("_new").cast("long")))
    # Versions are counted where one begins or is pointed at; no other event asks for the count.
    asks = F.coalesce(F.col("_new") | (kind == "pointed"), F.lit(False))
    counted = _carried(rows.where(asks), ["_versions"], [])
    rows = counted.unionByName(rows.where(~asks).withColumn("_versions", F.lit(None).cast("long")))
    # Of rows that repeat a step, the one that changes the state comes last.
    number = F.max(F.when(F.col("_new"), F.col("_versions"))).over(_of_run("_new")).cast("int")
    rows = rows.withColumn("_own", F.when(kind != "pointed", number))
    accepted = (
        F.when(kind == "logged", True)
        .when(kind == "registered", F.col("_fit"))
        .when(kind == "decided", F.col("_own").isNotNull())
        .otherwise(F.coalesce(target.between(1, F.col("_versions")), F.lit(False)))
    )
    rows = rows.withColumn("accepted", accepted)
    decided = (kind == "decided") & F.col("accepted")
    rows = decide(rows, tolerance).drop("reason")
    moved = F.when(decided & F.col("promoted"), F.col("_own")).when((kind == "pointed") & F.col("accepted"), target)
    rows = rows.withColumns({"_moved": moved, "_decisions": F.coalesce(decided, F.lit(False)).cast("long")})
    rows = settle(rows.drop("promoted", "_fit", "_new", "_versions"))
    rows = _carried(rows.withColumn("in_service", F.col("_moved")), ["_decisions"], ["in_service"])
    rows = rows.withColumnRenamed("before_in_service", "previous")
    bare = decided & F.coalesce(F.col("previous") == F.col("_own"), F.lit(False))
    written = decided & (~bare | (F.col("_decisions") == 1))
    back = F.coalesce((kind == "pointed") & (F.col("_moved") < F.col("previous")), F.lit(False))
    rows = rows.withColumns({"_bare": bare, "written": written, "rolled_back": back, "version": F.coalesce("_own", target)})
    rows = rows.withColumn("_record", F.when(F.col("written"), F.col("step")))
    inside = Window.partitionBy("registry", "_period").orderBy(*_ORDER, "written").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("on_record", F.last("_record", ignorenulls=True).over(inside))
    rows = settle(rows.drop("_own", "_moved", "_decisions", "_record"))
    # Only events before a period's first record take over the one that stood.
    stood = _begun(rows.withColumn("_record", F.when(F.col("written"), F.col("step"))), [], ["_record"])
    stood = stood.select(F.col("registry").alias("_of"), F.col("_period").alias("_in"), F.col("_record").alias("_stood"))
    open_ = rows.where("on_record IS NULL").join(stood, F.expr("registry <=> _of AND _period <=> _in"), "left")
    open_ = open_.withColumn("on_record", F.col("_stood")).select(*rows.columns)
    rows = decide(rows.where("on_record IS NOT NULL").unionByName(open_), tolerance)
    return rows.withColumns(
        {
            "promoted": F.when(decided, F.col("promoted") & ~F.col("_bare")),
            "reason": F.when(F.col("_bare"), F.lit(S.ALREADY_CURRENT)).when(decided, F.col("reason")),
        }
    ).select(
        "registry", "at", "step", "kind", "run_id", "version", "accepted", "promoted", "reason",
        "previous", "in_service", "rolled_back", "written", "on_record",
    )
