"""Runs, versions, decisions and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import ev_daily, or_partials, scratch
from catalog.documented import CUT
from catalog.section import Section
from catalog.sql import block, exact_mean, metrics, with_
from kerbcast import settings as S
from kerbcast.functions.exact import exact_mean as mean
from kerbcast.operators.baselines import baseline_scores
from kerbcast.plans import lifecycle as L
from kerbcast.plans.bundles import save_bundle
from kerbcast.plans.forecast import WeekdayMean, train
from kerbcast.plans.replay import replay
from kerbcast.session import settle
from kerbcast.sources import records
from kerbcast.sources.standins import lattice_centroids, table

register = Section()

# --- run and version tables from orders ----------------------------------------------

_AT = "o_orderdate + to_seconds(CAST(o_orderkey AS INTEGER))"
block(
    "runs",
    sql=f"""SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_custkey % 50 AS model,
      {_AT} AS trained_at,
      CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
      strftime(o_orderdate, '%Y-%m') AS trained_to,
      CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m') END
        AS test_month,
      o_totalprice / 1000000 AS wape,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 'true'
           WHEN o_orderpriority = '2-HIGH' THEN 'false' END AS promoted
      FROM orders""",
)
# Registered already: the finished runs before 1998.
block(
    "versions", "runs",
    sql="""SELECT run_id, model, CAST(row_number() OVER (PARTITION BY model
        ORDER BY trained_at, run_id) AS INTEGER) AS version
      FROM runs WHERE status = 'FINISHED' AND trained_at < TIMESTAMP '1998-01-01'""",
)


def _runs(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "FINISHED").when(
        F.col("o_orderstatus") == "O", "RUNNING"
    )
    at = F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey").cast("decimal(18,6)"))
    next_month = F.date_format(F.add_months(F.col("o_orderdate").cast("date"), 1), "yyyy-MM")
    promoted = F.when(F.col("o_orderpriority") == "1-URGENT", "true").when(
        F.col("o_orderpriority") == "2-HIGH", "false"
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        (F.col("o_custkey") % 50).alias("model"),
        at.alias("trained_at"),
        status.otherwise("FAILED").alias("status"),
        F.create_map(
            F.lit("train_last_month"),
            F.date_format("o_orderdate", "yyyy-MM"),
            F.lit("test_month"),
            F.when(F.col("o_orderkey") % 9 != 0, next_month),
        ).alias("params"),
        F.create_map(F.lit("wape"), F.col("o_totalprice") / 1000000).alias("metrics"),
        promoted.alias("promoted"),
    )


def _finished(spark, sf_dir):
    return _runs(spark, sf_dir).filter("status = 'FINISHED'")


def _versions(spark, sf_dir):
    empty = spark.createDataFrame([], "run_id string, version int, model bigint")
    split = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    older = _finished(spark, sf_dir).filter(F.col("trained_at") < split)
    return L.new_versions(older, empty, ["model"], F.year("trained_at"))


@register(
    "i19_register_new_runs",
    with_("versions") + """SELECT run_id, model, CAST(coalesce((SELECT max(version) FROM versions v
        WHERE v.model = r.model), 0) + row_number() OVER (PARTITION BY model ORDER BY trained_at,
        run_id) AS INTEGER) AS version
      FROM runs r WHERE status = 'FINISHED' AND run_id NOT IN (SELECT run_id FROM versions)""",
)
def i19(spark, sf_dir):
    return L.new_versions(
        _finished(spark, sf_dir), _versions(spark, sf_dir), ["model"], F.year("trained_at")
    )


@register(
    "i22_d11_g6_version_listing",
    with_("runs") + """
    , numbered AS (SELECT run_id, CAST(row_number() OVER (ORDER BY trained_at, run_id) AS INTEGER)
        AS version FROM runs WHERE status = 'FINISHED')
    SELECT version, CASE WHEN version = (SELECT max(version) FROM numbered) - 2 THEN '*' ELSE '' END
        AS current, trained_to, test_month, wape, coalesce(promoted, '') AS promoted
      FROM numbered JOIN runs USING (run_id) ORDER BY version DESC""",
)
def i22(spark, sf_dir):
    empty = spark.createDataFrame([], "run_id string, version int")
    runs = _finished(spark, sf_dir)
    versions = L.new_versions(runs, empty, (), F.trunc(F.col("trained_at").cast("date"), "month"))
    # Version numbers as text, as some stores keep them.
    pointer = versions.agg((F.max("version") - 2).cast("string").alias("version"))
    texts = versions.withColumn("version", F.col("version").cast("string"))
    return L.describe_versions(texts, runs, pointer)


@register(
    "d12_training_run_of_candidates",
    with_("runs") + """SELECT l_orderkey, l_linenumber, run_id FROM lineitem
      JOIN runs ON trained_at = l_shipdate + to_seconds(CAST(l_orderkey AS INTEGER))
      WHERE status = 'FINISHED'""",
)
def d12(spark, sf_dir):
    at = F.col("l_shipdate") + F.make_dt_interval(secs=F.col("l_orderkey").cast("decimal(18,6)"))
    candidates = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", at.alias("trained_at")
    )
    found = L.find_training_runs(candidates, _runs(spark, sf_dir))
    return found.select("l_orderkey", "l_linenumber", "run_id")


# --- decisions -----------------------------------------------------------------------

_LIMIT = "current_wape * 1.05::DOUBLE"
block(
    "pairs",
    sql="""SELECT o_orderkey,
      CASE WHEN o_orderkey % 11 <> 0 THEN round(o_totalprice / 2000000, 3) END AS candidate_wape,
      CASE WHEN o_orderkey % 13 <> 0 THEN round(0.05 + (o_custkey % 40) / 200, 3) END AS current_wape
      FROM orders""",
)


def _pairs(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 11 != 0, F.round(F.col("o_totalprice") / 2000000, 3)).alias("candidate_wape"),
        F.when(key % 13 != 0, F.round(0.05 + (F.col("o_custkey") % 40) / 200, 3)).alias(
            "current_wape"
        ),
    )


@register(
    "i17_c15_promotion_decisions",
    with_("pairs") + f"""SELECT *,
      coalesce(candidate_wape IS NOT NULL AND (current_wape IS NULL OR candidate_wape <= {_LIMIT}), false)
        AS promoted,
      CASE WHEN candidate_wape IS NULL
          THEN 'the new model was not evaluated, so it can''t be compared'
        WHEN current_wape IS NULL THEN 'there is no current model'
        ELSE printf('WAPE %.4f is %s the limit of %.4f (current model %.4f)', candidate_wape,
          CASE WHEN candidate_wape <= {_LIMIT} THEN 'within' ELSE 'above' END, {_LIMIT}, current_wape)
      END AS reason FROM pairs""",
)
def i17(spark, sf_dir):
    return L.decide(_pairs(spark, sf_dir))


block(
    "meetings",
    sql="""SELECT l_orderkey, l_linenumber,
      year(o_orderdate) || '-' || month(o_orderdate) AS candidate_test_month,
      strftime(o_orderdate - INTERVAL 2 MONTH, '%Y-%m') AS candidate_eval_last_month,
      CASE WHEN l_linenumber <> 7 THEN strftime(l_shipdate, '%Y-%m') END AS current_last_month,
      CASE WHEN l_returnflag = 'R' THEN strftime(o_orderdate, '%Y-%m') END AS current_test_month,
      CASE WHEN l_linestatus = 'O' THEN strftime(o_orderdate - INTERVAL 2 MONTH, '%Y-%m') END
        AS current_eval_last_month,
      CASE WHEN l_discount > 0.01 THEN l_discount END AS current_wape,
      l_tax < 0.06 AS cutoff_is_present
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)


def _meetings(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    day = F.col("o_orderdate").cast("date")
    evaluated = F.date_format(F.add_months(day, -2), "yyyy-MM")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.concat_ws("-", F.year(day).cast("string"), F.month(day).cast("string")).alias(
            "candidate_test_month"
        ),
        evaluated.alias("candidate_eval_last_month"),
        F.when(F.col("l_linenumber") != 7, F.date_format("l_shipdate", "yyyy-MM")).alias(
            "current_last_month"
        ),
        F.when(F.col("l_returnflag") == "R", F.date_format(day, "yyyy-MM")).alias(
            "current_test_month"
        ),
        F.when(F.col("l_linestatus") == "O", evaluated).alias("current_eval_last_month"),
        F.when(F.col("l_discount") > 0.01, F.col("l_discount")).alias("current_wape"),
        (F.col("l_tax") < 0.06).alias("cutoff_is_present"),
    )


_TEST = "strptime(candidate_test_month || '-1', '%Y-%m-%d')"
_CUTOFF = "strptime(current_last_month || '-1', '%Y-%m-%d')"
_LIKE = f"""coalesce(current_wape IS NOT NULL
  AND strptime(current_test_month || '-1', '%Y-%m-%d') = {_TEST}
  AND current_eval_last_month = candidate_eval_last_month, false)"""


@register(
    "i16_comparison_cases",
    with_("meetings") + f"""SELECT *,
      CASE WHEN current_last_month IS NULL THEN 'none' WHEN {_LIKE} THEN 'stored'
        WHEN {_CUTOFF} >= {_TEST} THEN 'none' WHEN NOT cutoff_is_present THEN 'none' ELSE 'refit' END
        AS "case",
      CASE WHEN current_last_month IS NULL
          THEN 'the current model doesn''t record what it was trained on'
        WHEN {_LIKE} THEN NULL
        WHEN {_CUTOFF} >= {_TEST}
          THEN 'the current model was already trained on data up to ' || current_last_month
        WHEN NOT cutoff_is_present
          THEN 'the data for ' || current_last_month || ' is not on disk to train a matching copy on'
        END AS obstacle FROM meetings""",
)
def i16(spark, sf_dir):
    return L.comparison_case(_meetings(spark, sf_dir))


# --- the event log of fifty registries, replayed --------------------------------------

# Each order is a run: logged, mostly registered a day later, decided on the second and (every
# eighth) third day; every seventh moves the pointer by hand, now and then to nowhere.
block(
    "life", "pairs",
    sql="""SELECT registry, happened + to_days(later) AS happened, o_orderkey * 8 + later AS step, kind,
        CASE WHEN kind <> 'pointed' THEN CAST(o_orderkey AS VARCHAR) END AS run_id,
        CASE WHEN kind = 'logged' THEN status END AS status,
        CASE WHEN kind = 'pointed' THEN CAST(o_custkey % 300 + 1 AS INTEGER) END AS version,
        CASE WHEN kind = 'decided' THEN candidate_wape END AS candidate_wape,
        CASE WHEN kind = 'decided' THEN current_wape END AS current_wape
      FROM (SELECT o_orderkey, o_custkey, o_custkey % 50 AS registry,
          o_orderdate + to_seconds(CAST(o_orderkey AS INTEGER)) AS happened,
          CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status
        FROM orders) JOIN pairs USING (o_orderkey),
        (VALUES ('logged', 0), ('registered', 1), ('decided', 2), ('decided', 3), ('pointed', 4))
          kinds(kind, later)
      WHERE CASE later WHEN 0 THEN true WHEN 1 THEN o_orderkey % 4 <> 3 WHEN 2 THEN o_orderkey % 5 <> 0
        WHEN 3 THEN o_orderkey % 8 = 0 ELSE o_orderkey % 7 = 0 END""",
)
_RUN = "PARTITION BY registry, run_id ORDER BY happened, step"
_ALL = "PARTITION BY registry ORDER BY happened, step"
block(
    "fit", "life",
    sql=f"""SELECT *, kind = 'registered' AND coalesce(max(CASE WHEN status = 'FINISHED' THEN 1 END)
        OVER ({_RUN}), 0) = 1 AS fit FROM life""",
)
block(
    "counted", "fit",
    sql=f"""SELECT *, count(*) FILTER (fresh) OVER ({_ALL}) AS versions
      FROM (SELECT *, fit AND count(*) FILTER (fit) OVER ({_RUN}) = 1 AS fresh FROM fit)""",
)
block(
    "owned", "counted",
    sql=f"""SELECT *, CASE WHEN kind <> 'pointed'
        THEN CAST(max(CASE WHEN fresh THEN versions END) OVER ({_RUN}) AS INTEGER) END AS own FROM counted""",
)
block(
    "settled", "owned",
    sql=f"""SELECT *, CASE kind WHEN 'logged' THEN true WHEN 'registered' THEN fit
          WHEN 'decided' THEN own IS NOT NULL ELSE version BETWEEN 1 AND versions END AS accepted,
        coalesce(candidate_wape IS NOT NULL AND (current_wape IS NULL OR candidate_wape <= {_LIMIT}), false)
          AS rule FROM owned""",
)
block(
    "placed_events", "settled",
    sql=f"""SELECT *, last_value(moved IGNORE NULLS) OVER ({_ALL}) AS in_service,
        last_value(moved IGNORE NULLS) OVER ({_ALL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous,
        count(*) FILTER (kind = 'decided' AND accepted) OVER ({_ALL}) AS decisions
      FROM (SELECT *, CASE WHEN kind = 'decided' AND accepted AND rule THEN own
          WHEN kind = 'pointed' AND accepted THEN version END AS moved FROM settled)""",
)
block(
    "replayed", "placed_events",
    sql=f"""SELECT *, kind = 'decided' AND accepted AND (NOT bare OR decisions = 1) AS written
      FROM (SELECT *, coalesce(previous = own, false) AND kind = 'decided' AS bare FROM placed_events)""",
)


def _events(spark, sf_dir):
    key = F.col("o_orderkey")
    happens = {
        "logged": ((0, F.lit(True)),),
        "registered": ((1, key % 4 != 3),),
        "decided": ((2, key % 5 != 0), (3, key % 8 == 0)),
        "pointed": ((4, key % 7 == 0),),
    }
    each = F.array(
        *[
            F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit(later).alias("later")))
            for kind, times in happens.items()
            for later, when in times
        ]
    )
    status = F.when(F.col("o_orderstatus") == "F", "FINISHED").when(F.col("o_orderstatus") == "O", "RUNNING")
    secs = (key + F.col("e.later") * 86400).cast("decimal(18,6)")
    only = lambda kind, value: F.when(F.col("e.kind") == kind, value)
    return (
        table(spark, sf_dir, "orders")
        .withColumn("e", F.explode(F.array_compact(each)))
        .select(
            (F.col("o_custkey") % 50).alias("registry"),
            (F.col("o_orderdate") + F.make_dt_interval(secs=secs)).alias("at"),
            (key * 8 + F.col("e.later")).alias("step"),
            "e.kind",
            F.when(F.col("e.kind") != "pointed", key.cast("string")).alias("run_id"),
            only("logged", status.otherwise("FAILED")).alias("status"),
            only("pointed", (F.col("o_custkey") % 300 + 1).cast("int")).alias("version"),
            only("decided", F.when(key % 11 != 0, F.round(F.col("o_totalprice") / 2000000, 3))).alias("candidate_wape"),
            only(
                "decided", F.when(key % 13 != 0, F.round(0.05 + (F.col("o_custkey") % 40) / 200, 3))
            ).alias("current_wape"),
        )
    )


def _replayed(spark, sf_dir):
    return replay(_events(spark, sf_dir), F.to_date("at"))


@register(
    "i20_version_in_service_after_each_event",
    with_("replayed") + """SELECT registry, step, kind, run_id, accepted, coalesce(own, version) AS version,
      previous, in_service FROM replayed""",
)
def i20(spark, sf_dir):
    return _replayed(spark, sf_dir).select(
        "registry", "step", "kind", "run_id", "accepted", "version", "previous", "in_service"
    )


@register(
    "i21_pointer_moves_and_rollbacks",
    with_("replayed") + """SELECT registry, step, version, accepted, previous, in_service,
      coalesce(moved < previous, false) AS rolled_back FROM replayed WHERE kind = 'pointed'""",
)
def i21(spark, sf_dir):
    moves = _replayed(spark, sf_dir).filter("kind = 'pointed'")
    return moves.select("registry", "step", "version", "accepted", "previous", "in_service", "rolled_back")


@register(
    "i18_promotions_replayed",
    with_("replayed") + f"""SELECT registry, step, run_id, own AS version, accepted, previous, in_service,
      CASE WHEN accepted THEN rule AND NOT bare END AS promoted,
      CASE WHEN accepted AND bare THEN 'this model is already the current one'
        WHEN NOT accepted THEN NULL
        WHEN candidate_wape IS NULL THEN 'the new model was not evaluated, so it can''t be compared'
        WHEN current_wape IS NULL THEN 'there is no current model'
        ELSE printf('WAPE %.4f is %s the limit of %.4f (current model %.4f)', candidate_wape,
          CASE WHEN candidate_wape <= {_LIMIT} THEN 'within' ELSE 'above' END, {_LIMIT}, current_wape)
      END AS reason FROM replayed WHERE kind = 'decided'""",
)
def i18_replayed(spark, sf_dir):
    decisions = _replayed(spark, sf_dir).filter("kind = 'decided'")
    return decisions.select(
        "registry", "step", "run_id", "version", "accepted", "previous", "in_service", "promoted", "reason"
    )


@register(
    "a10_decision_on_record",
    with_("replayed") + f"""SELECT registry, step, run_id, written,
      last_value(CASE WHEN written THEN step END IGNORE NULLS) OVER ({_ALL}) AS on_record
      FROM replayed WHERE kind = 'decided'""",
)
def a10(spark, sf_dir):
    decisions = _replayed(spark, sf_dir).filter("kind = 'decided'")
    return decisions.select("registry", "step", "run_id", "written", "on_record")


# --- labels, JSON and records --------------------------------------------------------


@register(
    "c14_run_labels",
    """SELECT l_orderkey, l_linenumber, 'backtest-window-' || l_linenumber || '-zones-' || l_suppkey
        AS backtest_name, 'train-' || strftime(l_shipdate, '%Y-%m') AS train_name FROM lineitem""",
)
def c14(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        L.backtest_run_name(F.col("l_linenumber"), F.col("l_suppkey")).alias("backtest_name"),
        L.train_run_name(F.date_format("l_shipdate", "yyyy-MM")).alias("train_name"),
    )


@register(
    "c13_decision_json_round_trip",
    with_("pairs") + """SELECT o_orderkey, candidate_wape, current_wape,
      json_extract_string(j, '$.reason') AS reason FROM (SELECT *,
        json_object('reason', 'order ' || o_orderkey) AS j FROM pairs)""",
)
def c13(spark, sf_dir):
    reason = F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))
    written = _pairs(spark, sf_dir).withColumn("reason", reason)
    text = records.encode(["candidate_wape", "current_wape", "reason"])
    schema = "candidate_wape double, current_wape double, reason string"
    read = written.select("o_orderkey", text.alias("j")).withColumn(
        "d", records.decode("j", schema)
    )
    return read.select("o_orderkey", "d.*")


@register(
    "a9_metrics_sink",
    with_("predictions") + f"""SELECT predictor, {metrics()} FROM predictions
      WHERE prediction IS NOT NULL GROUP BY predictor""",
)
def a9(spark, sf_dir):
    path = scratch(spark)
    records.write_records(baseline_scores(ev_daily(spark, sf_dir), CUT), path)
    schema = "predictor string, mae double, rmse double, wape double, n_test_rows bigint"
    return records.read_records(spark, path, schema)


block(
    "summary",
    sql=f"""SELECT CAST(l_linenumber AS INTEGER) AS window_months,
      CAST(l_suppkey % 3 * 10 AS INTEGER) AS n_zones, count(*) AS test_months,
      {exact_mean('l_quantity')} AS mae, {exact_mean('l_extendedprice / 1000')} AS rmse,
      {exact_mean('l_discount')} AS wape, {exact_mean('l_tax')} AS smallest_zone_share
      FROM lineitem GROUP BY l_linenumber, l_suppkey % 3""",
)


@register(
    "i23_backtest_run_log",
    with_("summary") + """SELECT 'backtest-window-' || window_months || '-zones-' || n_zones AS name,
      CAST(window_months AS VARCHAR) AS window_months, CAST(n_zones AS VARCHAR) AS n_pickup_zones,
      '2' AS gap_months, CAST(test_months AS VARCHAR) AS test_months, mae, rmse, wape,
      smallest_zone_share FROM summary""",
)
def i23(spark, sf_dir):
    summary = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_linenumber").cast("int").alias("window_months"),
            (F.col("l_suppkey") % 3 * 10).cast("int").alias("n_zones"),
        )
        .agg(
            F.count("*").alias("test_months"),
            mean(F.col("l_quantity")).alias("mae"),
            mean(F.col("l_extendedprice") / 1000).alias("rmse"),
            mean(F.col("l_discount")).alias("wape"),
            mean(F.col("l_tax")).alias("smallest_zone_share"),
        )
    )
    registry = L.Registry(spark, scratch(spark))
    registry.log_runs(L.backtest_runs(summary, S.EVAL_GAP_MONTHS))
    params = ("window_months", "n_pickup_zones", "gap_months", "test_months")
    scores = ("mae", "rmse", "wape", "smallest_zone_share")
    return registry.runs().select(
        "name",
        *[F.col("params")[name].alias(name) for name in params],
        *[F.col("metrics")[name].alias(name) for name in scores],
    )


# --- the whole life of a model -------------------------------------------------------


def _saved(spark, registry, partials, end_month):
    bundle = train(
        partials, lattice_centroids(spark), WeekdayMean(), end_month, window_months=3, n_zones=10
    )
    path = scratch(spark)
    save_bundle(spark, bundle, path)
    run_id = registry.log_training_run(path)
    return path, run_id


@register("i18_i20_i21_promotion_run")
def i18(spark, sf_dir):
    """Two models in turn: the first enters unopposed, the second is compared with it."""
    partials = settle(or_partials(spark, sf_dir))
    registry = L.Registry(spark, scratch(spark))
    centroids = lattice_centroids(spark)
    decisions = []
    for end_month in ("2001-06", "2001-07"):
        path, _ = _saved(spark, registry, partials, end_month)
        decisions.append(L.promote(registry, path, partials, centroids))
    registry.set_champion(1)
    out = scratch(spark)
    for decision in decisions:
        records.record_decision(spark, decision, out)
    return registry.listing()
