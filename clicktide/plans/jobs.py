"""The five jobs, each from tables to tables.

Given a `folder`, a job writes the tables that later steps read more than once and goes on from
the stored copy; without one the steps stay lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.operators import kpis, monitoring, quality
from clicktide.operators.attribution import (
    LOOKBACK_DAYS,
    MODELS,
    attribute_purchases,
    attributed_revenue_for,
)
from clicktide.operators.cleaning import (
    annotate_quarantine,
    cleaned,
    cleaning_manifest,
    cleaning_summary,
    defects,
    quarantined,
    without_defects,
)
from clicktide.operators.facts import build_daily_fact, daily_channel_funnel
from clicktide.operators.purchases import SESSION_FACTS, extract_purchases, purchase_events
from clicktide.operators.reconcile import reconcile
from clicktide.operators.sessions import (
    GAP_MINUTES,
    assign_sessions,
    session_slots,
    sessions_from_slots,
    slot_lookup,
    touchpoints_from_slots,
)
from clicktide.operators.shaping import prepare_events
from clicktide.settings import Contract, LandingRules, TrafficRules
from clicktide.sources.tables import (
    read_by_partition,
    stage,
    store_annotated,
    write_by_partition,
    write_json,
    write_table,
)


def _keep(df: DataFrame, folder: str | None, name: str) -> DataFrame:
    return df if folder is None else stage(df, f"{folder}/{name}")


def quality_job(
    events: DataFrame,
    contract: Contract = Contract(),
    partitions: DataFrame | None = None,
    folder: str | None = None,
    scope: quality.Scope = quality.DAY_SCOPE,
) -> dict[str, DataFrame]:
    """Profile, check results, scores and decisions, drift, roll-up and blocked partitions.

    `scope=quality.FILE_SCOPE` judges every file on its own.
    """
    measures = _keep(
        quality.partition_measures(events, contract, partitions, scope), folder, "measures"
    )
    profile = quality.partition_profile(measures, scope)
    results = _keep(
        quality.run_all_checks(events, contract, measures=measures, scope=scope), folder, "results"
    )
    scores = quality.score_partitions(results, scope)
    drift = quality.drift_results(profile, contract, scope)
    tables = {
        "profile": profile,
        "results": results,
        "scores": scores,
        "drift": drift,
        "rollup": quality.quality_rollup(scores),
        "blocked": quality.blocked_partitions(scores, scope),
        "failed_signals": quality.failed_signals(drift),
    }
    if folder is not None:
        for name in ("scores", "drift", "rollup"):
            write_json(tables[name], f"{folder}/{name}")
    return tables


def cleaning_job(
    events: DataFrame,
    folder: str | None = None,
    scope: quality.Scope = quality.DAY_SCOPE,
    replace: str = "table",
) -> dict[str, DataFrame]:
    """Clean and quarantined events, summary and manifest.

    With a folder, both sides are written in one pass and read from their own subfolders.
    `replace="days"` writes anew only the days that `events` holds; the tables returned, and the
    summary and manifest, then cover all days stored.
    """
    annotated = annotate_quarantine(events, scope)
    if folder is None:
        bad = defects(events, scope)
        sides = {
            "cleaned": without_defects(events, bad, scope),
            "quarantined": quarantined(annotated),
        }
    else:
        annotated = store_annotated(annotated, f"{folder}/events", replace)
        status = F.col("status")
        sides = {
            "cleaned": cleaned(annotated.where(status == "clean")).drop("status"),
            "quarantined": annotated.where(status == "quarantine").drop("status"),
        }
        annotated = annotated.drop("status")
    summary = cleaning_summary(annotated, scope)
    tables = {
        "annotated": annotated,
        **sides,
        "summary": summary,
        "manifest": cleaning_manifest(summary),
    }
    if folder is not None:
        write_json(tables["manifest"], f"{folder}/manifest")
    return tables


def transformation_job(
    events: DataFrame,
    rules: TrafficRules = TrafficRules(),
    landing: LandingRules = LandingRules(),
    gap_minutes: float = GAP_MINUTES,
    lookback_days: int = LOOKBACK_DAYS,
    clean_first: bool = False,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Sessions, sessionized events, purchases, attribution, touchpoints, fact and funnel."""
    if clean_first:
        events = cleaning_job(events, None if folder is None else f"{folder}/cleaning")["cleaned"]
    prepared = prepare_events(events, rules)
    slots = _keep(session_slots(prepared, gap_minutes, landing), folder, "session_slots")
    sessions = _keep(sessions_from_slots(slots), folder, "sessions")
    lookup = _keep(slot_lookup(slots), folder, "slot_lookup")
    sessionized = assign_sessions(prepared, lookup, gap_minutes)
    if folder is not None:
        # The one table that purchases and funnel are made of; raw events are read for the slots and
        # for this, and once more for two counts.
        day = F.col("ts").cast("date").cast("string")
        path = f"{folder}/events_with_sessions"
        write_by_partition(sessionized.withColumn("event_day", day), path, "event_day")
        sessionized = read_by_partition(events.sparkSession, path, "event_day")
    purchases = _keep(
        extract_purchases(purchase_events(sessionized), keep=SESSION_FACTS), folder, "purchases"
    )
    attribution = _keep(
        attribute_purchases(purchases, sessions, lookback_days),
        folder,
        "purchase_attribution",
    )
    tables = {
        "sessions": sessions,
        "events_with_sessions": sessionized.drop("landing_channel", "landing_device", "event_day"),
        "purchases": purchases.drop(*SESSION_FACTS),
        "attribution": attribution,
        "touchpoints": touchpoints_from_slots(slots),
        "fact": build_daily_fact(sessions, purchases, attribution),
        "funnel": daily_channel_funnel(sessionized, sessions),
        "reconciliation": reconcile(events, sessions, purchases, attribution),
        **{f"attribution_{m}_daily": attributed_revenue_for(attribution, m) for m in MODELS},
    }
    if folder is not None:
        for name in ("touchpoints", "fact", "funnel"):
            tables[name] = stage(tables[name], f"{folder}/{name}")
        for m in MODELS:
            write_table(tables[f"attribution_{m}_daily"], f"{folder}/attribution_{m}_daily")
        write_json(tables["reconciliation"], f"{folder}/reconciliation")
    return tables


def analysis_job(
    sessions: DataFrame, purchases: DataFrame, attribution: DataFrame, folder: str | None = None
) -> dict[str, DataFrame]:
    """KPI tables of the executive analysis."""
    timed = kpis.minutes_to_purchase(purchases, sessions)
    tables = {
        "totals": kpis.kpi_totals(sessions, purchases),
        "daily": kpis.daily_kpis(sessions, purchases),
        "channel_revenue": kpis.channel_revenue(attribution),
        "sensitivity": kpis.attribution_sensitivity(attribution),
        "device": kpis.device_conversion(sessions, purchases),
        "user_type": kpis.new_vs_returning(sessions, purchases),
        "time_to_purchase": kpis.time_to_purchase(timed),
        "time_to_purchase_histogram": kpis.time_to_purchase_histogram(timed),
        "executive_ratios": kpis.executive_ratios(sessions, purchases, attribution),
    }
    if folder is not None:
        for name, table in tables.items():
            write_table(table, f"{folder}/{name}")
    return tables


def monitoring_job(
    sessions: DataFrame,
    purchases: DataFrame,
    fact: DataFrame | None = None,
    funnel: DataFrame | None = None,
    scores: DataFrame | None = None,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Daily metrics, alerts, the report's last days and, with scores, the quality roll-up."""
    daily = _keep(
        monitoring.daily_metrics(sessions, purchases, fact, funnel), folder, "daily_metrics"
    )
    tables = {
        "daily_metrics": daily,
        "alerts": monitoring.detect_alerts(daily),
        "last_days": monitoring.last_days(daily),
    }
    if scores is not None:
        tables["dq_rollup"] = quality.quality_rollup(scores)
        tables["blocked"] = quality.blocked_partitions(scores)
    if folder is not None:
        write_json(tables["alerts"], f"{folder}/alerts")
    return tables
