"""Daily monitoring: metric series, trailing robust baselines and alerts.

Everything here runs over one row per day; windows are partitioned by metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.scoring import mentions, ratio, robust_z, share_of
from clicktide.operators.kpis import daily_kpis
from clicktide.settings import ALERT_RULES, MONITORED_METRICS, P0, P1, AlertRule

BASELINE_ROWS = 7
MIN_BASELINE = 3


def direct_shares(fact: DataFrame) -> DataFrame:
    """Direct traffic's part of sessions and revenue per day, from the daily fact."""
    direct = mentions(F.coalesce("landing_channel", F.lit("unknown")), "direct")
    return fact.groupBy("day").agg(
        share_of(F.col("sessions"), direct).alias("direct_session_share"),
        share_of(F.col("revenue"), direct).alias("direct_revenue_share"),
    )


def direct_shares_from_funnel(funnel: DataFrame) -> DataFrame:
    """Direct session share per day from the funnel, for inputs without a fact table."""
    direct = mentions(F.coalesce("landing_channel", F.lit("unknown")), "direct")
    return funnel.groupBy(F.col("event_day").alias("day")).agg(
        share_of(F.coalesce("sessions", F.lit(0)), direct).alias("direct_session_share")
    )


def daily_metrics(
    sessions: DataFrame,
    purchases: DataFrame,
    fact: DataFrame | None = None,
    funnel: DataFrame | None = None,
) -> DataFrame:
    """Daily KPIs with direct shares from the fact, else from the funnel, else without them."""
    daily = daily_kpis(sessions, purchases)
    if fact is not None:
        daily = daily.join(direct_shares(fact), "day", "left")
    elif funnel is not None:
        daily = daily.join(direct_shares_from_funnel(funnel), "day", "left")
    return daily


def _median(sorted_values: Column) -> Column:
    """Median of a sorted array."""
    n = F.array_size(sorted_values)
    low = F.get(sorted_values, F.floor((n - 1) / 2).cast("int"))
    high = F.get(sorted_values, F.floor(n / 2).cast("int"))
    return (low + high) / 2


def metric_baselines(daily: DataFrame, lookback: int = BASELINE_ROWS) -> DataFrame:
    """Every (day, metric) with median, MAD and robust z of the previous rows.

    A baseline takes the `lookback` rows before the day (rows, not calendar days) and at least
    three known values; other days are left out.
    """
    present = [m for m in MONITORED_METRICS if m in daily.columns]
    long = daily.select("day", *[F.col(m).cast("double").alias(m) for m in present]).unpivot(
        "day", present, "metric", "value"
    )
    before = (
        Window.partitionBy("metric").orderBy("day").rowsBetween(-lookback, Window.currentRow - 1)
    )
    history = F.array_sort(F.collect_list("value").over(before))
    rows_before = F.count(F.lit(1)).over(before)
    framed = (
        long.withColumn("_history", history)
        .withColumn("_rows", rows_before)
        .where(
            (F.col("_rows") >= MIN_BASELINE)
            & (F.array_size("_history") >= MIN_BASELINE)
            & F.col("value").isNotNull()
        )
        .withColumn("baseline_median", _median(F.col("_history")))
    )
    deviations = F.transform("_history", lambda v: F.abs(v - F.col("baseline_median")))
    return framed.withColumn("mad", _median(F.array_sort(deviations))).select(
        "day",
        "metric",
        "value",
        "baseline_median",
        "mad",
        robust_z(F.col("value"), F.col("baseline_median"), F.col("mad")).alias("robust_z"),
    )


def _fires(rule: AlertRule) -> Column:
    delta, z = F.col("_delta"), F.abs("robust_z")
    if rule.rel_delta is None:
        return (delta >= rule.abs_delta) & (z >= rule.min_z)
    # Only rises meet the delta test; drops fire through the z-score.
    big = (F.abs("_rel") >= rule.rel_delta) & (delta >= rule.abs_delta)
    return big | (z >= rule.min_z)


def detect_alerts(
    daily: DataFrame,
    lookback: int = BASELINE_ROWS,
    rules: tuple[AlertRule, ...] = ALERT_RULES,
) -> DataFrame:
    """Alert rows; a metric without a rule never fires."""
    base = metric_baselines(daily, lookback).withColumn(
        "_delta", F.col("value") - F.col("baseline_median")
    )
    infinite = F.lit(float("inf"))
    base = base.withColumn(
        "_rel", F.coalesce(ratio(F.col("_delta"), F.col("baseline_median")), infinite)
    )
    fires, severity, relative, message = (F.lit(None) for _ in range(4))
    for rule in rules:
        mine = F.col("metric") == rule.metric
        volume = rule.rel_delta is not None
        level = F.when(F.abs("_rel") < rule.blocker_rel, P1).otherwise(P0) if volume else F.lit(P1)
        text = (
            F.format_string(
                f"%s deviated materially vs prior {lookback} days (median=%.2f).",
                F.col("metric"),
                F.col("baseline_median"),
            )
            if volume
            else F.lit(rule.message)
        )
        fires = F.when(mine, _fires(rule)).otherwise(fires)
        severity = F.when(mine, level).otherwise(severity)
        relative = F.when(mine, F.col("_rel") if volume else F.lit(None)).otherwise(relative)
        message = F.when(mine, text).otherwise(message)
    return base.where(fires).select(
        "day",
        "metric",
        "value",
        "baseline_median",
        "mad",
        "robust_z",
        relative.cast("double").alias("relative_change"),
        severity.alias("severity"),
        message.alias("message"),
    )


def last_days(daily: DataFrame, days: int = 14) -> DataFrame:
    """The report's last days, in order."""
    return daily.orderBy(F.desc("day")).limit(days).orderBy("day")
