"""Daily marketing fact and daily channel funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions.scoring import ratio
from clicktide.functions.timing import day_text
from clicktide.operators.attribution import MODELS, attributed_revenue_daily
from clicktide.operators.shaping import with_event_ts
from clicktide.settings import ALLOWED_EVENTS, PURCHASE_EVENT


def sessions_by_segment(sessions: DataFrame) -> DataFrame:
    """Session counts by start day, landing channel and device; null groups are kept."""
    return sessions.groupBy(
        day_text(F.col("session_start_ts")).alias("day"), "landing_channel", "device_type"
    ).agg(F.count(F.lit(1)).alias("sessions"))


def purchases_by_segment(purchases: DataFrame, sessions: DataFrame) -> DataFrame:
    """Distinct transactions and revenue by purchase day and the session's channel and device.

    Purchases that carry the facts of their session need no join with the sessions.
    """
    if {"landing_channel", "landing_device"} <= set(purchases.columns):
        known = purchases.withColumnRenamed("landing_device", "device_type")
    else:
        segment = sessions.select("session_id", "landing_channel", "device_type")
        known = purchases.join(segment, "session_id", "left")
    return (
        known.groupBy(day_text(F.col("purchase_ts")).alias("day"), "landing_channel", "device_type")
        .agg(
            F.count_distinct("transaction_id").alias("purchases"),
            F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("revenue"),
        )
    )


def build_daily_fact(
    sessions: DataFrame, purchases: DataFrame, attribution: DataFrame
) -> DataFrame:
    """Day × channel × device fact.

    Attributed revenue is known per day and channel and is repeated on every device row, so it
    must not be summed over devices; use `attributed_revenue_daily` for totals. Segments with
    purchases but no session start on that day are not in the fact.
    """
    sess = sessions_by_segment(sessions).alias("s")
    pur = purchases_by_segment(purchases, sessions).alias("p")
    same_segment = (
        (F.col("s.day") == F.col("p.day"))
        & F.col("s.landing_channel").eqNullSafe(F.col("p.landing_channel"))
        & F.col("s.device_type").eqNullSafe(F.col("p.device_type"))
    )
    by_model = (
        attributed_revenue_daily(attribution)
        .groupBy("purchase_day", "channel")
        .agg(
            *[
                F.sum(F.when(F.col("model") == m, F.col("attributed_revenue"))).alias(m)
                for m in MODELS
            ]
        )
        .alias("a")
    )
    same_channel = (F.col("s.day") == F.col("a.purchase_day")) & F.col(
        "s.landing_channel"
    ).eqNullSafe(F.col("a.channel"))
    purchases_count = F.coalesce(F.col("p.purchases"), F.lit(0))
    return (
        sess.join(pur, same_segment, "left")
        .join(by_model, same_channel, "left")
        .select(
            "s.day",
            "s.landing_channel",
            "s.device_type",
            "s.sessions",
            purchases_count.alias("purchases"),
            F.coalesce(F.col("p.revenue"), F.lit(0.0)).alias("revenue"),
            ratio(purchases_count, F.col("s.sessions")).alias("conversion_rate"),
            *[
                F.coalesce(F.col(f"a.{m}"), F.lit(0.0)).alias(f"attributed_revenue_{m}")
                for m in MODELS
            ],
        )
    )


def daily_channel_funnel(
    events: DataFrame,
    sessions: DataFrame,
    event_names: tuple[str, ...] | None = ALLOWED_EVENTS,
    purchase_event: str = PURCHASE_EVENT,
) -> DataFrame:
    """Events per name by event day and landing channel, with that day's session starts.

    `events` carry `landing_channel` (see `slot_lookup`); where they do not, it is joined in by
    session id. Rows without a channel are left out. Sessions are counted on their start day, so
    the rate may be null or above 1. Events of other names than the listed ones are counted together
    as `other_events`; with `event_names=None` the names are taken from the data (one more job) and
    each has a column.
    """
    if "landing_channel" not in events.columns:
        channel = sessions.select("session_id", "landing_channel")
        events = events.join(channel, "session_id", "left")
    timed = with_event_ts(events).where(F.col("landing_channel").isNotNull())
    others = event_names is not None
    if event_names is None:
        found = timed.select("event_name").where(F.col("event_name").isNotNull()).distinct()
        event_names = tuple(sorted({r.event_name for r in found.collect()} | {purchase_event}))
    columns = [F.count(F.when(F.col("event_name") == n, F.col("timestamp"))).alias(n) for n in event_names]
    if others:
        other = ~F.col("event_name").isin(*event_names)
        columns.append(F.count(F.when(other, F.col("timestamp"))).alias("other_events"))
    counts = timed.groupBy(day_text(F.col("ts")).alias("event_day"), "landing_channel").agg(*columns)
    starts = (
        sessions.where(F.col("landing_channel").isNotNull())
        .groupBy(day_text(F.col("session_start_ts")).alias("event_day"), "landing_channel")
        .agg(F.count(F.lit(1)).alias("sessions"))
    )
    rate = ratio(F.col(purchase_event), F.col("sessions"))
    return counts.join(starts, ["event_day", "landing_channel"], "left").withColumn(
        "purchase_rate_per_session", rate
    )
