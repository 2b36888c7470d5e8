"""Sessions by inactivity gap, built so that one hot visitor key cannot stall a task.

Anonymous traffic shares one key per browser text, so a key may hold a large part of all events.
No window therefore runs over events. Time is cut into slots exactly one gap wide: two events of
one key in one slot are less than a gap apart, so they always belong to the same session. Events
are first aggregated per (key, slot), with map-side combine; only these slot rows, at most
`time span / gap` per key, are ordered by a window per key. The verdict goes back to the events
with an equi-join on (key, slot), which adaptive execution can split where a slot is hot.

First values are `min` of structs with strings, for which Spark sorts each task's events before the
first aggregate. Both ways around it were slower over 20 million events (README): hash aggregates of
packed (time, tie-break) numbers, and winners' values joined back to the events.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.scoring import mentions
from clicktide.functions.timing import (
    MICROS_PER_MINUTE,
    MICROS_PER_SECOND,
    floor_micros,
    to_second,
)
from clicktide.operators.shaping import with_event_ts
from clicktide.settings import UTM_FIELDS, LandingRules

GAP_MINUTES = 30
SLOT_KEYS = ["session_key", "slot_us"]
# Columns that may be null on single events, so the landing takes each one's first known value.
NULLABLE_CONTEXT = ("page_url", "referrer", *UTM_FIELDS, "client_id_canonical")
# Columns enrichment always fills: the first event's values are the first known ones.
FILLED_CONTEXT = ("channel", "channel_detail", "device_type")
SESSION_COLUMNS = (
    "session_key",
    "session_num",
    "session_start_ts",
    "session_id",
    "session_end_ts",
    "session_duration_seconds",
    "client_id_canonical",
    "landing_page_url",
    "referrer",
    *UTM_FIELDS,
    "landing_channel",
    "landing_channel_detail",
    "device_type",
    "event_count",
)


def session_key(client: Column, user_agent: Column) -> Column:
    """The client, or a stable key of the browser text when the client is unknown."""
    browser = F.substring(F.md5(F.coalesce(user_agent, F.lit("nan"))), 1, 12)
    return F.coalesce(client, F.concat(F.lit("anon:"), browser))


def session_id(key: Column, num: Column, start: Column) -> Column:
    return F.concat_ws(":", key, num.cast("string"), F.date_format(start, "yyyyMMdd'T'HHmmss"))


def with_slots(events: DataFrame, gap_minutes: float = GAP_MINUTES) -> DataFrame:
    """Drop events without a time; add session key, event micros and gap-wide slot."""
    gap = int(gap_minutes * MICROS_PER_MINUTE)
    keyed = with_event_ts(events).where(F.col("ts").isNotNull())
    return keyed.withColumns(
        {
            "session_key": session_key(F.col("client_id_canonical"), F.col("user_agent")),
            "ts_us": F.unix_micros(F.col("ts")),
        }
    ).withColumn("slot_us", floor_micros(F.col("ts_us"), gap))


def _numbered(slots: DataFrame, gap_minutes: float) -> DataFrame:
    """Number the sessions of each key over its slot rows; a gap must exceed the limit."""
    gap = int(gap_minutes * MICROS_PER_MINUTE)
    by_time = Window.partitionBy("session_key").orderBy("slot_us")
    previous = F.lag("last_us").over(by_time)
    opens = F.when(previous.isNull() | (F.col("first_us") - previous > gap), 1).otherwise(0)
    running = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return slots.withColumn("_opens", opens).withColumn(
        "session_num", F.sum("_opens").over(running)
    )


def _is_candidate(rules: LandingRules) -> Column:
    if rules.event is None:
        return F.lit(True)
    url = F.coalesce(F.col("page_url"), F.lit(""))
    return F.coalesce(
        (F.col("event_name") == rules.event)
        & url.contains(rules.site_host)
        & ~url.contains(rules.exclude_host),
        F.lit(False),
    )


def session_slots(
    events: DataFrame,
    gap_minutes: float = GAP_MINUTES,
    landing: LandingRules = LandingRules(),
    tie_break: str = "event_id",
) -> DataFrame:
    """One row per (key, slot) with its session number and mergeable first-value structs.

    A landing struct starts with `(not candidate, time, tie-break)`, so `min` picks the earliest
    candidate and falls back to any event; the same `min` merges slots into sessions.
    """
    order = (F.col("ts_us"), F.col(tie_break).alias("tie"))
    late = (~_is_candidate(landing)).alias("late")
    # first_<column>: (late, time, tie, value) of the first row where the column is known
    firsts = [
        F.min(F.when(F.col(c).isNotNull(), F.struct(late, *order, F.col(c).alias("v")))).alias(
            f"first_{c}"
        )
        for c in NULLABLE_CONTEXT
    ]
    slots = (
        with_slots(events, gap_minutes)
        .groupBy(*SLOT_KEYS)
        .agg(
            F.min("ts_us").alias("first_us"),
            F.max("ts_us").alias("last_us"),
            F.count(F.lit(1)).alias("events"),
            F.min(F.struct(late, *order, *FILLED_CONTEXT)).alias("landing"),
            F.min(F.struct(*order, *NULLABLE_CONTEXT, *FILLED_CONTEXT)).alias("first_event"),
            *firsts,
        )
    )
    return _numbered(slots, gap_minutes)


def _session_rollup(slots: DataFrame) -> DataFrame:
    """Merge slot rows into sessions; they already sit together by key, so nothing moves."""
    merged = [F.min(f"first_{c}").alias(f"first_{c}") for c in NULLABLE_CONTEXT]
    rolled = slots.groupBy("session_key", "session_num").agg(
        F.min("first_us").alias("start_us"),
        F.max("last_us").alias("end_us"),
        F.sum("events").alias("event_count"),
        F.min("landing").alias("landing"),
        F.min("first_event").alias("first_event"),
        *merged,
    )
    start = F.timestamp_micros("start_us")
    return rolled.withColumn(
        "session_id", session_id(F.col("session_key"), F.col("session_num"), start)
    )


def sessions_from_slots(slots: DataFrame) -> DataFrame:
    """The session table, one row per session."""
    rolled = _session_rollup(slots)

    def known(c: str) -> Column:
        first = F.col(f"first_{c}")
        # A session with candidates takes no value from its other events.
        return F.when(first.getField("late") & ~F.col("landing.late"), None).otherwise(
            first.getField("v")
        )

    return rolled.select(
        "session_key",
        "session_num",
        to_second(F.timestamp_micros("start_us")).alias("session_start_ts"),
        "session_id",
        to_second(F.timestamp_micros("end_us")).alias("session_end_ts"),
        ((F.col("end_us") - F.col("start_us")) / F.lit(float(MICROS_PER_SECOND))).alias(
            "session_duration_seconds"
        ),
        known("client_id_canonical").alias("client_id_canonical"),
        known("page_url").alias("landing_page_url"),
        known("referrer").alias("referrer"),
        *[known(c).alias(c) for c in UTM_FIELDS],
        F.col("landing.channel").alias("landing_channel"),
        F.col("landing.channel_detail").alias("landing_channel_detail"),
        F.col("landing.device_type").alias("device_type"),
        "event_count",
    )


def build_sessions(
    events: DataFrame,
    gap_minutes: float = GAP_MINUTES,
    landing: LandingRules = LandingRules(),
    tie_break: str = "event_id",
) -> DataFrame:
    """Enriched events to the session table."""
    return sessions_from_slots(session_slots(events, gap_minutes, landing, tie_break))


def touchpoints_from_slots(slots: DataFrame) -> DataFrame:
    """The true first event of each session as its marketing touchpoint."""
    rolled = _session_rollup(slots).select("session_id", "first_event.*")
    return rolled.select(
        "session_id",
        "client_id_canonical",
        F.timestamp_micros("ts_us").alias("touch_ts"),
        "page_url",
        "referrer",
        *UTM_FIELDS,
        *FILLED_CONTEXT,
        mentions(F.col("channel"), "direct").alias("is_direct"),
        mentions(F.col("channel"), "paid|affiliate").alias("is_paid"),
    )


def build_touchpoints(
    events: DataFrame, gap_minutes: float = GAP_MINUTES, tie_break: str = "event_id"
) -> DataFrame:
    return touchpoints_from_slots(session_slots(events, gap_minutes, tie_break=tie_break))


def narrow_slots(events: DataFrame, gap_minutes: float = GAP_MINUTES) -> DataFrame:
    """Numbered (key, slot) rows with times only, enough to label events and to count sessions.

    Numbers alone are aggregated by hash, without a sort. As with `segment_slots`, the branches of a
    query share the exchange of the events.
    """
    slots = (
        with_slots(events, gap_minutes)
        .groupBy(*SLOT_KEYS)
        .agg(F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"))
    )
    needed = [F.col(c).isNotNull() for c in ("slot_us", "first_us", "last_us")]
    return _numbered(slots.where(reduce(and_, needed)), gap_minutes)


def segment_slots(
    events: DataFrame,
    gap_minutes: float = GAP_MINUTES,
    landing: LandingRules = LandingRules(),
    tie_break: str = "event_id",
) -> DataFrame:
    """Numbered (key, slot) rows with times and the landing's channel, device and client.

    That is all that purchases, attribution, facts and metrics take from a session. Every branch of
    a query that starts from this frame needs the same columns of it (the filters name those that a
    branch could do without), so Spark plans one exchange of the events and reuses it.
    """
    first = F.min(
        F.struct(
            (~_is_candidate(landing)).alias("late"),
            F.col("ts_us"),
            F.col(tie_break).alias("tie"),
            "channel",
            "device_type",
            F.col("client_id_canonical").alias("client"),
        )
    )
    slots = (
        with_slots(events, gap_minutes)
        .groupBy(*SLOT_KEYS)
        .agg(
            F.min("ts_us").alias("first_us"),
            F.max("ts_us").alias("last_us"),
            first.alias("landing"),
        )
    )
    needed = [F.col(c).isNotNull() for c in ("slot_us", "first_us", "last_us", "landing")]
    return _numbered(slots.where(reduce(and_, needed)), gap_minutes)


def segment_sessions(slots: DataFrame) -> DataFrame:
    """Sessions of `segment_slots`: keys, times, client, landing channel and device.

    All rows of a key share its client (or have none), so the landing's client is the session's.
    Those of `narrow_slots` have keys and times.
    """
    start = F.timestamp_micros("start_us")
    firsts, landing = [], []
    if "landing" in slots.columns:
        firsts = [F.min("landing").alias("landing")]
        landing = [
            F.col("landing.client").alias("client_id_canonical"),
            F.col("landing.channel").alias("landing_channel"),
            F.col("landing.device_type").alias("device_type"),
        ]
    return (
        slots.groupBy("session_key", "session_num")
        .agg(F.min("first_us").alias("start_us"), F.max("last_us").alias("end_us"), *firsts)
        .select(
            "session_key",
            "session_num",
            to_second(start).alias("session_start_ts"),
            session_id(F.col("session_key"), F.col("session_num"), start).alias("session_id"),
            to_second(F.timestamp_micros("end_us")).alias("session_end_ts"),
            *landing,
        )
    )


def slot_lookup(slots: DataFrame) -> DataFrame:
    """(key, slot) to session number, id and start; also the landing's channel and device.

    The landing is there if the slots hold it; the device is named `landing_device`, as events have
    a device of their own.
    """
    whole = Window.partitionBy("session_key", "session_num")
    out = slots.withColumn("start_us", F.min("first_us").over(whole))
    extra = []
    if "landing" in slots.columns:
        out = out.withColumn("_landing", F.min("landing").over(whole))
        extra = [
            F.col("_landing.channel").alias("landing_channel"),
            F.col("_landing.device_type").alias("landing_device"),
        ]
    start = F.timestamp_micros("start_us")
    return out.select(
        *SLOT_KEYS,
        "session_num",
        session_id(F.col("session_key"), F.col("session_num"), start).alias("session_id"),
        to_second(start).alias("session_start_ts"),
        *extra,
    )


def assign_sessions(
    events: DataFrame, lookup: DataFrame, gap_minutes: float = GAP_MINUTES
) -> DataFrame:
    """Events (or any subset of them) with the session columns of `slot_lookup`."""
    return (
        with_slots(events, gap_minutes)
        .join(lookup, SLOT_KEYS, "inner")
        .drop("slot_us", "ts_us")
    )


def sessionize(events: DataFrame, gap_minutes: float = GAP_MINUTES) -> DataFrame:
    """Every timed event with its session key, number, id and start."""
    lookup = slot_lookup(narrow_slots(events, gap_minutes))
    return assign_sessions(events, lookup, gap_minutes)
