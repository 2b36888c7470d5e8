"""Registered queries: name → (spark, folder of the given tables) → DataFrame.

Every query runs over the whole `events` (or `pages`) table. Days and times leave as text and
doubles are rounded, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.functions import web
from clicktide.functions.timing import parse_ts
from clicktide.operators import kpis, monitoring, quality
from clicktide.operators.attribution import (
    ATTRIBUTION_COLUMNS,
    attribute_purchases,
    attributed_revenue_for,
    purchase_days,
)
from clicktide.operators.cleaning import (
    annotate_quarantine,
    clean_purchases,
    cleaned,
    cleaning_summary,
    defects,
    quarantine_reason_counts,
    quarantined,
    without_defects,
)
from clicktide.operators.facts import build_daily_fact, daily_channel_funnel
from clicktide.operators.purchases import SESSION_FACTS, extract_purchases, purchase_events
from clicktide.operators.reconcile import reconcile
from clicktide.operators.sessions import (
    SESSION_COLUMNS,
    assign_sessions,
    build_sessions,
    build_touchpoints,
    narrow_slots,
    segment_sessions,
    segment_slots,
    sessionize,
    slot_lookup,
)
from clicktide.operators.shaping import (
    canonical_identity,
    enrich_events,
    prepare_events,
    with_event_ts,
)
from clicktide.plans.event_view import raw_events
from clicktide.session import tune
from clicktide.settings import UTM_FIELDS, LandingRules

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; the session settings are applied before it is planned."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: build(tune(spark), sf_dir)
        return build

    return register


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _joined(c: str) -> Column:
    return F.array_join(c, ",").alias(c)


# --- shared steps -----------------------------------------------------------------


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_events(raw_events(spark, sf_dir))


def _purchases(prepared: DataFrame, slots: DataFrame) -> DataFrame:
    """Only purchase events meet the session lookup; they keep the facts of their session."""
    labelled = assign_sessions(purchase_events(prepared), slot_lookup(slots))
    return extract_purchases(labelled, keep=SESSION_FACTS)


def _sessions_and_purchases(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both from one frame of slots, whose exchange of the events the branches share."""
    slots = segment_slots(prepared)
    return segment_sessions(slots), _purchases(prepared, slots)


def _counted_sessions_and_purchases(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same with times only, for metrics that ask neither for client, channel nor device."""
    slots = narrow_slots(prepared)
    labelled = assign_sessions(purchase_events(prepared), slot_lookup(slots))
    return segment_sessions(slots), extract_purchases(labelled)


def _timed_purchases(prepared: DataFrame) -> DataFrame:
    """Minutes from session start to purchase; no payload is read."""
    labelled = assign_sessions(purchase_events(prepared), slot_lookup(narrow_slots(prepared)))
    times = labelled.select(F.col("ts").alias("purchase_ts"), "session_start_ts")
    return kpis.minutes_to_purchase(times)


def _tables(
    prepared: DataFrame, bought: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sessions, purchases and attribution; the days with purchases need no session lookup.

    `bought` may give the purchase events where they come from elsewhere than a filter.
    """
    bought = purchase_events(prepared) if bought is None else bought
    slots = segment_slots(prepared)
    sessions, purchases = segment_sessions(slots), _purchases(bought, slots)
    days = purchase_days(with_event_ts(bought).withColumnRenamed("ts", "purchase_ts"))
    attribution = attribute_purchases(purchases, sessions, buyers=days)
    return sessions, purchases, attribution


def _funnel(prepared: DataFrame) -> DataFrame:
    slots = segment_slots(prepared)
    return daily_channel_funnel(
        assign_sessions(prepared, slot_lookup(slots)), segment_sessions(slots)
    )


def _metrics(prepared: DataFrame) -> DataFrame:
    sessions, purchases, attribution = _tables(prepared)
    fact = build_daily_fact(sessions, purchases, attribution)
    return monitoring.daily_metrics(sessions, purchases, fact)


# --- event shaping ----------------------------------------------------------------


@query("canonical_identity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = canonical_identity(raw_events(spark, sf_dir))
    return events.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("client_id_canonical").alias("identified_rows"),
        F.count_distinct("client_id_canonical").alias("clients"),
        F.count_if(F.col("event_name") == "checkout_completed").alias("purchase_rows"),
    )


@query("event_times")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = parse_ts(F.col("timestamp"))
    return raw_events(spark, sf_dir).select(
        "event_id",
        ts.cast("date").cast("string").alias("event_day"),
        F.date_format(ts, "yyyyMMdd").alias("event_partition"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_iso"),
    )


@query("utm_fields")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_events(raw_events(spark, sf_dir)).select("event_id", *UTM_FIELDS)


@query("device_type")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(spark, sf_dir).select(
        "event_id", web.device_type(F.col("user_agent")).alias("device_type")
    )


@query("referrer_host")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(spark, sf_dir).select(
        "event_id", web.network_host(F.col("referrer")).alias("referrer_host")
    )


@query("channel_class")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_events(raw_events(spark, sf_dir)).select("event_id", "channel", "channel_detail")


@query("page_channels")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every crawled page as if it were both landing page and referrer."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    named = web.with_query(pages, "url", "query").withColumn("host", web.network_host(F.col("url")))
    named = web.with_query_values(
        named, "query", {"utm_source": "utm_source", "page_number": "page"}
    )
    outcome = named.withColumn("class", web.classify_channel(F.col("query"), F.col("host")))
    return outcome.select(
        "page_id",
        "host",
        "utm_source",
        "page_number",
        F.col("class.channel").alias("channel"),
        F.col("class.detail").alias("channel_detail"),
    )


# --- quality ----------------------------------------------------------------------


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.partition_measures(raw_events(spark, sf_dir))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_all_checks(raw_events(spark, sf_dir))


def _register_check(name: str, *check_ids: str) -> None:
    @query(name)
    def _(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = quality.run_all_checks(raw_events(spark, sf_dir), checks=check_ids)
        return _rounded(
            rows.select("partition_date", "check_id", "severity", "passed", "measure"),
            6,
            "measure",
        )


_register_check("json_parse_rate", "integrity.event_data_json_parse_rate")
_register_check(
    "timestamp_alignment", "integrity.timestamp_parse_and_partition_alignment"
)
_register_check("identity_null_rate", "tracking.identity_null_rate")
_register_check(
    "schema_presence",
    "schema.required_columns_present",
    "schema.identity_column_present",
    "schema.referrer_column_present",
)
_register_check(
    "purchase_integrity",
    "purchase.integrity.required_fields_and_positive_revenue",
    "purchase.integrity.no_purchases",
)


@query("partition_profile")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = quality.partition_profile(_measures(spark, sf_dir))
    profile = profile.withColumn("columns", _joined("columns"))
    return _rounded(_rounded(profile, 6, "identity_null_rate"), 2, "revenue_sum")


@query("unknown_events")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unknown_event_names(raw_events(spark, sf_dir))


@query("payload_contract")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.payload_contract(raw_events(spark, sf_dir))


@query("transaction_collisions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.transaction_collisions(raw_events(spark, sf_dir))


@query("replay_duplicates")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    replays = quality.replayed_purchases(raw_events(spark, sf_dir))
    return replays.select("partition_date", "transaction_id", "copies")


@query("dq_results")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _results(spark, sf_dir)
    return _rounded(
        results.select("partition_date", "check_id", "severity", "passed", "measure"), 6, "measure"
    )


@query("dq_score")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_partitions(_results(spark, sf_dir))


@query("identity_drift")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = quality.partition_profile(_measures(spark, sf_dir))
    return _rounded(quality.identity_drift(profile), 6, "robust_z", "identity_null_rate")


@query("schema_drift")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = quality.schema_drift(quality.partition_profile(_measures(spark, sf_dir)))
    lists = ("removed_columns", "added_columns", "missing_critical")
    return drift.withColumns({c: _joined(c) for c in lists})


@query("failed_signals")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = quality.partition_profile(_measures(spark, sf_dir))
    return quality.failed_signals(quality.drift_results(profile)).drop("details")


@query("dq_rollup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rollup(quality.score_partitions(_results(spark, sf_dir)))


@query("blocked_partitions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.blocked_partitions(quality.score_partitions(_results(spark, sf_dir)))


# --- cleaning ---------------------------------------------------------------------


@query("cleaned_events")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaned(annotate_quarantine(raw_events(spark, sf_dir)))
    return kept.select("event_id", "partition_date", "client_id_canonical", "event_name")


@query("quarantined_events")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quarantined(annotate_quarantine(raw_events(spark, sf_dir)))
    return bad.select("event_id", "partition_date", "client_id_canonical", "quarantine_reason")


@query("cleaning_summary")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning_summary(annotate_quarantine(raw_events(spark, sf_dir)))


@query("quarantine_reason_counts")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_reason_counts(annotate_quarantine(raw_events(spark, sf_dir)))


# --- sessions, purchases, attribution ---------------------------------------------


@query("sessionized_events")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = sessionize(canonical_identity(raw_events(spark, sf_dir)))
    return _text(
        labelled.select("event_id", "session_key", "session_num", "session_id", "session_start_ts"),
        "session_start_ts",
    )


def _session_output(sessions: DataFrame) -> DataFrame:
    shown = _text(sessions.select(*SESSION_COLUMNS), "session_start_ts", "session_end_ts")
    return _rounded(shown, 3, "session_duration_seconds")


@query("sessions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _session_output(build_sessions(_prepared(spark, sf_dir)))


@query("sessions_page_landing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing context from page views on the store's own pages, else from any event."""
    landing = LandingRules(event="page_viewed")
    return _session_output(build_sessions(_prepared(spark, sf_dir), landing=landing))


@query("touchpoints")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(build_touchpoints(_prepared(spark, sf_dir)), "touch_ts")


@query("purchases")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    purchases = _purchases(prepared, segment_slots(prepared)).drop(*SESSION_FACTS)
    return _text(purchases, "purchase_ts")


@query("purchase_attribution")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, attribution = _tables(_prepared(spark, sf_dir))
    shown = attribution.select(
        "transaction_id",
        "purchase_ts",
        "client_id_canonical",
        "session_id",
        "revenue",
        *ATTRIBUTION_COLUMNS,
    )
    return _text(shown, "purchase_ts")


def _register_model(name: str, model: str) -> None:
    @query(name)
    def _(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, _, attribution = _tables(_prepared(spark, sf_dir))
        return _rounded(attributed_revenue_for(attribution, model), 2, "attributed_revenue")


_register_model("attribution_daily_first", "first_click")
_register_model("attribution_daily_last", "last_click")
_register_model("attribution_daily_last_non_direct", "last_non_direct")


@query("clean_attribution_revenue")
def clean_attribution_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: quarantine, sessions, purchases, attribution, daily channel revenue."""
    raw = raw_events(spark, sf_dir)
    bad = defects(raw)
    kept, bought = without_defects(raw, bad), clean_purchases(raw, bad)
    _, _, attribution = _tables(enrich_events(kept), bought)
    return _rounded(
        attributed_revenue_for(attribution, "last_non_direct"), 2, "attributed_revenue"
    )


# --- facts, funnel, reconciliation ------------------------------------------------


@query("daily_fact")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = build_daily_fact(*_tables(_prepared(spark, sf_dir)))
    money = [c for c in fact.columns if "revenue" in c]
    return _rounded(_rounded(fact, 2, *money), 6, "conversion_rate")


@query("funnel_daily")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_funnel(_prepared(spark, sf_dir)), 6, "purchase_rate_per_session")


@query("reconciliation")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    row = reconcile(raw_events(spark, sf_dir), *_tables(prepared))
    return _rounded(row, 2, *[c for c in row.columns if c.startswith("revenue_")])


# --- analysis ---------------------------------------------------------------------


@query("kpi_totals")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    totals = kpis.kpi_totals(*_counted_sessions_and_purchases(prepared))
    return _rounded(_rounded(totals, 2, "total_revenue"), 6, "conversion", "aov", "rps")


@query("daily_kpis")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    daily = kpis.daily_kpis(*_counted_sessions_and_purchases(prepared))
    return _rounded(_rounded(daily, 2, "revenue"), 6, "purchase_rate")


@query("channel_revenue")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, attribution = _tables(_prepared(spark, sf_dir))
    return _rounded(kpis.channel_revenue(attribution), 2, "revenue")


@query("attribution_sensitivity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, attribution = _tables(_prepared(spark, sf_dir))
    table = kpis.attribution_sensitivity(attribution)
    return _rounded(table, 6, "first_click", "last_click", "last_non_direct")


@query("device_conversion")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    table = kpis.device_conversion(*_sessions_and_purchases(prepared))
    return _rounded(table, 6, "purchase_rate")


@query("new_vs_returning")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    table = kpis.new_vs_returning(*_sessions_and_purchases(prepared))
    return _rounded(table, 6, "purchase_rate")


@query("executive_ratios")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = kpis.executive_ratios(*_tables(_prepared(spark, sf_dir)))
    return _rounded(row, 6, *row.columns)


@query("time_to_purchase")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = _timed_purchases(_prepared(spark, sf_dir))
    return _rounded(kpis.time_to_purchase(timed), 5, "median_minutes", "p90_minutes")


@query("time_to_purchase_hist")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = _timed_purchases(_prepared(spark, sf_dir))
    return _rounded(kpis.time_to_purchase_histogram(timed), 5, "low", "high")


# --- monitoring -------------------------------------------------------------------


@query("direct_share")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = build_daily_fact(*_tables(_prepared(spark, sf_dir)))
    shares = monitoring.direct_shares(fact)
    return _rounded(shares, 6, "direct_session_share", "direct_revenue_share")


@query("direct_share_from_funnel")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = monitoring.direct_shares_from_funnel(_funnel(_prepared(spark, sf_dir)))
    return _rounded(shares, 6, "direct_session_share")


@query("daily_metrics")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _metrics(_prepared(spark, sf_dir))
    shares = ("purchase_rate", "direct_session_share", "direct_revenue_share")
    return _rounded(_rounded(daily, 2, "revenue"), 6, *shares)


@query("metric_baselines")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = monitoring.metric_baselines(_metrics(_prepared(spark, sf_dir)))
    return _rounded(_rounded(base, 6, "value", "baseline_median", "mad"), 7, "robust_z")


@query("alerts")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = monitoring.detect_alerts(_metrics(_prepared(spark, sf_dir)))
    rows = _rounded(rows, 6, "value", "baseline_median", "mad")
    return _rounded(rows, 7, "robust_z", "relative_change")


@query("monitoring_report")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 14 days of the metric series, with the alerts of each day counted."""
    daily = _metrics(_prepared(spark, sf_dir))
    fired = (
        monitoring.detect_alerts(daily)
        .groupBy("day")
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.count_if(F.col("severity") == "P0_BLOCKER").alias("blocker_alerts"),
        )
    )
    report = (
        monitoring.last_days(daily)
        .join(fired, "day", "left")
        .fillna(0, subset=["alerts", "blocker_alerts"])
    )
    shares = ("purchase_rate", "direct_session_share", "direct_revenue_share")
    return _rounded(_rounded(report, 2, "revenue"), 6, *shares)
