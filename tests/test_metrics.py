import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clicktide.operators import kpis, monitoring, reconcile
from clicktide.operators.facts import build_daily_fact, daily_channel_funnel
from clicktide.operators.quantiles import exact_quantiles, histogram, quantile_row

BASE = datetime(2025, 1, 1, 12)
SESSIONS = (
    "session_id string, client_id_canonical string, session_start_ts timestamp, "
    "landing_channel string, device_type string"
)
PURCHASES = (
    "transaction_id string, purchase_ts timestamp, client_id_canonical string, "
    "session_id string, revenue double"
)
ATTRIBUTION = (
    "transaction_id string, purchase_ts timestamp, revenue double, first_click_channel string, "
    "last_click_channel string, last_non_direct_channel string"
)


@pytest.fixture
def sessions(spark):
    return spark.createDataFrame(
        [
            ("s1", "u", BASE, "direct", "mobile"),
            ("s2", "u", BASE + timedelta(days=1), "referral", "desktop"),
            ("s3", None, BASE, None, "mobile"),
            ("s4", None, BASE, "direct", None),
        ],
        SESSIONS,
    )


@pytest.fixture
def purchases(spark):
    return spark.createDataFrame(
        [
            ("t1", BASE + timedelta(minutes=6), "u", "s1", 10.0),
            ("t1", BASE + timedelta(minutes=9), "u", "s1", 10.0),
            ("t2", BASE + timedelta(days=1, minutes=3), "u", "s2", 5.0),
            ("t3", BASE + timedelta(minutes=2), None, "s3", None),
            ("t4", BASE, None, None, 1.0),
        ],
        PURCHASES,
    )


@pytest.fixture
def attribution(spark):
    return spark.createDataFrame(
        [
            ("t1", BASE, 10.0, "referral", "direct", None),
            ("t1", BASE, 10.0, "referral", "direct", None),
            ("t2", BASE + timedelta(days=1), 5.0, "direct", "referral", "referral"),
            ("t3", BASE, None, None, None, None),
            ("t4", BASE, 1.0, None, None, None),
        ],
        ATTRIBUTION,
    )


def test_totals(sessions, purchases):
    row = kpis.kpi_totals(sessions, purchases).first()
    assert (row.total_revenue, row.total_purchases, row.total_sessions) == (26.0, 4, 4)
    assert (row.conversion, row.aov, row.rps) == (1.0, 6.5, 6.5)


def test_totals_of_nothing_are_null_ratios(sessions, purchases):
    row = kpis.kpi_totals(sessions.limit(0), purchases.limit(0)).first()
    assert (row.total_revenue, row.total_sessions, row.conversion, row.aov) == (0.0, 0, None, None)


def test_known_totals():
    """Committed totals: 276 purchases of 278,799.4 in 40,133 sessions."""
    assert 276 / 40133 == pytest.approx(0.006877133531009394)
    assert 278799.4 / 276 == pytest.approx(1010.1427536231885)


def test_fact_matches_null_segments_and_repeats_channel_revenue(sessions, purchases, attribution):
    rows = {
        (r.day, r.landing_channel, r.device_type): r
        for r in build_daily_fact(sessions, purchases, attribution).collect()
    }
    assert len(rows) == 4
    hit = rows[("2025-01-01", "direct", "mobile")]
    assert (hit.purchases, hit.revenue, hit.conversion_rate) == (1, 20.0, 1.0)
    assert hit.attributed_revenue_last_click == 20.0
    # The same day and channel on another device repeats the attributed revenue.
    other = rows[("2025-01-01", "direct", None)]
    assert (other.purchases, other.attributed_revenue_last_click) == (0, 20.0)
    # Null channel and its purchases meet.
    null = rows[("2025-01-01", None, "mobile")]
    assert (null.purchases, null.revenue, null.attributed_revenue_last_non_direct) == (1, 0.0, 21.0)


def test_funnel(spark, sessions):
    events = spark.createDataFrame(
        [
            ("s1", BASE.isoformat() + "Z", "page_viewed"),
            ("s1", (BASE + timedelta(days=1)).isoformat() + "Z", "checkout_completed"),
            ("s3", BASE.isoformat() + "Z", "page_viewed"),
            ("s4", BASE.isoformat() + "Z", "checkout_completed"),
        ],
        "session_id string, timestamp string, event_name string",
    )
    rows = {(r.event_day, r.landing_channel): r for r in daily_channel_funnel(events, sessions).collect()}
    assert set(rows) == {("2025-01-01", "direct"), ("2025-01-02", "direct")}
    first, second = rows[("2025-01-01", "direct")], rows[("2025-01-02", "direct")]
    assert (first.page_viewed, first.checkout_completed, first.sessions) == (1, 1, 2)
    assert (first.checkout_started, first.purchase_rate_per_session) == (0, 0.5)
    assert (second.sessions, second.purchase_rate_per_session) == (None, None)


def test_daily_kpis(sessions, purchases):
    rows = {r.day: r for r in kpis.daily_kpis(sessions, purchases).collect()}
    assert (rows["2025-01-01"].sessions, rows["2025-01-01"].purchases) == (3, 3)
    assert rows["2025-01-02"].revenue == 5.0


def test_channel_revenue_and_sensitivity(attribution):
    rows = [(r.channel, r.revenue) for r in kpis.channel_revenue(attribution).collect()]
    assert rows == [("direct", 21.0), ("referral", 5.0)]
    table = {r.channel: r for r in kpis.attribution_sensitivity(attribution).collect()}
    assert table["direct"].first_click == pytest.approx(6 / 26)
    assert table["referral"].first_click == pytest.approx(20 / 26)
    assert sum(r.last_click for r in table.values()) == pytest.approx(1)


def test_sensitivity_takes_the_top_of_every_model(spark):
    rows = [("t", BASE, float(10 - i), f"f{i}", f"l{i}", f"n{i}") for i in range(3)]
    got = kpis.attribution_sensitivity(spark.createDataFrame(rows, ATTRIBUTION), top=2).collect()
    assert [r.channel for r in got] == ["n0", "n1", "f0", "f1", "l0", "l1"]
    assert got[0].first_click == 0.0


def test_known_channel_shares(spark):
    """Committed last-non-direct revenue, where no channel means direct."""
    known = {None: 137456.0, "paid_search": 84105.0, "unknown_paid": 46188.4, "organic_search": 10805.0,
             "paid_social": 245.0}
    rows = [("t", BASE, v, c, c, c) for c, v in known.items()]
    shares = {
        r.channel: r.last_non_direct
        for r in kpis.attribution_sensitivity(spark.createDataFrame(rows, ATTRIBUTION)).collect()
    }
    assert shares["direct"] == pytest.approx(0.49302832072091973)
    assert shares["unknown_paid"] == pytest.approx(0.1656689361598339)
    assert list(shares) == ["direct", "paid_search", "unknown_paid", "organic_search", "paid_social"]


def test_device_and_user_type_conversion(sessions, purchases):
    device = {r.device_type: (r.sessions, r.purchases) for r in kpis.device_conversion(sessions, purchases).collect()}
    assert device == {"mobile": (2, 2), "desktop": (1, 1)}
    user = {r.user_type: (r.sessions, r.purchases) for r in kpis.new_vs_returning(sessions, purchases).collect()}
    assert user == {"new": (1, 1), "returning": (3, 2)}
    apart = kpis.new_vs_returning(sessions, purchases, anonymous_as="anonymous")
    assert {r.user_type for r in apart.collect()} == {"new", "returning", "anonymous"}


def test_executive_ratios(sessions, purchases, attribution):
    row = kpis.executive_ratios(sessions, purchases, attribution).first()
    assert (row.new_rate, row.mobile_rate, row.desktop_rate) == (1.0, 1.0, 1.0)
    assert row.returning_rate == pytest.approx(2 / 3)
    assert row.mobile_session_share == 0.5
    assert row.direct_share == pytest.approx(21 / 26)


def test_time_to_purchase(sessions, purchases):
    timed = kpis.minutes_to_purchase(purchases, sessions)
    assert sorted(r.minutes_to_purchase for r in timed.collect()) == [2.0, 3.0, 6.0, 9.0]
    row = kpis.time_to_purchase(timed).first()
    assert row.median_minutes == pytest.approx(4.5)
    assert row.p90_minutes == pytest.approx(8.1)


def test_exact_quantiles_match_interpolated_percentiles(spark):
    rng = random.Random(5)
    # A third of the values are one and the same.
    xs = [77 if i % 3 == 0 else rng.randrange(-(10**9), 10**9) for i in range(999)]
    df = spark.createDataFrame([(x,) for x in [*xs, None]], "x long")
    got = {r.probability: r.value for r in exact_quantiles(df, "x", (0.0, 0.25, 0.5, 0.9, 1.0), 1.0).collect()}
    want = df.select(F.percentile("x", F.array(*[F.lit(p) for p in got]))).first()[0]
    assert list(got.values()) == pytest.approx(want)
    assert got[0.5] == statistics.median(xs)
    row = quantile_row(df, "x", {"low": 0.25, "middle": 0.5, "again": 0.5, "high": 0.9}, 2.0).first()
    assert row.asDict() == pytest.approx({"low": got[0.25] / 2, "middle": got[0.5] / 2, "again": got[0.5] / 2, "high": got[0.9] / 2})


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x long")
    assert exact_quantiles(df, "x", (0.5,), 1.0).count() == 0
    assert quantile_row(df, "x", {"middle": 0.5}, 1.0).first().middle is None


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 5, 10, 10]], "x double")
    rows = {r.bin: r for r in histogram(df, "x", 10).collect()}
    assert {b: r.rows for b, r in rows.items() if r.rows} == {1: 1, 2: 1, 6: 1, 10: 2}
    assert len(rows) == 10 and (rows[1].low, rows[10].high) == (0.0, 10.0)
    flat = histogram(df.where("x = 10"), "x", 4).collect()
    assert sum(r.rows for r in flat) == 2 and min(r.low for r in flat) == 9.5
    assert histogram(df.limit(0), "x").count() == 0


def test_reconciliation_sums_each_model(spark, sessions, purchases, attribution):
    events = spark.createDataFrame([("checkout_completed",)] * 5 + [("x",)], "event_name string")
    row = reconcile.reconcile(events, sessions, purchases, attribution).first()
    assert (row.input_event_rows, row.purchase_events_rows, row.session_rows) == (6, 5, 4)
    assert (row.purchases_table_rows, row.purchases_missing_session_id) == (5, 1)
    assert row.revenue_sum_attrib_first_click == row.revenue_sum_purchases == 26.0
    assert row.revenue_sum_diff_purchases_vs_attrib == 0.0


# Known daily series: sessions, purchases, revenue.
SERIES = [
    ("2025-02-23", 3393, 21, 20408.0), ("2025-02-24", 3126, 25, 25457.6), ("2025-02-25", 2853, 15, 13543.0),
    ("2025-02-26", 2585, 13, 13906.0), ("2025-02-27", 2821, 18, 14000.0), ("2025-02-28", 2593, 18, 18669.0),
    ("2025-03-01", 2818, 27, 29590.0), ("2025-03-02", 3302, 22, 28221.0), ("2025-03-03", 3195, 22, 20504.8),
    ("2025-03-04", 2984, 18, 12415.0), ("2025-03-05", 2377, 20, 20714.0), ("2025-03-06", 2702, 21, 21754.0),
    ("2025-03-07", 2467, 16, 18331.0), ("2025-03-08", 2917, 20, 21286.0),
]


@pytest.fixture
def known_daily(spark):
    rows = [(d, s, p, r, p / s, 0.0, 0.0) for d, s, p, r in SERIES]
    return spark.createDataFrame(
        rows,
        "day string, sessions long, purchases long, revenue double, purchase_rate double, "
        "direct_session_share double, direct_revenue_share double",
    )


def test_known_series_gives_the_known_alerts(known_daily):
    got = monitoring.detect_alerts(known_daily).orderBy("day").collect()
    assert [(a.day, a.metric, a.severity) for a in got] == [
        ("2025-02-28", "revenue", "P1_HIGH"),
        ("2025-03-01", "revenue", "P0_BLOCKER"),
        ("2025-03-02", "revenue", "P1_HIGH"),
    ]
    assert [a.robust_z for a in got] == pytest.approx([6.891117067833698, 3.425607183908046, 1.3526819231576737])
    assert [a.relative_change for a in got] == pytest.approx([0.3335, 0.8115032599712265, 0.5116493294231078], abs=1e-4)
    assert got[0].message == "revenue deviated materially vs prior 7 days (median=14000.00)."
    assert (got[0].baseline_median, got[0].mad) == (14000.0, 457.0)


def test_baseline_needs_three_known_values(spark):
    rows = [(f"2025-01-0{i}", v) for i, v in enumerate([1.0, None, 2.0, 3.0, 4.0], 1)]
    base = monitoring.metric_baselines(spark.createDataFrame(rows, "day string, purchase_rate double"))
    assert [(r.day, r.baseline_median) for r in base.collect()] == [("2025-01-05", 2.0)]


def test_zero_median_is_an_infinite_change(spark):
    rows = [(f"2025-01-{i:02}", v) for i, v in enumerate([0.0, 0.0, 0.0, 6000.0], 1)]
    got = monitoring.detect_alerts(spark.createDataFrame(rows, "day string, revenue double")).collect()
    assert [(a.relative_change, a.severity, a.robust_z) for a in got] == [(float("inf"), "P0_BLOCKER", 0.0)]


def test_share_metric_rules(spark):
    rows = [(f"2025-01-{i:02}", v, v) for i, v in enumerate([0.2, 0.21, 0.19, 0.2, 0.5], 1)]
    df = spark.createDataFrame(rows, "day string, direct_session_share double, direct_revenue_share double")
    got = monitoring.detect_alerts(df).collect()
    # The revenue share is watched but has no rule.
    assert [(a.day, a.metric, a.severity, a.relative_change) for a in got] == [
        ("2025-01-05", "direct_session_share", "P1_HIGH", None)
    ]


def test_direct_shares(spark, sessions, purchases, attribution):
    fact = build_daily_fact(sessions, purchases, attribution)
    rows = {r.day: r for r in monitoring.direct_shares(fact).collect()}
    assert rows["2025-01-01"].direct_session_share == pytest.approx(2 / 3)
    assert rows["2025-01-01"].direct_revenue_share == 1.0
    assert rows["2025-01-02"].direct_session_share == 0.0
    funnel = spark.createDataFrame(
        [("d", "direct", 3), ("d", "referral", 1), ("e", "direct", None)],
        "event_day string, landing_channel string, sessions long",
    )
    shares = {r.day: r.direct_session_share for r in monitoring.direct_shares_from_funnel(funnel).collect()}
    assert shares == {"d": 0.75, "e": 0.0}


def test_daily_metrics_sources(sessions, purchases, attribution):
    fact = build_daily_fact(sessions, purchases, attribution)
    assert "direct_revenue_share" in monitoring.daily_metrics(sessions, purchases, fact).columns
    assert "direct_session_share" not in monitoring.daily_metrics(sessions, purchases).columns


def test_last_days(known_daily):
    days = [r.day for r in monitoring.last_days(known_daily, 2).collect()]
    assert days == ["2025-03-07", "2025-03-08"]
