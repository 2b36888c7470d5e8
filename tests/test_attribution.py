import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clicktide.operators.attribution import (
    MODELS,
    attribute_purchases,
    attributed_revenue_daily,
    attributed_revenue_for,
)

BASE = datetime(2025, 1, 1)
SESSIONS = (
    "client_id_canonical string, session_id string, session_start_ts timestamp, "
    "landing_channel string"
)
PURCHASES = (
    "transaction_id string, purchase_ts timestamp, client_id_canonical string, "
    "session_id string, revenue double"
)


def attribute(spark, sessions, purchases, **options):
    s = spark.createDataFrame(sessions, SESSIONS)
    p = spark.createDataFrame(purchases, PURCHASES)
    return {r.transaction_id: r for r in attribute_purchases(p, s, **options).collect()}


def test_first_last_and_last_non_direct(spark):
    sessions = [
        ("u", "s1", BASE, "paid_social"),
        ("u", "s2", BASE + timedelta(days=2), "organic_search"),
        ("u", "s3", BASE + timedelta(days=6), "direct"),
        ("v", "x1", BASE, "referral"),
    ]
    got = attribute(
        spark, sessions, [("t", BASE + timedelta(days=6, minutes=3), "u", "s3", 100.0)]
    )["t"]
    assert (got.first_click_session_id, got.first_click_channel) == ("s1", "paid_social")
    assert (got.last_click_session_id, got.last_click_channel) == ("s3", "direct")
    assert (got.last_non_direct_session_id, got.last_non_direct_channel) == (
        "s2",
        "organic_search",
    )


def test_lookback_bounds_are_inclusive(spark):
    week = timedelta(days=7)
    sessions = [("u", "s1", BASE, "referral")]
    got = attribute(
        spark,
        sessions,
        [
            ("at start", BASE, "u", "s", 1.0),
            ("just before", BASE - timedelta(microseconds=1), "u", "s", 1.0),
            ("seven days", BASE + week, "u", "s", 1.0),
            ("over", BASE + week + timedelta(microseconds=1), "u", "s", 1.0),
        ],
    )
    assert {t: r.first_click_session_id for t, r in got.items()} == {
        "at start": "s1",
        "just before": None,
        "seven days": "s1",
        "over": None,
    }


def test_session_start_is_cut_to_the_second(spark):
    sessions = [("u", "s1", BASE + timedelta(milliseconds=900), "referral")]
    got = attribute(spark, sessions, [("t", BASE + timedelta(milliseconds=100), "u", "s1", 1.0)])
    assert got["t"].last_click_session_id == "s1"


def test_null_channel_is_non_direct_and_null_client_matches_nothing(spark):
    sessions = [
        ("u", "s1", BASE, "referral"),
        ("u", "s2", BASE + timedelta(hours=1), None),
        (None, "s3", BASE, "referral"),
    ]
    purchases = [
        ("t", BASE + timedelta(hours=2), "u", "s2", 1.0),
        ("n", BASE + timedelta(hours=2), None, "s3", 1.0),
        ("no time", None, "u", "s2", 1.0),
    ]
    got = attribute(spark, sessions, purchases)
    assert got["t"].last_non_direct_session_id == "s2"
    assert got["t"].last_non_direct_channel is None
    assert got["n"].first_click_session_id is None
    assert got["no time"].first_click_session_id is None


def test_equal_starts_go_by_session_id(spark):
    sessions = [("u", "s2", BASE, "referral"), ("u", "s1", BASE, "direct")]
    got = attribute(spark, sessions, [("t", BASE, "u", "s", 1.0)])["t"]
    assert (got.first_click_session_id, got.last_click_session_id) == ("s1", "s2")


@pytest.mark.parametrize("days", [1, 7])
def test_matches_a_plain_loop_with_one_hot_client(spark, days):
    rng = random.Random(days)
    channels = ["direct", "referral", "paid_search", None]

    def client():
        return "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])

    def moment():
        return BASE + timedelta(seconds=rng.randrange(-10 * 86400, 20 * 86400))

    sessions = [(client(), f"s{i:03}", moment(), rng.choice(channels)) for i in range(300)]
    purchases = [(f"t{i}", moment(), client(), None, 1.0) for i in range(400)]
    got = attribute(spark, sessions, purchases, lookback_days=days)
    assert len(got) == len(purchases)
    for tx, when, who, _, _ in purchases:
        seen = sorted(
            (start, sid, channel)
            for c, sid, start, channel in sessions
            if who is not None and c == who and when - timedelta(days=days) <= start <= when
            for channel in [channel or ""]
        )
        other = [s for s in seen if s[2] != "direct"]
        want = [seen[0], seen[-1]] if seen else [None, None]
        want.append(other[-1] if other else None)
        row = got[tx]
        for model, pick in zip(MODELS, want):
            assert row[f"{model}_session_id"] == (pick[1] if pick else None)
            assert row[f"{model}_channel"] == ((pick[2] or None) if pick else None)


def test_attributed_revenue_keeps_unattributed_money(spark):
    rows = [
        ("t1", BASE, 10.0, "referral", "direct", None),
        ("t2", BASE, 5.0, "referral", "referral", "referral"),
        ("t3", BASE, None, None, None, None),
    ]
    attribution = spark.createDataFrame(
        rows,
        "transaction_id string, purchase_ts timestamp, revenue double, first_click_channel string, "
        "last_click_channel string, last_non_direct_channel string",
    )
    daily = attributed_revenue_daily(attribution)
    sums = {r.model: r.s for r in daily.groupBy("model").agg(F.sum("attributed_revenue").alias("s")).collect()}
    assert sums == {m: 15.0 for m in MODELS}
    one = {r.channel: r.attributed_revenue for r in attributed_revenue_for(attribution, "last_non_direct").collect()}
    assert one == {None: 10.0, "referral": 5.0}
