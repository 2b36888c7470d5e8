import hashlib
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from clicktide.operators.purchases import extract_purchases
from clicktide.operators.sessions import build_sessions, build_touchpoints, sessionize
from clicktide.operators.shaping import canonical_identity, ensure_columns, prepare_events
from clicktide.settings import LandingRules

BASE = datetime(2025, 1, 1, tzinfo=timezone.utc)


def at(**delta):
    return (BASE + timedelta(**delta)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def sessions_of(events):
    return build_sessions(prepare_events(events)).orderBy("session_key", "session_num").collect()


def test_inactivity_splits_sessions(make_events):
    rows = [{"client_id": "u1", "timestamp": at(minutes=m)} for m in (0, 10, 41)]
    got = sessions_of(make_events(rows))
    assert [(s.session_num, s.event_count) for s in got] == [(1, 2), (2, 1)]
    assert got[0].session_id == "u1:1:20250101T000000"
    assert got[0].session_duration_seconds == 600.0


def test_gap_of_exactly_the_limit_stays_in_the_session(make_events):
    exact = [{"client_id": "a", "timestamp": at(seconds=s)} for s in (5, 1805)]
    over = [{"client_id": "b", "timestamp": at(seconds=s)} for s in (5, 1805.000001)]
    got = sessions_of(make_events(exact + over))
    assert [(s.session_key, s.session_num) for s in got] == [("a", 1), ("b", 1), ("b", 2)]


def test_long_session_crosses_many_slots(make_events):
    rows = [{"client_id": "u", "timestamp": at(minutes=29 * i)} for i in range(20)]
    got = sessions_of(make_events(rows))
    assert len(got) == 1 and got[0].event_count == 20


def test_anonymous_events_share_a_browser_key(make_events):
    rows = [
        {"timestamp": at(minutes=0), "user_agent": "B"},
        {"timestamp": at(minutes=5), "user_agent": "B"},
        {"timestamp": at(minutes=5), "user_agent": None},
    ]
    got = {s.session_key: s.event_count for s in sessions_of(make_events(rows))}

    def key(agent):
        return "anon:" + hashlib.md5(agent.encode()).hexdigest()[:12]

    assert got == {key("B"): 2, key("nan"): 1}


def test_unparsable_times_are_left_out(make_events):
    rows = [{"client_id": "u", "timestamp": at()}, {"client_id": "u", "timestamp": "x"}]
    assert [s.event_count for s in sessions_of(make_events(rows))] == [1]


def test_landing_takes_first_known_value_per_column_but_touchpoint_the_first_row(make_events):
    rows = [
        {"client_id": "u", "timestamp": at(minutes=0), "page_url": None, "referrer": None},
        {
            "client_id": "u",
            "timestamp": at(minutes=1),
            "page_url": "https://shop.example.com/?utm_source=s",
            "referrer": "https://www.google.com/",
        },
    ]
    events = prepare_events(make_events(rows))
    s = build_sessions(events).first()
    assert s.landing_page_url == "https://shop.example.com/?utm_source=s"
    assert (s.referrer, s.utm_source) == ("https://www.google.com/", "s")
    assert s.landing_channel == "direct"
    t = build_touchpoints(events).first()
    assert (t.page_url, t.referrer, t.channel) == (None, None, "direct")
    assert (t.is_direct, t.is_paid) == (True, False)


def test_equal_times_are_ordered_by_event_id(make_events):
    rows = [
        {"client_id": "u", "timestamp": at(), "page_url": "https://s/second", "event_id": 2},
        {"client_id": "u", "timestamp": at(), "page_url": "https://s/first", "event_id": 1},
    ]
    assert sessions_of(make_events(rows))[0].landing_page_url == "https://s/first"


def test_landing_rules_fall_back_per_session(make_events):
    store, checkout = "https://shop.example.com/p", "https://checkout.shop.example.com/c"
    rows = [
        {"client_id": "a", "timestamp": at(), "page_url": checkout, "referrer": "https://r/"},
        {"client_id": "a", "timestamp": at(minutes=1), "page_url": store},
        {"client_id": "b", "timestamp": at(), "page_url": checkout, "referrer": "https://r/"},
    ]
    got = build_sessions(
        prepare_events(make_events(rows)), landing=LandingRules(event="page_viewed")
    ).orderBy("session_key")
    a, b = got.collect()
    # The candidate has no referrer, so the session has none, whatever its other events say.
    assert (a.landing_page_url, a.referrer, a.landing_channel) == (store, None, "direct")
    assert (b.landing_page_url, b.referrer, b.landing_channel) == (checkout, "https://r/", "referral")


def test_sessions_match_a_plain_loop(make_events):
    rng = random.Random(7)
    rows = [
        {
            "client_id": rng.choice(["u1", "u2", "u3", None]),
            "user_agent": rng.choice(["A", "B"]),
            "timestamp": at(seconds=rng.uniform(-86400, 3 * 86400)),
        }
        for _ in range(600)
    ]
    events = canonical_identity(make_events(rows))
    got = {
        r.event_id: (r.session_key, r.session_num)
        for r in sessionize(events).collect()
    }
    by_key = {}
    for i, row in enumerate(rows):
        anonymous = "anon:" + hashlib.md5(row["user_agent"].encode()).hexdigest()[:12]
        by_key.setdefault(row["client_id"] or anonymous, []).append((row["timestamp"], i))
    for key, entries in by_key.items():
        previous, number = None, 0
        for text, i in sorted(entries):
            now = datetime.strptime(text, "%Y-%m-%dT%H:%M:%S.%fZ")
            if previous is None or now - previous > timedelta(minutes=30):
                number += 1
            previous = now
            assert got[i] == (key, number)
    assert len(got) == len(rows)


def test_no_window_runs_over_events(make_events):
    """The window's input is the slot aggregate; the event side only meets a join."""
    rows = [{"client_id": "u", "timestamp": at(minutes=m)} for m in range(3)]
    plan = sessionize(canonical_identity(make_events(rows)))._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    for i, line in enumerate(text.splitlines()):
        if "Window [" in line:
            below = "\n".join(text.splitlines()[i + 1 :])
            assert "Aggregate [session_key" in below


def test_purchases_tolerate_malformed_payloads(make_events):
    rows = [
        {
            "client_id": "u",
            "timestamp": at(),
            "event_name": "checkout_completed",
            "event_data": '{"transaction_id":"t","revenue":"7.5","items":[{"b":1,"a":2}],"user_email":"e"}',
        },
        {"client_id": "u", "timestamp": at(), "event_name": "checkout_completed", "event_data": "{x"},
        {"client_id": "u", "timestamp": at()},
    ]
    got = extract_purchases(sessionize(canonical_identity(make_events(rows)))).collect()
    by_tx = {p.transaction_id: p for p in got}
    assert set(by_tx) == {"t", None}
    assert (by_tx["t"].revenue, by_tx["t"].user_email) == (7.5, "e")
    assert by_tx["t"].items_json == '[{"a":2,"b":1}]'
    assert by_tx[None].items_json == "null"


def test_shaping_keeps_what_exists(spark):
    df = spark.createDataFrame([("x", "mine")], "clientId string, channel string")
    df = ensure_columns(df, ["clientId", "page_url", "referrer", "user_agent", "timestamp"])
    out = canonical_identity(df)
    assert out.first().client_id_canonical == "x"
    assert canonical_identity(out.withColumn("client_id_canonical", F.lit("k"))).first()[
        "client_id_canonical"
    ] == "k"
    kept = prepare_events(df.withColumns({"channel_detail": F.lit("d"), "device_type": F.lit("tv")}))
    row = kept.first()
    assert (row.channel, row.channel_detail, row.device_type) == ("mine", "d", "tv")


@pytest.mark.parametrize("gap", [5, 30, 60.5])
def test_every_event_has_one_session(make_events, gap):
    rng = random.Random(gap)
    rows = [
        {"client_id": f"u{rng.randrange(3)}", "timestamp": at(seconds=rng.randrange(40000))}
        for _ in range(200)
    ]
    events = prepare_events(make_events(rows))
    assert sessionize(events, gap).count() == 200
    total = build_sessions(events, gap).agg(F.sum("event_count")).first()[0]
    assert total == 200
