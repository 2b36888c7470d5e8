import hashlib

import pytest
from pyspark.sql import functions as F

from clicktide.functions import payload as P
from clicktide.functions import scoring, timing, web
from clicktide.settings import TrafficRules


def values(spark, rows, column, schema="x string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


def test_payload_hash_ignores_key_order_and_spacing(spark):
    same = ['{"b":1,"a":{"d":2,"c":[1,"x"]}}', '{ "a": {"c": [1, "x"], "d": 2}, "b": 1 }']
    hashes = values(spark, same, P.payload_hash(P.parse_payload(F.col("x"))))
    assert hashes[0] == hashes[1]
    assert hashes[0] == hashlib.sha256(b'{"a":{"c":[1,"x"],"d":2},"b":1}').hexdigest()


def test_payload_hash_of_missing_payload_is_that_of_empty_text(spark):
    empty = hashlib.sha256(b"").hexdigest()
    hashes = values(spark, ["{bad", "null", None], P.payload_hash(P.parse_payload(F.col("x"))))
    assert hashes == [empty] * 3


def test_parse_failures_count_bad_and_null_json_but_not_missing_text(spark):
    texts = ["{bad", "null", "", None, "{}", '{"a":1} trailing', '{"a":1}}', '{"a":1},"b":2', '[1] 2', ' {"a":1}\n']
    got = values(spark, texts, P.parse_failed(F.col("x"), P.parse_payload(F.col("x"))))
    assert got == [True, True, False, False, False, True, True, True, True, False]


def test_duplicate_keys_and_nan_literals_do_not_parse(spark):
    got = values(spark, ['{"a":1,"a":2}', '{"a":NaN}', '{"a":{"b":1,"b":1}}'], P.parse_payload(F.col("x")).isNull())
    assert got == [True, True, True]


@pytest.mark.parametrize(
    "value,want",
    [
        ("5", 5.0), ("1e3", 1000.0), ("true", 1.0), ("false", 0.0), ("null", None), ("[1]", None), ('{"a":1}', None),
        ("1e400", float("inf")), ('"12.5"', 12.5), ('" 12.5 "', 12.5), ('"\\t7\\n"', 7.0), ('"+5"', 5.0), ('".5"', 0.5),
        ('"5."', 5.0), ('"NaN"', None), ('" nan "', None), ('"12.5d"', None), ('"12.5f"', None), ('"0x10"', None),
        ('"1_0"', None), ('"true"', None), ('""', None), ('"1e400"', None), ('"Infinity"', float("inf")),
        ('"-inf"', float("-inf")), ('"1e"', None), ('"12,5"', None),
    ],
)
def test_numbers_of_a_payload(spark, value, want):
    payload = P.parse_payload(F.col("x"))
    assert values(spark, [f'{{"revenue":{value}}}'], P.number(payload, "revenue")) == [want]


@pytest.mark.parametrize(
    "text,check,clean",
    [
        ('{"transaction_id":"t","revenue":5,"items":[{}]}', False, False),
        ('{"transaction_id":"t","revenue":"5.5","items":[{}]}', False, False),
        ('{"transaction_id":null,"revenue":5,"items":[{}]}', True, True),
        ('{"transaction_id":"","revenue":5,"items":[{}]}', False, True),
        ('{"transaction_id":"t","revenue":0,"items":[{}]}', True, True),
        ('{"transaction_id":"t","revenue":"abc","items":[{}]}', True, True),
        ('{"transaction_id":"t","items":[{}]}', True, True),
        ('{"transaction_id":"t","revenue":5,"items":[]}', True, True),
        ('{"transaction_id":"t","revenue":5,"items":null}', True, True),
        ('{"transaction_id":"t","revenue":5,"items":{"a":1}}', False, True),
        ("{bad", True, True),
    ],
)
def test_purchase_defects(spark, text, check, clean):
    p = P.purchase_columns(P.parse_payload(F.col("x")))
    row = spark.createDataFrame([(text,)], "x string").select(
        P.invalid_purchase_check(
            p["transaction_id"], p["revenue"], p["has_items"], p["item_count"]
        ).alias("check"),
        P.invalid_purchase_clean(p["transaction_id"], p["revenue"], p["item_count"]).alias("clean"),
    )
    got = row.first()
    assert (got.check, got.clean) == (check, clean)


@pytest.mark.parametrize(
    "url,source",
    [
        ("https://a.b/?utm_source=a%20b", "a b"),
        ("https://a.b/?utm_source=a+b", "a b"),
        ("https://a.b/?utm_source=&utm_source=z", "z"),
        ("https://a.b/?utm_source=x&utm_source=y", "x"),
        ("https://a.b/?x_utm_source=no", None),
        ("https://a.b/?utm%5Fsource=enc", "enc"),
        ("https://a.b/?utm_source=%zz%41", "%zzA"),
        ("https://a.b/?utm_source=m%26n%3Do", "m&n=o"),
        ("https://a.b/?utm_source=v=w", "v=w"),
        ("https://a.b/#f?utm_source=no", None),
        ("https://a.b/?utm_source=yes#f", "yes"),
        ("https://a.b/", None),
        (None, None),
    ],
)
def test_utm_value(spark, url, source):
    df = web.with_query(spark.createDataFrame([(url,)], "x string"), "x", "q")
    assert web.with_query_values(df, "q", {"v": "utm_source"}).first().v == source


@pytest.mark.parametrize(
    "url,host",
    [
        ("https://www.Google.com/x", "www.google.com"),
        ("  HTTP://A.b:80?x ", "a.b:80"),
        ("//user:pw@c.d/e", "user:pw@c.d"),
        ("a.b/c", ""),
        ("https://h|x.com/y", "h|x.com"),
        ("", ""),
        (None, ""),
    ],
)
def test_network_host(spark, url, host):
    assert values(spark, [url], web.network_host(F.col("x"))) == [host]


@pytest.mark.parametrize(
    "url,referrer,expected",
    [
        ("https://s/?gclid=1", "https://www.google.com", ("paid_search", "click_id")),
        ("https://s/?msclkid=1&fbclid=2", None, ("paid_search", "click_id")),
        ("https://s/?gclid=", None, ("direct", "no_referrer")),
        ("https://s/?igshid=2", None, ("paid_social", "click_id")),
        ("https://s/", "https://www.bing.com/s", ("organic_search", "www.bing.com")),
        ("https://s/?utm_source=a", "https://t.co/x.com", ("referral", "t.co")),
        ("https://s/", "https://netflix.com", ("organic_social", "netflix.com")),
        ("https://s/", "https://source-12.com/a", ("unknown_paid", "redirect_domain")),
        ("https://s/", "https://blog.example.org/", ("referral", "blog.example.org")),
        ("https://s/", "https://www.shop.example.com/", ("direct", "no_referrer")),
        ("https://s/?utm_x=1", "https://shop.example.com/", ("unknown_paid", "utm_present")),
        (None, None, ("direct", "no_referrer")),
    ],
)
def test_channel_rules(spark, url, referrer, expected):
    df = spark.createDataFrame([(url, referrer)], "u string, r string")
    df = web.with_query(df, "u", "q")
    outcome = web.classify_channel(F.col("q"), web.network_host(F.col("r")))
    assert tuple(df.select(outcome.alias("c")).select("c.*").first()) == expected


def test_own_domain_is_a_parameter(spark):
    df = spark.createDataFrame([("https://my.store/",)], "r string")
    rules = TrafficRules(own_domain="my.store")
    outcome = web.classify_channel(F.lit(""), web.network_host(F.col("r")), rules)
    assert df.select(outcome.alias("c")).first().c.channel == "direct"


def test_device_type(spark):
    agents = ["X iPhone", "ANDROID", "Mobile Safari", "iPad", "Macintosh", "", None]
    got = values(spark, agents, web.device_type(F.col("x")))
    assert got == ["mobile"] * 4 + ["desktop"] * 3


def test_parse_ts_is_tolerant(spark):
    texts = ["2025-01-01T00:00:58.313Z", "2025-01-01T00:00:58Z", "2025-01-01T01:00:58+01:00", "x", None]
    got = values(spark, texts, F.unix_seconds(timing.parse_ts(F.col("x"))))
    assert got == [1735689658, 1735689658, 1735689658, None, None]


def test_floor_micros_before_1970(spark):
    got = values(spark, [-1, 0, 9, 10], timing.floor_micros(F.col("x"), 10), "x long")
    assert got == [-10, 0, 0, 10]


def test_robust_z_without_spread_is_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0, 2.0), (5.0, 1.0, 0.0), (5.0, 1.0, None)], "x double, m double, d double")
    z = scoring.robust_z(F.col("x"), F.col("m"), F.col("d"))
    assert [r[0] for r in df.select(z).collect()] == [pytest.approx(0.6745 * 2), 0.0, 0.0]


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(scoring.ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.5]
