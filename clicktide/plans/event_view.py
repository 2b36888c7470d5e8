"""The given `events` table in the shape of raw daily web events.

The given table is clean, so the view derives from each event id the defects that the operators
look for: renamed and missing identities, unparsable times and payloads, text behind a payload, numbers as text, late partitions,
repeated purchases (the copy with other key order and spacing) and colliding ones, blank click ids. All expressions are plain SQL that Spark and DuckDB read
alike, so the checking queries use the very same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DAY = "CAST(CAST(ts AS DATE) AS STRING)"
IS_PURCHASE = "event_type = 'purchase'"

# Two copies of some purchases: the same payload again, one second later or at the same time.
COPIED = f"{IS_PURCHASE} AND event_id % 97 < 2"
SPARK_COPY = f"explode(CASE WHEN {COPIED} THEN array(0, 1) ELSE array(0) END)"
DUCKDB_COPY = f"unnest(CASE WHEN {COPIED} THEN [0, 1] ELSE [0] END)"

HAS_IDENTITY = (
    "NOT (event_id % 23 = 0 OR (event_id % 7 = 0 AND "
    f"{DAY} IN ('2024-01-20', '2024-01-21')))"
)
# Four given users share one client, so that sessions hold several events.
CLIENT = "'u' || CAST(user_id - user_id % 4 AS STRING)"

TRANSACTION = f"""CASE WHEN event_id % 101 = 3 THEN 'null'
  WHEN event_id % 109 = 6 THEN '""'
  WHEN event_id % 13 = 0 THEN '"ORD-' || {DAY} || '-' || CAST(event_id % 7 AS STRING) || '"'
  ELSE '"ORD-' || CAST(event_id AS STRING) || '"' END"""
REVENUE = """CASE WHEN event_id % 29 = 0 THEN '0'
  WHEN event_id % 59 = 4 THEN '"abc"'
  WHEN event_id % 53 = 1 THEN '"12.5"'
  WHEN event_id % 61 = 2 THEN '"NaN"'
  WHEN event_id % 67 = 3 THEN '"12.5d"'
  WHEN event_id % 73 = 4 THEN '" 7.5 "'
  WHEN event_id % 79 = 5 THEN 'true'
  ELSE CAST(value AS STRING) END"""
ITEMS = """CASE WHEN event_id % 103 = 5 THEN '[]'
  WHEN event_id % 107 = 2 THEN '{"a":1}'
  WHEN event_id % 113 = 7 THEN 'null'
  ELSE '[{"item_id":"i' || CAST(event_id % 50 AS STRING) || '","quantity":1}]' END"""

COLUMNS = {
    "event_id": "event_id + copy * 1000000000000",
    "partition_date": (
        "replace(CAST(CAST(ts + CASE WHEN event_id % 23 = 7 THEN INTERVAL '1' DAY "
        "ELSE INTERVAL '0' DAY END AS DATE) AS STRING), '-', '')"
    ),
    "client_id": f"CASE WHEN {HAS_IDENTITY} AND {DAY} < '2024-01-15' THEN {CLIENT} END",
    "clientId": f"CASE WHEN {HAS_IDENTITY} AND {DAY} >= '2024-01-15' THEN {CLIENT} END",
    "page_url": """CASE WHEN event_id % 41 = 0 THEN NULL ELSE
  CASE WHEN event_id % 11 = 0 THEN 'https://checkout.shop.example.com/c/'
       ELSE 'https://shop.example.com/p/' END || CAST(event_id % 50 AS STRING) ||
  CASE event_id % 12 WHEN 0 THEN '?gclid=g1' WHEN 1 THEN '?page=2&fbclid=f1#top'
    WHEN 2 THEN '?utm_source=a%20b&utm_campaign=c1' WHEN 3 THEN '?gclid=&page=2'
    WHEN 4 THEN '?utm_source=&utm_source=x+y&utm_source=z' WHEN 5 THEN '#a?utm_source=no'
    WHEN 6 THEN '?utm_medium=m%26n&utm_term=t%3D1&utm_content=v=w' ELSE '' END END""",
    "referrer": f"""CASE WHEN {DAY} >= '2024-01-25' THEN NULL ELSE
  CASE event_id % 13 WHEN 0 THEN 'https://www.google.com/search?q=x'
    WHEN 1 THEN ' HTTPS://L.Facebook.com/ ' WHEN 2 THEN 'https://partner.example.org:8080/x'
    WHEN 3 THEN 'https://source-7.com/r' WHEN 4 THEN 'https://shop.example.com/p/1'
    WHEN 5 THEN 'https://www.netflix.com' WHEN 6 THEN 'partner.example.org/no-scheme'
    WHEN 7 THEN '//user@cdn.example.net/a' WHEN 8 THEN '' END END""",
    "timestamp": """CASE WHEN event_id % 307 = 0 THEN 'not-a-time' ELSE
  replace(CAST(ts + CASE WHEN copy = 1 AND event_id % 97 = 0 THEN INTERVAL '1' SECOND
    ELSE INTERVAL '0' SECOND END AS STRING), ' ', 'T') || 'Z' END""",
    "event_name": """CASE event_type WHEN 'view' THEN 'page_viewed'
    WHEN 'signup' THEN 'email_filled_on_popup' WHEN 'purchase' THEN 'checkout_completed'
    WHEN 'click' THEN CASE WHEN event_id % 3 = 0 THEN 'checkout_started'
                           ELSE 'product_added_to_cart' END
    ELSE event_type END""",
    "event_data": f"""CASE WHEN event_id % 71 = 0 THEN '{{bad' WHEN event_id % 83 = 0 THEN NULL
  WHEN event_id % 89 = 3 THEN '{{"transaction_id":"T","revenue":1,"items":[{{}}]}} and more'
  WHEN {IS_PURCHASE} AND copy = 1 THEN '{{ "items": ' || {ITEMS} ||
    CASE WHEN event_id % 2 = 0 THEN ', "user_email": "h' || CAST(user_id AS STRING) || '"' ELSE '' END
    || ', "revenue": ' || {REVENUE} || ', "transaction_id": ' || {TRANSACTION} || ' }}'
  WHEN {IS_PURCHASE} THEN '{{"transaction_id":' || {TRANSACTION} || ',"revenue":' || {REVENUE} ||
    ',"items":' || {ITEMS} ||
    CASE WHEN event_id % 2 = 0 THEN ',"user_email":"h' || CAST(user_id AS STRING) || '"' ELSE '' END
    || '}}'
  WHEN event_type = 'signup' AND event_id % 10 <> 0
    THEN '{{"email":"h' || CAST(user_id AS STRING) || '"}}'
  ELSE props END""",
    "user_agent": """CASE event_id % 5 WHEN 0 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 18_3)'
    WHEN 1 THEN 'Mozilla/5.0 (iPad)' WHEN 2 THEN 'Mozilla/5.0 (Macintosh)'
    WHEN 3 THEN 'Mozilla/5.0 (Linux; ANDROID 14)' END""",
}


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web events over the whole `events` table."""
    given = spark.read.parquet(f"{sf_dir}/events.parquet")
    copied = given.selectExpr("*", f"{SPARK_COPY} AS copy")
    return copied.selectExpr(*[f"{sql} AS {name}" for name, sql in COLUMNS.items()])


def duckdb_raw_events() -> str:
    """The same rows as a DuckDB query."""
    columns = ",\n".join(f"{sql} AS {name}" for name, sql in COLUMNS.items())
    return f"SELECT {columns} FROM (SELECT *, {DUCKDB_COPY} AS copy FROM events)"
