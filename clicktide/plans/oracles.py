"""Checking SQL for DuckDB, one text per registered query.

The texts follow the plain definitions (row windows over events, range joins, row numbers), not the
plans of the operators, so that agreement means something. `_STEPS` are shared named subqueries.
"""

from __future__ import annotations

from clicktide.plans.event_view import duckdb_raw_events

_UTM = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content")


def _parameter(name: str, query: str = "q") -> str:
    return (
        f"nullif(url_decode(replace(regexp_extract({query}, '(?:^|&){name}=([^&]+)', 1), "
        "'+', ' ')), '')"
    )


def _host(url: str) -> str:
    return (
        f"coalesce(regexp_extract(lower(trim({url})), "
        "'^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1), '')"
    )


_QUERY = "coalesce(regexp_extract({0}, '^[^?#]*\\?([^#]*)', 1), '')"


def _channel(
    paid: str, social: str, search: str, network: str, other: str, redirect: str, tagged: str, none: str
) -> str:
    return f"""CASE
    WHEN regexp_matches(q, '(^|&)(gclid|gbraid|wbraid|msclkid)=[^&]') THEN {paid}
    WHEN regexp_matches(q, '(^|&)(fbclid|ttclid|igshid)=[^&]') THEN {social}
    WHEN regexp_matches(host, 'google\\.|bing\\.|yahoo\\.|duckduckgo\\.|baidu\\.|ecosia\\.') THEN {search}
    WHEN regexp_matches(host, 'facebook\\.|instagram\\.|tiktok\\.|pinterest\\.|snapchat\\.|reddit\\.|x\\.com|twitter\\.')
      THEN {network}
    WHEN host LIKE 'source-%.com' THEN {redirect}
    WHEN host <> '' AND NOT contains(host, 'shop.example.com') THEN {other}
    WHEN regexp_matches(q, '(^|&)utm_[^&=]*=[^&]') THEN {tagged}
    ELSE {none} END"""


_CHANNEL = _channel(
    "'paid_search'", "'paid_social'", "'organic_search'", "'organic_social'", "'referral'",
    "'unknown_paid'", "'unknown_paid'", "'direct'",
)
_DETAIL = _channel(
    "'click_id'", "'click_id'", "host", "host", "host",
    "'redirect_domain'", "'utm_present'", "'no_referrer'",
)

_COLUMNS = ("clientId", "client_id", "event_data", "event_name", "page_url", "referrer",
            "timestamp", "user_agent")
_REQUIRED = ("page_url", "timestamp", "event_name", "event_data", "user_agent")
_ALLOWED = ("'page_viewed', 'product_added_to_cart', 'checkout_started', 'checkout_completed', "
            "'email_filled_on_popup'")
_HAS = ", ".join(f'count("{c}") > 0 AS has_{c}' for c in _COLUMNS)
_DAY = "CAST(CAST({0} AS DATE) AS STRING)"
_SECOND = "CAST(date_trunc('second', {0}) AS STRING)"


def _known(c: str, name: str) -> str:
    return f"first({c} ORDER BY ts, event_id) FILTER (WHERE {c} IS NOT NULL) AS {name}"


def _cand(c: str, name: str) -> str:
    """First known value among the candidates, or among all rows when there is none."""
    return (
        f"CASE WHEN bool_or(cand) THEN first({c} ORDER BY ts, event_id) FILTER "
        f"(WHERE cand AND {c} IS NOT NULL) ELSE first({c} ORDER BY ts, event_id) FILTER "
        f"(WHERE {c} IS NOT NULL) END AS {name}"
    )


def _session_select(pick) -> str:
    return f"""SELECT session_key, session_num, any_value(start) AS start, max(ts) AS stop,
    any_value(session_id) AS session_id, {pick('client', 'client_id_canonical')},
    {pick('page_url', 'landing_page_url')}, {pick('referrer', 'referrer')},
    {', '.join(pick(c, c) for c in _UTM)}, {pick('channel', 'landing_channel')},
    {pick('channel_detail', 'landing_channel_detail')}, {pick('device', 'device_type')},
    count(*) AS event_count
  FROM labelled GROUP BY session_key, session_num"""


def _check(check_id: str, severity: str, passed: str, measure: str, where: str = "true") -> str:
    return (
        f"SELECT partition_date, '{check_id}' AS check_id, {severity} AS severity, "
        f"{passed} AS passed, round(CAST({measure} AS DOUBLE), 6) AS measure FROM meas WHERE {where}"
    )


_MISSING = " + ".join(f"CAST(NOT has_{c} AS INT)" for c in _REQUIRED)
_CHECKS = " UNION ALL ".join(
    [
        _check("schema.required_columns_present", "'P0_BLOCKER'", f"({_MISSING}) = 0", f"({_MISSING})"),
        _check("schema.identity_column_present", "'P0_BLOCKER'", "has_client_id OR has_clientId",
               "(CAST(has_client_id AS INT) + CAST(has_clientId AS INT))"),
        _check("schema.unknown_event_names", "'P2_MEDIUM'", "unknown = 0", "unknown"),
        _check("integrity.event_data_json_parse_rate",
               "CASE WHEN NOT has_event_data THEN 'P0_BLOCKER' WHEN json_bad / n > 0.02 THEN 'P1_HIGH' "
               "WHEN json_bad / n > 0.01 THEN 'P2_MEDIUM' ELSE 'P3_INFO' END",
               "has_event_data AND json_bad / n <= 0.01", "json_bad / n"),
        _check("integrity.timestamp_parse_and_partition_alignment",
               "CASE WHEN NOT has_timestamp OR ts_bad / n > 0.01 OR off / n > 0.10 THEN 'P0_BLOCKER' "
               "WHEN off / n > 0.05 THEN 'P1_HIGH' WHEN ts_bad > 0 THEN 'P2_MEDIUM' ELSE 'P3_INFO' END",
               "has_timestamp AND ts_bad / n <= 0.01 AND off / n <= 0.05", "off / n"),
        _check("schema.referrer_column_present", "'P1_HIGH'", "has_referrer", "CAST(has_referrer AS INT)"),
        _check("tracking.identity_null_rate",
               "CASE WHEN anon / n > 0.10 THEN 'P1_HIGH' WHEN anon / n > 0.02 THEN 'P2_MEDIUM' "
               "ELSE 'P3_INFO' END", "anon / n <= 0.10", "anon / n"),
        _check("purchase.integrity.no_purchases", "'P3_INFO'", "true", "0", "bought = 0"),
        _check("purchase.integrity.required_fields_and_positive_revenue",
               "CASE WHEN invalid > 0 THEN 'P1_HIGH' ELSE 'P3_INFO' END", "invalid = 0", "invalid",
               "bought > 0"),
        _check("purchase.transaction_id_collision", "'P0_BLOCKER'", "collided = 0", "collided",
               "bought > 0"),
        _check("purchase.transaction_id_replay_duplicates", "'P1_HIGH'", "replayed = 0", "replayed",
               "bought > 0"),
    ]
)

_LOOKBACK = """sess.client_id_canonical = pur.client_id_canonical
    AND date_trunc('second', sess.start) BETWEEN pur.purchase_ts - INTERVAL '7' DAY AND pur.purchase_ts"""
_OLDEST = "date_trunc('second', start), sess_id"
_NEWEST = "date_trunc('second', start) DESC, sess_id DESC"


def _metric(name: str) -> str:
    return f"SELECT day, '{name}' AS metric, CAST({name} AS DOUBLE) AS value FROM metrics"


def _model_daily(model: str, source: str = "attr") -> str:
    return (
        f"SELECT {_DAY.format('purchase_ts')} AS purchase_day, {model}_channel AS channel, "
        f"round(coalesce(sum(revenue), 0.0), 2) AS attributed_revenue FROM {source} GROUP BY 1, 2"
    )


def _shares(model: str) -> str:
    return (
        f"SELECT '{model}' AS model, coalesce({model}_channel, 'direct') AS channel, "
        "coalesce(sum(revenue), 0.0) / (SELECT sum(revenue) FROM attr) AS share FROM attr GROUP BY 1, 2"
    )


_METRICS = ("sessions", "purchases", "revenue", "purchase_rate", "direct_session_share",
            "direct_revenue_share")
_FRAME = "PARTITION BY metric ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING"

# Revenue as a number: JSON numbers, booleans, and texts of a plain or infinite number.
_REVENUE = r"""CASE json_type(j, '$.revenue') WHEN 'BOOLEAN' THEN CAST(CAST(j->'$.revenue' AS BOOLEAN) AS DOUBLE)
    WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match(trim(j->>'$.revenue'),
        '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i)[+-]?inf(inity)?')
      THEN TRY_CAST(trim(j->>'$.revenue') AS DOUBLE) END
    ELSE TRY_CAST(j->>'$.revenue' AS DOUBLE) END"""
# The payload with its members in a fixed order and no spacing between them.
_CANONICAL = "concat_ws('|', " + ", ".join(
    f"coalesce(CAST(j->'$.{c}' AS STRING), '-')" for c in ("items", "revenue", "transaction_id", "user_email")
) + ")"

_STEPS: dict[str, str] = {
    "raw": duckdb_raw_events(),
    "base": """SELECT *, coalesce(client_id, clientId) AS client, TRY_CAST("timestamp" AS TIMESTAMP) AS ts,
    CASE WHEN json_valid(event_data) THEN CAST(event_data AS JSON) END AS j FROM raw""",
    "paid": f"""SELECT *, j->>'$.transaction_id' AS tx, {_REVENUE} AS rev,
    coalesce(json_type(j, '$.items'), 'NULL') AS items_type,
    CASE WHEN json_type(j, '$.items') = 'ARRAY' THEN json_array_length(j, '$.items') END AS n_items,
    CASE WHEN j IS NULL THEN '' ELSE {_CANONICAL} END AS payload
    FROM base WHERE event_name = 'checkout_completed'""",
    # quality
    "payloads": "SELECT partition_date, tx, payload, count(*) AS copies FROM paid GROUP BY ALL",
    "txs": """SELECT partition_date, tx, count(*) AS payloads, sum(copies) AS purchase_rows,
    sum(CASE WHEN copies > 1 THEN copies ELSE 0 END) AS replay_rows FROM payloads GROUP BY 1, 2""",
    "meas": f"""SELECT a.*, coalesce(b.invalid, 0) AS invalid, coalesce(b.revenue_sum, 0.0) AS revenue_sum,
    coalesce(c.collided, 0) AS collided, coalesce(c.replayed, 0) AS replayed
    FROM (SELECT partition_date, count(*) AS n, {_HAS},
      count(*) FILTER (WHERE length(event_data) > 0 AND j IS NULL) AS json_bad,
      count(*) FILTER (WHERE ts IS NULL) AS ts_bad,
      count(*) FILTER (WHERE strftime(ts, '%Y%m%d') <> partition_date) AS off,
      count(*) FILTER (WHERE client IS NULL) AS anon,
      count(*) FILTER (WHERE event_name NOT IN ({_ALLOWED})) AS unknown,
      count(*) FILTER (WHERE event_name = 'checkout_completed') AS bought
      FROM base GROUP BY 1) a
    LEFT JOIN (SELECT partition_date, count(*) FILTER (WHERE tx IS NULL OR coalesce(rev, -1) <= 0
        OR items_type = 'NULL' OR n_items = 0) AS invalid, sum(coalesce(rev, 0)) AS revenue_sum
      FROM paid GROUP BY 1) b USING (partition_date)
    LEFT JOIN (SELECT partition_date, count(*) FILTER (WHERE tx IS NOT NULL AND payloads > 1) AS collided,
        sum(replay_rows) AS replayed FROM txs GROUP BY 1) c USING (partition_date)""",
    "results": _CHECKS,
    "scores": """SELECT partition_date,
    CAST(greatest(0, 100 - sum(CASE WHEN passed THEN 0 WHEN severity = 'P0_BLOCKER' THEN 30
      WHEN severity = 'P1_HIGH' THEN 15 WHEN severity = 'P2_MEDIUM' THEN 5 ELSE 0 END)) AS BIGINT) AS dq_score,
    CASE WHEN bool_or(NOT passed AND severity = 'P0_BLOCKER') THEN 'QUARANTINE'
      WHEN bool_or(NOT passed) THEN 'WARN' ELSE 'PASS' END AS decision,
    count(*) FILTER (WHERE NOT passed) AS failed,
    count(*) FILTER (WHERE NOT passed AND severity = 'P0_BLOCKER') AS p0_failed,
    count(*) FILTER (WHERE NOT passed AND severity = 'P1_HIGH') AS p1_failed,
    count(*) FILTER (WHERE NOT passed AND severity = 'P2_MEDIUM') AS p2_failed
    FROM results GROUP BY 1""",
    # cleaning
    "q1": """SELECT *, coalesce(tx, '') = '' OR coalesce(rev, 0) <= 0 OR coalesce(n_items, 0) = 0 AS bad
    FROM paid""",
    "q2": """SELECT *, NOT bad AND count(DISTINCT payload) FILTER (WHERE NOT bad)
      OVER (PARTITION BY partition_date, tx) > 1 AS coll FROM q1""",
    "q3": """SELECT event_id, CASE WHEN bad THEN 'invalid_purchase_fields_or_revenue'
      WHEN coll THEN 'transaction_id_collision'
      WHEN row_number() OVER (PARTITION BY partition_date, tx, payload, bad
        ORDER BY ts NULLS LAST, event_id) > 1 THEN 'duplicate_purchase_replay' END AS quarantine_reason
    FROM q2""",
    "ann": "SELECT base.*, q3.quarantine_reason FROM base LEFT JOIN q3 USING (event_id)",
    # enrichment; `seen` is replaced for the cleaned chain
    "seen": "SELECT * FROM base",
    "split": f"""SELECT *, {_QUERY.format('page_url')} AS q, {_host('referrer')} AS host FROM seen""",
    "enr": f"""SELECT *, {', '.join(f'{_parameter(c)} AS {c}' for c in _UTM)},
    CASE WHEN regexp_matches(lower(user_agent), 'iphone|android|mobile|ipad') THEN 'mobile'
      ELSE 'desktop' END AS device, {_CHANNEL} AS channel, {_DETAIL} AS channel_detail FROM split""",
    # sessions by row windows
    "keyed": """SELECT *, coalesce(client, 'anon:' || substr(md5(coalesce(user_agent, 'nan')), 1, 12))
      AS session_key FROM enr WHERE ts IS NOT NULL""",
    "flagged": """SELECT *, lag(ts) OVER (PARTITION BY session_key ORDER BY ts, event_id) AS prev FROM keyed""",
    "counted": """SELECT *, CAST(sum(CASE WHEN prev IS NULL OR ts - prev > INTERVAL '30' MINUTE THEN 1 ELSE 0 END)
      OVER (PARTITION BY session_key ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_num
    FROM flagged""",
    "started": """SELECT *, min(ts) OVER (PARTITION BY session_key, session_num) AS start FROM counted""",
    "labelled": """SELECT *, session_key || ':' || CAST(session_num AS STRING) || ':' ||
      strftime(start, '%Y%m%dT%H%M%S') AS session_id, event_name = 'page_viewed'
      AND contains(coalesce(page_url, ''), 'shop.example.com')
      AND NOT contains(coalesce(page_url, ''), 'checkout.shop.example.com') AS cand FROM started""",
    "sess": _session_select(_known),
    "sess_page": _session_select(_cand),
    "pur": f"""SELECT event_id AS pid, j->>'$.transaction_id' AS transaction_id, ts AS purchase_ts,
    client AS client_id_canonical, session_id, {_REVENUE} AS revenue,
    j->>'$.user_email' AS user_email, coalesce(CAST(j->'$.items' AS STRING), 'null') AS items_json
    FROM labelled WHERE event_name = 'checkout_completed'""",
    # attribution by range join
    "cand": f"""SELECT pur.pid, sess.session_id AS sess_id, sess.landing_channel AS ch, sess.start
    FROM pur JOIN sess ON {_LOOKBACK}""",
    "picked": f"""SELECT pid, first(sess_id ORDER BY {_OLDEST}) AS first_click_session_id,
    first(ch ORDER BY {_OLDEST}) AS first_click_channel,
    first(sess_id ORDER BY {_NEWEST}) AS last_click_session_id,
    first(ch ORDER BY {_NEWEST}) AS last_click_channel,
    first(sess_id ORDER BY {_NEWEST}) FILTER (WHERE ch IS DISTINCT FROM 'direct') AS last_non_direct_session_id,
    first(ch ORDER BY {_NEWEST}) FILTER (WHERE ch IS DISTINCT FROM 'direct') AS last_non_direct_channel
    FROM cand GROUP BY pid""",
    "attr": "SELECT pur.*, picked.* EXCLUDE (pid) FROM pur LEFT JOIN picked USING (pid)",
    # facts
    "pseg": f"""SELECT {_DAY.format('purchase_ts')} AS day, landing_channel, device_type,
    count(DISTINCT transaction_id) AS purchases, coalesce(sum(revenue), 0.0) AS revenue
    FROM pur LEFT JOIN sess USING (session_id) GROUP BY 1, 2, 3""",
    "fact": f"""SELECT s.day, s.landing_channel, s.device_type, s.sessions, coalesce(p.purchases, 0) AS purchases,
    coalesce(p.revenue, 0.0) AS revenue, coalesce(p.purchases, 0) / s.sessions AS conversion_rate,
    coalesce(f.r, 0.0) AS attributed_revenue_first_click, coalesce(l.r, 0.0) AS attributed_revenue_last_click,
    coalesce(d.r, 0.0) AS attributed_revenue_last_non_direct
    FROM (SELECT {_DAY.format('start')} AS day, landing_channel, device_type, count(*) AS sessions
      FROM sess GROUP BY 1, 2, 3) s
    LEFT JOIN pseg p ON s.day = p.day AND s.landing_channel IS NOT DISTINCT FROM p.landing_channel
      AND s.device_type IS NOT DISTINCT FROM p.device_type
    LEFT JOIN (SELECT {_DAY.format('purchase_ts')} AS day, first_click_channel AS c, sum(revenue) AS r FROM attr
      GROUP BY 1, 2) f ON s.day = f.day AND s.landing_channel IS NOT DISTINCT FROM f.c
    LEFT JOIN (SELECT {_DAY.format('purchase_ts')} AS day, last_click_channel AS c, sum(revenue) AS r FROM attr
      GROUP BY 1, 2) l ON s.day = l.day AND s.landing_channel IS NOT DISTINCT FROM l.c
    LEFT JOIN (SELECT {_DAY.format('purchase_ts')} AS day, last_non_direct_channel AS c, sum(revenue) AS r
      FROM attr GROUP BY 1, 2) d ON s.day = d.day AND s.landing_channel IS NOT DISTINCT FROM d.c""",
    "funnel": f"""SELECT e.*, s.sessions, e.checkout_completed / s.sessions AS purchase_rate_per_session
    FROM (SELECT {_DAY.format('ts')} AS event_day, sess.landing_channel,
      count(*) FILTER (WHERE event_name = 'page_viewed') AS page_viewed,
      count(*) FILTER (WHERE event_name = 'product_added_to_cart') AS product_added_to_cart,
      count(*) FILTER (WHERE event_name = 'checkout_started') AS checkout_started,
      count(*) FILTER (WHERE event_name = 'checkout_completed') AS checkout_completed,
      count(*) FILTER (WHERE event_name = 'email_filled_on_popup') AS email_filled_on_popup,
      count(*) FILTER (WHERE event_name NOT IN ({_ALLOWED})) AS other_events
      FROM labelled JOIN sess USING (session_id) GROUP BY 1, 2) e
    LEFT JOIN (SELECT {_DAY.format('start')} AS event_day, landing_channel, count(*) AS sessions
      FROM sess GROUP BY 1, 2) s
    ON e.event_day = s.event_day AND e.landing_channel = s.landing_channel""",
    # metrics
    "daily": f"""SELECT s.day, s.sessions, coalesce(p.purchases, 0) AS purchases,
    coalesce(p.revenue, 0.0) AS revenue, coalesce(p.purchases, 0) / s.sessions AS purchase_rate
    FROM (SELECT {_DAY.format('start')} AS day, count(DISTINCT session_id) AS sessions FROM sess GROUP BY 1) s
    LEFT JOIN (SELECT {_DAY.format('purchase_ts')} AS day, count(DISTINCT transaction_id) AS purchases,
      coalesce(sum(revenue), 0.0) AS revenue FROM pur GROUP BY 1) p USING (day)""",
    "shares": " UNION ALL ".join(_shares(m) for m in ("first_click", "last_click", "last_non_direct")),
    "visited": """SELECT sess.*, session_id IN (SELECT session_id FROM pur) AS bought,
    CASE WHEN client_id_canonical IS NULL THEN 'returning' WHEN row_number() OVER
      (PARTITION BY client_id_canonical ORDER BY date_trunc('second', start), session_id) = 1
      THEN 'new' ELSE 'returning' END AS user_type FROM sess""",
    "timed": """SELECT (epoch_us(purchase_ts) - epoch_us(date_trunc('second', start))) / 60000000.0 AS minutes
    FROM pur JOIN sess USING (session_id)""",
    "direct": """SELECT day, sum(CASE WHEN landing_channel LIKE '%direct%' THEN sessions ELSE 0 END)
      / greatest(sum(sessions), 1) AS direct_session_share,
    sum(CASE WHEN landing_channel LIKE '%direct%' THEN revenue ELSE 0 END)
      / greatest(sum(revenue), 1) AS direct_revenue_share FROM fact GROUP BY 1""",
    "metrics": "SELECT * FROM daily LEFT JOIN direct USING (day)",
    "series": " UNION ALL ".join(_metric(m) for m in _METRICS),
    "framed": f"""SELECT *, median(value) OVER ({_FRAME}) AS baseline_median, mad(value) OVER ({_FRAME}) AS mad,
    count(value) OVER ({_FRAME}) AS known FROM series""",
    "baselines": """SELECT day, metric, value, baseline_median, mad,
    CASE WHEN mad = 0 THEN 0.0 ELSE 0.6745 * (value - baseline_median) / mad END AS robust_z
    FROM framed WHERE known >= 3 AND value IS NOT NULL""",
    "judged": """SELECT *, value - baseline_median AS delta, CASE WHEN baseline_median = 0
      THEN CAST('inf' AS DOUBLE) ELSE (value - baseline_median) / baseline_median END AS rel,
    metric IN ('sessions', 'purchases', 'revenue') AS volume FROM baselines""",
    "alerted": """SELECT day, metric, value, baseline_median, mad, robust_z,
    CASE WHEN volume THEN rel END AS relative_change,
    CASE WHEN volume AND abs(rel) >= 0.75 THEN 'P0_BLOCKER' ELSE 'P1_HIGH' END AS severity,
    CASE WHEN volume THEN printf('%s deviated materially vs prior 7 days (median=%.2f).', metric, baseline_median)
      WHEN metric = 'purchase_rate' THEN 'Conversion rate shifted vs baseline; investigate tracking or UX changes.'
      ELSE 'Direct traffic share shifted materially; could indicate attribution signal loss (e.g., missing referrer/UTMs).'
      END AS message
    FROM judged WHERE (volume AND ((abs(rel) >= 0.35 AND delta >= CASE WHEN metric = 'revenue' THEN 5000 ELSE 50 END)
        OR abs(robust_z) >= 4))
      OR (metric = 'purchase_rate' AND delta >= 0.01 AND abs(robust_z) >= 3)
      OR (metric = 'direct_session_share' AND delta >= 0.15 AND abs(robust_z) >= 3)""",
}


def _sql(select: str, **replaced: str) -> str:
    steps = {**_STEPS, **replaced}
    named = ",\n".join(f"{name} AS ({text})" for name, text in steps.items())
    return f"WITH {named}\n{select}"


def _results_of(*check_ids: str) -> str:
    ids = ", ".join(f"'{c}'" for c in check_ids)
    return _sql(f"SELECT * FROM results WHERE check_id IN ({ids})")


def _sessions_output(source: str) -> str:
    return f"""SELECT session_key, session_num, {_SECOND.format('start')} AS session_start_ts, session_id,
    {_SECOND.format('stop')} AS session_end_ts,
    round((epoch_us(stop) - epoch_us(start)) / 1000000.0, 3) AS session_duration_seconds,
    client_id_canonical, landing_page_url, referrer, {', '.join(_UTM)}, landing_channel,
    landing_channel_detail, device_type, event_count FROM {source}"""


def _conversion(label: str) -> str:
    return f"""SELECT {label}, count(*) AS sessions, count(*) FILTER (WHERE bought) AS purchases,
    round(count(*) FILTER (WHERE bought) / count(*), 6) AS purchase_rate FROM visited GROUP BY 1"""


def _rate(condition: str) -> str:
    return (f"count(*) FILTER (WHERE bought AND {condition}) / "
            f"nullif(count(*) FILTER (WHERE {condition}), 0)")


def _share_of(channel: str) -> str:
    return (f"round(coalesce((SELECT share FROM shares WHERE model = 'last_non_direct' "
            f"AND channel = '{channel}'), 0.0), 6) AS {channel}_share")


def _ranked(model: str, order: int) -> str:
    return (f"SELECT channel, {order} * 7 + row_number() OVER (ORDER BY share DESC, channel) AS place, "
            f"row_number() OVER (ORDER BY share DESC, channel) AS r FROM shares WHERE model = '{model}'")


def _share_column(model: str) -> str:
    return (f"round(coalesce((SELECT share FROM shares s WHERE s.model = '{model}' "
            f"AND s.channel = t.channel), 0.0), 6) AS {model}")


def _changed(condition: str, columns: tuple[str, ...] = _COLUMNS) -> str:
    return "concat_ws(',', " + ", ".join(
        f"CASE WHEN {condition.format(c)} THEN '{c}' END" for c in columns
    ) + ")"


_LAGS = ", ".join(f"lag(has_{c}) OVER (ORDER BY partition_date) AS had_{c}" for c in _COLUMNS)
_MONEY = ("revenue", "attributed_revenue_first_click", "attributed_revenue_last_click",
          "attributed_revenue_last_non_direct")
_METRIC_COLUMNS = """day, sessions, purchases, round(revenue, 2) AS revenue,
    round(purchase_rate, 6) AS purchase_rate, round(direct_session_share, 6) AS direct_session_share,
    round(direct_revenue_share, 6) AS direct_revenue_share"""

ORACLES: dict[str, str] = {
    "canonical_identity": _sql("""SELECT partition_date, count(*) AS rows, count(client) AS identified_rows,
    count(DISTINCT client) AS clients, count(*) FILTER (WHERE event_name = 'checkout_completed') AS purchase_rows
    FROM base GROUP BY 1"""),
    "event_times": _sql(f"""SELECT event_id, {_DAY.format('ts')} AS event_day,
    strftime(ts, '%Y%m%d') AS event_partition, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_iso FROM base"""),
    "utm_fields": _sql(f"SELECT event_id, {', '.join(_UTM)} FROM enr"),
    "device_type": _sql("SELECT event_id, device AS device_type FROM enr"),
    "referrer_host": _sql("SELECT event_id, host AS referrer_host FROM split"),
    "channel_class": _sql("SELECT event_id, channel, channel_detail FROM enr"),
    "page_channels": f"""SELECT page_id, host, {_parameter('utm_source')} AS utm_source,
    {_parameter('page')} AS page_number, {_CHANNEL} AS channel, {_DETAIL} AS channel_detail
    FROM (SELECT page_id, {_QUERY.format('url')} AS q, {_host('url')} AS host FROM pages)""",
    "json_parse_rate": _results_of("integrity.event_data_json_parse_rate"),
    "timestamp_alignment": _results_of("integrity.timestamp_parse_and_partition_alignment"),
    "identity_null_rate": _results_of("tracking.identity_null_rate"),
    "schema_presence": _results_of(
        "schema.required_columns_present",
        "schema.identity_column_present",
        "schema.referrer_column_present",
    ),
    "purchase_integrity": _results_of(
        "purchase.integrity.required_fields_and_positive_revenue",
        "purchase.integrity.no_purchases",
    ),
    "partition_profile": _sql(f"""SELECT partition_date, n AS rows, {_changed('has_{0}')} AS columns,
    round(anon / n, 6) AS identity_null_rate, bought AS purchase_count, round(revenue_sum, 2) AS revenue_sum
    FROM meas"""),
    "unknown_events": _sql(f"""SELECT partition_date, event_name, count(*) AS rows FROM base
    WHERE event_name NOT IN ({_ALLOWED}) GROUP BY 1, 2"""),
    "payload_contract": _sql(" UNION ALL ".join(
        f"""SELECT partition_date, event_name, '{f}' AS field, count(*) AS events,
    count(*) FILTER (WHERE j IS NULL OR coalesce(json_type(j, '$.{f}'), 'NULL') = 'NULL') AS missing
    FROM base WHERE event_name = '{e}' GROUP BY 1, 2"""
        for e, f in (
            ("checkout_completed", "transaction_id"),
            ("checkout_completed", "revenue"),
            ("checkout_completed", "items"),
            ("email_filled_on_popup", "email"),
        )
    )),
    "transaction_collisions": _sql("""SELECT partition_date, tx AS transaction_id, payloads,
    CAST(purchase_rows AS BIGINT) AS purchase_rows FROM txs WHERE tx IS NOT NULL AND payloads > 1"""),
    "replay_duplicates": _sql("""SELECT partition_date, tx AS transaction_id, copies FROM payloads
    WHERE copies > 1"""),
    "dq_results": _sql("SELECT * FROM results"),
    "dq_score": _sql("SELECT * FROM scores"),
    "identity_drift": _sql("""SELECT partition_date, 'drift.identity_null_rate_robust_z' AS check_id,
    CASE WHEN abs(z) > 4.5 THEN 'P1_HIGH' WHEN abs(z) > 3.5 THEN 'P2_MEDIUM' ELSE 'P3_INFO' END AS severity,
    abs(z) <= 3.5 AS passed, round(z, 6) AS robust_z, round(rate, 6) AS identity_null_rate
    FROM (SELECT partition_date, rate, CASE WHEN m = 0 THEN 0.0 ELSE 0.6745 * (rate - med) / m END AS z
      FROM (SELECT partition_date, anon / n AS rate, (SELECT median(anon / n) FROM meas) AS med,
        (SELECT mad(anon / n) FROM meas) AS m FROM meas))"""),
    "schema_drift": _sql(f"""SELECT *, missing_critical = '' AS passed, CASE WHEN missing_critical <> '' THEN
      'P0_BLOCKER' WHEN removed_columns <> '' THEN 'P1_HIGH' ELSE 'P3_INFO' END AS severity
    FROM (SELECT partition_date, 'drift.schema_removed_or_missing_critical' AS check_id, prev_date,
      {_changed('had_{0} AND NOT has_{0}')} AS removed_columns,
      {_changed('has_{0} AND NOT had_{0}')} AS added_columns,
      {_changed('NOT has_{0}', tuple(sorted(_REQUIRED)))} AS missing_critical
      FROM (SELECT *, lag(partition_date) OVER (ORDER BY partition_date) AS prev_date, {_LAGS} FROM meas)
      WHERE prev_date IS NOT NULL)"""),
    "failed_signals": _sql("""SELECT partition_date, 'drift.identity_null_rate_robust_z' AS check_id,
    CASE WHEN abs(z) > 4.5 THEN 'P1_HIGH' ELSE 'P2_MEDIUM' END AS severity, false AS passed
    FROM (SELECT partition_date, CASE WHEN m = 0 THEN 0.0 ELSE 0.6745 * (rate - med) / m END AS z
      FROM (SELECT partition_date, anon / n AS rate, (SELECT median(anon / n) FROM meas) AS med,
        (SELECT mad(anon / n) FROM meas) AS m FROM meas)) WHERE abs(z) > 3.5
    UNION ALL
    SELECT partition_date, 'drift.schema_removed_or_missing_critical', 'P0_BLOCKER', false
    FROM (SELECT *, lag(partition_date) OVER (ORDER BY partition_date) AS prev_date FROM meas)
    WHERE prev_date IS NOT NULL AND NOT (has_page_url AND has_timestamp AND has_event_name AND has_event_data AND has_user_agent)"""),
    "dq_rollup": _sql("""SELECT count(*) AS partitions, CAST(sum(failed) AS BIGINT) AS failed_checks,
    CAST(sum(p0_failed) AS BIGINT) AS p0_blockers, round(avg(dq_score), 1) AS mean_score,
    count(*) FILTER (WHERE p0_failed > 0) AS p0_days FROM scores"""),
    "blocked_partitions": _sql("""SELECT partition_date, dq_score, decision, p0_failed FROM scores
    WHERE decision = 'QUARANTINE' OR p0_failed > 0"""),
    "cleaned_events": _sql("""SELECT event_id, partition_date, client AS client_id_canonical, event_name
    FROM ann WHERE quarantine_reason IS NULL"""),
    "quarantined_events": _sql("""SELECT event_id, partition_date, client AS client_id_canonical,
    quarantine_reason FROM ann WHERE quarantine_reason IS NOT NULL"""),
    "cleaning_summary": _sql("""SELECT partition_date, count(*) FILTER (WHERE quarantine_reason IS NULL) AS clean_rows,
    count(quarantine_reason) AS quarantine_rows,
    count(*) FILTER (WHERE quarantine_reason = 'invalid_purchase_fields_or_revenue')
      AS invalid_purchase_fields_or_revenue,
    count(*) FILTER (WHERE quarantine_reason = 'transaction_id_collision') AS transaction_id_collision,
    count(*) FILTER (WHERE quarantine_reason = 'duplicate_purchase_replay') AS duplicate_purchase_replay
    FROM ann GROUP BY 1"""),
    "quarantine_reason_counts": _sql("""SELECT partition_date, quarantine_reason, count(*) AS rows FROM ann
    WHERE quarantine_reason IS NOT NULL GROUP BY 1, 2"""),
    "sessionized_events": _sql(f"""SELECT event_id, session_key, session_num, session_id,
    {_SECOND.format('start')} AS session_start_ts FROM labelled"""),
    "sessions": _sql(_sessions_output("sess")),
    "sessions_page_landing": _sql(_sessions_output("sess_page")),
    "touchpoints": _sql(f"""SELECT session_id, client AS client_id_canonical, CAST(ts AS STRING) AS touch_ts,
    page_url, referrer, {', '.join(_UTM)}, channel, channel_detail, device AS device_type,
    channel LIKE '%direct%' AS is_direct, regexp_matches(channel, 'paid|affiliate') AS is_paid
    FROM labelled QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) = 1"""),
    "purchases": _sql("""SELECT transaction_id, CAST(purchase_ts AS STRING) AS purchase_ts, client_id_canonical,
    session_id, revenue, user_email, items_json FROM pur"""),
    "purchase_attribution": _sql("""SELECT transaction_id, CAST(purchase_ts AS STRING) AS purchase_ts,
    client_id_canonical, session_id, revenue, first_click_session_id, first_click_channel,
    last_click_session_id, last_click_channel, last_non_direct_session_id, last_non_direct_channel FROM attr"""),
    "attribution_daily_first": _sql(_model_daily("first_click")),
    "attribution_daily_last": _sql(_model_daily("last_click")),
    "attribution_daily_last_non_direct": _sql(_model_daily("last_non_direct")),
    "clean_attribution_revenue": _sql(
        _model_daily("last_non_direct"), seen="SELECT * FROM ann WHERE quarantine_reason IS NULL"
    ),
    "daily_fact": _sql(f"""SELECT day, landing_channel, device_type, sessions, purchases,
    {', '.join(f'round({c}, 2) AS {c}' for c in _MONEY)}, round(conversion_rate, 6) AS conversion_rate FROM fact"""),
    "funnel_daily": _sql("""SELECT * REPLACE (round(purchase_rate_per_session, 6) AS purchase_rate_per_session)
    FROM funnel"""),
    "reconciliation": _sql("""SELECT (SELECT count(*) FROM base) AS input_event_rows,
    (SELECT count(*) FROM sess) AS session_rows,
    (SELECT count(*) FROM base WHERE event_name = 'checkout_completed') AS purchase_events_rows,
    (SELECT count(*) FROM pur) AS purchases_table_rows,
    (SELECT round(sum(revenue), 2) FROM pur) AS revenue_sum_purchases,
    (SELECT count(*) FROM pur WHERE session_id IS NULL) AS purchases_missing_session_id,
    (SELECT round(sum(revenue), 2) FROM attr) AS revenue_sum_attrib_first_click,
    (SELECT round(sum(revenue), 2) FROM attr) AS revenue_sum_attrib_last_click,
    (SELECT round(sum(revenue), 2) FROM attr) AS revenue_sum_attrib_last_non_direct,
    round((SELECT sum(revenue) FROM pur) - (SELECT sum(revenue) FROM attr), 2)
      AS revenue_sum_diff_purchases_vs_attrib"""),
    "kpi_totals": _sql("""SELECT round(r, 2) AS total_revenue, p AS total_purchases, s AS total_sessions,
    round(p / s, 6) AS conversion, round(r / p, 6) AS aov, round(r / s, 6) AS rps
    FROM (SELECT (SELECT sum(revenue) FROM pur) AS r, (SELECT count(DISTINCT transaction_id) FROM pur) AS p,
      (SELECT count(DISTINCT session_id) FROM sess) AS s)"""),
    "daily_kpis": _sql("""SELECT day, sessions, purchases, round(revenue, 2) AS revenue,
    round(purchase_rate, 6) AS purchase_rate FROM daily"""),
    "channel_revenue": _sql("""SELECT coalesce(last_non_direct_channel, 'direct') AS channel,
    round(coalesce(sum(revenue), 0.0), 2) AS revenue FROM attr GROUP BY 1 ORDER BY 2 DESC, 1"""),
    "attribution_sensitivity": _sql(f"""SELECT channel, {_share_column('first_click')}, {_share_column('last_click')},
    {_share_column('last_non_direct')} FROM (SELECT channel, min(place) AS place FROM (
      {_ranked('last_non_direct', 0)} UNION ALL {_ranked('first_click', 1)} UNION ALL {_ranked('last_click', 2)})
      WHERE r <= 6 GROUP BY channel) t ORDER BY place"""),
    "device_conversion": _sql(_conversion("device_type")),
    "new_vs_returning": _sql(_conversion("user_type")),
    "executive_ratios": _sql(f"""SELECT round(new_rate, 6) AS new_rate, round(returning_rate, 6) AS returning_rate,
    round(desktop_rate, 6) AS desktop_rate, round(mobile_rate, 6) AS mobile_rate,
    round(mobile_session_share, 6) AS mobile_session_share,
    round(CASE WHEN new_rate = 0 THEN 0.0 ELSE returning_rate / new_rate END, 6) AS returning_lift,
    {', '.join(_share_of(c) for c in ('direct', 'paid_search', 'unknown_paid', 'organic_search'))}
    FROM (SELECT {_rate("user_type = 'new'")} AS new_rate, {_rate("user_type = 'returning'")} AS returning_rate,
      {_rate("device_type = 'desktop'")} AS desktop_rate, {_rate("device_type = 'mobile'")} AS mobile_rate,
      count(*) FILTER (WHERE device_type = 'mobile') / count(*) AS mobile_session_share FROM visited)"""),
    "time_to_purchase": _sql("""SELECT round(quantile_cont(minutes, 0.5), 5) AS median_minutes,
    round(quantile_cont(minutes, 0.9), 5) AS p90_minutes FROM timed"""),
    "time_to_purchase_hist": _sql("""SELECT CAST(b.bin AS BIGINT) AS bin,
    round(lo + (b.bin - 1) * (hi - lo) / 20, 5) AS low, round(lo + b.bin * (hi - lo) / 20, 5) AS high,
    count(t.k) AS rows
    FROM (SELECT unnest(range(1, 21)) AS bin) b, (SELECT min(minutes) AS lo, max(minutes) AS hi FROM timed) r
    LEFT JOIN (SELECT least(CAST(floor(20 * (minutes - lo) / (hi - lo)) AS BIGINT) + 1, 20) AS k FROM timed,
      (SELECT min(minutes) AS lo, max(minutes) AS hi FROM timed)) t ON t.k = b.bin
    GROUP BY b.bin, lo, hi"""),
    "direct_share": _sql("""SELECT day, round(direct_session_share, 6) AS direct_session_share,
    round(direct_revenue_share, 6) AS direct_revenue_share FROM direct"""),
    "direct_share_from_funnel": _sql("""SELECT event_day AS day,
    round(sum(CASE WHEN landing_channel LIKE '%direct%' THEN coalesce(sessions, 0) ELSE 0 END)
      / greatest(coalesce(sum(sessions), 0), 1), 6) AS direct_session_share FROM funnel GROUP BY 1"""),
    "daily_metrics": _sql(f"SELECT {_METRIC_COLUMNS} FROM metrics"),
    "metric_baselines": _sql("""SELECT day, metric, round(value, 6) AS value,
    round(baseline_median, 6) AS baseline_median, round(mad, 6) AS mad, round(robust_z, 7) AS robust_z
    FROM baselines"""),
    "alerts": _sql("""SELECT day, metric, round(value, 6) AS value, round(baseline_median, 6) AS baseline_median,
    round(mad, 6) AS mad, round(robust_z, 7) AS robust_z, round(relative_change, 7) AS relative_change, severity,
    message FROM alerted"""),
    "monitoring_report": _sql(f"""SELECT {_METRIC_COLUMNS}, coalesce(alerts, 0) AS alerts,
    coalesce(blocker_alerts, 0) AS blocker_alerts FROM metrics LEFT JOIN (SELECT day, count(*) AS alerts,
      count(*) FILTER (WHERE severity = 'P0_BLOCKER') AS blocker_alerts FROM alerted GROUP BY 1) USING (day)
    ORDER BY day DESC LIMIT 14"""),
}
