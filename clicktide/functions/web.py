"""URL, referrer and user-agent expressions.

They are built from string functions, regular expressions and CASE only, so that they stay inside
whole-stage code generation (higher-order functions over a parsed parameter array would leave it).
Plain substring tests come first: a regular expression runs only on the texts that need it.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.settings import TrafficRules

# Stand-ins (Unicode non-characters) for an escaped `&` and `=` inside a decoded query.
_AMP, _EQ = "\ufdd0", "\ufdd1"
_BLANKS = " \t\n\r\f\u000b"


def url_query(url: Column) -> Column:
    """Raw query text of a URL: after the first `?`, before any `#`; empty when there is none."""
    before_fragment = F.substring_index(url, "#", 1)
    mark = F.instr(before_fragment, "?")
    return F.when(mark > 0, F.substr(before_fragment, mark + 1)).otherwise("")


def decode_query(raw: Column) -> Column:
    """Query text with `+` and percent escapes decoded once.

    A broken escape such as `%zz` stays as it is. Escaped `&` and `=` become stand-ins, so the
    decoded text still splits at the true separators.
    """
    mended = F.regexp_replace(raw, "%(?![0-9A-Fa-f]{2})", "%25")
    marked = F.regexp_replace(F.regexp_replace(mended, "%26", _AMP), "%3[Dd]", _EQ)
    return F.when(raw.contains("%"), F.try_url_decode(marked)).otherwise(
        F.translate(raw, "+", " ")
    )


def matched_value(decoded: Column, name: str) -> Column:
    """First non-blank value of a parameter in a decoded query, else null or empty."""
    value = F.regexp_extract(decoded, f"(?:^|&){re.escape(name)}=([^&]+)", 1)
    return F.when(decoded.contains(f"{name}="), value)


def plain_value(matched: Column) -> Column:
    """A `matched_value` with its stand-ins undone; null when it is empty."""
    return F.when(matched != "", F.translate(matched, _AMP + _EQ, "&="))


def with_query(df: DataFrame, url: str, name: str) -> DataFrame:
    """Add the decoded query of a URL column, in steps that keep each generated method small."""
    return df.withColumn(name, url_query(F.col(url))).withColumn(name, decode_query(F.col(name)))


def with_query_values(df: DataFrame, query: str, names: dict[str, str]) -> DataFrame:
    """Add parameter values of a decoded query, given as column name → parameter."""
    found = {c: matched_value(F.col(query), parameter) for c, parameter in names.items()}
    return df.withColumns(found).withColumns({c: plain_value(F.col(c)) for c in names})


def has_any_parameter(decoded: Column, names: tuple[str, ...]) -> Column:
    """True when one of the parameters carries a non-blank value."""
    return decoded.rlike(f"(?:^|&)(?:{'|'.join(map(re.escape, names))})=[^&]")


def has_parameter_prefix(decoded: Column, prefix: str) -> Column:
    """True when a parameter whose name starts with `prefix` carries a non-blank value."""
    return decoded.rlike(f"(?:^|&){re.escape(prefix)}[^&=]*=[^&]")


def network_host(url: Column) -> Column:
    """Lower-case network location (host, with port and credentials if given), else empty."""
    cleaned = F.lower(F.btrim(url, F.lit(_BLANKS)))
    host = F.regexp_extract(cleaned, r"^(?:[a-z][a-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.when(url.contains("//"), host).otherwise("")


def contains_any(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(part) for part in parts])


def device_type(user_agent: Column, rules: TrafficRules = TrafficRules()) -> Column:
    marker = contains_any(F.lower(user_agent), rules.mobile_markers)
    return F.when(marker, "mobile").otherwise("desktop")


def classify_channel(decoded: Column, host: Column, rules: TrafficRules = TrafficRules()) -> Column:
    """`struct(channel, detail)`; the first rule that holds wins.

    `decoded` is the page's decoded query, `host` the referrer's network host ('' when none).
    """
    has_query = decoded != ""

    def outcome(channel: str, detail: Column | str) -> Column:
        detail = F.lit(detail) if isinstance(detail, str) else detail
        return F.struct(F.lit(channel).alias("channel"), detail.alias("detail"))

    return (
        F.when(
            has_query & has_any_parameter(decoded, rules.paid_search_ids),
            outcome("paid_search", "click_id"),
        )
        .when(
            has_query & has_any_parameter(decoded, rules.paid_social_ids),
            outcome("paid_social", "click_id"),
        )
        .when(contains_any(host, rules.search_hosts), outcome("organic_search", host))
        .when(contains_any(host, rules.social_hosts), outcome("organic_social", host))
        .when(
            host.startswith("source-") & host.endswith(".com"),
            outcome("unknown_paid", "redirect_domain"),
        )
        .when(
            (host != "") & ~host.contains(rules.own_domain.lower()),
            outcome("referral", host),
        )
        .when(has_query & has_parameter_prefix(decoded, "utm_"), outcome("unknown_paid", "utm_present"))
        .otherwise(outcome("direct", "no_referrer"))
    )
