"""Event schema shaping: missing columns, canonical identity, traffic enrichment."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions import web
from clicktide.functions.timing import parse_ts
from clicktide.settings import IDENTITY_COLUMNS, UTM_FIELDS, TrafficRules


def ensure_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Add the absent columns as null strings."""
    absent = [c for c in required if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df


def canonical_identity(
    df: DataFrame, columns: tuple[str, ...] = IDENTITY_COLUMNS
) -> DataFrame:
    """Add `client_id_canonical`, the first non-null identity, unless it exists already."""
    if "client_id_canonical" in df.columns:
        return df
    present = [F.col(c) for c in columns if c in df.columns]
    value = F.coalesce(*present) if present else F.lit(None)
    return df.withColumn("client_id_canonical", value.cast("string"))


def with_event_ts(df: DataFrame) -> DataFrame:
    """Add `ts`, the parsed event time (null where it does not parse)."""
    return df if "ts" in df.columns else df.withColumn("ts", parse_ts(F.col("timestamp")))


def enrich_events(df: DataFrame, rules: TrafficRules = TrafficRules()) -> DataFrame:
    """Add UTM fields, device type, channel and channel detail, each only where absent."""
    df = ensure_columns(df, ("page_url", "referrer", "user_agent"))
    wants_channel = not {"channel", "channel_detail"} <= set(df.columns)
    utm = [c for c in UTM_FIELDS if c not in df.columns]
    out = web.with_query(df, "page_url", "_query")
    if wants_channel:
        out = out.withColumn("_host", web.network_host(F.col("referrer"))).withColumn(
            "_class", web.classify_channel(F.col("_query"), F.col("_host"), rules)
        )
    if "device_type" not in df.columns:
        out = out.withColumn("device_type", web.device_type(F.col("user_agent"), rules))
    out = web.with_query_values(out, "_query", {c: c for c in utm})
    if wants_channel:
        out = out.withColumns(
            {"channel": F.col("_class.channel"), "channel_detail": F.col("_class.detail")}
        )
    return out.drop("_query", "_host", "_class")


def prepare_events(df: DataFrame, rules: TrafficRules = TrafficRules()) -> DataFrame:
    """Canonical identity, parsed time and enrichment in one projection chain."""
    return enrich_events(with_event_ts(canonical_identity(df)), rules)
