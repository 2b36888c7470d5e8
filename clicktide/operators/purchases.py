"""Purchase rows from sessionized events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions.payload import field, items_json, number, with_facts
from clicktide.operators.shaping import with_event_ts
from clicktide.settings import PURCHASE_EVENT


def purchase_events(events: DataFrame, event: str = PURCHASE_EVENT) -> DataFrame:
    return events.where(F.col("event_name") == event)


# What purchases may carry of their session, so that no join has to fetch it again.
SESSION_FACTS = ("session_start_ts", "landing_channel", "landing_device")


def extract_purchases(
    sessionized: DataFrame, event: str = PURCHASE_EVENT, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Purchase table; a malformed payload gives null fields instead of failing the job.

    `keep` names columns to carry along, for instance SESSION_FACTS.
    """
    rows = with_facts(
        with_event_ts(purchase_events(sessionized, event)),
        F.col("event_data"),
        lambda payload: {
            "_tx": field(payload, "transaction_id", "string"),
            "_revenue": number(payload, "revenue"),
            "_email": field(payload, "user_email", "string"),
            "_items": items_json(payload),
        },
    )
    return rows.select(
        F.col("_tx").alias("transaction_id"),
        F.col("ts").alias("purchase_ts"),
        "client_id_canonical",
        "session_id",
        F.col("_revenue").alias("revenue"),
        F.col("_email").alias("user_email"),
        F.col("_items").alias("items_json"),
        *keep,
    )
