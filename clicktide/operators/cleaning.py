"""Row quarantine: bad purchases get a reason, everything else passes.

Rules run in order: invalid fields, then collisions among the valid purchases, then replays, of
which the earliest row stays. Copies of one purchase or one transaction may be a large part of the
data, so no window groups them: the verdict per transaction comes from two combined aggregates,
first by payload and then by transaction, and returns to the purchases by one left join. Only
transactions with a defect are in the verdict table; the join becomes a broadcast when it is small
(the usual case) and is split by adaptive execution otherwise. Other events never meet a join.

A single table of verdicts is enough for one pass (`annotate_quarantine`). A plan whose branches all
start from clean events takes `defects`, a narrow relation of the bad rows, and anti-joins it in each
branch (`without_defects`): payloads are then judged once, and the exchange is reused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.functions.payload import (
    field,
    invalid_purchase_clean,
    item_count,
    number,
    payload_hash,
    with_facts,
)
from clicktide.functions.timing import place
from clicktide.operators.purchases import purchase_events
from clicktide.operators.shaping import canonical_identity, ensure_columns, with_event_ts
from clicktide.settings import PURCHASE_EVENT, RAW_EVENT_COLUMNS

# --- fixed values: quarantine reasons ---------------------------------------------
INVALID = "invalid_purchase_fields_or_revenue"
COLLISION = "transaction_id_collision"
REPLAY = "duplicate_purchase_replay"
REASONS = (INVALID, COLLISION, REPLAY)

# Micros that stand for an unknown time; known ones are smaller for 30,000 years.
_LAST = 10**18
_WORK = ("_tx", "_key", "_invalid", "_collided", "_kept", "_place")
DAY_SCOPE = ("partition_date",)


def _shaped(events: DataFrame) -> DataFrame:
    return with_event_ts(canonical_identity(ensure_columns(events, RAW_EVENT_COLUMNS)))


def _others(shaped: DataFrame) -> DataFrame:
    """Events that no rule looks at."""
    return shaped.where(F.col("event_name").isNull() | (F.col("event_name") != PURCHASE_EVENT))


def _scoped(rows: DataFrame, scope: tuple[str, ...]) -> DataFrame:
    """Scope columns without nulls: rows of files without a date are one partition of their own."""
    named = {f"_in_{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in scope}
    return rows.withColumns(named) if named else rows


def _judged(shaped: DataFrame, scope: tuple[str, ...], tie_break: str) -> DataFrame:
    """Purchases with `quarantine_reason` and work columns; each scan parses a payload once."""
    time = F.coalesce(F.unix_micros("ts"), F.lit(_LAST))
    at = place(time, F.col(tie_break), dict(shaped.dtypes)[tie_break])
    rows = _scoped(purchase_events(shaped), scope).withColumn("_place", at)

    def judged(payload: Column) -> dict[str, Column]:
        tx = field(payload, "transaction_id", "string")
        bad = invalid_purchase_clean(tx, number(payload, "revenue"), item_count(payload))
        return {"_tx": tx, "_invalid": bad}

    def compared(payload: Column) -> dict[str, Column]:
        return {**judged(payload), "_hash": payload_hash(payload)}

    text, keys = F.col("event_data"), [f"_in_{c}" for c in scope]
    verdicts = (
        with_facts(rows, text, compared)
        .where(~F.col("_invalid"))
        .groupBy(*keys, F.col("_tx").alias("_key"), "_hash")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("_place").alias("first"))
        .groupBy(*keys, "_key")
        .agg(
            (F.count(F.lit(1)) > 1).alias("_collided"),
            F.max("copies").alias("copies"),
            # Only read where the transaction has a single payload.
            F.min("first").alias("_kept"),
        )
        .where(F.col("_collided") | (F.col("copies") > 1))
        .drop("copies")
    )
    # Invalid rows may lack an id; a key of their own spreads them, and the reason ignores a match.
    own = F.coalesce(F.col(tie_break).cast("string"), F.lit(""))
    rows = with_facts(rows, text, judged).withColumn(
        "_key", F.when(F.col("_invalid"), own).otherwise(F.col("_tx"))
    )
    return rows.join(verdicts, [*keys, "_key"], "left").withColumn(
        "quarantine_reason",
        F.when(F.col("_invalid"), INVALID)
        .when(F.col("_collided"), COLLISION)
        .when(F.col("_place") > F.col("_kept"), REPLAY),
    )


def annotate_quarantine(
    events: DataFrame, scope: tuple[str, ...] = DAY_SCOPE, tie_break: str = "event_id"
) -> DataFrame:
    """Events with `quarantine_reason` (null: the row is clean).

    `scope` bounds where ids are compared: one partition by default, `("source_file",
    "partition_date")` for each file alone, `()` for the whole input.
    """
    shaped = _shaped(events)
    passed = _others(shaped).withColumn("quarantine_reason", F.lit(None).cast("string"))
    judged = _judged(shaped, scope, tie_break).drop(*_WORK, *[f"_in_{c}" for c in scope])
    return passed.unionByName(judged)


def _row_key(rows: DataFrame, scope: tuple[str, ...], tie_break: str) -> DataFrame:
    """What a purchase is judged by: scope, time, tie-break and text. Rows equal in it share a verdict."""
    return _scoped(rows, scope).withColumns(
        {
            "_row_at": F.coalesce(F.unix_micros("ts"), F.lit(_LAST)),
            "_row_tie": F.coalesce(F.col(tie_break).cast("string"), F.lit("")),
            "_row_text": F.xxhash64("event_data"),
        }
    )


def _row_keys(scope: tuple[str, ...]) -> list[str]:
    return [*[f"_in_{c}" for c in scope], "_row_at", "_row_tie", "_row_text"]


def defects(
    events: DataFrame, scope: tuple[str, ...] = DAY_SCOPE, tie_break: str = "event_id"
) -> DataFrame:
    """The purchases with a defect as (row key, quarantine_reason), one row per key."""
    judged = _judged(_shaped(events), scope, tie_break).where(F.col("quarantine_reason").isNotNull())
    keys = _row_keys(scope)
    return (
        _row_key(judged.drop(*[f"_in_{c}" for c in scope]), scope, tie_break)
        .groupBy(*keys)
        .agg(F.first("quarantine_reason").alias("quarantine_reason"))
    )


def clean_purchases(
    events: DataFrame,
    bad: DataFrame,
    scope: tuple[str, ...] = DAY_SCOPE,
    tie_break: str = "event_id",
) -> DataFrame:
    """The purchases whose key is not in `bad`, the `defects` of these events.

    The row key has a 64-bit hash of the payload text beside scope, time and tie-break.
    """
    keys = _row_keys(scope)
    rows = _row_key(purchase_events(_shaped(events)), scope, tie_break)
    return rows.join(bad.select(*keys), keys, "left_anti").drop(*keys)


def without_defects(
    events: DataFrame,
    bad: DataFrame,
    scope: tuple[str, ...] = DAY_SCOPE,
    tie_break: str = "event_id",
) -> DataFrame:
    """Clean events: those that are no purchase, and the clean purchases."""
    good = clean_purchases(events, bad, scope, tie_break)
    return _others(_shaped(events)).unionByName(good)


def cleaned(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason")


def quarantined(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("quarantine_reason").isNotNull())


def quarantine_reason_counts(
    annotated: DataFrame, scope: tuple[str, ...] = DAY_SCOPE
) -> DataFrame:
    return (
        quarantined(annotated)
        .groupBy(*scope, "quarantine_reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def cleaning_summary(annotated: DataFrame, scope: tuple[str, ...] = DAY_SCOPE) -> DataFrame:
    """Clean and quarantined rows per partition, with one count per reason."""
    reason = F.col("quarantine_reason")
    return annotated.groupBy(*scope).agg(
        F.count_if(reason.isNull()).alias("clean_rows"),
        F.count(reason).alias("quarantine_rows"),
        *[F.count_if(reason == r).alias(r) for r in REASONS],
    )


def cleaning_manifest(summary: DataFrame) -> DataFrame:
    """The summary with its reason counts nested as a map of the reasons that occur."""
    pairs = F.array(
        *[F.struct(F.lit(r).alias("reason"), F.col(r).alias("rows")) for r in REASONS]
    )
    occurring = F.map_from_entries(F.filter(pairs, lambda x: x["rows"] > 0))
    return summary.select(
        *[c for c in summary.columns if c not in ("clean_rows", "quarantine_rows", *REASONS)],
        "clean_rows",
        "quarantine_rows",
        occurring.alias("quarantine_reason_counts"),
    )
