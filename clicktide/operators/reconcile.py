"""Reconciliation of the transformation's tables against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.operators.attribution import MODELS, attributed_revenue_daily
from clicktide.operators.kpis import one_row
from clicktide.settings import PURCHASE_EVENT


def reconcile(
    events: DataFrame, sessions: DataFrame, purchases: DataFrame, attribution: DataFrame
) -> DataFrame:
    """One row of row counts and revenue sums.

    Each model's sum comes from its own daily aggregate (null channel included), so a loss in any
    of them shows. The difference compares purchases with the attribution table.
    """
    by_model = attributed_revenue_daily(attribution).agg(
        *[
            F.coalesce(
                F.sum(F.when(F.col("model") == m, F.col("attributed_revenue"))), F.lit(0.0)
            ).alias(f"revenue_sum_attrib_{m}")
            for m in MODELS
        ]
    )
    merged = one_row(
        events.agg(
            F.count(F.lit(1)).alias("input_event_rows"),
            F.count_if(F.col("event_name") == PURCHASE_EVENT).alias("purchase_events_rows"),
        ),
        sessions.agg(F.count(F.lit(1)).alias("session_rows")),
        purchases.agg(
            F.count(F.lit(1)).alias("purchases_table_rows"),
            F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("revenue_sum_purchases"),
            F.count_if(F.col("session_id").isNull()).alias("purchases_missing_session_id"),
        ),
        by_model,
        attribution.agg(F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("_attributed")),
    )
    return merged.withColumn(
        "revenue_sum_diff_purchases_vs_attrib",
        F.col("revenue_sum_purchases") - F.col("_attributed"),
    ).drop("_attributed")
