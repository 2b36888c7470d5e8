"""Business metrics over the session, purchase and attribution tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.scoring import ratio
from clicktide.functions.timing import MICROS_PER_MINUTE, day_text
from clicktide.operators.attribution import MODELS
from clicktide.operators.quantiles import histogram, quantile_row

# Order in which the models contribute channels to the sensitivity table.
MODEL_PRIORITY = ("last_non_direct", "first_click", "last_click")
TOP_CHANNELS = 6


def one_row(*frames: DataFrame) -> DataFrame:
    """Merge single-row frames with distinct columns into one row, without a cross join."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def _revenue(c: str = "revenue") -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0))


def kpi_totals(sessions: DataFrame, purchases: DataFrame) -> DataFrame:
    """One row: revenue, distinct purchases, sessions, conversion, order value, revenue/session."""
    totals = one_row(
        purchases.agg(
            _revenue().alias("total_revenue"),
            F.count_distinct("transaction_id").alias("total_purchases"),
        ),
        sessions.agg(F.count("session_id").alias("total_sessions")),
    )
    revenue, bought, visits = (
        F.col("total_revenue"),
        F.col("total_purchases"),
        F.col("total_sessions"),
    )
    return totals.withColumns(
        {
            "conversion": ratio(bought, visits),
            "aov": ratio(revenue, bought),
            "rps": ratio(revenue, visits),
        }
    )


def daily_kpis(sessions: DataFrame, purchases: DataFrame) -> DataFrame:
    """Sessions, purchases, revenue and purchase rate per session day."""
    visits = sessions.groupBy(day_text(F.col("session_start_ts")).alias("day")).agg(
        F.count("session_id").alias("sessions")
    )
    bought = purchases.groupBy(day_text(F.col("purchase_ts")).alias("day")).agg(
        F.count_distinct("transaction_id").alias("purchases"), _revenue().alias("revenue")
    )
    return (
        visits.join(bought, "day", "left")
        .fillna({"purchases": 0, "revenue": 0.0})
        .withColumn("purchase_rate", ratio(F.col("purchases"), F.col("sessions")))
    )


def channel_revenue(attribution: DataFrame, model: str = "last_non_direct") -> DataFrame:
    """Attributed revenue per channel, a missing channel counted as direct, largest first."""
    return (
        attribution.groupBy(
            F.coalesce(F.col(f"{model}_channel"), F.lit("direct")).alias("channel")
        )
        .agg(_revenue().alias("revenue"))
        .orderBy(F.desc("revenue"), "channel")
    )


def attribution_shares(attribution: DataFrame) -> DataFrame:
    """(model, channel, share): each channel's part of a model's revenue."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"),
                F.coalesce(F.col(f"{m}_channel"), F.lit("direct")).alias("channel"),
            )
            for m in MODELS
        ]
    )
    whole = Window.partitionBy("model")
    return (
        attribution.select("revenue", F.inline(pairs))
        .groupBy("model", "channel")
        .agg(_revenue().alias("revenue"))
        .select(
            "model",
            "channel",
            ratio(F.col("revenue"), F.sum("revenue").over(whole)).alias("share"),
        )
    )


def attribution_sensitivity(
    attribution: DataFrame, top: int = TOP_CHANNELS, rows: int | None = None
) -> DataFrame:
    """Revenue share per channel and model for the top channels of any model.

    `rows` keeps only the first rows of the ordered table, as a report shows them.

    Rows are placed by the first model (in `MODEL_PRIORITY`) that ranks the channel, then by rank.
    """
    ranked = attribution_shares(attribution).withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("model").orderBy(F.desc("share"), "channel")),
    )
    slot = F.lit(None).cast("int")
    for order, model in enumerate(MODEL_PRIORITY):
        slot = F.when(F.col("model") == model, order * (top + 1) + F.col("rank")).otherwise(slot)
    table = (
        ranked.groupBy("channel")
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("model") == m, F.col("share"))), F.lit(0.0)).alias(m)
                for m in MODELS
            ],
            F.min(F.when(F.col("rank") <= top, slot)).alias("_place"),
        )
        .where(F.col("_place").isNotNull())
        .orderBy("_place")
        .drop("_place")
    )
    return table if rows is None else table.limit(rows)


def with_purchase_flag(sessions: DataFrame, purchases: DataFrame) -> DataFrame:
    """Sessions with `has_purchase`."""
    bought = purchases.select("session_id").distinct().withColumn("_bought", F.lit(True))
    return (
        sessions.join(bought, "session_id", "left")
        .withColumn("has_purchase", F.coalesce("_bought", F.lit(False)))
        .drop("_bought")
    )


def _conversion(flagged: DataFrame, label: str) -> DataFrame:
    return (
        flagged.groupBy(label)
        .agg(
            F.count("session_id").alias("sessions"),
            F.count_if("has_purchase").alias("purchases"),
        )
        .withColumn("purchase_rate", ratio(F.col("purchases"), F.col("sessions")))
    )


def device_conversion(sessions: DataFrame, purchases: DataFrame) -> DataFrame:
    """Share of sessions with a purchase, per device; sessions without a device are left out."""
    known = sessions.where(F.col("device_type").isNotNull())
    return _conversion(with_purchase_flag(known, purchases), "device_type")


def with_user_type(sessions: DataFrame, anonymous_as: str = "returning") -> DataFrame:
    """`new` for a client's first session of the input, else `returning`.

    Sessions without a client are all `anonymous_as`; the window gives each a group of its own so
    that they do not meet in one task. A known client's group is bounded by time span / gap.
    """
    client = F.col("client_id_canonical")
    by_client = Window.partitionBy(
        client, F.when(client.isNull(), F.col("session_id"))
    ).orderBy("session_start_ts", "session_id")
    return sessions.withColumn("_index", F.row_number().over(by_client)).withColumn(
        "user_type",
        F.when(client.isNull(), anonymous_as)
        .when(F.col("_index") == 1, "new")
        .otherwise("returning"),
    ).drop("_index")


def new_vs_returning(
    sessions: DataFrame, purchases: DataFrame, anonymous_as: str = "returning"
) -> DataFrame:
    typed = with_user_type(sessions, anonymous_as)
    return _conversion(with_purchase_flag(typed, purchases), "user_type")


def minutes_to_purchase(purchases: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Purchases with the time since their session's start; without a session, left out.

    Purchases that carry `session_start_ts` need no join with the sessions.
    """
    if "session_start_ts" in purchases.columns:
        known = purchases.withColumnRenamed("session_start_ts", "_start")
    else:
        starts = sessions.select("session_id", F.col("session_start_ts").alias("_start"))
        known = purchases.join(starts, "session_id", "left")
    micros = F.unix_micros("purchase_ts") - F.unix_micros("_start")
    return (
        known.withColumn("micros_to_purchase", micros)
        .where(F.col("micros_to_purchase").isNotNull())
        .withColumn(
            "minutes_to_purchase", F.col("micros_to_purchase") / F.lit(float(MICROS_PER_MINUTE))
        )
        .drop("_start")
    )


def time_to_purchase(timed: DataFrame) -> DataFrame:
    """One row: exact median and 90th percentile of the minutes to purchase."""
    wanted = {"median_minutes": 0.5, "p90_minutes": 0.9}
    return quantile_row(timed, "micros_to_purchase", wanted, MICROS_PER_MINUTE)


def time_to_purchase_histogram(timed: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(timed, "minutes_to_purchase", bins)


# --- fixed values: channels named in the executive summary ------------------------
SUMMARY_CHANNELS = ("direct", "paid_search", "unknown_paid", "organic_search")


def executive_ratios(
    sessions: DataFrame, purchases: DataFrame, attribution: DataFrame
) -> DataFrame:
    """One row of the headline ratios: lift, device rates, mobile share and channel shares.

    One pass over the flagged sessions gives every conversion figure.
    """
    flagged = with_purchase_flag(with_user_type(sessions), purchases)

    def rate(condition: Column) -> Column:
        return ratio(F.count_if(condition & F.col("has_purchase")), F.count_if(condition))

    device, user = F.col("device_type"), F.col("user_type")
    rates = flagged.agg(
        rate(user == "new").alias("new_rate"),
        rate(user == "returning").alias("returning_rate"),
        rate(device == "desktop").alias("desktop_rate"),
        rate(device == "mobile").alias("mobile_rate"),
        ratio(F.count_if(device == "mobile"), F.count("session_id")).alias(
            "mobile_session_share"
        ),
    )
    shares = (
        attribution_shares(attribution)
        .where(F.col("model") == "last_non_direct")
        .agg(
            *[
                F.coalesce(
                    F.sum(F.when(F.col("channel") == c, F.col("share"))), F.lit(0.0)
                ).alias(f"{c}_share")
                for c in SUMMARY_CHANNELS
            ]
        )
    )
    return one_row(rates, shares).withColumn(
        "returning_lift",
        F.when(F.col("new_rate") == 0, F.lit(0.0)).otherwise(
            F.col("returning_rate") / F.col("new_rate")
        ),
    )
