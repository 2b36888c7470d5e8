"""Multi-model attribution over a look-back, as an as-of join that survives hot clients.

For one client the attributed sessions only change when a session enters the look-back (at its
start) or leaves it (just after start + look-back). A window per client runs over these change
points, which are session rows and hence bounded by `time span / session gap`; purchases, which
one client may own without bound, never enter it. Each change point is valid until the next one.
Purchases meet these intervals by an equi-join on (client, day) plus `valid_from <= t < valid_to`,
so every purchase meets at most one of them and nothing is paired twice; adaptive execution can
split a hot client's purchases. An interval is only copied to the days on which its client buys:
those days, at most one value per day of data, travel with the client's sessions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.timing import MICROS_PER_DAY, floor_micros, to_second

LOOKBACK_DAYS = 7
MODELS = ("first_click", "last_click", "last_non_direct")
ATTRIBUTION_COLUMNS = tuple(f"{m}_{f}" for m in MODELS for f in ("session_id", "channel"))


def _day_of(micros: Column) -> Column:
    return floor_micros(micros, MICROS_PER_DAY)


def purchase_days(purchases: DataFrame) -> DataFrame:
    """Per client, the starts (micros) of the days with a purchase."""
    at = F.unix_micros("purchase_ts")
    return (
        purchases.where(F.col("client_id_canonical").isNotNull() & at.isNotNull())
        .groupBy("client_id_canonical")
        .agg(F.collect_set(_day_of(at)).alias("buy_days"))
    )


def attribution_states(
    sessions: DataFrame, buyers: DataFrame, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Per client and purchase day, the three attributed sessions for every interval of time.

    Columns: client_id_canonical, day_slot, valid_from, valid_to (micros, end exclusive), one
    struct per model. `buyers` comes from `purchase_days`. Session starts are cut to the second,
    both look-back bounds are inclusive and ties go by session id. A null channel counts as
    non-direct.
    """
    span = lookback_days * MICROS_PER_DAY
    start = F.unix_micros(to_second(F.col("session_start_ts")))
    touch = F.struct(start.alias("start_us"), "session_id", F.col("landing_channel").alias("channel"))
    # Sessions outside the look-back of every purchase day cannot matter.
    relevant = F.exists(
        "buy_days",
        lambda day: F.col("touch.start_us").between(day - span, day + MICROS_PER_DAY),
    )
    starts = (
        sessions.select("client_id_canonical", touch.alias("touch"))
        .join(buyers, "client_id_canonical")
        .where(relevant)
    )
    in_order = Window.partitionBy("client_id_canonical").orderBy("touch")
    nothing = F.when(F.lit(False), F.col("touch"))
    enters = F.struct(
        F.col("touch.start_us").alias("at"),
        F.col("touch").alias("entered"),
        nothing.alias("left"),
        nothing.alias("after_left"),
    )
    leaves = F.struct(
        (F.col("touch.start_us") + span + 1).alias("at"),
        nothing.alias("entered"),
        F.col("touch").alias("left"),
        F.col("next").alias("after_left"),
    )
    changes = starts.withColumn("next", F.lead("touch").over(in_order)).select(
        "client_id_canonical", "buy_days", F.inline(F.array(enters, leaves))
    )

    # Running extremes over all changes so far; a touch counts while it is inside the look-back.
    by_time = Window.partitionBy("client_id_canonical").orderBy("at")
    so_far = by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    entered, at = F.col("entered"), F.col("at")
    non_direct = F.when(~entered.getField("channel").eqNullSafe(F.lit("direct")), entered)
    gone = F.when(F.col("left").isNotNull(), F.struct("left", "after_left"))

    def inside(touch: str) -> Column:
        return F.when(F.col(f"{touch}.start_us").between(at - span, at), F.col(touch))

    intervals = (
        changes.select(
            "client_id_canonical",
            "buy_days",
            "at",
            F.lead("at").over(by_time).alias("valid_to"),
            F.min(entered).over(so_far).alias("oldest"),
            F.max(gone).over(so_far).alias("gone"),
            F.max(entered).over(so_far).alias("last_click"),
            F.max(non_direct).over(so_far).alias("last_non_direct"),
        )
        # The oldest session inside follows the last one that left.
        .withColumn(
            "first_click",
            F.when(F.col("gone").isNull(), F.col("oldest")).otherwise(F.col("gone.after_left")),
        )
        .select(
            "client_id_canonical",
            "buy_days",
            at.alias("valid_from"),
            "valid_to",
            *[inside(m).alias(m) for m in MODELS],
        )
        # Change points that share a time leave empty intervals; the last one carries the state.
        .where(F.col("first_click").isNotNull() & (F.col("valid_to") > F.col("valid_from")))
    )
    overlapping = F.filter(
        "buy_days",
        lambda day: (day < F.col("valid_to")) & (day + MICROS_PER_DAY > F.col("valid_from")),
    )
    return intervals.withColumn("day_slot", F.explode(overlapping)).drop("buy_days")


def attribute_purchases(
    purchases: DataFrame,
    sessions: DataFrame,
    lookback_days: int = LOOKBACK_DAYS,
    buyers: DataFrame | None = None,
) -> DataFrame:
    """Purchases plus session id and channel of the first, last and last non-direct session.

    `buyers` (see `purchase_days`) may come from rows that are cheaper to read than `purchases`.
    """
    states = attribution_states(
        sessions, purchase_days(purchases) if buyers is None else buyers, lookback_days
    ).withColumnRenamed("client_id_canonical", "state_client")
    # Purchases without a client match nothing; a hash as their slot spreads them over all tasks.
    at = F.unix_micros("purchase_ts")
    spread = F.xxhash64("transaction_id", "purchase_ts", "session_id")
    has_key = F.col("client_id_canonical").isNotNull() & at.isNotNull()
    timed = purchases.withColumns(
        {
            "_at": at,
            "_slot": F.when(has_key, _day_of(at)).otherwise(spread),
        }
    )
    joined = timed.join(
        states,
        (F.col("client_id_canonical") == F.col("state_client"))
        & (F.col("_slot") == F.col("day_slot"))
        & (F.col("_at") >= F.col("valid_from"))
        & (F.col("_at") < F.col("valid_to")),
        "left",
    )
    return joined.select(
        *purchases.columns,
        *[
            F.col(f"{m}.{f}").alias(f"{m}_{f}")
            for m in MODELS
            for f in ("session_id", "channel")
        ],
    )


def attributed_revenue_daily(attribution: DataFrame) -> DataFrame:
    """Revenue per model, purchase day and channel (null channel kept) from one aggregation."""
    day = F.col("purchase_ts").cast("date").cast("string").alias("purchase_day")
    pairs = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.col(f"{m}_channel").alias("channel"))
            for m in MODELS
        ]
    )
    return (
        attribution.select(day, "revenue", F.inline(pairs))
        .groupBy("model", "purchase_day", "channel")
        .agg(F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("attributed_revenue"))
    )


def attributed_revenue_for(attribution: DataFrame, model: str) -> DataFrame:
    """One model's daily revenue by channel."""
    return (
        attribution.groupBy(
            F.col("purchase_ts").cast("date").cast("string").alias("purchase_day"),
            F.col(f"{model}_channel").alias("channel"),
        )
        .agg(F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("attributed_revenue"))
    )
