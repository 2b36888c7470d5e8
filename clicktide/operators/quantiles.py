"""Exact quantiles and histograms without gathering all values in one task.

The built-in exact `percentile` holds every distinct value in a single buffer. Here the input is counted
once by value. From those counts a first pass sums up coarse bins; running sums over spans of bins, then
within the few spans that matter, find the bins that hold a wanted rank. A second pass over the same counts,
whose exchange Spark reuses, orders only the values of those bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Width of a coarse bin in microseconds, about 17 s: a year has under 2 million bins, and one bin
# holds at most 2^24 distinct values.
BIN_BITS = 24
# Bins of a span, 4096: a year has a few hundred spans.
SPAN_BITS = 12


def exact_quantiles(
    df: DataFrame, micros: str, probabilities: tuple[float, ...], unit_micros: float
) -> DataFrame:
    """(probability, value) with linear interpolation, `micros` divided by `unit_micros`.

    Null values are left out. An empty input has no rows.
    """
    parts = _weighted(df, micros, probabilities)
    return parts.groupBy("probability").agg((F.sum("part") / F.lit(float(unit_micros))).alias("value"))


def quantile_row(df: DataFrame, micros: str, named: dict[str, float], unit_micros: float) -> DataFrame:
    """One row with a column per named probability; nulls where there is no value."""
    parts = _weighted(df, micros, tuple(named.values()))
    return parts.agg(
        *[
            (F.sum(F.when(F.col("probability") == p, F.col("part"))) / F.lit(float(unit_micros))).alias(name)
            for name, p in named.items()
        ]
    )


def _weighted(df: DataFrame, micros: str, probabilities: tuple[float, ...]) -> DataFrame:
    """(probability, part): the one or two values around each wanted position times their weights."""
    # Both passes start here and filter alike, so that the second one finds the exchange of the first.
    counted = (
        df.select(F.col(micros).cast("long").alias("v"))
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin", F.shiftright("v", BIN_BITS))
        .where(F.col("v").isNotNull() & F.col("bin").isNotNull())
    )
    # A row per span with its bins in order, at most 4096 of them.
    spans = (
        counted.groupBy("bin")
        .agg(F.sum("n").alias("n"))
        .groupBy(F.shiftright("bin", SPAN_BITS).alias("span"))
        .agg(F.sum("n").alias("span_n"), F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"))
    )
    in_order = Window.orderBy("span")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The two ranks (from 0) around each wanted position, and the bin that holds each.
    position = F.col("probability") * (F.col("total") - 1)
    wanted = F.array(*[F.lit(float(p)) for p in dict.fromkeys(probabilities)])
    ranks = (
        spans.withColumns(
            {
                "before": F.coalesce(F.sum("span_n").over(earlier), F.lit(0)),
                "total": F.sum("span_n").over(everything),
            }
        )
        .withColumn("probability", F.explode(wanted))
        .withColumn(
            "rank",
            F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))),
        )
        .where(
            (F.col("rank") >= F.col("before"))
            & (F.col("rank") < F.col("before") + F.col("span_n"))
        )
        .withColumn("found", _bin_of(F.col("bins"), F.col("rank") - F.col("before")))
        .select(
            F.col("found.bin").alias("bin"),
            "probability",
            "rank",
            (F.lit(1.0) - F.abs(position - F.col("rank"))).alias("weight"),
            (F.col("rank") - F.col("before") - F.col("found.start")).alias("rank_in_bin"),
        )
    )
    # At most two rows per probability; values of other bins drop out before anything is ordered.
    upto = Window.partitionBy("probability", "rank").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counted.join(F.broadcast(ranks), "bin")
        .withColumn("end", F.sum("n").over(upto))
        .where(
            (F.col("rank_in_bin") < F.col("end"))
            & (F.col("rank_in_bin") >= F.col("end") - F.col("n"))
        )
        .select("probability", (F.col("v") * F.col("weight")).alias("part"))
    )


def _bin_of(bins: Column, rank: Column) -> Column:
    """(bin, start): the bin that holds a rank within its span, and the rows of the span before it."""
    zero, nothing = F.lit(0).cast("long"), F.lit(None).cast("long")
    empty = F.struct(zero.alias("upto"), nothing.alias("bin"), nothing.alias("start"))

    def step(held: Column, own: Column) -> Column:
        upto = held["upto"] + own["n"]
        here = held["bin"].isNull() & (rank < upto)
        return F.struct(
            upto.alias("upto"),
            F.when(here, own["bin"]).otherwise(held["bin"]).alias("bin"),
            F.when(here, held["upto"]).otherwise(held["start"]).alias("start"),
        )

    return F.aggregate(bins, empty, step)


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are listed too.

    Columns: bin (from 1), low, high, rows. If all values are equal, they lie in the middle of a
    range one wide. An empty input has no bins.
    """
    x = F.col(value)
    present = df.where(x.isNotNull() & ~F.isnan(x)).select(x.cast("double").alias("x"))
    least, most = F.min("x"), F.max("x")
    pad = F.when(least == most, F.lit(0.5)).otherwise(F.lit(0.0))
    bounds = present.agg(F.struct((least - pad).alias("lo"), (most + pad).alias("hi")).alias("b"))
    number = F.least(F.width_bucket("x", "b.lo", "b.hi", F.lit(bins)), F.lit(bins))
    counts = (
        present.withColumn("b", bounds.scalar())
        .groupBy(number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    width = (F.col("b.hi") - F.col("b.lo")) / F.lit(float(bins))
    spine = bounds.where(F.col("b.lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))).alias("bin"), "b"
    )
    return spine.join(counts, "bin", "left").select(
        "bin",
        (F.col("b.lo") + (F.col("bin") - 1) * width).alias("low"),
        (F.col("b.lo") + F.col("bin") * width).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )
