"""Token counts from an exact length histogram.

The corpus is reduced to (encoded length, documents). Suffix sums over the distinct lengths then
answer totals, quantiles and the tokens left by any context limit, without a second pass.

Null texts count as empty; an empty table gives an empty histogram. Every row counts, repeated rows
and null ids included; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktide.llm import tokens

#: Lengths of a band share one window; the sums of whole bands come from a second, small window.
BAND = 1024


def length_histogram(documents: DataFrame, tokenizer: str, text: str = "text", extra_ids: int = 0) -> DataFrame:
    """(length, n_docs): how many documents encode to how many ids.

    Each task counts the lengths of its own blocks, so the shuffle holds a row per length and block at
    most. `extra_ids` are added to every document (begin or end ids).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, sizes in tokens.encoded(batches, tokenizer, 0):
            length, docs = np.unique(sizes + extra_ids, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(length, pa.int64()), pa.array(docs, pa.int64())], ["length", "n_docs"]
            )

    counted = documents.select(F.col(text).alias("text")).mapInArrow(count, "length long, n_docs long")
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """A row per distinct length, read as a context limit.

    n_docs, n_tokens: documents of just this length and their ids. docs_ge, tokens_ge: of this length or
    longer (suffix sums; at the smallest length the totals). truncated_total: ids left when documents are
    cut at this length. share_le: part of the documents that fit, the length's upper quantile.
    """
    own = histogram.withColumns(
        {"n_tokens": F.col("length") * F.col("n_docs"), "band": F.floor(F.col("length") / BAND)}
    )
    whole = own.groupBy("band").agg(F.sum("n_docs").alias("band_docs"), F.sum("n_tokens").alias("band_tokens"))
    above = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    bands = whole.select(
        "band",
        F.coalesce(F.sum("band_docs").over(above), zero).alias("docs_above"),
        F.coalesce(F.sum("band_tokens").over(above), zero).alias("tokens_above"),
        F.sum("band_docs").over(everything).alias("all_docs"),
        F.sum("band_tokens").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("band").orderBy(F.desc("length"))
    summed = own.join(bands, "band").select(
        "length",
        "n_docs",
        "n_tokens",
        (F.sum("n_docs").over(inside) + F.col("docs_above")).alias("docs_ge"),
        (F.sum("n_tokens").over(inside) + F.col("tokens_above")).alias("tokens_ge"),
        "all_docs",
        "all_tokens",
    )
    below = F.col("all_tokens") - F.col("tokens_ge")
    fit = F.col("all_docs") - F.col("docs_ge") + F.col("n_docs")
    return summed.select(
        "length",
        "n_docs",
        "n_tokens",
        "docs_ge",
        "tokens_ge",
        (below + F.col("length") * F.col("docs_ge")).alias("truncated_total"),
        (fit / F.col("all_docs")).alias("share_le"),
    )


def truncated_totals(table: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, truncated_total) for any limits, also between the lengths that occur."""
    spark = table.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in limits], "context_limit long")
    parts = table.select(
        F.explode(F.array([F.lit(int(x)).cast("long") for x in limits])).alias("context_limit"),
        (F.least("length", "context_limit") * F.col("n_docs")).alias("kept"),
    )
    summed = parts.groupBy("context_limit").agg(F.sum("kept").alias("truncated_total"))
    return asked.join(summed, "context_limit", "left").fillna(0, ["truncated_total"])


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that so large a part of the documents does not exceed."""
    found = [F.min(F.when(F.col("share_le") >= share, F.col("length"))).alias(f"q{k}") for k, share in enumerate(shares)]
    answers = table.agg(*found)
    pairs = [F.struct(F.lit(float(share)).alias("share"), F.col(f"q{k}").alias("length")) for k, share in enumerate(shares)]
    return answers.select(F.inline(F.array(pairs)))
