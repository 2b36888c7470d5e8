"""Table readers and writers, the contract and quality results."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.settings import Contract

# Rows that only make a partition exist, so that an overwrite replaces it.
_MARKER = "is_marker"


def read_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A stored table; CSV keeps its header and reads every column as text."""
    reader = spark.read
    if format == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.format(format).load(path)


def write_by_partition(
    df: DataFrame,
    path: str,
    *partitions: str,
    format: str = "parquet",
    replace: str = "table",
) -> str:
    """Write one folder per partition value, by default per day.

    `replace="table"` writes the whole table anew; `replace="days"` only the partitions that `df`
    holds rows of, so that a day can be run again while the others stay. `rebalance` keeps files
    sensible: small days make few, a hot day is cut into several.
    """
    if replace not in ("table", "days"):
        raise ValueError(f"replace is 'table' or 'days', not {replace!r}")
    keys = partitions or ("partition_date",)
    mode = {"table": "static", "days": "dynamic"}[replace]
    writer = df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(*keys).format(format).save(path)
    return path


def read_by_partition(
    spark: SparkSession, path: str, partition: str = "partition_date"
) -> DataFrame:
    """A table of `write_by_partition`, its partition value as text."""
    return spark.read.parquet(path).withColumn(partition, F.col(partition).cast("string"))


def write_table(df: DataFrame, path: str, format: str = "parquet") -> str:
    writer = df.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """Rows as JSON lines (results, manifest, reconciliation, alerts)."""
    df.write.mode("overwrite").json(path)
    return path


def store_annotated(annotated: DataFrame, path: str, replace: str = "table") -> DataFrame:
    """Write clean and quarantined rows in one pass, as `status=clean|quarantine` by day.

    Returns the stored table; `cleaned` and `quarantined` of it read only their own folders when
    `status` is filtered. `replace="days"` leaves the days that `annotated` does not hold as they
    are. A day run again replaces both of its sides: each day holds a marker of the side that it has
    no rows of, so no old quarantine stays behind.
    """
    status = F.when(F.col("quarantine_reason").isNull(), "clean").otherwise("quarantine")
    rows = annotated.withColumn("status", status).withColumn(_MARKER, F.lit(False))
    if replace == "days":
        days = annotated.select("partition_date").distinct()
        sides = days.withColumn("status", F.explode(F.array(F.lit("clean"), F.lit("quarantine"))))
        marks = sides.withColumn(_MARKER, F.lit(True))
        rows = rows.unionByName(marks, allowMissingColumns=True)
    write_by_partition(rows, path, "status", "partition_date", replace=replace)
    stored = read_by_partition(annotated.sparkSession, path)
    return stored.where(~F.col(_MARKER)).drop(_MARKER)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: a cut in the lineage that survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_contract(spark: SparkSession, path: str | None = None) -> Contract:
    """The contract document at `path`, or the default when there is none."""
    if path is None:
        return Contract()
    try:
        text = spark.read.text(path, wholetext=True).select("value").first()
    except AnalysisException:
        return Contract()
    if text is None:
        return Contract()
    doc = json.loads(text.value)
    default = Contract()
    requirements = {
        name: tuple(rule.get("required_fields", ()))
        for name, rule in doc.get("event_data_requirements", {}).items()
    }
    return Contract(
        required_columns=tuple(doc.get("required_base_columns", ())),
        identity_columns=tuple(doc.get("identity_columns", default.identity_columns)),
        optional_columns=tuple(doc.get("optional_columns", default.optional_columns)),
        allowed_events=tuple(doc.get("allowed_events", ())),
        payload_requirements=requirements,
    )


def load_quality_scores(
    spark: SparkSession, path: str | None, dated_only: bool = False
) -> DataFrame | None:
    """Stored partition scores with `day`, or None when they are absent, unreadable or empty.

    Partitions without a date have a null day and count in the monitoring roll-up; `dated_only`
    leaves them out, as the analysis by day does.
    """
    if path is None:
        return None
    try:
        scores = spark.read.json(path)
        needed = {"partition_date", "dq_score", "p0_failed"}
        if not needed <= set(scores.columns):
            return None
    except AnalysisException:
        return None
    text = F.col("partition_date").cast("string")
    iso = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    scores = scores.withColumn("day", iso.try_cast("date").cast("string"))
    if dated_only:
        scores = scores.where(F.col("day").isNotNull())
    return None if scores.isEmpty() else scores
