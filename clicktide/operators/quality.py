"""Data-quality checks per daily partition, scores, decisions and cross-partition drift.

A partition is a day by default; with `scope=FILE_SCOPE` it is a file, so that two files of one day
are measured, compared and scored apart.

One scan yields every row-level measure of a partition with map-side combine. Collisions and
replays take a second aggregation over purchases, first by (partition, transaction, payload) and
then by (partition, transaction), so a hot transaction is combined before it is shuffled. Result
rows carry counts; the offending names, ids and rows are tables of their own
(`unknown_event_names`, `transaction_collisions`, `replayed_purchases`), never lists collected
into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.payload import (
    field,
    has_field,
    invalid_purchase_check,
    parse_failed,
    payload_hash,
    purchase_columns,
    with_facts,
)
from clicktide.functions.scoring import ladder, penalty, robust_z
from clicktide.functions.timing import partition_text
from clicktide.operators.purchases import purchase_events
from clicktide.operators.shaping import canonical_identity, ensure_columns, with_event_ts
from clicktide.settings import P0, P1, P2, P3, PURCHASE_EVENT, Contract

PARTITION = "partition_date"
# What a partition is: the columns that measures, checks, drift and scores are grouped by.
Scope = tuple[str, ...]
DAY_SCOPE: Scope = (PARTITION,)
FILE_SCOPE: Scope = ("source_file", PARTITION)
DRIFT_Z_FAIL = 3.5
DRIFT_Z_HIGH = 4.5


def _shaped(events: DataFrame, contract: Contract) -> DataFrame:
    known = (*contract.required_columns, *contract.identity_columns, *contract.optional_columns)
    shaped = ensure_columns(events, known)
    return with_event_ts(canonical_identity(shaped, contract.identity_columns))


def _present_columns(events: DataFrame, contract: Contract) -> Column:
    """Columns of a partition: as scanned (`source_columns`), else those holding any value."""
    if "source_columns" in events.columns:
        # One distinct array per header variant of the partition.
        return F.array_sort(F.array_distinct(F.flatten(F.collect_set("source_columns"))))
    known = (*contract.required_columns, *contract.identity_columns, *contract.optional_columns)
    present = [
        F.when(F.count(c) > 0, F.lit(c)) for c in sorted(set(known)) if c in events.columns
    ]
    return F.array_compact(F.array(*present))


def _left_join_partition(left: DataFrame, right: DataFrame, scope: Scope) -> DataFrame:
    """Join two per-partition tables; rows of files without a date are one partition."""
    renamed = right.withColumnsRenamed({c: f"_of_{c}" for c in scope})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in scope]
    return left.join(renamed, same, "left").drop(*[f"_of_{c}" for c in scope])


def partition_measures(
    events: DataFrame,
    contract: Contract = Contract(),
    partitions: DataFrame | None = None,
    scope: Scope = DAY_SCOPE,
) -> DataFrame:
    """One row per partition with every count the checks need.

    `partitions` (the scope columns, columns) may name partitions with no rows at all.
    """

    def facts(payload: Column) -> dict[str, Column]:
        p = purchase_columns(payload)
        invalid = invalid_purchase_check(
            p["transaction_id"], p["revenue"], p["has_items"], p["item_count"]
        )
        failed = parse_failed(F.col("event_data"), payload)
        return {"_failed": failed, "_invalid": invalid, "_revenue": p["revenue"]}

    shaped = with_facts(_shaped(events, contract), F.col("event_data"), facts)
    is_purchase = F.col("event_name") == PURCHASE_EVENT
    unknown = F.col("event_name").isNotNull() & ~F.col("event_name").isin(
        *contract.allowed_events
    )
    measures = {
        "rows": F.count(F.lit(1)),
        "json_failed": F.count_if("_failed"),
        "ts_failed": F.count_if(F.col("ts").isNull()),
        "ts_misaligned": F.count_if(partition_text(F.col("ts")) != F.col(PARTITION)),
        "identity_nulls": F.count_if(F.col("client_id_canonical").isNull()),
        "unknown_event_rows": F.count_if(unknown),
        "purchase_count": F.count_if(is_purchase),
        "invalid_purchases": F.count_if(is_purchase & F.col("_invalid")),
        "revenue_sum": F.sum(F.when(is_purchase, F.coalesce("_revenue", F.lit(0.0)))),
    }
    stats = shaped.groupBy(*scope).agg(
        _present_columns(events, contract).alias("columns"),
        *[c.alias(name) for name, c in measures.items()],
    )
    if partitions is not None:
        every = F.array_sort(F.array_distinct(F.flatten(F.collect_set("columns"))))
        headers = partitions.groupBy(*scope).agg(every.alias("_columns"))
        stats = _left_join_partition(headers, stats, scope).withColumn(
            "columns", F.coalesce("columns", "_columns")
        )
    counts = [name for name in measures if name != "revenue_sum"]
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in counts}
    filled["revenue_sum"] = F.coalesce(F.col("revenue_sum"), F.lit(0.0))
    rate = F.col("identity_nulls") / F.col("rows")
    return (
        stats.withColumns(filled)
        .withColumn("identity_null_rate", F.when(F.col("rows") > 0, rate).otherwise(1.0))
        .select(*scope, "columns", *measures, "identity_null_rate")
    )


def partition_profile(measures: DataFrame, scope: Scope = DAY_SCOPE) -> DataFrame:
    return measures.select(
        *scope, "rows", "columns", "identity_null_rate", "purchase_count", "revenue_sum"
    )


# --- purchase collisions and replays ----------------------------------------------


def payload_groups(events: DataFrame, scope: Scope = DAY_SCOPE) -> DataFrame:
    """Purchases counted by (partition, transaction, payload hash)."""
    rows = with_facts(
        purchase_events(events),
        F.col("event_data"),
        lambda payload: {
            "transaction_id": field(payload, "transaction_id", "string"),
            "payload_hash": payload_hash(payload),
        },
    )
    return rows.groupBy(*scope, "transaction_id", "payload_hash").agg(
        F.count(F.lit(1)).alias("copies")
    )


def _transaction_groups(events: DataFrame, scope: Scope) -> DataFrame:
    return (
        payload_groups(events, scope)
        .groupBy(*scope, "transaction_id")
        .agg(
            F.count(F.lit(1)).alias("payloads"),
            F.sum("copies").alias("purchase_rows"),
            F.sum(F.when(F.col("copies") > 1, F.col("copies")).otherwise(0)).alias("replay_rows"),
        )
    )


def transaction_collisions(events: DataFrame, scope: Scope = DAY_SCOPE) -> DataFrame:
    """Transaction ids used for more than one payload within a partition."""
    return (
        _transaction_groups(events, scope)
        .where(F.col("transaction_id").isNotNull() & (F.col("payloads") > 1))
        .select(*scope, "transaction_id", "payloads", "purchase_rows")
    )


def replayed_purchases(events: DataFrame, scope: Scope = DAY_SCOPE) -> DataFrame:
    """(Transaction, payload) pairs seen more than once in a partition; a null id is a value."""
    return payload_groups(events, scope).where(F.col("copies") > 1)


def duplicate_measures(events: DataFrame, scope: Scope = DAY_SCOPE) -> DataFrame:
    """Collision and replay counts per partition."""
    collided = F.col("transaction_id").isNotNull() & (F.col("payloads") > 1)
    return (
        _transaction_groups(events, scope)
        .groupBy(*scope)
        .agg(
            F.count_if(collided).alias("collision_count"),
            F.sum("replay_rows").alias("replay_event_rows"),
        )
    )


def unknown_event_names(
    events: DataFrame, contract: Contract = Contract(), scope: Scope = DAY_SCOPE
) -> DataFrame:
    """Event names outside the contract, with their row counts."""
    return (
        events.where(
            F.col("event_name").isNotNull() & ~F.col("event_name").isin(*contract.allowed_events)
        )
        .groupBy(*scope, "event_name")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def payload_contract(
    events: DataFrame, contract: Contract = Contract(), scope: Scope = DAY_SCOPE
) -> DataFrame:
    """Events whose payload lacks a required field, per partition, event name and field."""
    asked = sorted({f for fields in contract.payload_requirements.values() for f in fields})
    rows = with_facts(
        events.where(F.col("event_name").isin(*contract.payload_requirements)),
        F.col("event_data"),
        lambda payload: {f"_has_{k}": has_field(payload, f) for k, f in enumerate(asked)},
    )
    checks = [
        F.struct(
            F.lit(required).alias("field"),
            (~F.col(f"_has_{asked.index(required)}")).alias("missing"),
            F.lit(name).alias("required_for"),
        )
        for name, fields in contract.payload_requirements.items()
        for required in fields
    ]
    return (
        rows.select(*scope, "event_name", F.inline(F.array(*checks)))
        .where(F.col("event_name") == F.col("required_for"))
        .groupBy(*scope, "event_name", "field")
        .agg(F.count(F.lit(1)).alias("events"), F.count_if("missing").alias("missing"))
    )


# --- check results ----------------------------------------------------------------


def _result(
    check_id: str, description: str, severity: Column | str, passed: Column, measure: Column, **details
) -> Column:
    return F.struct(
        F.lit(check_id).alias("check_id"),
        F.lit(description).alias("description"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        passed.alias("passed"),
        measure.cast("double").alias("measure"),
        F.to_json(F.struct(*[c.alias(k) for k, c in details.items()])).alias("details"),
    )


def _strings(values: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


# Ids in the order of the results.
ROW_CHECKS = (
    "schema.required_columns_present",
    "schema.identity_column_present",
    "schema.unknown_event_names",
    "integrity.event_data_json_parse_rate",
    "integrity.timestamp_parse_and_partition_alignment",
    "schema.referrer_column_present",
    "tracking.identity_null_rate",
)
NO_PURCHASES = "purchase.integrity.no_purchases"
PURCHASE_CHECKS = (
    "purchase.integrity.required_fields_and_positive_revenue",
    "purchase.transaction_id_collision",
    "purchase.transaction_id_replay_duplicates",
)
# Checks that compare purchases with each other.
DUPLICATE_CHECKS = PURCHASE_CHECKS[1:]


def _row_checks(contract: Contract, scanned: bool | None = None) -> dict[str, Column]:
    """Checks of a partition's own rows by id; `scanned` says where the column names come from."""
    cols, rows = F.col("columns"), F.col("rows")
    source = {None: None, True: "file header", False: "columns holding any value"}[scanned]
    origin = {} if source is None else {"columns_from": F.lit(source)}

    def rate(count: str) -> Column:
        return F.when(rows > 0, F.col(count) / rows).otherwise(0.0)

    missing = F.array_except(_strings(contract.required_columns), cols)
    present = F.array_intersect(_strings(contract.identity_columns), cols)
    json_rate, ts_rate, off_rate = rate("json_failed"), rate("ts_failed"), rate("ts_misaligned")
    null_rate = F.col("identity_null_rate")
    has_data = F.array_contains(cols, "event_data")
    has_time = F.array_contains(cols, "timestamp")
    has_referrer = F.array_contains(cols, "referrer")
    checks = [
        _result(
            "schema.required_columns_present",
            "Required base columns are present",
            P0,
            F.size(missing) == 0,
            F.size(missing),
            missing_columns=missing,
            present_columns=cols,
            **origin,
        ),
        _result(
            "schema.identity_column_present",
            "At least one identity column is present",
            P0,
            F.size(present) > 0,
            F.size(present),
            identity_columns=_strings(contract.identity_columns),
            present=present,
            **origin,
        ),
        _result(
            "schema.unknown_event_names",
            "All event names are in the contract",
            P2,
            F.col("unknown_event_rows") == 0,
            F.col("unknown_event_rows"),
            unknown_event_rows=F.col("unknown_event_rows"),
            allowed=_strings(tuple(sorted(contract.allowed_events))),
        ),
        _result(
            "integrity.event_data_json_parse_rate",
            "At most 1% of payloads fail to parse",
            ladder((~has_data, P0), (json_rate > 0.02, P1), (json_rate > 0.01, P2), default=P3),
            has_data & (json_rate <= 0.01),
            json_rate,
            fail_rate=json_rate,
            fail_count=F.col("json_failed"),
            total=rows,
        ),
        _result(
            "integrity.timestamp_parse_and_partition_alignment",
            "Timestamps parse and fall on the partition date, small spill-over aside",
            ladder(
                (~has_time | (ts_rate > 0.01) | (off_rate > 0.10), P0),
                (off_rate > 0.05, P1),
                (ts_rate > 0, P2),
                default=P3,
            ),
            has_time & (ts_rate <= 0.01) & (off_rate <= 0.05),
            off_rate,
            parse_fail_rate=ts_rate,
            mismatch_rate=off_rate,
            rows=rows,
        ),
        _result(
            "schema.referrer_column_present",
            "The referrer column is present",
            P1,
            has_referrer,
            has_referrer.cast("int"),
            present=has_referrer,
            **origin,
        ),
        _result(
            "tracking.identity_null_rate",
            "At most 10% of events lack an identity",
            ladder((null_rate > 0.10, P1), (null_rate > 0.02, P2), default=P3),
            null_rate <= 0.10,
            null_rate,
            null_rate=null_rate,
            null_count=F.col("identity_nulls"),
            total=rows,
        ),
    ]
    return dict(zip(ROW_CHECKS, checks, strict=True))


def _purchase_checks(wanted: set[str]) -> Column | None:
    """The wanted purchase checks: one row for a partition without purchases, else one for each."""
    purchases, invalid = F.col("purchase_count"), F.col("invalid_purchases")
    nothing = F.lit(0)
    collisions = F.col("collision_count") if DUPLICATE_CHECKS[0] in wanted else nothing
    replays = F.col("replay_event_rows") if DUPLICATE_CHECKS[1] in wanted else nothing
    none = _result(
        "purchase.integrity.no_purchases",
        "No purchases in the partition",
        P3,
        F.lit(True),
        F.lit(0),
        purchase_events=purchases,
    )
    some = [
        _result(
            "purchase.integrity.required_fields_and_positive_revenue",
            "Purchases have a transaction id, revenue above 0 and items",
            ladder((invalid > 0, P1), default=P3),
            invalid == 0,
            invalid,
            invalid_count=invalid,
            invalid_rate=F.try_divide(invalid, purchases),
            purchase_events=purchases,
        ),
        _result(
            "purchase.transaction_id_collision",
            "No transaction id is used for different payloads",
            P0,
            collisions == 0,
            collisions,
            collision_count=collisions,
        ),
        _result(
            "purchase.transaction_id_replay_duplicates",
            "No purchase is sent twice with the same id and payload",
            P1,
            replays == 0,
            replays,
            replay_event_rows=replays,
        ),
    ]
    chosen = [c for name, c in zip(PURCHASE_CHECKS, some, strict=True) if name in wanted]
    if NO_PURCHASES not in wanted:
        return F.when(purchases > 0, F.array(*chosen)) if chosen else None
    listed = F.array(*chosen) if chosen else F.slice(F.array(none), 1, 0)
    return F.when(purchases == 0, F.array(none)).otherwise(listed)


def check_results(
    measures: DataFrame,
    duplicates: DataFrame | None,
    contract: Contract = Contract(),
    checks: tuple[str, ...] | None = None,
    scanned: bool | None = None,
    scope: Scope = DAY_SCOPE,
) -> DataFrame:
    """The checks (all by default) of all partitions, one row each.

    `duplicates` may be None where no check of DUPLICATE_CHECKS is wanted. Measures that no wanted
    check reads are never computed.
    """
    wanted = set(checks if checks is not None else (*ROW_CHECKS, NO_PURCHASES, *PURCHASE_CHECKS))
    joined = measures
    if duplicates is not None:
        joined = _left_join_partition(measures, duplicates, scope).fillna(
            0, subset=["collision_count", "replay_event_rows"]
        )
    parts = [c for name, c in _row_checks(contract, scanned).items() if name in wanted]
    rows = [F.array(*parts)] if parts else []
    bought = _purchase_checks(wanted)
    if bought is not None:
        rows.append(bought)
    return joined.select(*scope, F.inline(F.concat(*rows)))


def run_all_checks(
    events: DataFrame,
    contract: Contract = Contract(),
    partitions: DataFrame | None = None,
    measures: DataFrame | None = None,
    checks: tuple[str, ...] | None = None,
    scope: Scope = DAY_SCOPE,
) -> DataFrame:
    """All checks, or only the named ones with just the work that they need."""
    if measures is None:
        measures = partition_measures(events, contract, partitions, scope)
    compared = checks is None or bool(set(checks) & set(DUPLICATE_CHECKS))
    duplicates = duplicate_measures(events, scope) if compared else None
    return check_results(
        measures, duplicates, contract, checks, "source_columns" in events.columns, scope
    )


def score_partitions(results: DataFrame, scope: Scope = DAY_SCOPE) -> DataFrame:
    """Score (100 minus the weights of failed checks, at least 0), decision and failed counts."""
    failed = ~F.col("passed")

    def failed_at(severity: str) -> Column:
        return F.count_if(failed & (F.col("severity") == severity))

    return (
        results.groupBy(*scope)
        .agg(
            F.greatest(
                F.lit(0), F.lit(100) - F.sum(penalty(F.col("severity"), F.col("passed")))
            ).alias("dq_score"),
            F.count_if(failed).alias("failed"),
            failed_at(P0).alias("p0_failed"),
            failed_at(P1).alias("p1_failed"),
            failed_at(P2).alias("p2_failed"),
        )
        .select(
            *scope,
            "dq_score",
            ladder(
                (F.col("p0_failed") > 0, "QUARANTINE"), (F.col("failed") > 0, "WARN"), default="PASS"
            ).alias("decision"),
            "failed",
            "p0_failed",
            "p1_failed",
            "p2_failed",
        )
    )


# --- drift over partitions (one row per day, so unpartitioned windows stay small) ---


def identity_drift(profile: DataFrame, scope: Scope = DAY_SCOPE) -> DataFrame:
    """Robust z of each partition's identity null rate against all partitions."""
    everything = Window.partitionBy(F.lit(1))
    rate = F.col("identity_null_rate")
    z = robust_z(rate, F.col("_med"), F.median("_dev").over(everything))
    return (
        profile.withColumn("_med", F.median("identity_null_rate").over(everything))
        .withColumn("_dev", F.abs(rate - F.col("_med")))
        .select(*scope, "identity_null_rate", z.alias("robust_z"))
        .select(
            *scope,
            F.lit("drift.identity_null_rate_robust_z").alias("check_id"),
            ladder(
                (F.abs("robust_z") > DRIFT_Z_HIGH, P1),
                (F.abs("robust_z") > DRIFT_Z_FAIL, P2),
                default=P3,
            ).alias("severity"),
            (F.abs("robust_z") <= DRIFT_Z_FAIL).alias("passed"),
            "robust_z",
            "identity_null_rate",
        )
    )


def schema_drift(
    profile: DataFrame, contract: Contract = Contract(), scope: Scope = DAY_SCOPE
) -> DataFrame:
    """Columns added, removed or critically missing against the previous partition.

    Partitions follow each other by date, files of one date by name.
    """
    by_date = Window.partitionBy(F.lit(1)).orderBy(PARTITION, *[c for c in scope if c != PARTITION])
    cols, prev = F.col("columns"), F.col("_prev")
    missing = F.array_sort(F.array_except(_strings(contract.required_columns), cols))
    return (
        profile.withColumn("_prev", F.lag("columns").over(by_date))
        .withColumn("prev_date", F.lag(PARTITION).over(by_date))
        .where(F.col("prev_date").isNotNull())
        .select(
            *scope,
            F.lit("drift.schema_removed_or_missing_critical").alias("check_id"),
            "prev_date",
            F.array_sort(F.array_except(prev, cols)).alias("removed_columns"),
            F.array_sort(F.array_except(cols, prev)).alias("added_columns"),
            missing.alias("missing_critical"),
        )
        .withColumn("passed", F.size("missing_critical") == 0)
        .withColumn(
            "severity",
            ladder((~F.col("passed"), P0), (F.size("removed_columns") > 0, P1), default=P3),
        )
    )


def drift_results(
    profile: DataFrame, contract: Contract = Contract(), scope: Scope = DAY_SCOPE
) -> DataFrame:
    """Both drift checks as rows (partition, check, severity, passed, details)."""
    identity = identity_drift(profile, scope).select(
        *scope,
        "check_id",
        "severity",
        "passed",
        F.to_json(F.struct("robust_z", "identity_null_rate")).alias("details"),
    )
    schema = schema_drift(profile, contract, scope).select(
        *scope,
        "check_id",
        "severity",
        "passed",
        F.to_json(
            F.struct("removed_columns", "added_columns", "missing_critical", "prev_date")
        ).alias("details"),
    )
    return identity.unionByName(schema)


def failed_signals(drift: DataFrame) -> DataFrame:
    """The drift results that failed, the cross-partition signals of a report."""
    return drift.where(~F.col("passed"))


def quality_rollup(scores: DataFrame) -> DataFrame:
    """One row: partitions, failed checks, P0 blockers, mean score, days with a P0."""
    return scores.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed_checks"),
        F.coalesce(F.sum("p0_failed"), F.lit(0)).alias("p0_blockers"),
        F.coalesce(F.round(F.avg("dq_score"), 1), F.lit(0.0)).alias("mean_score"),
        F.count_if(F.col("p0_failed") > 0).alias("p0_days"),
    )


def blocked_partitions(scores: DataFrame, scope: Scope = DAY_SCOPE) -> DataFrame:
    """Partitions that were quarantined or hold a failed blocker."""
    return scores.where((F.col("decision") == "QUARANTINE") | (F.col("p0_failed") > 0)).select(
        *scope, "dq_score", "decision", "p0_failed"
    )
