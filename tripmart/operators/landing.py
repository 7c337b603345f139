"""Incremental landing, decided as set operations over file listings.

A source listing ``(key, status, etag, declared_size)`` is joined with the ledger
of what was landed ``(key, etag, size, landed_at)``. Precedence per key:
excused status, error status, no declared size, then marker comparison. The
transfer itself (HTTP, object store) is not part of this library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.flags import MONTH
from tripmart.lake import list_dirs, path_exists

# --- Fixed values: outcome names ---------------------------------------------
DOWNLOADED = "descargado"
ALREADY_PRESENT = "ya_presente"
REVISION = "revision"
NOT_AVAILABLE = "no_disponible"
ERROR = "error"
# Statuses that mean "not published" for monthly trip files; other sources
# (the zone catalogue) excuse none, which is the default.
TRIPS_NOT_PUBLISHED = (403, 404)
# ---------------------------------------------------------------------------
# How an object differs from the last listing.
NEW, CHANGED, REMOVED = "nuevo", "cambiado", "quitado"
LISTING_SCHEMA = "key string, length bigint, modified timestamp, cambio string, gone boolean"
LEDGER_SCHEMA = "key string, etag string, size bigint, landed_at timestamp_ntz"


def _isin(col: Column, values: Sequence[int]) -> Column:
    return col.isin(list(values)) if values else F.lit(False)


def source_marker(etag: Column) -> Column:
    """The marker as recorded: surrounding quotes stripped, an absent one empty."""
    return F.coalesce(F.regexp_replace(etag, r'^"+|"+$', ""), F.lit(""))


def classify(
    listing: DataFrame,
    ledger: DataFrame,
    forced: bool = False,
    excused: Sequence[int] = (),
) -> DataFrame:
    """One outcome per listed key.

    A key absent from the ledger has no marker and is downloaded; the same marker
    is already present; a different one is a revision. ``forced`` downloads every
    key that passed the status and size checks.
    """
    recorded = ledger.select(F.col("key"), F.col("etag").alias("recorded_etag"))
    joined = listing.withColumn("etag", source_marker(F.col("etag"))).join(recorded, "key", "left")
    status, size, etag, rec = (F.col(c) for c in ("status", "declared_size", "etag", "recorded_etag"))
    outcome = (
        F.when(_isin(status, excused), F.lit(NOT_AVAILABLE))
        .when(status >= 400, F.lit(ERROR))
        .when(size.isNull(), F.lit(ERROR))
        .when(rec.isNull() | F.lit(forced), F.lit(DOWNLOADED))
        .when(rec == etag, F.lit(ALREADY_PRESENT))
        .otherwise(F.lit(REVISION))
    )
    reason = (
        F.when(_isin(status, excused), F.lit(None).cast("string"))
        .when(status >= 400, F.concat(F.lit("status "), status.cast("string")))
        .when(size.isNull(), F.lit("no declared size"))
    )
    return joined.select(*listing.columns, "recorded_etag", outcome.alias("resultado"), reason.alias("motivo"))


def outcome_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("resultado").agg(F.count(F.lit(1)).alias("n"))


def verify_sizes(classified: DataFrame, landed: DataFrame) -> DataFrame:
    """Of the keys to transfer, accept only those whose landed length equals the
    declared size; the rest are errors and never reach the final key."""
    to_land = classified.where(F.col("resultado").isin(DOWNLOADED, REVISION))
    joined = to_land.join(landed.select("key", "length"), "key", "left")
    complete = F.coalesce(F.col("length") == F.col("declared_size"), F.lit(False))
    return joined.select(
        "key",
        "etag",
        "declared_size",
        "length",
        "resultado",
        complete.alias("completo"),
    )


def verify_changed(classified: DataFrame, changes: DataFrame) -> DataFrame:
    """L5 for what arrived since the last listing: ``changes`` of ``listing_changes``.

    A key without a new or changed file is left out: it was checked when it arrived.
    """
    arrived = changes.where(F.col("cambio") != REMOVED)
    return verify_sizes(classified.join(arrived.select("key"), "key", "left_semi"), arrived)


def listing_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """(key, length, modified, cambio, gone): the objects of two listings that differ.

    An object is the same if its length and its modification time are; a rewritten one of
    equal length has a later time. ``gone`` marks objects that are listed no more.
    """
    old = before.select(F.col("key"), F.col("length").alias("old_length"), F.col("modified").alias("old_modified"),
                        F.lit(True).alias("known"))
    both = now.select("key", "length", "modified", F.lit(True).alias("listed")).join(old, "key", "full_outer")
    same = F.col("length").eqNullSafe(F.col("old_length")) & F.col("modified").eqNullSafe(F.col("old_modified"))
    change = (
        F.when(F.col("known").isNull(), NEW).when(F.col("listed").isNull(), REMOVED).when(~same, CHANGED)
    )
    return both.select("key", "length", "modified", change.alias("cambio"), F.col("listed").isNull().alias("gone")).where(
        F.col("cambio").isNotNull()
    )


def accepted(verified: DataFrame, landed_at: Column | None = None) -> DataFrame:
    """The ledger entries of accepted transfers: the *source* marker and the declared size."""
    landed_at = F.current_timestamp().cast("timestamp_ntz") if landed_at is None else landed_at
    return verified.where(F.col("completo")).select(
        "key", "etag", F.col("declared_size").alias("size"), landed_at.alias("landed_at")
    )


def next_ledger(ledger: DataFrame, verified: DataFrame, landed_at: Column | None = None) -> DataFrame:
    """The new ledger version: old entries of untouched keys plus accepted transfers."""
    new = accepted(verified, landed_at)
    kept = ledger.join(new.select("key"), "key", "left_anti")
    return kept.unionByName(new)


def ledger_versions(spark: SparkSession, root: str) -> list[int]:
    """Committed ledger versions (``v=N`` folders holding a ``_SUCCESS`` marker)."""
    names = list_dirs(spark, f"{root.rstrip('/')}/v=*") or []
    versions = []
    for name in names:
        n = name.split("=", 1)[1]
        if n.isdigit() and path_exists(spark, f"{root.rstrip('/')}/{name}/_SUCCESS"):
            versions.append(int(n))
    return sorted(versions)


def current_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The latest committed ledger version, or an empty ledger."""
    versions = ledger_versions(spark, root)
    if not versions:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.parquet(f"{root.rstrip('/')}/v={versions[-1]}")


def write_ledger_version(spark: SparkSession, ledger: DataFrame, root: str) -> int:
    """Write ``ledger`` as the next version; earlier versions stay as they are, so a
    reader of the current version is never disturbed and history is kept."""
    versions = ledger_versions(spark, root)
    version = (versions[-1] + 1) if versions else 1
    ledger.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/v={version}")
    return version


def _month_date(col: Column) -> Column:
    return F.to_date(F.concat(col, F.lit("-01")))


def pending_months(published: DataFrame, landed: DataFrame, months_past_last: int = 0) -> DataFrame:
    """Months to fetch in a backfill range, stopping at the first unpublished one.

    The range runs from the first published month to ``months_past_last`` months
    after the last one; months already landed are skipped. Everything stays in
    the plan (``sequence`` over the range bounds, anti join with the ledger).
    """
    bounds = published.agg(F.min(MONTH).alias("first"), F.max(MONTH).alias("last"))
    expected = bounds.select(
        F.explode(
            F.sequence(
                _month_date(F.col("first")),
                F.add_months(_month_date(F.col("last")), months_past_last),
                F.expr("INTERVAL 1 MONTH"),
            )
        ).alias("d")
    ).select(F.date_format("d", "yyyy-MM").alias(MONTH))
    unpublished = expected.join(published, MONTH, "left_anti")
    first_gap = unpublished.select(F.min(MONTH)).scalar()
    in_range = expected.where(F.col(MONTH) < F.coalesce(first_gap, F.lit("9999-12")))
    return in_range.join(landed.select(MONTH), MONTH, "left_anti")
