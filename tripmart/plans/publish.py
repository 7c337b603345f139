"""Stage months, decide there, and publish them by one pointer.

The months are materialised into folders of their own and their mart beside them.
Everything that can refuse the publication is decided from those: counts and a content digest
observed on the write against what the files hold, the flags, and the mart's tests. Then
one small file makes silver and mart current together (``operators.published``); nothing is
copied and nothing that a reader has open changes. A month whose rows are all flagged is valid;
it has no mart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.flags import MONTH
from tripmart.lake import Lake, drop_tree, read_months
from tripmart.operators import checks, gold, published, silver


class PublishRefused(RuntimeError):
    """A check on the staged months failed; what is published is as it was."""


@dataclass(frozen=True)
class Staged:
    """Months written beside the published ones, not yet named by a pointer."""

    service: str
    version: str
    run: silver.Run
    silver_path: str
    gold_path: str


def stage(spark: SparkSession, lake: Lake, service: str, months: Sequence[str]) -> Staged:
    """Write the months and their mart into folders of a new version."""
    version = published.new_version()
    silver_path, gold_path = (published.version_folder(lake, service, t, version) for t in ("silver", "gold"))
    try:
        run = silver.materialize(spark, lake, service, months, target=silver_path, digest=published.row_digest)
        if run.flagged < run.read:  # else the mart is empty: no file, no schema to read
            gold.write_mart(gold.mart(read_months(spark, silver_path, run.months)), gold_path)
    except BaseException:
        _clear(spark, silver_path, gold_path)
        raise
    return Staged(service, version, run, silver_path, gold_path)


def _staged_mart(spark: SparkSession, staged: Staged) -> DataFrame:
    if staged.run.flagged < staged.run.read:
        return spark.read.parquet(staged.gold_path)
    return gold.mart(read_months(spark, staged.silver_path, staged.run.months))


def decide(spark: SparkSession, staged: Staged) -> tuple[list[str], dict[str, published.PublishedMonth]]:
    """(what is wrong, the months to publish), from the files that would be published.

    Checked: row conservation (D5), never-null flags (A5, observed on the write), the content
    of the files against the digest observed there, and for the mart not-null, unique grain and not
    empty (D1-D3) and trips equal to clean silver rows (D6).
    """
    run = staged.run
    rows = _staged_mart(spark, staged)
    found = [f"{flag} is null in {n} rows" for flag, n in run.null_flags.items() if n]
    # one row for each month
    held = {r[MONTH]: r for r in published.month_digests(read_months(spark, staged.silver_path, run.months)).collect()}
    if {m: held[m].filas if m in held else 0 for m in run.months} != {m: n.silver for m, n in run.by_month.items()}:
        found.append(f"the staged files hold {[(m, r.filas) for m, r in held.items()]}, {run.written} rows were written")
    if sum((r.huella for r in held.values()), 0) != run.digest:
        found.append("the staged files do not hold the rows that were written")
    found += [f"{r.prueba} {r.ejemplo}: {r.violaciones} ({r.sujetos} subjects)" for r in
              checks.violation_counts(checks.mart_violations(rows, allow_empty=run.flagged == run.read)).collect()]
    trips = {r[0]: r[1] for r in rows.groupBy(MONTH).agg(F.sum("viajes")).collect()}  # one row for each month
    if sum(trips.values()) != run.read - run.flagged:
        found.append(f"the mart counts {sum(trips.values())} trips, silver has {run.read - run.flagged} clean rows")
    months = {
        m: published.PublishedMonth(m, staged.version, staged.version if trips.get(m) else None, r.filas, trips.get(m, 0), str(r.huella))
        for m, r in held.items()
    }
    return found, months


def stage_validate_publish(spark: SparkSession, lake: Lake, service: str, months: Sequence[str]) -> silver.Run:
    """Stage the months, decide, publish. What is published changes only if every check passes."""
    staged = stage(spark, lake, service, months)
    publish(spark, lake, staged)
    return staged.run


def publish(spark: SparkSession, lake: Lake, staged: Staged) -> published.Snapshot:
    """Decide on staged months and make them current; refused months leave nothing behind.

    Folders stay if the commit itself fails, since their pointer may have been written: ``published.expire``
    removes those that no pointer names.
    """
    try:
        problems, fresh = decide(spark, staged)
        if problems:
            raise PublishRefused("; ".join(problems))
    except BaseException:
        _clear(spark, staged.silver_path, staged.gold_path)
        raise
    return published.commit(spark, lake, staged.service, lambda now: now | fresh)


def _clear(spark: SparkSession, *folders: str) -> None:
    for folder in folders:
        drop_tree(spark, folder)
