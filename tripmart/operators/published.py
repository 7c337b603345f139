"""Published months: immutable month folders and one pointer that says which are current.

A publication writes its months into folders of their own, ``<table>/v=<run>/mes=YYYY-MM``,
which nobody reads yet. It becomes visible by one small file, ``current/<N>.json``: a line for each
month with the folders of its silver rows and its mart, their counts and a digest. The file is written
aside and renamed to its number, which fails if that number exists, so of two publishers
one starts again from the other's months. A reader resolves the highest number once and sees silver
and mart of that publication alone, however long it reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.flags import MONTH
from tripmart.lake import Lake, drop_tree, file_names, list_dirs, put_once, read_text

VERSION = "v"


class NothingPublished(RuntimeError):
    """No publication has been committed for the service."""


class Contended(RuntimeError):
    """Other publishers were first, again and again."""


@dataclass(frozen=True)
class PublishedMonth:
    """One month of a publication. ``gold`` is None where no trip of the month is clean."""

    mes: str
    silver: str
    gold: str | None
    filas: int
    viajes: int
    huella: str


@dataclass(frozen=True)
class Snapshot:
    number: int
    months: dict[str, PublishedMonth]


def root(lake: Lake, service: str) -> str:
    return lake.published(service)


def new_version() -> str:
    return f"r{uuid.uuid4().hex[:16]}"  # a letter first: never read as a number


def version_folder(lake: Lake, service: str, table: str, version: str) -> str:
    return f"{root(lake, service)}/{table}/{VERSION}={version}"


def row_digest(columns: list[str]) -> Column:
    """The hash of a row, as a number whose sum does not depend on the order of rows."""
    return F.xxhash64(*[F.col(c) for c in sorted(columns)]).cast("decimal(38,0)")


def month_digests(rows: DataFrame) -> DataFrame:
    """(mes, filas, huella): count and sum of the row hashes of each month."""
    return rows.groupBy(MONTH).agg(F.count(F.lit(1)).alias("filas"), F.sum(row_digest(rows.columns)).alias("huella"))


def _pointers(spark: SparkSession, lake: Lake, service: str) -> list[int]:
    names = file_names(spark, f"{root(lake, service)}/current/*.json") or []
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _pointer(lake: Lake, service: str, number: int) -> str:
    return f"{root(lake, service)}/current/{number:012d}.json"


def snapshot(spark: SparkSession, lake: Lake, service: str, number: int | None = None) -> Snapshot:
    """The months of the current publication, or of an earlier one by its number."""
    if number is None:
        found = _pointers(spark, lake, service)
        if not found:
            return Snapshot(0, {})
        number = found[-1]
    lines = read_text(spark, _pointer(lake, service, number)).splitlines()
    return Snapshot(number, {m.mes: m for m in (PublishedMonth(**json.loads(line)) for line in lines)})


def commit(
    spark: SparkSession, lake: Lake, service: str, change: Callable[[dict[str, PublishedMonth]], dict[str, PublishedMonth]],
    attempts: int = 20,
) -> Snapshot:
    """Make ``change(months)`` the current months; if another publication comes first, of its months."""
    for _ in range(attempts):
        now = snapshot(spark, lake, service)
        months = change(now.months)
        text = "".join(json.dumps(asdict(months[m])) + "\n" for m in sorted(months))
        if put_once(spark, _pointer(lake, service, now.number + 1), text):
            return Snapshot(now.number + 1, months)
    raise Contended(f"{attempts} publications of {service} came first")


def _read(spark: SparkSession, lake: Lake, service: str, table: str, at: Snapshot, months) -> DataFrame:
    wanted = sorted(at.months if months is None else months)
    versions = {m: getattr(at.months[m], table) for m in wanted if m in at.months}
    paths = [f"{version_folder(lake, service, table, v)}/{MONTH}={m}" for m, v in versions.items() if v]
    if not paths:
        raise NothingPublished(f"no month of {table} for {service} in publication {at.number}")
    return spark.read.option("basePath", f"{root(lake, service)}/{table}").parquet(*paths).drop(VERSION)


def silver_rows(spark: SparkSession, lake: Lake, service: str, at: Snapshot | None = None, months=None) -> DataFrame:
    """Silver of a publication (the current one); only the folders of the months wanted are listed."""
    return _read(spark, lake, service, "silver", at or snapshot(spark, lake, service), months)


def mart_rows(spark: SparkSession, lake: Lake, service: str, at: Snapshot | None = None, months=None) -> DataFrame:
    """The mart of a publication, of the same months as its silver."""
    return _read(spark, lake, service, "gold", at or snapshot(spark, lake, service), months)


def damaged_months(spark: SparkSession, lake: Lake, service: str, at: Snapshot | None = None) -> DataFrame:
    """(mes, filas, filas_publicadas): months whose files no longer hold what was published."""
    at = at or snapshot(spark, lake, service)
    known = spark.createDataFrame(
        [(m.mes, m.filas, m.huella) for m in at.months.values()], f"{MONTH} string, filas_publicadas bigint, publicada string"
    )
    found = month_digests(silver_rows(spark, lake, service, at))
    differs = ~(F.col("filas").eqNullSafe(F.col("filas_publicadas")) & F.col("huella").cast("string").eqNullSafe(F.col("publicada")))
    return known.join(found, MONTH, "left").where(differs).select(MONTH, F.coalesce("filas", F.lit(0)).alias("filas"), "filas_publicadas")


def expire(spark: SparkSession, lake: Lake, service: str, keep: int = 10) -> list[str]:
    """Remove folders that none of the last ``keep`` publications names; their pointers stay readable.

    Run it when no publication is under way: folders not yet named by a pointer go as well.
    """
    if keep < 1:
        raise ValueError("the current publication cannot expire")
    used = {
        (table, getattr(m, table)) for n in _pointers(spark, lake, service)[-keep:]
        for m in snapshot(spark, lake, service, n).months.values() for table in ("silver", "gold")
    }
    gone = []
    for table in ("silver", "gold"):
        for name in list_dirs(spark, f"{root(lake, service)}/{table}/{VERSION}=*") or []:
            if (table, name.split("=", 1)[1]) not in used:
                drop_tree(spark, f"{root(lake, service)}/{table}/{name}")
                gone.append(f"{table}/{name}")
    return sorted(gone)
