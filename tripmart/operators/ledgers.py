"""Keyed state kept as numbered change sets over a base.

A run appends only the rows that it changed (``v=N``), so what it writes follows the
run and not the history.  Every ``BASE_EVERY`` runs the state is also written whole
(``base=N``); readers take the latest base and the change sets after it.  A key's last
change counts; a change marked ``gone`` takes the key out.  A folder counts once its
``_SUCCESS`` is there, and a number that a broken run began is not used again, so a run
that stops anywhere changes nothing and hinders no later one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.lake import drop_tree, list_dirs, path_exists

BASE_EVERY = 20
GONE = "gone"
KEY = "key"


def _begun(spark: SparkSession, root: str, kind: str) -> list[int]:
    names = list_dirs(spark, f"{root.rstrip('/')}/{kind}=*")
    if names is None:
        raise RuntimeError(f"cannot list {root}: its file system is out of reach")
    return sorted(int(n) for n in (name.split("=", 1)[1] for name in names) if n.isdigit())


def _committed(spark: SparkSession, root: str, kind: str, after: int = 0) -> list[int]:
    root = root.rstrip("/")
    return [n for n in _begun(spark, root, kind) if n > after and path_exists(spark, f"{root}/{kind}={n}/_SUCCESS")]


def append(spark: SparkSession, changes: DataFrame, root: str, base_every: int = BASE_EVERY) -> int:
    """Write the rows of ``changes`` (one for each ``key``) as the next change set; its number."""
    root = root.rstrip("/")
    number = max(_begun(spark, root, "v") + _begun(spark, root, "base"), default=0) + 1
    changes.write.mode("errorifexists").parquet(f"{root}/v={number}")
    if len(_committed(spark, root, "v", _last_base(spark, root))) >= base_every:
        state(spark, root, changes.schema.simpleString()).write.mode("errorifexists").parquet(f"{root}/base={number}")
    return number


def _last_base(spark: SparkSession, root: str) -> int:
    return max(_committed(spark, root, "base"), default=0)


def state(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The current rows; none, with ``schema``, before the first run.

    The base is filtered by the keys of the change sets after it, a small side that the
    planner broadcasts, so a long history is scanned and not shuffled.
    """
    root = root.rstrip("/")
    base = _last_base(spark, root)
    numbers = _committed(spark, root, "v", base)
    whole = spark.read.parquet(f"{root}/base={base}") if base else None
    if not numbers:
        return whole if whole is not None else spark.createDataFrame([], schema).drop(GONE)
    sets = spark.read.option("basePath", root).parquet(*[f"{root}/v={n}" for n in numbers])
    columns = [c for c in sets.columns if c != "v"]
    last = sets.groupBy(KEY).agg(F.max_by(F.struct(*columns), "v").alias("row")).select("row.*")
    live = last.where(~F.coalesce(F.col(GONE), F.lit(False))).drop(GONE) if GONE in columns else last
    return live if whole is None else whole.join(last.select(KEY), KEY, "left_anti").unionByName(live)


def changes_of(spark: SparkSession, root: str, number: int) -> DataFrame:
    """What one run changed."""
    return spark.read.parquet(f"{root.rstrip('/')}/v={number}")


def forget(spark: SparkSession, root: str) -> list[int]:
    """Remove the change sets and bases that no reader of the last two bases needs; their numbers."""
    root = root.rstrip("/")
    bases = _committed(spark, root, "base")
    if len(bases) < 2:
        return []
    gone = [n for n in _begun(spark, root, "v") if n <= bases[-2]]
    for n in gone:
        drop_tree(spark, f"{root}/v={n}")
    for n in bases[:-2]:
        drop_tree(spark, f"{root}/base={n}")
    return gone
