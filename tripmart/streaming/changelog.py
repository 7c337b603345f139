"""The counts a stream has written: a folder for each micro-batch, folded into a base now and then.

``tail/lote=N`` holds the hours that batch N updated, with their counts so far; ``base/v=<id>`` the latest
count of every hour up to some batch; ``current/<N>.json`` says which base, and up to which
batch it goes. Readers take the base and the batches after it. A compaction writes a new base,
then the pointer, then removes what neither the new pointer nor the one before names: a
reader that resolved the one before still finds everything, and a compaction that stops at any
point leaves the counts as they are and its remains to the next one. So files are bounded
by twice the batches between two compactions, however long the stream runs.

Batch ids come from the stream's checkpoint; a sink belongs to one checkpoint.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.lake import drop_tree, file_names, list_dirs, path_exists, put_once, read_text

COMPACT_EVERY = 50
SCHEMA = "hora timestamp_ntz, eventos bigint, lote bigint"


@dataclass(frozen=True)
class Pointer:
    """``base`` holds the batches up to ``upto``; before the first compaction there is none."""

    number: int = 0
    base: str | None = None
    upto: int = -1


def _tail(sink: str, batch_id: int) -> str:
    return f"{sink.rstrip('/')}/tail/lote={batch_id:012d}"


def _base(sink: str, base: str) -> str:
    return f"{sink.rstrip('/')}/base/v={base}"


def _numbers(names) -> list[int]:
    """The numbers in names such as ``lote=000000000012`` and ``000000000003.json``."""
    found = (n.removesuffix(".json").split("=")[-1] for n in names or [])
    return sorted(int(n) for n in found if n.isdigit())


def write_batch(batch: DataFrame, sink: str, batch_id: int) -> None:
    """Write the hours of one micro-batch; a batch that is replayed has been written already."""
    path = _tail(sink, batch_id)
    if not path_exists(batch.sparkSession, f"{path}/_SUCCESS"):
        rows = batch.select("hora", "eventos", F.lit(batch_id).cast("bigint").alias("lote"))
        rows.coalesce(1).write.mode("overwrite").parquet(path)  # a row for each hour the batch touched


def pointer(spark: SparkSession, sink: str) -> Pointer:
    numbers = _numbers(file_names(spark, f"{sink.rstrip('/')}/current/*.json"))
    if not numbers:
        return Pointer()
    return Pointer(**json.loads(read_text(spark, f"{sink.rstrip('/')}/current/{numbers[-1]:012d}.json")))


def _after(spark: SparkSession, sink: str, upto: int) -> list[int]:
    """Batches written whole after ``upto``."""
    found = _numbers(list_dirs(spark, f"{sink.rstrip('/')}/tail/lote=*"))
    return [n for n in found if n > upto and path_exists(spark, f"{_tail(sink, n)}/_SUCCESS")]


def _folded(spark: SparkSession, sink: str, at: Pointer, batches: list[int]) -> DataFrame:
    paths = ([_base(sink, at.base)] if at.base else []) + [_tail(sink, n) for n in batches]
    rows = spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)
    return rows.groupBy("hora").agg(F.max_by("eventos", "lote").alias("eventos"), F.max("lote").alias("lote"))


def latest(spark: SparkSession, sink: str) -> DataFrame:
    """(hora, eventos): the latest count of every hour."""
    at = pointer(spark, sink)
    return _folded(spark, sink, at, _after(spark, sink, at.upto)).select("hora", "eventos")


def last_batch(spark: SparkSession, sink: str) -> int:
    """The highest batch that is written whole (-1: none)."""
    at = pointer(spark, sink)
    return max([at.upto, *_after(spark, sink, at.upto)])


def batches_waiting(spark: SparkSession, sink: str) -> int:
    """Batches that the base does not hold yet."""
    return len(_after(spark, sink, pointer(spark, sink).upto))


def write_base(spark: SparkSession, sink: str, at: Pointer, batches: list[int]) -> Pointer:
    """The base that follows ``at``, written and not yet current."""
    base = f"r{uuid.uuid4().hex[:16]}"
    _folded(spark, sink, at, batches).coalesce(1).write.parquet(_base(sink, base))  # a row for each hour of the calendar
    return Pointer(at.number + 1, base, batches[-1])


def compact(spark: SparkSession, sink: str) -> Pointer:
    """Fold the batches written so far into a new base. Only the stream that writes them runs this."""
    at = pointer(spark, sink)
    batches = _after(spark, sink, at.upto)
    if not batches:
        return at
    new = write_base(spark, sink, at, batches)
    if not put_once(spark, f"{sink.rstrip('/')}/current/{new.number:012d}.json", json.dumps(asdict(new))):
        drop_tree(spark, _base(sink, new.base))
        return pointer(spark, sink)
    _clean(spark, sink, at, new)
    return new


def _clean(spark: SparkSession, sink: str, before: Pointer, now: Pointer) -> None:
    """Remove what neither of the two last pointers needs."""
    root = sink.rstrip("/")
    for n in _numbers(list_dirs(spark, f"{root}/tail/lote=*")):
        if n <= before.upto:
            drop_tree(spark, _tail(sink, n))
    for name in list_dirs(spark, f"{root}/base/v=*") or []:
        if name.split("=", 1)[1] not in (before.base, now.base):
            drop_tree(spark, f"{root}/base/{name}")
    for n in _numbers(file_names(spark, f"{root}/current/*.json")):
        if n < before.number:
            drop_tree(spark, f"{root}/current/{n:012d}.json")
