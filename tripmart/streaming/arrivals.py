"""Landings of hourly files with a number each, and counts that read only what is new.

A landing writes its hours into a folder of its own and then takes the next number with one small
file, ``arrivals/<N>.json``. Numbers have no holes, so a consumer that has counted up to N asks for
N + 1, N + 2, ... until one is missing: no folder is listed, and a trigger costs what has landed
since the last one, however much landed before. Counting reads those folders alone, adds to the
counts so far the hours they touch, and writes them as batch N of the changelog: whole or not at all,
so a trigger that is lost or run again counts nothing twice.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.lake import path_exists, put_once, read_text
from tripmart.streaming import changelog, hourly


def _entry(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/arrivals/{number:012d}.json"


def last_number(spark: SparkSession, root: str) -> int:
    """The number of the last landing (-1: none), in as many looks as it has binary digits."""
    high = 1
    while path_exists(spark, _entry(root, high - 1)):
        high *= 2
    low = high // 2  # the numbers below ``low`` exist, ``high - 1`` does not
    while low < high - 1:
        middle = (low + high) // 2
        if path_exists(spark, _entry(root, middle - 1)):
            low = middle
        else:
            high = middle
    return low - 1


def land(events: DataFrame, root: str, attempts: int = 100) -> int:
    """Write events as hourly files of a landing of their own; its number.

    A landing without a number is not there: its folder is never read.
    """
    spark = events.sparkSession
    folder = f"files/l{uuid.uuid4().hex[:16]}"
    hourly.land_hourly_files(events, f"{root.rstrip('/')}/{folder}")
    number = last_number(spark, root) + 1
    for number in range(number, number + attempts):
        if put_once(spark, _entry(root, number), json.dumps({"folder": folder})):
            return number
    raise RuntimeError(f"{attempts} other landings came first")


def new_folders(spark: SparkSession, root: str, after: int, most: int) -> tuple[int, list[str]]:
    """(last number, folders) of at most ``most`` landings after the one of number ``after``."""
    found, number = [], after
    while len(found) < most and path_exists(spark, _entry(root, number + 1)):
        number += 1
        found.append(f"{root.rstrip('/')}/{json.loads(read_text(spark, _entry(root, number)))['folder']}")
    return number, found


def count_new(spark: SparkSession, root: str, sink: str, most: int = 1000, compact_every: int = changelog.COMPACT_EVERY) -> int:
    """Count what has landed since the last call into ``sink``; the number of landings counted.

    One consumer at a time. Nothing new writes nothing.
    """
    done = changelog.last_batch(spark, sink)
    number, folders = new_folders(spark, root, done, most)
    if not folders:
        return 0
    # a landing may be empty: folders without files have no schema to infer and need none
    fresh = hourly.hourly_counts(hourly.read_hourly_files(spark, folders))
    before = changelog.latest(spark, sink).withColumnRenamed("eventos", "antes")
    total = F.coalesce("antes", F.lit(0)) + F.col("eventos")
    changelog.write_batch(fresh.join(before, "hora", "left").select("hora", total.alias("eventos")), sink, number)
    if changelog.batches_waiting(spark, sink) >= compact_every:
        changelog.compact(spark, sink)
    return len(folders)
