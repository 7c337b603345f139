"""Numbered landings and counts of what is new."""

import datetime as dt

from tripmart.session import scratch
from tripmart.streaming import arrivals, changelog, hourly


def events(spark, *hours):
    rows = [(i, dt.datetime(2024, 1, 1, h, i % 60), 1, "e", 1.0, "{}") for h, n in hours for i in range(n)]
    return spark.createDataFrame(rows, hourly.EVENT_SCHEMA)


def counts(spark, sink):
    return {r.hora.hour: r.eventos for r in changelog.latest(spark, sink).collect()}


def test_only_new_landings_are_read(spark):
    root = scratch(spark, "test-arrivals")
    sink = f"{root}/counts"
    assert arrivals.last_number(spark, root) == -1 and arrivals.count_new(spark, root, sink) == 0
    for n in range(5):
        assert arrivals.land(events(spark, (n, 2), (9, 1)), root) == n
        assert arrivals.last_number(spark, root) == n
    assert arrivals.count_new(spark, root, sink, most=2) == 2
    assert counts(spark, sink) == {0: 2, 1: 2, 9: 2}
    number, folders = arrivals.new_folders(spark, root, changelog.last_batch(spark, sink), 1000)
    assert number == 4 and len(folders) == 3
    # a trigger that was lost while it wrote leaves a folder without its mark
    events(spark, (3, 50)).selectExpr("date_trunc('HOUR', ts) AS hora", "1L AS eventos", "4L AS lote").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(changelog._tail(sink, 4))
    assert counts(spark, sink) == {0: 2, 1: 2, 9: 2}
    assert arrivals.count_new(spark, root, sink) == 3
    want = {0: 2, 1: 2, 2: 2, 3: 2, 4: 2, 9: 5}
    assert counts(spark, sink) == want
    assert arrivals.count_new(spark, root, sink) == 0 and counts(spark, sink) == want
    changelog.compact(spark, sink)
    assert counts(spark, sink) == want and changelog.last_batch(spark, sink) == 4
    arrivals.land(events(spark), root)  # an empty landing
    arrivals.land(events(spark, (0, 1)), root)
    assert arrivals.count_new(spark, root, sink, compact_every=1) == 2
    assert counts(spark, sink) == want | {0: 3} and changelog.pointer(spark, sink).upto == 6
