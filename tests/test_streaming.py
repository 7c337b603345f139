from tests.conftest import SF_SMALL
from tripmart.session import scratch
from tripmart.sources import fixtures
from tripmart.streaming import hourly


def test_stream_counts_equal_batch_counts(spark):
    root = scratch(spark, "test-hourly")
    events = fixtures.landed_events(spark, SF_SMALL)
    hourly.land_hourly_files(events, f"{root}/files")
    q = hourly.start_hourly_stream(spark, f"{root}/files", f"{root}/counts", f"{root}/ckpt")
    q.awaitTermination()
    streamed = hourly.read_hourly_sink(spark, f"{root}/counts")
    batch = hourly.hourly_counts(events)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # files read back in batch give the same counts as the source rows
    again = hourly.hourly_counts(hourly.read_hourly_files(spark, f"{root}/files"))
    assert again.exceptAll(batch).count() == 0
    # a restarted query over the same checkpoint finds nothing new and changes nothing
    hourly.start_hourly_stream(spark, f"{root}/files", f"{root}/counts", f"{root}/ckpt").awaitTermination()
    assert hourly.read_hourly_sink(spark, f"{root}/counts").exceptAll(batch).count() == 0


def test_missing_hours_include_dropped_files(spark):
    events = fixtures.landed_events(spark, SF_SMALL)
    missing = {r.hora.strftime("%d %H") for r in hourly.missing_hours(events).collect()}
    assert "05 04" in missing and "11 13" in missing
    present = {r.hora.strftime("%d %H") for r in hourly.hourly_counts(events).collect()}
    assert not (missing & present)


def test_files_count_however_late_they_land(spark):
    import datetime as dt

    root = scratch(spark, "test-late")
    events = fixtures.table(spark, SF_SMALL, "events")
    hourly.land_hourly_files(events, f"{root}/files")
    args = (spark, f"{root}/files", f"{root}/counts", f"{root}/ckpt")
    hourly.start_hourly_stream(*args).awaitTermination()
    before = {r.hora: r.eventos for r in hourly.read_hourly_sink(spark, f"{root}/counts").collect()}
    last = max(before)
    late = {last - dt.timedelta(hours=5): 3, last - dt.timedelta(days=5): 4, last - dt.timedelta(days=4000): 2}
    for hour, n in late.items():
        rows = [(10_000_000 + i, hour + dt.timedelta(minutes=i), 1, "late", 1.0, "{}") for i in range(n)]
        hourly.land_hourly_files(spark.createDataFrame(rows, hourly.EVENT_SCHEMA), f"{root}/files", mode="append")
    hourly.start_hourly_stream(*args).awaitTermination()
    after = {r.hora: r.eventos for r in hourly.read_hourly_sink(spark, f"{root}/counts").collect()}
    assert after == before | {h: before.get(h, 0) + n for h, n in late.items()}


def test_missing_hours_of_no_events(spark):
    assert hourly.missing_hours(spark.createDataFrame([], hourly.EVENT_SCHEMA)).count() == 0


def test_many_micro_batches_give_the_batch_counts(spark):
    root = scratch(spark, "test-multi")
    events = fixtures.landed_events(spark, SF_SMALL)
    hourly.land_hourly_files(events, f"{root}/files")
    q = hourly.start_hourly_stream(
        spark, f"{root}/files", f"{root}/counts", f"{root}/ckpt", max_files_per_trigger=100
    )
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) > 1
    streamed = hourly.read_hourly_sink(spark, f"{root}/counts")
    batch = hourly.hourly_counts(events)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_a_long_changelog_stays_small_and_survives_interrupted_compactions(spark, monkeypatch):
    import datetime as dt
    import random

    from tripmart.lake import list_dirs
    from tripmart.streaming import changelog

    sink = scratch(spark, "test-changelog")
    rng = random.Random(1)
    hours = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(30)]
    counts = {}

    def trigger(batch_id):
        for h in rng.sample(hours, 4):
            counts[h] = counts.get(h, 0) + rng.randrange(1, 9)
        rows = [(h, counts[h]) for h in rng.sample(sorted(counts), min(6, len(counts)))]
        for h, n in rows:
            shown[h] = n
        changelog.write_batch(spark.createDataFrame(rows, "hora timestamp_ntz, eventos bigint").coalesce(1), sink, batch_id)

    def read():
        return {r.hora: r.eventos for r in changelog.latest(spark, sink).collect()}

    shown = {}
    assert read() == {}
    put, clean = changelog.put_once, changelog._clean

    def stopped(*args):
        raise RuntimeError("stopped")

    for batch_id in range(60):
        trigger(batch_id)
        if batch_id % 5 == 4:
            if batch_id % 15 == 4:  # after the base, before the pointer
                monkeypatch.setattr(changelog, "put_once", stopped)
            if batch_id % 15 == 9:  # after the pointer, before old files go
                monkeypatch.setattr(changelog, "_clean", stopped)
            early = changelog.latest(spark, sink)
            try:
                changelog.compact(spark, sink)
            except RuntimeError:
                pass
            monkeypatch.setattr(changelog, "put_once", put)
            monkeypatch.setattr(changelog, "_clean", clean)
            assert read() == shown
            assert {r.hora: r.eventos for r in early.collect()} == shown  # a reader that began before
            assert len(list_dirs(spark, f"{sink}/tail/lote=*")) <= 20 and len(list_dirs(spark, f"{sink}/base/v=*")) <= 4
    changelog.write_batch(spark.createDataFrame([(hours[0], 10**6)], "hora timestamp_ntz, eventos bigint"), sink, 59)  # a replay
    assert read() == shown
