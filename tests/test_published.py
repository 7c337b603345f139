"""Publications by one pointer: snapshots, contention, damage, expiry."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripmart.lake import Lake, list_dirs, put_once, read_months, read_text
from tripmart.operators import published, silver
from tripmart.operators.contract import FILE_MONTH
from tripmart.plans import publish
from tripmart.session import scratch
from tripmart.sources import fixtures


@pytest.fixture(scope="module")
def lake(spark):
    lake = Lake(scratch(spark, "test-published"))
    silver.land_raw(fixtures.trips_raw(spark, SF_SMALL), lake)
    return lake


def month(name, version, rows=1):
    return published.PublishedMonth(name, version, None, rows, 0, "0")


def test_a_pointer_is_written_once_and_whole(spark, tmp_path):
    path = f"{tmp_path}/current/1.json"
    assert put_once(spark, path, "first é\n") and not put_once(spark, path, "second")
    assert read_text(spark, path) == "first é\n"
    assert [p.name for p in (tmp_path / "current").iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_the_later_of_two_publishers_starts_from_the_other_s_months(spark, tmp_path):
    lake = Lake(str(tmp_path))
    tried = []

    def slow(now):
        tried.append(sorted(now))
        if len(tried) == 1:  # another publisher comes in between
            published.commit(spark, lake, "yellow", lambda m: m | {"1995-01": month("1995-01", "ra")})
        return now | {"1995-02": month("1995-02", "rb")}

    at = published.commit(spark, lake, "yellow", slow)
    assert tried == [[], ["1995-01"]] and at.number == 2
    assert {m.mes: m.silver for m in published.snapshot(spark, lake, "yellow").months.values()} == {"1995-01": "ra", "1995-02": "rb"}
    assert sorted(published.snapshot(spark, lake, "yellow", 1).months) == ["1995-01"]


def test_a_publisher_that_never_comes_first_gives_up(spark, tmp_path):
    lake = Lake(str(tmp_path))

    def beaten(now):
        published.commit(spark, lake, "yellow", lambda m: m | {"1995-01": month("1995-01", f"r{len(m)}")})
        return now

    with pytest.raises(published.Contended):
        published.commit(spark, lake, "yellow", beaten, attempts=3)


def test_damage_after_publication_is_found_and_old_versions_expire(spark, lake):
    months = silver.landed_raw_months(spark, lake, "yellow")[:2]
    publish.stage_validate_publish(spark, lake, "yellow", months)
    publish.stage_validate_publish(spark, lake, "yellow", months[:1])
    assert published.damaged_months(spark, lake, "yellow").count() == 0
    first = published.snapshot(spark, lake, "yellow", 1)
    assert published.silver_rows(spark, lake, "yellow", first).count() == published.silver_rows(spark, lake, "yellow").count()
    # the first version still holds the second month, so only its mart and silver of both stay until it is replaced
    assert published.expire(spark, lake, "yellow", keep=1) == []
    publish.stage_validate_publish(spark, lake, "yellow", months[1:])
    gone = published.expire(spark, lake, "yellow", keep=1)
    assert {g.split("=")[1] for g in gone} == {first.months[months[0]].silver}
    assert len(list_dirs(spark, f"{lake.published('yellow')}/silver/v=*")) == 2
    at = published.snapshot(spark, lake, "yellow")
    path = published.version_folder(lake, "yellow", "silver", at.months[months[1]].silver)
    rows = read_months(spark, path, months[1:])
    rows.withColumn("extra", (F.col("extra") + 1).cast(rows.schema["extra"].dataType)).write.partitionBy("mes").parquet(f"{lake.root}/x")
    silver.write_months(read_months(spark, f"{lake.root}/x", months[1:]), path)
    assert [r.mes for r in published.damaged_months(spark, lake, "yellow").collect()] == months[1:]
    with pytest.raises(ValueError):
        published.expire(spark, lake, "yellow", keep=0)


def test_nothing_published(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert published.snapshot(spark, lake, "yellow") == published.Snapshot(0, {})
    with pytest.raises(published.NothingPublished):
        published.silver_rows(spark, lake, "yellow")


def test_the_command_publishes_and_refuses(spark, capsys):
    from tripmart import cli

    lake = Lake(scratch(spark, "test-publicar"))
    silver.land_raw(fixtures.trips_raw(spark, SF_SMALL), lake)
    months = silver.landed_raw_months(spark, lake, "yellow")
    assert cli.main(["publicar", "yellow", "--mes", months[0], "--hasta", months[1], "--lake", lake.root], spark) == 0
    said = json.loads(capsys.readouterr().out)
    assert said["publicacion"] == 1 and said["meses"] == months[:2]
    silver.land_raw(fixtures.trips_raw(spark, SF_SMALL, null_pickup_every=2).where(F.col(FILE_MONTH) == months[1]), lake)
    assert cli.main(["publicar", "yellow", "--mes", months[1], "--lake", lake.root], spark) == 1
    assert "not_null hora" in capsys.readouterr().out
    assert cli.main(["salud", "--lake", lake.root, "--publicado", "yellow"], spark) == 0
    assert json.loads(capsys.readouterr().out)["estado"] == "ok"
