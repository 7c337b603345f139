"""Change sets over a base, listing differences, and the clustered mart."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripmart.lake import list_dirs
from tripmart.operators import gold, landing, ledgers
from tripmart.plans import catalog
from tripmart.session import scratch

SCHEMA = "key string, n bigint, gone boolean"


def test_the_state_is_the_last_change_of_each_key_at_every_run(spark):
    root, want = scratch(spark, "ledger"), {}
    assert ledgers.state(spark, root, SCHEMA).count() == 0
    for run in range(9):
        changes = {f"k{(run * 3 + i) % 7}": (run * 10 + i, (run + i) % 4 == 0) for i in range(3)}
        number = ledgers.append(spark, spark.createDataFrame([(k, *v) for k, v in changes.items()], SCHEMA), root, base_every=3)
        assert ledgers.changes_of(spark, root, number).count() == 3
        want = {k: v for k, v in {**want, **changes}.items() if not v[1]}
        assert {r.key: r.n for r in ledgers.state(spark, root, SCHEMA).collect()} == {k: n for k, (n, _) in want.items()}
    assert sorted(list_dirs(spark, f"{root}/base=*")) == ["base=3", "base=6", "base=9"]
    assert ledgers.forget(spark, root) == [1, 2, 3, 4, 5, 6]
    assert {r.key: r.n for r in ledgers.state(spark, root, SCHEMA).collect()} == {k: n for k, (n, _) in want.items()}
    assert ledgers.append(spark, spark.createDataFrame([("z", 1, False)], SCHEMA), root) == 10


def test_a_broken_run_changes_nothing_and_hinders_none(spark):
    root = scratch(spark, "ledger-broken")
    one = spark.createDataFrame([("a", 1, False)], SCHEMA)
    assert ledgers.append(spark, one, root) == 1
    spark.createDataFrame([("a", 9, False)], SCHEMA).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/v=2")
    assert [r.n for r in ledgers.state(spark, root, SCHEMA).collect()] == [1]
    assert ledgers.append(spark, spark.createDataFrame([("b", 2, False)], SCHEMA), root) == 3
    assert {r.key: r.n for r in ledgers.state(spark, root, SCHEMA).collect()} == {"a": 1, "b": 2}


def test_only_objects_that_differ_are_listed_and_checked(spark):
    schema = "key string, length bigint, modified timestamp"

    def listing(*rows):
        return spark.createDataFrame(rows, "key string, length bigint, at string").select(
            "key", "length", F.to_timestamp("at").alias("modified"))

    before = listing(("a", 1, "2024-01-01"), ("b", 2, "2024-01-01"), ("c", 3, "2024-01-01"), ("d", 4, None))
    now = listing(("a", 1, "2024-01-01"), ("b", 2, "2024-01-02"), ("d", 4, None), ("e", 5, "2024-01-02"))
    changes = landing.listing_changes(now, before)
    assert {(r.key, r.cambio, r.gone) for r in changes.collect()} == {
        ("b", "cambiado", False), ("c", "quitado", True), ("e", "nuevo", False)}
    assert landing.listing_changes(now, now).count() == 0
    assert landing.listing_changes(now, spark.createDataFrame([], schema)).count() == 4
    classified = spark.createDataFrame(
        [(k, "m", n, "descargado") for k, n in (("a", 1), ("b", 2), ("c", 3), ("e", 6))],
        "key string, etag string, declared_size bigint, resultado string")
    assert {(r.key, r.completo) for r in landing.verify_changed(classified, changes).collect()} == {("b", True), ("e", False)}


def test_a_filter_by_zone_meets_few_row_groups_of_the_mart(spark):
    path = scratch(spark, "clustered")
    rows = spark.range(265 * 24).select(
        F.lit("2024-01").alias("mes"), (F.col("id") % 265).cast("int").alias("pu_location_id"),
        F.expr("cast(id div 265 as int)").alias("hora"), F.lit(1).alias("viajes"))
    gold.write_mart(rows, path)
    groups = []
    for name in glob.glob(f"{path.removeprefix('file:')}/mes=2024-01/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("pu_location_id")
        groups += [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
    assert len(groups) >= 10
    assert sum(s.min <= 132 <= s.max for s in groups) <= 2
    assert spark.read.parquet(path).where("pu_location_id = 132").count() == 24


def test_registered_differences(spark):
    rows = catalog.q_landing_changes(spark, SF_SMALL).collect()
    assert not [r for r in rows if r.corrida == "corrida 3"]
    assert {r.cambio for r in rows if r.corrida == "corrida 1"} == {"nuevo"}
    assert {r.cambio for r in rows if r.corrida == "corrida 2"} == {"cambiado"}
