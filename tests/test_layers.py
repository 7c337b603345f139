"""Silver and gold on the driver's data: golden counts, conservation, idempotence."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripmart.functions.flags import FLAG_NAMES, any_flag
from tripmart.lake import Lake
from tripmart.operators import checks, gold, profile, serving, silver
from tripmart.plans import catalog
from tripmart.session import scratch
from tripmart.sources import fixtures

GOLDEN_SF0001 = dict(filas=6000, marcadas=1816, fuera_de_mes=7, cronologia_invalida=24, duracion_absurda=37,
                     sin_distancia=545, velocidad_absurda=212, importe_negativo=319, pasajeros_cero=845)


def test_golden_flag_profile(silver_small):
    assert profile.flag_profile(silver_small).first().asDict() == GOLDEN_SF0001


def test_golden_mart_rows(silver_small):
    assert gold.mart(silver_small).count() == 3887


def test_silver_has_27_columns_with_the_contract_types(silver_small):
    types = dict(silver_small.dtypes)
    assert len(silver_small.columns) == 27
    assert types["pickup_datetime"] == "timestamp_ntz" and types["total_amount"] == "decimal(10,2)"
    assert all(types[f] == "boolean" for f in FLAG_NAMES)


def test_gold_trips_equal_clean_silver_rows(silver_small):
    clean = silver_small.where(~any_flag()).count()
    assert gold.mart(silver_small).agg(F.sum("viajes")).first()[0] == clean
    assert checks.gold_vs_silver(silver_small, gold.mart(silver_small)).where(~F.col("cuadra")).count() == 0


def test_mart_types(silver_small):
    mart = serving.check_mart_schema(gold.mart(silver_small))
    assert dict(mart.dtypes)["ingreso"] == "decimal(20,2)"
    assert checks.income_text(mart).count() == 0
    assert checks.mart_violations(mart).count() == 0


def test_null_pickup_reaches_gold_and_is_caught(spark):
    from tripmart.plans.catalog import mart_of

    v = checks.mart_violations(mart_of(spark, SF_SMALL, null_pickup_every=101)).collect()
    assert [(r.prueba, r.sujeto) for r in v] == [("not_null", "hora")]


@pytest.fixture(scope="module")
def lake(spark):
    lake = Lake(scratch(spark, "test-layers"))
    silver.land_raw(fixtures.trips_raw(spark, SF_SMALL), lake)
    return lake


def _files(path):
    out = {}
    for root, _, names in os.walk(path):
        for n in names:
            full = os.path.join(root, n)
            out[full] = (os.path.getsize(full), os.path.getmtime(full))
    return out


def test_materialize_rewrite_and_missing_month(spark, lake):
    months = silver.landed_raw_months(spark, lake, "yellow")
    assert len(months) == 83
    first = silver.materialize(spark, lake, "yellow", months)
    assert first.new_table and not first.unequal
    assert (first.read, first.written, first.flagged) == (6000, 6000, 1816)
    assert first.extras == ()

    target = months[10]
    others = {m: _files(f"{lake.silver('yellow')}/mes={m}") for m in months if m != target}
    again = silver.materialize(spark, lake, "yellow", target)
    twice = silver.materialize(spark, lake, "yellow", target)
    assert not again.new_table and again.written == twice.written == first.by_month[target].raw
    assert {m: _files(f"{lake.silver('yellow')}/mes={m}") for m in others} == others

    with pytest.raises(silver.MonthNotLanded):
        silver.materialize(spark, lake, "yellow", "2099-01")
    present = {r[0] for r in spark.read.parquet(lake.silver("yellow")).select("mes").distinct().collect()}
    assert "2099-01" not in present and len(present) == 83


def test_incremental_refresh_equals_full_rebuild(spark, lake):
    months = silver.landed_raw_months(spark, lake, "yellow")
    silver.materialize(spark, lake, "yellow", months)
    gold.build(spark, lake)
    silver.materialize(spark, lake, "yellow", [months[0], months[5]])
    gold.refresh(spark, lake, [months[0], months[5]])
    incremental = serving.read_mart(spark, lake.gold())
    full = gold.mart(spark.read.parquet(lake.silver("yellow"))).select(*incremental.columns)
    assert incremental.exceptAll(full).count() == 0 and full.exceptAll(incremental).count() == 0
    before = incremental.agg(F.count("*"), F.sum("viajes"), F.sum("ingreso")).first()
    gold.build(spark, lake)
    after = serving.read_mart(spark, lake.gold()).agg(F.count("*"), F.sum("viajes"), F.sum("ingreso")).first()
    assert before == after


def test_staged_publish(spark, lake):
    from tripmart.plans import publish

    months = silver.landed_raw_months(spark, lake, "yellow")
    run = publish.stage_validate_publish(spark, lake, "yellow", months[:3])
    assert not run.unequal and run.read > 0
    from tripmart.operators import published

    at = published.snapshot(spark, lake, "yellow")
    assert at.number == 1 and sorted(at.months) == months[:3]
    assert published.silver_rows(spark, lake, "yellow").count() == run.read


def test_canary(spark, lake):
    silver.materialize(spark, lake, "yellow", silver.landed_raw_months(spark, lake, "yellow"))
    path = gold.write_canary(spark, lake)
    assert spark.read.parquet(path).first()["filas_en_silver"] == 6000


def test_catalog_names(spark, lake):
    from tripmart import tables

    silver.materialize(spark, lake, "yellow", silver.landed_raw_months(spark, lake, "yellow"))
    gold.build(spark, lake)
    names = tables.register_lake(spark, lake)
    assert "silver.tlc_yellow" in names and "gold.viajes_por_zona_hora" in names
    assert tables.exists(spark, "silver.tlc_yellow")
    assert tables.partitions(spark, "silver.tlc_yellow").count() == 83
    assert spark.table("silver.tlc_yellow").count() == 6000
    for name in names:
        tables.drop(spark, name)
    for ns in ("silver", "gold"):
        tables.drop_namespace(spark, ns)
    assert "silver" not in tables.namespaces(spark)
    assert spark.read.parquet(lake.silver("yellow")).count() == 6000  # files stay


def test_backfill_of_a_range(spark, lake):
    months = silver.landed_raw_months(spark, lake, "yellow")
    first, last = months[-3], months[-1]
    y, m = map(int, last.split("-"))
    beyond = f"{y + (m == 12):04d}-{1 if m == 12 else m + 1:02d}"
    result = silver.backfill(spark, lake, "yellow", first, beyond)
    assert result.not_landed == (beyond,)
    assert result.run.months == (months[-3], months[-2], months[-1]) and not result.run.unequal


def test_registration_picks_up_new_months(spark):
    from tripmart import tables

    lake = Lake(scratch(spark, "test-register"))
    silver.land_raw(fixtures.trips_raw(spark, SF_SMALL), lake)
    months = silver.landed_raw_months(spark, lake, "yellow")
    silver.materialize(spark, lake, "yellow", months[:2])
    tables.register(spark, "silver_reg.tlc_yellow", lake.silver("yellow"))
    assert tables.partitions(spark, "silver_reg.tlc_yellow").count() == 2
    silver.materialize(spark, lake, "yellow", months[2:4])
    tables.register(spark, "silver_reg.tlc_yellow", lake.silver("yellow"))
    assert tables.partitions(spark, "silver_reg.tlc_yellow").count() == 4
    expected = spark.read.parquet(lake.silver("yellow")).count()
    assert spark.table("silver_reg.tlc_yellow").count() == expected
    tables.drop(spark, "silver_reg.tlc_yellow")
    tables.drop_namespace(spark, "silver_reg")


def test_refresh_of_a_month_not_in_silver_is_refused(spark, lake):
    months = silver.landed_raw_months(spark, lake, "yellow")
    silver.materialize(spark, lake, "yellow", months)
    gold.build(spark, lake)
    with pytest.raises(gold.EmptyMart, match="2099-01"):
        gold.refresh(spark, lake, ["2099-01"])


def test_reading_a_missing_mart_raises(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        serving.read_mart(spark, scratch(spark, "no-mart") + "/gold/viajes_por_zona_hora")


def test_named_mart(spark, lake):
    months = silver.landed_raw_months(spark, lake, "yellow")
    silver.materialize(spark, lake, "yellow", months)
    gold.build(spark, lake)
    path = gold.build_with_names(spark, lake, fixtures.zones(spark, SF_SMALL))
    named = spark.read.parquet(path)
    assert named.count() == spark.read.parquet(lake.gold()).count()
    assert named.where(F.col("zona_nombre").isNull()).count() == 0
    assert {"borough", "zona_nombre", "service_zone"} <= set(named.columns)


def test_publish_is_refused_when_the_staged_mart_fails_its_tests(spark):
    from tripmart.plans import publish

    lake = Lake(scratch(spark, "test-refuse"))
    silver.land_raw(fixtures.trips_raw(spark, SF_SMALL, null_pickup_every=101), lake)
    months = silver.landed_raw_months(spark, lake, "yellow")
    with pytest.raises(publish.PublishRefused, match="not_null hora"):
        publish.stage_validate_publish(spark, lake, "yellow", months)
    from tripmart.lake import list_dirs
    from tripmart.operators import published

    assert published.snapshot(spark, lake, "yellow").number == 0
    assert not list_dirs(spark, f"{lake.published('yellow')}/*/v=*")  # nothing staged stays behind


def test_the_failing_data_tests_read_one_computed_mart(spark):
    df = catalog.q_tests_that_fail(spark, SF_SMALL)
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("Relation [l_orderkey") == 1  # clean silver rows of D6; the mart is read as kept
