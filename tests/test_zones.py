import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripmart.operators import zones as Z
from tripmart.plans.catalog import mart_of
from tripmart.session import scratch
from tripmart.sources import fixtures
from tripmart.sources import zones as S


def test_csv_roundtrip_keeps_text(spark):
    path = scratch(spark, "zones") + "/zonas.csv"
    S.write_zones(fixtures.zones(spark, SF_SMALL), path)
    part = [f for f in os.listdir(path) if f.endswith(".csv")][0]
    with open(os.path.join(path, part)) as fh:
        assert fh.readline().strip() == '"LocationID","Borough","Zone","service_zone"'
    cat = S.read_zones(spark, path)
    assert cat.count() == 27
    assert cat.where("LocationID = 26").first().asDict() == {
        "LocationID": 26, "Borough": "Unknown", "Zone": "N/A", "service_zone": "N/A"}
    assert Z.id_gaps(cat).count() == 0 and Z.id_duplicates(cat).count() == 0


def test_join_keeps_rows_and_names(spark):
    mart = mart_of(spark, SF_SMALL)
    cat = fixtures.zones(spark, SF_SMALL)
    named = Z.with_zone_names(mart, cat)
    assert named.count() == mart.count()
    assert named.where(F.col("zona_nombre").isNull()).count() == 0
    assert named.where("pu_location_id = 27").select("zona_nombre").distinct().first()[0] == "Outside of NYC"
    gap = Z.with_zone_names(mart, cat.where("LocationID <> 13"))
    assert gap.count() == mart.count()
    assert gap.where(F.col("zona_nombre").isNull()).count() == mart.where("pu_location_id = 13").count() > 0
    assert [r.LocationID for r in Z.id_gaps(cat.where("LocationID <> 13")).collect()] == [13]
