import json
from decimal import Decimal

import pytest

from tripmart.operators import serving

ROWS = [
    (f"2031-{m:02d}", zone, hour, m * 100 + zone + hour, Decimal(f"{m * zone + hour}.{hour:02d}"), 2.5, 90.0)
    for m in (6, 7) for zone in (3, 8, 21) for hour in (0, 9, 23)
]
SCHEMA = ("mes string, pu_location_id int, hora int, viajes bigint, ingreso decimal(20,2), "
          "distancia_total double, duracion_media_seg double")


@pytest.fixture(scope="module")
def mart(spark):
    return serving.check_mart_schema(spark.createDataFrame(ROWS, SCHEMA))


@pytest.mark.parametrize("month", [None, "2031-07", "2031-09"])
@pytest.mark.parametrize("zone", [None, 8, 99])
@pytest.mark.parametrize("hour", [None, 0, 23])
@pytest.mark.parametrize("limit", [None, 1, 4])
def test_filters_equal_a_list_filter(mart, month, zone, hour, limit):
    given = {"mes": month, "zona": zone, "hora": hour, "limite": limit}
    flt = serving.TripFilter.parse(**{k: str(v) for k, v in given.items() if v is not None})
    want = sorted(r for r in ROWS if month in (None, r[0]) and zone in (None, r[1]) and hour in (None, r[2]))
    got = serving.trips(mart, flt).collect()
    assert [tuple(r)[:7] for r in got] == want[:limit]
    assert {r.total for r in got} <= {len(want)}


BAD = {"zona": ["ocho", "3.0", str(2**31), " 8", "0x8"], "hora": ["24", "-3", "mediodia", "9h"], "limite": ["-7", "diez", "2_0"]}
FINE = {"zona": ["+8", "-1", str(-(2**31)), ""], "hora": ["0", "23", "007", ""], "limite": ["0", "99999999999", ""]}


@pytest.mark.parametrize("name,value", [(n, v) for n, vs in BAD.items() for v in vs])
def test_bad_values_are_refused(name, value):
    with pytest.raises(serving.InvalidFilter, match=name):
        serving.TripFilter.parse(**{name: value})


@pytest.mark.parametrize("name,value", [(n, v) for n, vs in FINE.items() for v in vs])
def test_fine_values_are_taken(name, value):
    serving.TripFilter.parse(**{name: value})


def test_the_column_check_agrees_with_the_parser(spark):
    from pyspark.sql import functions as F

    rows = [tuple(v if n == name else None for n in BAD) for group in (BAD, FINE) for name, vs in group.items() for v in vs]
    df = spark.createDataFrame(rows, "zona string, hora string, limite string")
    for row in df.select("*", serving.refusal(F.col("zona"), F.col("hora"), F.col("limite")).alias("why")).collect():
        try:
            serving.TripFilter.parse(zona=row.zona, hora=row.hora, limite=row.limite)
            assert row.why is None
        except serving.InvalidFilter as err:
            assert row.why == str(err)


def test_month_is_not_validated(mart):
    assert serving.trips(mart, serving.TripFilter.parse(mes="enero")).count() == 0


def test_income_is_quoted_text_in_json(mart):
    rows = serving.as_json(serving.trips(mart, serving.TripFilter.parse(hora="9", zona="21", mes="2031-07")))
    doc = json.loads(rows.first()["json"])
    assert doc["ingreso"] == "156.09" and doc["zona"] == 21 and doc["viajes"] == 730


def test_state(mart):
    assert serving.state(mart).first().asDict() == {"estado": "ok", "filas": len(ROWS)}


def test_schema_assertion(spark):
    bad = spark.createDataFrame([("2024-01", 1, 1, 1, 1.0, 1.0, 1.0)],
                                "mes string, pu_location_id int, hora int, viajes bigint, ingreso double, "
                                "distancia_total double, duracion_media_seg double")
    with pytest.raises(serving.MartSchemaError):
        serving.check_mart_schema(bad)
    with pytest.raises(serving.MartSchemaError):
        serving.check_mart_schema(bad.drop("hora").withColumn("ingreso", bad.ingreso.cast("decimal(20,2)")))
