import json

from tests.conftest import SF_SMALL
from tripmart import cli
from tripmart.lake import Lake
from tripmart.operators import silver
from tripmart.session import scratch
from tripmart.sources import fixtures


def run(capsys, spark, *argv):
    code = cli.main(list(argv), spark=spark)
    out = capsys.readouterr().out.strip().splitlines()[-1]
    return code, json.loads(out)


def test_commands_end_to_end(spark, capsys):
    lake = Lake(scratch(spark, "cli"))
    silver.land_raw(fixtures.trips_raw(spark, SF_SMALL), lake)
    months = silver.landed_raw_months(spark, lake, "yellow")

    code, rep = run(capsys, spark, "silver", "yellow", "--mes", months[0], "--hasta", months[-1], "--lake", lake.root)
    assert code == 0 and rep["leidas"] == rep["escritas"] == 6000 and rep["tabla_creada"]

    code, rep = run(capsys, spark, "silver", "yellow", "--mes", months[1], "--gold", "--lake", lake.root)
    assert code == 0 and rep["mart"].endswith("viajes_por_zona_hora")

    code, rep = run(capsys, spark, "silver", "yellow", "--mes", "2099-01", "--lake", lake.root)
    assert code == 1 and "2099-01" in rep["error"]

    code, rep = run(capsys, spark, "silver", "yellow", "--mes", "2024-13", "--lake", lake.root)
    assert code == 2

    code, rep = run(capsys, spark, "gold", "--lake", lake.root)
    assert code == 0 and rep["filas"] == 3887
    code, rep = run(capsys, spark, "gold", "--meses", months[0], "--lake", lake.root)
    assert code == 0 and rep["filas"] == 3887

    from tripmart.sources import zones as zone_source

    zpath = zone_source.write_zones(fixtures.zones(spark, SF_SMALL), scratch(spark, "cli-zones") + "/zonas.csv")
    code, rep = run(capsys, spark, "gold", "--zonas", zpath, "--lake", lake.root)
    assert code == 0 and spark.read.parquet(rep["con_zona"]).count() == 3887

    code, rep = run(capsys, spark, "test", "--lake", lake.root)
    assert code == 0 and rep["violaciones"] == []

    code = cli.main(["viajes", "--hora", "12", "--limite", "5", "--lake", lake.root], spark=spark)
    *trips, totals = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
    assert code == 0 and len(trips) == totals["filas"] == 5 and totals["total"] >= 5
    assert isinstance(trips[0]["ingreso"], str)

    code, rep = run(capsys, spark, "viajes", "--hora", "25", "--lake", lake.root)
    assert code == 2 and "hora" in rep["error"]

    code, rep = run(capsys, spark, "salud", "--lake", lake.root)
    assert code == 0 and rep == {"estado": "ok", "filas": 3887}


def test_landing_command(spark, capsys, tmp_path):
    lake = Lake(scratch(spark, "cli-landing"))
    arrived = tmp_path / "arrived"
    (arrived / "tlc").mkdir(parents=True)
    (arrived / "tlc" / "a.parquet").write_bytes(b"x" * 10)
    (arrived / "tlc" / "b.parquet").write_bytes(b"y" * 3)
    listing = str(tmp_path / "listing.parquet")
    spark.createDataFrame(
        [("tlc/a.parquet", 200, '"e1"', 10), ("tlc/b.parquet", 200, "e2", 5), ("tlc/c.parquet", 403, "e3", 1)],
        "key string, status int, etag string, declared_size bigint",
    ).write.parquet(listing)
    args = ["landing", "--listing", listing, "--llegados", f"file://{arrived}", "--excusados", "403,404",
            "--lake", lake.root]
    code, rep = run(capsys, spark, *args)
    assert rep["resultados"] == {"descargado": 2, "no_disponible": 1}
    assert rep["incompletos"] == 1 and rep["ledger"] == 1 and rep["version"] == 1 and code == 1
    code, rep = run(capsys, spark, *args)   # second run: a.parquet is now present
    assert rep["resultados"] == {"ya_presente": 1, "descargado": 1, "no_disponible": 1}
    assert rep["version"] == 2 and rep["ledger"] == 1   # b.parquet still incomplete


def test_pending_command(spark, capsys, tmp_path):
    lake = Lake(scratch(spark, "cli-pending"))
    silver.land_raw(fixtures.trips_raw(spark, SF_SMALL).where("mes_archivo < '1995-04'"), lake)
    published = str(tmp_path / "published.parquet")
    spark.createDataFrame([("1995-01",), ("1995-02",), ("1995-03",), ("1995-04",), ("1995-05",), ("1995-07",)],
                          "mes string").write.parquet(published)
    code, rep = run(capsys, spark, "pendientes", "--publicados", published, "--meses-extra", "2", "--lake", lake.root)
    assert code == 0 and rep["pendientes"] == ["1995-04", "1995-05"]


def test_missing_layers_are_errors_not_tracebacks(spark, capsys):
    lake = Lake(scratch(spark, "cli-empty"))
    code, rep = run(capsys, spark, "salud", "--lake", lake.root)
    assert code == 1 and "error" in rep
    code, rep = run(capsys, spark, "gold", "--lake", lake.root)
    assert code == 1 and "error" in rep


def test_register_command(spark, capsys):
    from tripmart import tables

    lake = Lake(scratch(spark, "cli-register"))
    silver.land_raw(fixtures.trips_raw(spark, SF_SMALL), lake)
    assert run(capsys, spark, "silver", "yellow", "--mes", "1995-03", "--gold", "--lake", lake.root)[0] == 0
    code, rep = run(capsys, spark, "register", "--lake", lake.root)
    assert code == 0 and set(rep["tablas"]) == {"silver.tlc_yellow", "gold.viajes_por_zona_hora"}
    assert spark.table("gold.viajes_por_zona_hora").count() > 0
    for name in rep["tablas"]:
        tables.drop(spark, name)
    for ns in ("silver", "gold"):
        tables.drop_namespace(spark, ns)
