"""Command line over the library: the commands a user of the reference runs.

    python -m tripmart silver yellow --mes 2024-01 --lake ROOT [--hasta 2024-06] [--gold]
    python -m tripmart gold --lake ROOT [--meses 2024-01,2024-02] [--zonas zonas.csv]
    python -m tripmart test --lake ROOT
    python -m tripmart viajes --lake ROOT [--mes M] [--zona Z] [--hora H] [--limite N]
    python -m tripmart salud --lake ROOT
    python -m tripmart pendientes --lake ROOT --publicados P.parquet [--meses-extra 3]
    python -m tripmart landing --lake ROOT --listing L.parquet [--llegados DIR] [--forzar] [--excusados 403,404]
    python -m tripmart register --lake ROOT

The session comes from ``SparkSession.builder.getOrCreate()`` (``spark-submit``
settings apply). Exit codes: 0 done, 1 the data failed a check, 2 bad arguments.
"""

from __future__ import annotations

import argparse
import json
import sys
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripmart import tables
from tripmart.functions import months as M
from tripmart.lake import Lake
from tripmart.operators import checks, gold, landing, ledgers, published, serving, silver
from tripmart.operators.contract import ContractError
from tripmart.plans import publish
from tripmart.session import configure
from tripmart.sources.landed import landed_files
from tripmart.sources.zones import read_zones


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tripmart")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("silver", help="type, flag and write months of raw into silver")
    s.add_argument("service")
    s.add_argument("--mes", required=True)
    s.add_argument("--hasta", help="last month of a range backfill")
    s.add_argument("--gold", action="store_true", help="then refresh the mart for the months written")
    g = sub.add_parser("gold", help="rebuild the mart, or refresh some months")
    g.add_argument("--meses", help="comma-separated months to refresh")
    g.add_argument("--zonas", help="zone catalogue CSV; also writes the mart with zone names")
    t = sub.add_parser("test", help="data tests over the mart; fails when any returns rows")
    t.add_argument("--detalle", help="folder for the full list of violations, as a table")
    v = sub.add_parser("viajes", help="filtered, limited trips of the mart as JSON")
    for name in ("mes", "zona", "hora", "limite"):
        v.add_argument(f"--{name}")
    h = sub.add_parser("salud", help="mart state")
    for cmd in (v, h):
        cmd.add_argument("--publicado", metavar="SERVICE", help="the mart of this service's current publication")
    pb = sub.add_parser("publicar", help="stage months and their mart, decide, and publish them together")
    pb.add_argument("service")
    pb.add_argument("--mes", required=True)
    pb.add_argument("--hasta", help="last month of a range; months that are not in raw are reported")
    pe = sub.add_parser("pendientes", help="months of a backfill range still to land")
    pe.add_argument("--publicados", required=True, help="parquet with a 'mes' column of published months")
    pe.add_argument("--meses-extra", type=int, default=0, dest="extra",
                    help="months past the last published one to include in the range")
    ld = sub.add_parser("landing", help="classify a source listing against the ledger, write the next ledger")
    ld.add_argument("--listing", required=True, help="parquet: key, status, etag, declared_size")
    ld.add_argument("--llegados", help="folder of what arrived; sizes are checked against the listing")
    ld.add_argument("--forzar", action="store_true")
    ld.add_argument("--excusados", default="", help="comma-separated statuses meaning 'not published'")
    sub.add_parser("register", help="catalog names for the lake's tables")
    for cmd in sub.choices.values():
        cmd.add_argument("--lake", required=True, help="root folder of the lake")
        cmd.add_argument("--service", default="yellow", dest="svc")
    return p


def _json_default(value):
    if isinstance(value, Decimal):
        return str(value)
    return str(value)


def _print(obj) -> None:
    print(json.dumps(obj, default=_json_default, ensure_ascii=False))


def _landing(spark: SparkSession, lake: Lake, args) -> int:
    """One landing decision run: outcomes, size check, next ledger version."""
    excused = tuple(int(x) for x in args.excusados.split(",") if x.strip())
    listing = spark.read.parquet(args.listing)
    ledger = ledgers.state(spark, lake.landing(), landing.LEDGER_SCHEMA)
    classified = landing.classify(listing, ledger, args.forzar, excused)
    counts = {r["resultado"]: r["n"] for r in landing.outcome_counts(classified).collect()}
    out = {"resultados": counts}
    if args.llegados:
        verified = landing.verify_sizes(classified, landed_files(spark, args.llegados))
        out["incompletos"] = verified.where(~F.col("completo")).count()
        version = ledgers.append(spark, landing.accepted(verified), lake.landing())
        out["version"] = version
        out["ledger"] = ledgers.state(spark, lake.landing(), landing.LEDGER_SCHEMA).count()
    _print(out)
    return 1 if counts.get(landing.ERROR) or out.get("incompletos") else 0


def _mart(spark: SparkSession, lake: Lake, args):
    """The rebuilt mart, or that of the current publication."""
    if args.publicado:
        return serving.check_mart_schema(published.mart_rows(spark, lake, args.publicado))
    return serving.read_mart(spark, lake.gold())


def _publish(spark: SparkSession, lake: Lake, args) -> int:
    wanted = M.month_range(args.mes, args.hasta or args.mes)
    landed = set(silver.landed_raw_months(spark, lake, args.service))
    months, missing = [m for m in wanted if m in landed], [m for m in wanted if m not in landed]
    if not months:
        _print({"error": "no month of the range is in raw", "sin_raw": missing})
        return 1
    run = publish.stage_validate_publish(spark, lake, args.service, months)
    at = published.snapshot(spark, lake, args.service)
    _print({"publicacion": at.number, "meses": list(run.months), "leidas": run.read, "marcadas": run.flagged, "sin_raw": missing})
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.getOrCreate())
    lake = Lake(args.lake)
    try:
        if args.command == "silver":
            if args.hasta:
                done = silver.backfill(spark, lake, args.service, args.mes, args.hasta)
            else:
                done = silver.Backfill(silver.materialize(spark, lake, args.service, args.mes), ())
            run, missing = done.run, list(done.not_landed)
            if run is None:
                _print({"error": "no month of the range is in raw", "sin_raw": missing})
                return 1
            out = {"tabla": run.table, "meses": list(run.months), "leidas": run.read, "marcadas": run.flagged,
                   "escritas": run.written, "sobrantes": list(run.extras), "tabla_creada": run.new_table,
                   "nulos_por_cast": run.cast_nulls, "sin_raw": missing}
            if args.gold:
                out["mart"] = gold.refresh(spark, lake, list(run.months), args.service)
            _print(out)
            return 0
        if args.command == "gold":
            if args.meses:
                gold.refresh(spark, lake, [M.month_text(m) for m in args.meses.split(",")], args.svc)
            else:
                gold.build(spark, lake, args.svc)
            out = {"mart": lake.gold(), "filas": spark.read.parquet(lake.gold()).count()}
            if args.zonas:
                out["con_zona"] = gold.build_with_names(spark, lake, read_zones(spark, args.zonas))
            _print(out)
            return 0
        if args.command == "test":
            mart = serving.read_mart(spark, lake.gold())
            # a row for each test that fails; D6 has one row for each month
            found = [r.asDict() for r in checks.violation_counts(checks.mart_violations(mart)).collect()]
            mismatch = checks.gold_vs_silver(spark.read.parquet(lake.silver(args.svc)), mart)
            found += [{"prueba": "gold_vs_silver", "sujetos": 1, "violaciones": 1, "mes": r[0]}
                      for r in mismatch.where(~F.col("cuadra")).select("mes").collect()]
            if found and args.detalle:
                checks.mart_violations(mart).write.mode("overwrite").parquet(args.detalle)
            _print({"violaciones": found})
            return 1 if found else 0
        if args.command == "viajes":
            flt = serving.TripFilter.parse(mes=args.mes, zona=args.zona, hora=args.hora, limite=args.limite)
            # one partition of rows at a time: the whole mart never sits in the driver
            filas = total = 0
            for r in serving.trips(_mart(spark, lake, args), flt).toLocalIterator():
                row = r.asDict()
                filas, total = filas + 1, row.pop("total")
                row["ingreso"] = str(row["ingreso"])
                _print(row)
            _print({"filas": filas, "total": total})
            return 0
        if args.command == "pendientes":
            offered = spark.read.parquet(args.publicados).select("mes")
            landed = spark.createDataFrame([(m,) for m in silver.landed_raw_months(spark, lake, args.svc)], "mes string")
            pending = landing.pending_months(offered, landed, args.extra)
            _print({"pendientes": sorted(r["mes"] for r in pending.collect())})
            return 0
        if args.command == "publicar":
            return _publish(spark, lake, args)
        if args.command == "landing":
            return _landing(spark, lake, args)
        if args.command == "salud":
            _print(serving.state(_mart(spark, lake, args)).first().asDict())
            return 0
        if args.command == "register":
            _print({"tablas": tables.register_lake(spark, lake, args.svc)})
            return 0
    except serving.InvalidFilter as err:
        _print({"error": str(err)})
        return 2
    except (M.BadMonth, M.BadService) as err:
        _print({"error": str(err)})
        return 2
    except (silver.MonthNotLanded, silver.EmptyMonth, silver.IncoherentPartition, ContractError,
            gold.EmptyMart, serving.MartSchemaError,
            publish.PublishRefused, published.NothingPublished, published.Contended) as err:
        _print({"error": str(err)})
        return 1
    except AnalysisException as err:  # a layer that is not there or cannot be read
        _print({"error": str(err).splitlines()[0]})
        return 1
    return 2


if __name__ == "__main__":
    sys.exit(main())
