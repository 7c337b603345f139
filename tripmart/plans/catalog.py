"""The query catalogue: one Spark plan per registered operator.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's
tables (or data Spark derives from them). Queries that exercise sinks write
into a fresh folder below the shared checkpoint directory and return what was
read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import tables
from tripmart.functions.flags import FLAG_NAMES, MONTH, any_flag
from tripmart.functions.months import Month
from tripmart.lake import Lake, list_dirs, read_months, table_exists
from tripmart.operators import checks, gold, landing, ledgers, profile, published, serving, silver, zones
from tripmart.plans import publish, reports
from tripmart.session import configure, scratch
from tripmart.operators.contract import FILE_MONTH
from tripmart.sources import fixtures
from tripmart.sources import zones as zone_source
from tripmart.sources.landed import changed_files, landed_files
from tripmart.streaming import arrivals, changelog, hourly

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the serving queries.
SERVE_HOUR, SERVE_LIMIT = 18, 100
SERVE_MONTH, SERVE_ZONE = "1995-03", 5
# The file month of the query that puts all trips into one month.
ONE_MONTH = "1995-06"
MONEY = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
         "congestion_surcharge", "airport_fee")


def silver_of(spark: SparkSession, sf_dir: str, null_pickup_every: int | None = None) -> DataFrame:
    raw = fixtures.trips_raw(configure(spark), sf_dir, null_pickup_every)
    df, _ = silver.transform(raw, "yellow")
    return df


def mart_of(spark: SparkSession, sf_dir: str, null_pickup_every: int | None = None) -> DataFrame:
    return gold.mart(silver_of(spark, sf_dir, null_pickup_every))


# --- silver -----------------------------------------------------------------
def q_silver_typed(spark, sf_dir):
    return silver_of(spark, sf_dir)


def q_flag_profile(spark, sf_dir):
    return profile.flag_profile(silver_of(spark, sf_dir))


def q_flag_profile_by_month(spark, sf_dir):
    return profile.flag_profile_by_month(silver_of(spark, sf_dir))


def q_flag_nulls(spark, sf_dir):
    return checks.flag_nulls(silver_of(spark, sf_dir))


def q_out_of_month(spark, sf_dir):
    return profile.out_of_month(silver_of(spark, sf_dir))


def q_flagged_share(spark, sf_dir):
    return profile.flagged_share(silver_of(spark, sf_dir))


# --- gold -------------------------------------------------------------------
def q_gold_mart(spark, sf_dir):
    return mart_of(spark, sf_dir)


def q_gold_clean_by_negated_or(spark, sf_dir):
    return gold.aggregate(silver_of(spark, sf_dir).where(~any_flag()))


def q_gold_totals(spark, sf_dir):
    return profile.gold_totals(mart_of(spark, sf_dir))


def q_gold_domain(spark, sf_dir):
    return profile.gold_domain(mart_of(spark, sf_dir))


def q_gold_partitions(spark, sf_dir):
    return checks.partition_counts(mart_of(spark, sf_dir))


def q_gold_violations(spark, sf_dir):
    return checks.mart_violations(mart_of(spark, sf_dir, null_pickup_every=101))


def q_gold_vs_silver(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    return checks.gold_vs_silver(s, gold.mart(s))


def q_canary_count(spark, sf_dir):
    return gold.canary(silver_of(spark, sf_dir))


# --- sinks ------------------------------------------------------------------
def _landed_lake(spark: SparkSession, sf_dir: str, name: str) -> tuple[Lake, list[str]]:
    lake = Lake(scratch(configure(spark), name))
    silver.land_raw(fixtures.trips_raw(spark, sf_dir), lake)
    return lake, silver.landed_raw_months(spark, lake, "yellow")


def _contents_by_month(table: DataFrame) -> DataFrame:
    """Rows, every flag and the exact sum of every money column, by month."""
    return table.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("filas"),
        *[F.count_if(F.col(n)).alias(n) for n in FLAG_NAMES],
        *[F.sum(c).alias(c) for c in MONEY],
        F.sum("passenger_count").alias("passenger_count"),
    )


def q_rewrite_month(spark, sf_dir):
    """Backfill every month in one job, then replace one month twice;
    the table must still hold exactly the raw rows of every month."""
    lake, months = _landed_lake(spark, sf_dir, "rewrite")
    first = silver.materialize(spark, lake, "yellow", months)
    again = [silver.materialize(spark, lake, "yellow", months[len(months) // 2]) for _ in range(2)]
    if not (first.new_table and not any(r.new_table for r in again) and again[0].written == again[1].written):
        raise AssertionError("re-running a month changed the table")
    return _contents_by_month(spark.read.parquet(lake.silver("yellow")))


def q_silver_report(spark, sf_dir):
    """The report of a silver backfill (A2, A3, P3, S6, D5) as one row."""
    lake, months = _landed_lake(spark, sf_dir, "report")
    r = silver.materialize(spark, lake, "yellow", months)
    row = (r.read, r.flagged, r.written, ",".join(r.extras), r.new_table, not r.unequal, sum(r.cast_nulls.values()))
    schema = ("leidas bigint, marcadas bigint, escritas bigint, sobrantes string, tabla_creada boolean, "
              "coherente boolean, nulos_por_cast bigint")
    return spark.createDataFrame([row], schema)


def q_staged_publish(spark, sf_dir):
    """Write months to staging, validate there, publish only if clean."""
    lake, months = _landed_lake(spark, sf_dir, "staged")
    publish.stage_validate_publish(spark, lake, "yellow", months)
    return _contents_by_month(published.silver_rows(spark, lake, "yellow"))


def _emptied(spark, sf_dir, lake, months) -> str:
    """Land the middle month again with every row flagged."""
    middle = months[len(months) // 2]
    silver.land_raw(fixtures.flagged_month(fixtures.trips_raw(spark, sf_dir), middle), lake)
    return middle


def q_refresh_emptied_month(spark, sf_dir):
    """R2: a month re-landed without a clean trip leaves the mart, as in a rebuild."""
    lake, months = _landed_lake(spark, sf_dir, "emptied")
    silver.materialize(spark, lake, "yellow", months)
    gold.build(spark, lake)
    middle = _emptied(spark, sf_dir, lake, months)
    silver.materialize(spark, lake, "yellow", middle)
    gold.refresh(spark, lake, [months[0], middle])
    return serving.read_mart(spark, lake.gold())


def q_publish_emptied_month(spark, sf_dir):
    """Two months published together, one of them now without a clean trip."""
    lake, months = _landed_lake(spark, sf_dir, "publish-emptied")
    publish.stage_validate_publish(spark, lake, "yellow", months)
    middle = _emptied(spark, sf_dir, lake, months)
    publish.stage_validate_publish(spark, lake, "yellow", [months[0], middle])
    return serving.check_mart_schema(published.mart_rows(spark, lake, "yellow"))


def _refused(spark, lake, months, because: str) -> DataFrame:
    """Two marts: that of the silver still published, and the one still published."""
    try:
        publish.stage_validate_publish(spark, lake, "yellow", months)
    except publish.PublishRefused as err:
        if because not in str(err):
            raise AssertionError(f"refused for another reason: {err}") from err
        live = published.silver_rows(spark, lake, "yellow")
        return gold.mart(live).unionByName(serving.check_mart_schema(published.mart_rows(spark, lake, "yellow")))
    raise AssertionError("months that fail a check were published")


def q_publish_refused(spark, sf_dir):
    """One of two staged months fails D1 (hours without a value); nothing published changes."""
    lake, months = _landed_lake(spark, sf_dir, "refused")
    publish.stage_validate_publish(spark, lake, "yellow", months)
    broken = fixtures.trips_raw(spark, sf_dir, null_pickup_every=2).where(F.col(FILE_MONTH) == months[1])
    silver.land_raw(broken, lake)
    return _refused(spark, lake, months[:2], "not_null hora")


def q_publish_corrupted(spark, sf_dir):
    """The files of a staged month are replaced by as many other rows before they are
    published; the digest of their content refuses them, and they are still absent."""
    lake, months = _landed_lake(spark, sf_dir, "corrupted")
    middle = months[len(months) // 2]
    publish.stage_validate_publish(spark, lake, "yellow", [m for m in months if m != middle])
    staged = publish.stage(spark, lake, "yellow", [middle])
    rows = read_months(spark, staged.silver_path, [middle])
    other = f"{lake.root}/other"
    tip = (F.col("tip_amount") + 1).cast(rows.schema["tip_amount"].dataType)
    silver.write_months(rows.withColumn("tip_amount", tip), other)
    silver.write_months(read_months(spark, other, [middle]), staged.silver_path)
    try:
        publish.publish(spark, lake, staged)
    except publish.PublishRefused as err:
        if "do not hold the rows that were written" not in str(err):
            raise
        return _contents_by_month(published.silver_rows(spark, lake, "yellow"))
    raise AssertionError("a month with other rows was published")


def q_publish_while_reading(spark, sf_dir):
    """A reader opens silver and mart, two months are published again (one without a clean
    trip), and only then are the reader's tables computed; beside them what a new reader gets."""
    lake, months = _landed_lake(spark, sf_dir, "reading")
    publish.stage_validate_publish(spark, lake, "yellow", months)

    def opened(label):
        at = published.snapshot(spark, lake, "yellow")
        trips = published.mart_rows(spark, lake, "yellow", at).groupBy(MONTH).agg(F.sum("viajes").alias("viajes"), F.sum("ingreso").alias("ingreso"))
        rows = published.silver_rows(spark, lake, "yellow", at).groupBy(MONTH).agg(
            F.count(F.lit(1)).alias("filas"), F.count_if(~any_flag()).alias("limpias"))
        return rows.join(trips, MONTH, "left").select(F.lit(label).alias("lector"), "*")

    early = opened("antes")
    middle = _emptied(spark, sf_dir, lake, months)
    publish.stage_validate_publish(spark, lake, "yellow", [months[0], middle])
    return early.unionByName(opened("despues"))


def q_raw_single_files(spark, sf_dir):
    """Months landed as single files, backfilled over a range whose last
    two months never landed; those have no rows and no partition."""
    lake = Lake(scratch(configure(spark), "single"))
    months = silver.land_single_files(fixtures.trips_raw(spark, sf_dir), lake)
    end = Month.of(months[-1]).next().next()
    done = silver.backfill(spark, lake, "yellow", months[0], str(end))
    absent = spark.createDataFrame([(m,) for m in done.not_landed], f"{MONTH} string")
    return _contents_by_month(spark.read.parquet(lake.silver("yellow"))).unionByName(absent, allowMissingColumns=True)


def q_incremental_vs_full(spark, sf_dir):
    """R2: full mart, then two months re-materialised and refreshed incrementally;
    the mart must equal a full rebuild."""
    lake, months = _landed_lake(spark, sf_dir, "incremental")
    silver.materialize(spark, lake, "yellow", months)
    gold.build(spark, lake)
    changed = [months[0], months[-1]]
    silver.materialize(spark, lake, "yellow", changed)
    gold.refresh(spark, lake, changed)
    return serving.read_mart(spark, lake.gold())


# --- serving ----------------------------------------------------------------
SERVE_FILTER = serving.TripFilter.parse(hora=str(SERVE_HOUR), limite=str(SERVE_LIMIT))


def q_serve_trips(spark, sf_dir):
    return serving.trips(serving.check_mart_schema(mart_of(spark, sf_dir)), SERVE_FILTER)


def q_serve_json(spark, sf_dir):
    return serving.as_json(q_serve_trips(spark, sf_dir))


def q_mart_state(spark, sf_dir):
    return serving.state(serving.check_mart_schema(mart_of(spark, sf_dir)))


def q_serve_month(spark, sf_dir):
    """F12 by month."""
    return serving.trips(mart_of(spark, sf_dir), serving.TripFilter.parse(mes=SERVE_MONTH))


def q_serve_zone(spark, sf_dir):
    """F12 by zone."""
    return serving.trips(mart_of(spark, sf_dir), serving.TripFilter.parse(zona=str(SERVE_ZONE)))


def q_serve_refusals(spark, sf_dir):
    """F13 over requests: why each is refused, or null."""
    asked = fixtures.requests(configure(spark), sf_dir)
    return asked.select("pedido", serving.refusal(F.col("zona"), F.col("hora"), F.col("limite")).alias("motivo"))


# --- landing ----------------------------------------------------------------
def q_landing_errors(spark, sf_dir):
    """L3, L4: failing statuses and missing sizes."""
    configure(spark)
    found = landing.classify(fixtures.listing_with_errors(spark, sf_dir), fixtures.ledger(spark, sf_dir),
                             excused=landing.TRIPS_NOT_PUBLISHED)
    return found.select("key", "status", "resultado", "motivo")


def q_landing_files(spark, sf_dir):
    """L5, L6 through real files and ledger versions: one folder of lines for each source,
    every fourth with a wrong declared size; two runs, the second after the first's ledger."""
    root = scratch(configure(spark), "landing-files")
    docs = fixtures.table(spark, sf_dir, "documents")
    docs.select("source", F.md5("text").alias("value")).write.partitionBy("source").text(f"{root}/files")
    listing = docs.groupBy(F.col("source").alias("key")).agg(F.count(F.lit(1)).alias("n")).select(
        "key", F.lit(200).alias("status"), F.md5(F.col("n").cast("string")).alias("etag"),
        (F.col("n") * 33 + (F.regexp_extract("key", "[0-9]+", 0).cast("int") % 4 == 0).cast("int")).alias("declared_size"),
    )
    files = landed_files(spark, f"{root}/files", "*.txt")
    landed = files.groupBy(F.regexp_extract("key", "source=([^/]+)/", 1).alias("key")).agg(F.sum("length").alias("length"))
    for _ in range(2):
        known = landing.current_ledger(spark, f"{root}/ledger")
        classified = landing.classify(listing, known)
        landing.write_ledger_version(
            spark, landing.next_ledger(known, landing.verify_sizes(classified, landed)), f"{root}/ledger"
        )
    ledger = landing.current_ledger(spark, f"{root}/ledger").select("key", F.col("etag").alias("marca"), "size")
    return classified.join(ledger, "key", "left").select("key", "resultado", "marca", "size")


def q_landing_changes(spark, sf_dir):
    """L5, L6 by differences: files listed in three runs. Every third
    source gets more lines after the first run, and nothing happens before the last."""
    root = scratch(configure(spark), "landing-changes")
    lines = fixtures.table(spark, sf_dir, "documents").select("source", F.md5("text").alias("value"))
    more = lines.where(F.regexp_extract("source", "[0-9]+", 0).cast("int") % 3 == 0)
    found = []
    for run, landed in enumerate((lines, more, None), start=1):
        if landed is not None:
            landed.write.mode("append").partitionBy("source").text(f"{root}/files")
        files = landed_files(spark, f"{root}/files", "*.txt").groupBy(
            F.regexp_extract("key", "source=([^/]+)/", 1).alias("key")
        ).agg(F.sum("length").alias("length"), F.max("modified").alias("modified"))
        found.append(changed_files(spark, files, f"{root}/snapshots").select(
            F.lit(f"corrida {run}").alias("corrida"), "key", "cambio", "length"))
    state = ledgers.state(spark, f"{root}/snapshots", landing.LISTING_SCHEMA)
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(
        state.select(F.lit("estado").alias("corrida"), "key", F.lit(None).cast("string").alias("cambio"), "length")
    )


def _classified(spark, sf_dir, forced=False):
    configure(spark)
    return landing.classify(
        fixtures.listing(spark, sf_dir), fixtures.ledger(spark, sf_dir), forced, landing.TRIPS_NOT_PUBLISHED
    )


def q_landing_outcome(spark, sf_dir):
    return _classified(spark, sf_dir).select("key", "status", "resultado", "motivo")


def q_landing_forced(spark, sf_dir):
    return _classified(spark, sf_dir, forced=True).select("key", "status", "resultado", "motivo")


def _verified(spark, sf_dir):
    return landing.verify_sizes(_classified(spark, sf_dir), fixtures.landed_objects(spark, sf_dir))


def q_landing_incomplete(spark, sf_dir):
    return _verified(spark, sf_dir)


def q_landing_next_ledger(spark, sf_dir):
    new = landing.next_ledger(fixtures.ledger(spark, sf_dir), _verified(spark, sf_dir))
    return new.select("key", "etag", "size")


def q_pending_months(spark, sf_dir):
    configure(spark)
    return landing.pending_months(
        fixtures.published_months(spark, sf_dir), fixtures.landed_months(spark, sf_dir), months_past_last=3
    )


# --- zones ------------------------------------------------------------------
def _zone_catalogue(spark, sf_dir, drop_id: int | None = None) -> DataFrame:
    """B2 landed as a quoted CSV and read back with the catalogue reader (S3)."""
    path = scratch(configure(spark), "zones") + "/zonas.csv"
    cat = fixtures.zones(spark, sf_dir)
    if drop_id is not None:
        cat = cat.where(F.col("LocationID") != drop_id)
    zone_source.write_zones(cat, path)
    return zone_source.read_zones(spark, path)


def q_zone_names(spark, sf_dir):
    return zones.with_zone_names(mart_of(spark, sf_dir), _zone_catalogue(spark, sf_dir))


def q_zone_gaps(spark, sf_dir):
    return zones.catalogue_problems(silver_of(spark, sf_dir), _zone_catalogue(spark, sf_dir, drop_id=13))


def q_special_zones(spark, sf_dir):
    return zones.special_zone_trips(mart_of(spark, sf_dir), _zone_catalogue(spark, sf_dir))


def q_catalog_names(spark, sf_dir):
    """A table by name, its partitions, what dropping the name leaves, and a
    month that never landed leaving no table."""
    lake, months = _landed_lake(spark, sf_dir, "names")
    silver.materialize(spark, lake, "yellow", months)
    namespace = f"lago_{uuid.uuid4().hex[:12]}"
    tables.ensure_namespace(spark, namespace, f"{lake.root}/{namespace}")
    name = f"{namespace}.tlc_yellow"
    tables.register(spark, name, lake.silver("yellow"))
    rows = [("filas", spark.table(name).count()), ("particiones", tables.partitions(spark, name).count())]
    tables.drop(spark, name)
    tables.drop_namespace(spark, namespace)
    rows += [("nombre tras borrar", int(namespace in tables.namespaces(spark))),
             ("filas tras borrar", spark.read.parquet(lake.silver("yellow")).count())]
    empty = Lake(f"{lake.root}/otro")
    try:
        silver.materialize(spark, empty, "yellow", "2099-01")
    except silver.MonthNotLanded:
        rows.append(("tabla de un mes sin aterrizar", int(table_exists(spark, empty.silver("yellow")))))
    return spark.createDataFrame(rows, "paso string, valor bigint")


def q_tests_that_fail(spark, sf_dir):
    """D2, D3, D6 and D9 on inputs that break them, by case. The mart is computed once and kept,
    since each test reads it."""
    s = silver_of(spark, sf_dir)
    kept = scratch(spark, "tests") + "/mart"
    gold.mart(s).write.parquet(kept)
    mart = spark.read.parquet(kept)
    first = mart.agg(F.min(MONTH)).first()[0]
    zone_list = fixtures.zones(spark, sf_dir)
    twice = zone_list.unionByName(zone_list.where("LocationID IN (7, 9)"))

    def of(case, counted):
        return counted.select(F.lit(case).alias("caso"), "prueba", "sujetos", "violaciones")

    unequal = checks.gold_vs_silver(s, mart.where(F.col(MONTH) != first)).where(~F.col("cuadra"))
    return (
        of("zona repetida", checks.violation_counts(
            checks.mart_violations(mart.unionByName(mart.where(F.col("pu_location_id") == SERVE_ZONE)))))
        .unionByName(of("mart vacio", checks.violation_counts(checks.mart_violations(mart.where(F.lit(False))))))
        .unionByName(of("falta un mes", checks.violation_counts(unequal.select(
            F.lit("gold_vs_silver").alias("prueba"), F.col(MONTH).alias("sujeto"),
            (F.col("limpias") - F.col("viajes")).alias("violaciones")))))
        .unionByName(of("id repetido", checks.violation_counts(zones.id_duplicates(twice).select(
            F.lit("id_unico").alias("prueba"), F.col(zones.ZONE_ID).cast("string").alias("sujeto"),
            F.col("n").alias("violaciones")))))
    )


def q_income_text_other_scale(spark, sf_dir):
    """D10 on a mart whose income has another scale and whose dearest groups have lost theirs: it fires."""
    dear = F.col("ingreso") >= 1000
    text = F.when(dear, F.col("ingreso").cast("decimal(20,0)").cast("string")).when(
        F.col("hora") == SERVE_HOUR, F.col("ingreso").cast("decimal(20,3)").cast("string")).otherwise(F.col("ingreso").cast("string"))
    return checks.not_two_decimals(mart_of(spark, sf_dir).withColumn("ingreso", text), "ingreso")


def q_flag_list(spark, sf_dir):
    """The flags as silver holds them, in order, with their rows; gold drops by the same list."""
    s = silver_of(spark, sf_dir)
    held = [f.name for f in s.schema.fields if f.dataType.simpleString() == "boolean"]
    if tuple(held) != FLAG_NAMES:
        raise AssertionError(f"silver holds {held}")
    counts = s.agg(F.count_if(any_flag()).alias("__any"), *[F.count_if(F.col(n)).alias(n) for n in held])
    return counts.select("__any", F.posexplode(F.array(*[F.struct(F.lit(n).alias("marca"), F.col(n).alias("filas")) for n in held]))).select(
        (F.col("pos") + 1).alias("orden"), "col.marca", "col.filas", F.col("__any").alias("sin_oro")
    )


def q_income_text(spark, sf_dir):
    """Incomes that do not print with two decimals."""
    return checks.income_text(mart_of(spark, sf_dir))


# --- profiles ---------------------------------------------------------------
def q_speed_profile(spark, sf_dir):
    return profile.speed_profile(silver_of(spark, sf_dir))


def q_speed_profile_one_month(spark, sf_dir):
    """A11 with every trip in one file month: more rows than any bound of the ranking."""
    lake = Lake(scratch(configure(spark), "one-month"))
    silver.land_raw(fixtures.trips_raw(spark, sf_dir).withColumn(FILE_MONTH, F.lit(ONE_MONTH)), lake)
    silver.materialize(spark, lake, "yellow", ONE_MONTH)
    return profile.speed_profile(spark.read.parquet(lake.silver("yellow")))


def q_negative_by_payment(spark, sf_dir):
    return profile.negative_by_payment(silver_of(spark, sf_dir))


def q_null_together(spark, sf_dir):
    return profile.null_together(silver_of(spark, sf_dir))


def q_flagged_with_null_passengers(spark, sf_dir):
    return profile.flagged_with_null_passengers(silver_of(spark, sf_dir))


def q_distance_outlier(spark, sf_dir):
    return profile.distance_outlier(silver_of(spark, sf_dir))


# --- hourly events ----------------------------------------------------------
def _all_events(spark, sf_dir):
    return fixtures.table(configure(spark), sf_dir, "events")


def q_hourly_events(spark, sf_dir):
    return hourly.hourly_counts(_all_events(spark, sf_dir))


def q_missing_hours(spark, sf_dir):
    return hourly.missing_hours(fixtures.landed_events(configure(spark), sf_dir))


def _streamed(spark, root):
    query = hourly.start_hourly_stream(spark, f"{root}/files", f"{root}/counts", f"{root}/checkpoint")
    query.awaitTermination()


def q_hourly_events_stream(spark, sf_dir):
    """The hourly count again, landed as gzip JSON files and counted by a stream."""
    root = scratch(configure(spark), "hourly")
    hourly.land_hourly_files(_all_events(spark, sf_dir), f"{root}/files")
    _streamed(spark, root)
    return hourly.read_hourly_sink(spark, f"{root}/counts")


def q_hourly_events_two_runs(spark, sf_dir):
    """The stream run twice, the older hours landing after the newer ones were counted."""
    root = scratch(configure(spark), "hourly-two")
    events = _all_events(spark, sf_dir)
    newer = F.dayofmonth("ts") >= 10
    for part in (events.where(newer), events.where(~newer)):
        hourly.land_hourly_files(part, f"{root}/files", mode="append")
        _streamed(spark, root)
    return hourly.read_hourly_sink(spark, f"{root}/counts")


def q_hourly_events_compacted(spark, sf_dir):
    """The changelog compacted after every second trigger; one more compaction stops
    before its pointer, and counts stay as they are."""
    root = scratch(configure(spark), "hourly-compacted")
    hourly.land_hourly_files(_all_events(spark, sf_dir), f"{root}/files")
    sink = f"{root}/counts"
    hourly.start_hourly_stream(
        spark, f"{root}/files", sink, f"{root}/checkpoint", max_files_per_trigger=150, compact_every=2
    ).awaitTermination()
    at = changelog.pointer(spark, sink)
    if at.number < 2 or len(list_dirs(spark, f"{sink}/tail/lote=*")) > 4 or len(list_dirs(spark, f"{sink}/base/v=*")) > 2:
        raise AssertionError("the changelog was not compacted")
    changelog.write_base(spark, sink, at, [at.upto])
    return hourly.read_hourly_sink(spark, sink)


def q_hourly_events_by_arrival(spark, sf_dir):
    """Landings with numbers, counted after each, twice after the last, and compacted on the way;
    every other event of the older hours lands last."""
    root = scratch(configure(spark), "hourly-arrivals")
    events = _all_events(spark, sf_dir)
    newer, odd = F.dayofmonth("ts") >= 10, F.col("event_id") % 2 == 1
    for part in (events.where(newer), events.where(~newer & ~odd), events.where(~newer & odd)):
        arrivals.land(part, root)
        arrivals.count_new(spark, root, f"{root}/counts", compact_every=2)
    if arrivals.count_new(spark, root, f"{root}/counts"):
        raise AssertionError("landings were counted again")
    return hourly.read_hourly_sink(spark, f"{root}/counts")


# --- contract ---------------------------------------------------------------
def q_contract_report(spark, sf_dir):
    """Months landed with differing schemas, reported from their files."""
    lake = Lake(scratch(configure(spark), "contract"))
    for part in fixtures.months_in_variants(fixtures.trips_raw(spark, sf_dir)).values():
        silver.land_raw(part, lake)
    return reports.contract_by_month(spark, lake, "yellow", silver.landed_raw_months(spark, lake, "yellow"))


QUERIES: dict[str, Query] = {
    "silver_typed": q_silver_typed,
    "flag_profile": q_flag_profile,
    "flag_profile_by_month": q_flag_profile_by_month,
    "flag_nulls": q_flag_nulls,
    "out_of_month": q_out_of_month,
    "flagged_share": q_flagged_share,
    "gold_mart": q_gold_mart,
    "gold_clean_by_negated_or": q_gold_clean_by_negated_or,
    "gold_totals": q_gold_totals,
    "gold_domain": q_gold_domain,
    "gold_partitions": q_gold_partitions,
    "gold_violations": q_gold_violations,
    "gold_vs_silver": q_gold_vs_silver,
    "rewrite_month": q_rewrite_month,
    "incremental_vs_full": q_incremental_vs_full,
    "canary_count": q_canary_count,
    "serve_trips": q_serve_trips,
    "serve_json": q_serve_json,
    "mart_state": q_mart_state,
    "landing_outcome": q_landing_outcome,
    "landing_forced": q_landing_forced,
    "landing_incomplete": q_landing_incomplete,
    "landing_next_ledger": q_landing_next_ledger,
    "pending_months": q_pending_months,
    "zone_names": q_zone_names,
    "zone_gaps": q_zone_gaps,
    "special_zones": q_special_zones,
    "speed_profile": q_speed_profile,
    "negative_by_payment": q_negative_by_payment,
    "null_together": q_null_together,
    "flagged_with_null_passengers": q_flagged_with_null_passengers,
    "distance_outlier": q_distance_outlier,
    "hourly_events": q_hourly_events,
    "missing_hours": q_missing_hours,
    "hourly_events_stream": q_hourly_events_stream,
    "staged_publish": q_staged_publish,
    "silver_report": q_silver_report,
    "contract_report": q_contract_report,
    "speed_profile_one_month": q_speed_profile_one_month,
    "hourly_events_two_runs": q_hourly_events_two_runs,
    "hourly_events_compacted": q_hourly_events_compacted,
    "hourly_events_by_arrival": q_hourly_events_by_arrival,
    "refresh_emptied_month": q_refresh_emptied_month,
    "publish_emptied_month": q_publish_emptied_month,
    "publish_refused": q_publish_refused,
    "publish_corrupted": q_publish_corrupted,
    "publish_while_reading": q_publish_while_reading,
    "raw_single_files": q_raw_single_files,
    "landing_errors": q_landing_errors,
    "landing_files": q_landing_files,
    "landing_changes": q_landing_changes,
    "tests_that_fail": q_tests_that_fail,
    "income_text": q_income_text,
    "income_text_other_scale": q_income_text_other_scale,
    "flag_list": q_flag_list,
    "serve_month": q_serve_month,
    "serve_zone": q_serve_zone,
    "serve_refusals": q_serve_refusals,
    "catalog_names": q_catalog_names,
}
