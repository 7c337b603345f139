"""DuckDB renderings of every registered query, for side-by-side comparison.

The SQL is written independently of the Spark plans, following the engine rules
of FIXTURES.md part C: ``date_sub('second', a, b)`` for whole elapsed seconds,
``strftime`` for month text, decimal sums cast to Spark's result precision,
``hour`` cast to int, ``count`` as bigint.
"""

from __future__ import annotations

FLAGS = (
    "fuera_de_mes",
    "cronologia_invalida",
    "duracion_absurda",
    "sin_distancia",
    "velocidad_absurda",
    "importe_negativo",
    "pasajeros_cero",
)
DUR = "date_sub('second', pickup_datetime, dropoff_datetime)"


def _trips_raw(null_pickup_every: int | None = None) -> str:
    pickup = "p" if null_pickup_every is None else f"CASE WHEN l_orderkey % {null_pickup_every} = 0 THEN NULL ELSE p END"
    return f"""trips_raw AS (
  SELECT CAST(l_linenumber % 3 + 1 AS BIGINT) AS VendorID,
         strftime(l_shipdate, '%Y-%m') AS mes_archivo,
         {pickup} AS tpep_pickup_datetime,
         p + to_seconds(CAST((l_orderkey * 7 + l_partkey * 13) % 5400 - 30
           + CASE WHEN l_partkey % 499 = 0 THEN 90000 ELSE 0 END AS INT)) AS tpep_dropoff_datetime,
         CASE WHEN l_orderkey % 21 = 0 THEN NULL ELSE CAST(l_linenumber - 1 AS BIGINT) END AS passenger_count,
         CASE WHEN l_suppkey % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity / CAST(4 AS DOUBLE) END AS trip_distance,
         CASE WHEN l_orderkey % 21 = 0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS RatecodeID,
         CASE WHEN l_orderkey % 21 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'N' ELSE 'Y' END AS store_and_fwd_flag,
         CAST(l_partkey % 27 + 1 AS BIGINT) AS PULocationID,
         CAST(l_suppkey % 27 + 1 AS BIGINT) AS DOLocationID,
         CAST(l_orderkey % 4 + 1 AS BIGINT) AS payment_type,
         l_extendedprice AS fare_amount,
         CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
         l_discount AS tip_amount, CAST(0 AS DOUBLE) AS tolls_amount,
         CAST(1 AS DOUBLE) AS improvement_surcharge,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -l_extendedprice ELSE l_extendedprice END AS total_amount,
         CASE WHEN l_orderkey % 21 = 0 THEN NULL ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
         CASE WHEN l_orderkey % 21 = 0 THEN NULL ELSE CAST(1.25 AS DOUBLE) END AS Airport_fee
  FROM (SELECT *, l_shipdate + to_seconds(CAST((l_partkey * 37 + l_suppkey * 61 + l_linenumber * 7919) % 86400
          - CASE WHEN l_orderkey % 997 = 0 THEN 5184000 ELSE 0 END AS INT)) AS p
        FROM lineitem) AS x
)"""


_TYPED = """typed AS (
  SELECT CAST(VendorID AS INT) AS vendor_id,
         CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
         CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
         CAST(passenger_count AS INT) AS passenger_count,
         CAST(trip_distance AS DOUBLE) AS trip_distance,
         CAST(RatecodeID AS INT) AS ratecode_id,
         CAST(store_and_fwd_flag AS VARCHAR) AS store_and_fwd_flag,
         CAST(PULocationID AS INT) AS pu_location_id,
         CAST(DOLocationID AS INT) AS do_location_id,
         CAST(payment_type AS INT) AS payment_type,
         CAST(fare_amount AS DECIMAL(10,2)) AS fare_amount,
         CAST(extra AS DECIMAL(10,2)) AS extra,
         CAST(mta_tax AS DECIMAL(10,2)) AS mta_tax,
         CAST(tip_amount AS DECIMAL(10,2)) AS tip_amount,
         CAST(tolls_amount AS DECIMAL(10,2)) AS tolls_amount,
         CAST(improvement_surcharge AS DECIMAL(10,2)) AS improvement_surcharge,
         CAST(total_amount AS DECIMAL(10,2)) AS total_amount,
         CAST(congestion_surcharge AS DECIMAL(10,2)) AS congestion_surcharge,
         CAST(Airport_fee AS DECIMAL(10,2)) AS airport_fee,
         mes_archivo AS mes
  FROM trips_raw
)"""

_SILVER = f"""silver AS (
  SELECT *,
    coalesce(strftime(pickup_datetime, '%Y-%m') <> mes, false) AS fuera_de_mes,
    coalesce({DUR} <= 0, false) AS cronologia_invalida,
    coalesce({DUR} > 86400, false) AS duracion_absurda,
    coalesce(trip_distance <= 0, false) AS sin_distancia,
    coalesce(CASE WHEN {DUR} > 0 THEN trip_distance / ({DUR} / 3600.0) > 100 END, false) AS velocidad_absurda,
    coalesce(total_amount < 0, false) AS importe_negativo,
    coalesce(passenger_count = 0, false) AS pasajeros_cero
  FROM typed
)"""

CLEAN = " AND ".join(f"NOT {f}" for f in FLAGS)
ANY = " OR ".join(FLAGS)

_MART = f"""mart AS (
  SELECT mes, pu_location_id, CAST(hour(pickup_datetime) AS INT) AS hora,
         count(*) AS viajes,
         CAST(sum(total_amount) AS DECIMAL(20,2)) AS ingreso,
         sum(trip_distance) AS distancia_total,
         avg({DUR}) AS duracion_media_seg
  FROM silver
  WHERE {CLEAN}
  GROUP BY mes, pu_location_id, CAST(hour(pickup_datetime) AS INT)
)"""

_ZONES = """zones AS (
  SELECT CAST(n_nationkey + 1 AS INT) AS LocationID, r_name AS Borough, n_name AS Zone, 'Zone' AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 26, 'Unknown', 'N/A', 'N/A'
  UNION ALL SELECT 27, 'N/A', 'Outside of NYC', 'N/A'
)"""


def with_silver(body: str, null_pickup_every: int | None = None, extra: str = "") -> str:
    ctes = [_trips_raw(null_pickup_every), _TYPED, _SILVER] + ([extra] if extra else [])
    return "WITH " + ",\n".join(ctes) + "\n" + body


def with_mart(body: str, extra: str = "", null_pickup_every: int | None = None) -> str:
    ctes = [_trips_raw(null_pickup_every), _TYPED, _SILVER, _MART]
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body


_MART_COLS = "mes, pu_location_id, hora, viajes, ingreso, distancia_total, duracion_media_seg"

_LISTING = """listing AS (
  SELECT doc_id AS key, CASE WHEN doc_id % 17 = 0 THEN 403 ELSE 200 END AS status,
         coalesce(regexp_replace(md5(text), '^"+|"+$', '', 'g'), '') AS etag, n_chars AS declared_size
  FROM documents
), ledger AS (
  SELECT doc_id AS key, CASE WHEN doc_id % 5 = 0 THEN md5('old') ELSE md5(text) END AS etag,
         n_chars AS size
  FROM documents WHERE doc_id % 3 <> 0
)"""


def _classified(forced: bool, excused: tuple[int, ...]) -> str:
    exc = f"status IN ({', '.join(map(str, excused))})" if excused else "false"
    force = "true" if forced else "false"
    return f"""classified AS (
  SELECT l.key, l.status, l.etag, l.declared_size, g.etag AS recorded_etag,
    CASE WHEN {exc} THEN 'no_disponible'
         WHEN status >= 400 THEN 'error'
         WHEN declared_size IS NULL THEN 'error'
         WHEN g.etag IS NULL OR {force} THEN 'descargado'
         WHEN g.etag = l.etag THEN 'ya_presente'
         ELSE 'revision' END AS resultado,
    CASE WHEN {exc} THEN NULL
         WHEN status >= 400 THEN 'status ' || CAST(status AS VARCHAR)
         WHEN declared_size IS NULL THEN 'no declared size' END AS motivo
  FROM listing l LEFT JOIN ledger g ON l.key = g.key
)"""


def _landing(body: str, forced: bool = False, excused: tuple[int, ...] = (403, 404), extra: str = "") -> str:
    ctes = [_LISTING, _classified(forced, excused)] + ([extra] if extra else [])
    return "WITH " + ",\n".join(ctes) + "\n" + body


_LANDED = """landed AS (SELECT doc_id AS key, CAST(strlen(text) AS BIGINT) AS length FROM documents),
verified AS (
  SELECT c.key, c.etag, c.declared_size, d.length, c.resultado,
         coalesce(d.length = c.declared_size, false) AS completo
  FROM classified c LEFT JOIN landed d ON c.key = d.key
  WHERE c.resultado IN ('descargado', 'revision')
)"""

_HOURLY = "SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hora, count(*) AS eventos FROM events GROUP BY 1"
_EVENTS_LANDED = """landed_events AS (
  SELECT * FROM events
  WHERE NOT ((day(ts) % 5 = 0 AND hour(ts) = 4) OR (day(ts) = 11 AND hour(ts) = 13))
)"""

_MPH = f"""mph AS (
  SELECT mes, trip_distance / (CAST({DUR} AS DOUBLE) / CAST(3600 AS DOUBLE)) AS mph
  FROM silver WHERE {DUR} > 0 AND trip_distance IS NOT NULL
), ranked AS (
  SELECT mes, mph, row_number() OVER (PARTITION BY mes ORDER BY mph) AS rn,
         count(*) OVER (PARTITION BY mes) AS n FROM mph
)"""


def _pct(col: str) -> str:
    return f"round({col} * CAST(100 AS DOUBLE) / filas, 2)"


def _json_text() -> str:
    return (
        """'{"mes":"' || mes || '","zona":' || CAST(zona AS VARCHAR) || ',"hora":' || CAST(hora AS VARCHAR)"""
        """ || ',"viajes":' || CAST(viajes AS VARCHAR) || ',"ingreso":"' || CAST(ingreso AS VARCHAR)"""
        """ || '","distancia_total":' || CAST(distancia_total AS VARCHAR)"""
        """ || ',"duracion_media_seg":' || CAST(duracion_media_seg AS VARCHAR) || '}'"""
    )


SERVE_HOUR = 18
SERVE_LIMIT = 100

_SERVE = f"""served AS (
  SELECT mes, pu_location_id AS zona, hora, viajes, ingreso, distancia_total, duracion_media_seg,
         (SELECT count(*) FROM mart WHERE hora = {SERVE_HOUR}) AS total
  FROM mart WHERE hora = {SERVE_HOUR}
  ORDER BY mes, pu_location_id, hora
  LIMIT {SERVE_LIMIT}
)"""


_CONTENTS = (
    "SELECT mes, count(*) AS filas, "
    + ", ".join(f"CAST(count_if({f}) AS BIGINT) AS {f}" for f in FLAGS) + ", "
    + ", ".join(f"CAST(sum({c}) AS DECIMAL(20,2)) AS {c}" for c in (
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
        "congestion_surcharge", "airport_fee"))
    + ", CAST(sum(passenger_count) AS BIGINT) AS passenger_count FROM silver GROUP BY mes"
)
# The month in the middle of the sorted months.
_MIDDLE = ("(SELECT mes FROM (SELECT mes, row_number() OVER (ORDER BY mes) - 1 AS i, count(*) OVER () AS n "
           "FROM (SELECT DISTINCT mes FROM silver)) WHERE i = n // 2)")


def _contract_report() -> str:
    kind = "CAST(substr(mes, 6, 2) AS INT) % 5"
    return (
        f"WITH {_trips_raw()}, t AS (SELECT *, mes_archivo AS mes FROM trips_raw) "
        f"SELECT mes, CASE WHEN {kind} = 2 THEN 17 ELSE 19 END AS columnas, "
        f"CASE WHEN {kind} = 2 THEN 'RatecodeID,tolls_amount' ELSE '' END AS ausentes, "
        f"CASE WHEN {kind} = 3 THEN 'peaje_puente' ELSE '' END AS sobrantes, count(*) AS filas, "
        f"CASE WHEN {kind} = 2 THEN NULL WHEN {kind} = 4 THEN CAST(count_if(VendorID = 1 "
        "AND TRY_CAST(fare_amount * 1e7 AS DECIMAL(10,2)) IS NULL) AS BIGINT) ELSE 0 END AS perdidas, "
        f"true AS tipos_ok, {kind} <> 2 AS contrato_ok FROM t GROUP BY mes"
    )


def oracle_sql() -> dict[str, str]:
    flag_counts = ", ".join(f"CAST(count_if({f}) AS BIGINT) AS {f}" for f in FLAGS)
    return {
        "silver_typed": with_silver("SELECT * FROM silver"),
        "flag_profile": with_silver(
            f"SELECT count(*) AS filas, CAST(count_if({ANY}) AS BIGINT) AS marcadas, {flag_counts} FROM silver"
        ),
        "flag_profile_by_month": with_silver(
            f"SELECT mes, count(*) AS filas, CAST(count_if({ANY}) AS BIGINT) AS marcadas, {flag_counts} "
            "FROM silver GROUP BY mes"
        ),
        "flag_nulls": with_silver(
            "SELECT " + ", ".join(f"CAST(count_if({f} IS NULL) AS BIGINT) AS {f}" for f in FLAGS) + " FROM silver"
        ),
        "out_of_month": with_silver(
            "SELECT mes, CAST(count_if(strftime(pickup_datetime, '%Y-%m') <> mes) AS BIGINT) AS fuera "
            "FROM silver GROUP BY mes"
        ),
        "flagged_share": with_silver(
            f"SELECT mes, filas, marcadas, {_pct('marcadas')} AS pct_marcadas FROM ("
            f"SELECT mes, count(*) AS filas, CAST(count_if({ANY}) AS BIGINT) AS marcadas FROM silver GROUP BY mes)"
        ),
        "gold_mart": with_mart(f"SELECT {_MART_COLS} FROM mart"),
        "gold_clean_by_negated_or": with_silver(
            f"SELECT mes, pu_location_id, CAST(hour(pickup_datetime) AS INT) AS hora, count(*) AS viajes, "
            f"CAST(sum(total_amount) AS DECIMAL(20,2)) AS ingreso, sum(trip_distance) AS distancia_total, "
            f"avg({DUR}) AS duracion_media_seg FROM silver WHERE NOT ({ANY}) "
            f"GROUP BY mes, pu_location_id, CAST(hour(pickup_datetime) AS INT)"
        ),
        "gold_totals": with_mart(
            "SELECT CAST(sum(viajes) AS BIGINT) AS viajes, CAST(sum(ingreso) AS DECIMAL(30,2)) AS ingreso, "
            "round(sum(distancia_total), 2) AS distancia FROM mart"
        ),
        "gold_domain": with_mart(
            "SELECT count(DISTINCT pu_location_id) AS zonas, count(DISTINCT hora) AS horas, "
            "min(hora) AS hora_min, max(hora) AS hora_max, count(DISTINCT mes) AS meses FROM mart"
        ),
        "gold_partitions": with_mart("SELECT mes, count(*) AS record_count FROM mart GROUP BY mes"),
        "gold_violations": with_mart(
            "SELECT 'not_null' AS prueba, sujeto, violaciones FROM ("
            "SELECT 'mes' AS sujeto, CAST(count_if(mes IS NULL) AS BIGINT) AS violaciones FROM mart UNION ALL "
            "SELECT 'pu_location_id', CAST(count_if(pu_location_id IS NULL) AS BIGINT) FROM mart UNION ALL "
            "SELECT 'hora', CAST(count_if(hora IS NULL) AS BIGINT) FROM mart UNION ALL "
            "SELECT 'viajes', CAST(count_if(viajes IS NULL) AS BIGINT) FROM mart UNION ALL "
            "SELECT 'ingreso', CAST(count_if(ingreso IS NULL) AS BIGINT) FROM mart) WHERE violaciones > 0 "
            "UNION ALL SELECT 'grain_unique', concat_ws('|', coalesce(mes, 'null'), "
            "coalesce(CAST(pu_location_id AS VARCHAR), 'null'), coalesce(CAST(hora AS VARCHAR), 'null')), count(*) "
            "FROM mart GROUP BY mes, pu_location_id, hora HAVING count(*) > 1 "
            "UNION ALL SELECT 'not_empty', 'mart', CAST(1 AS BIGINT) WHERE (SELECT count(*) FROM mart) = 0",
            null_pickup_every=101,
        ),
        "gold_vs_silver": with_mart(
            f"SELECT coalesce(c.mes, t.mes) AS mes, coalesce(c.limpias, 0) AS limpias, "
            f"CAST(coalesce(t.viajes, 0) AS BIGINT) AS viajes, coalesce(c.limpias, 0) = coalesce(t.viajes, 0) AS cuadra "
            f"FROM (SELECT mes, count(*) AS limpias FROM silver WHERE NOT ({ANY}) GROUP BY mes) c "
            f"FULL JOIN (SELECT mes, sum(viajes) AS viajes FROM mart GROUP BY mes) t ON c.mes = t.mes"
        ),
        "rewrite_month": with_silver(_CONTENTS),
        "staged_publish": with_silver(_CONTENTS),
        "refresh_emptied_month": with_mart(f"SELECT {_MART_COLS} FROM mart WHERE mes <> {_MIDDLE}"),
        "publish_emptied_month": with_mart(f"SELECT {_MART_COLS} FROM mart WHERE mes <> {_MIDDLE}"),
        "publish_corrupted": with_silver(f"SELECT * FROM ({_CONTENTS}) WHERE mes <> {_MIDDLE}"),
        "publish_while_reading": with_mart(
            f"SELECT lector, c.mes, filas, CASE WHEN lector = 'despues' AND c.mes = {_MIDDLE} THEN 0 ELSE limpias END AS limpias, "
            f"CASE WHEN lector = 'antes' OR c.mes <> {_MIDDLE} THEN viajes END AS viajes, "
            f"CASE WHEN lector = 'antes' OR c.mes <> {_MIDDLE} THEN ingreso END AS ingreso "
            f"FROM (SELECT mes, count(*) AS filas, CAST(count_if(NOT ({ANY})) AS BIGINT) AS limpias FROM silver GROUP BY mes) c "
            "LEFT JOIN (SELECT mes, CAST(sum(viajes) AS BIGINT) AS viajes, CAST(sum(ingreso) AS DECIMAL(30,2)) AS ingreso "
            "FROM mart GROUP BY mes) t ON c.mes = t.mes, (VALUES ('antes'), ('despues')) l(lector)"
        ),
        "publish_refused": with_mart(f"SELECT {_MART_COLS} FROM mart UNION ALL SELECT {_MART_COLS} FROM mart"),
        "raw_single_files": with_silver(
            f"SELECT * FROM ({_CONTENTS}) UNION ALL BY NAME SELECT strftime(CAST(max(mes) || '-01' AS DATE) "
            "+ to_months(CAST(i AS INT)), '%Y-%m') AS mes FROM silver, range(1, 3) t(i) GROUP BY i"
        ),
        "landing_errors": (
            "WITH " + _LISTING + """, found AS (
  SELECT key, CASE WHEN key % 19 = 0 THEN 500 ELSE status END AS status, etag,
         CASE WHEN key % 23 <> 0 THEN declared_size END AS size FROM listing)
SELECT f.key, f.status,
       CASE WHEN f.status = 403 THEN 'no_disponible' WHEN f.status = 500 OR f.size IS NULL THEN 'error'
            WHEN g.etag IS NULL THEN 'descargado' WHEN g.etag = f.etag THEN 'ya_presente' ELSE 'revision' END AS resultado,
       CASE WHEN f.status = 500 THEN 'status 500' WHEN f.status <> 403 AND f.size IS NULL THEN 'no declared size' END
         AS motivo
FROM found f LEFT JOIN ledger g ON f.key = g.key"""
        ),
        "landing_files": """
SELECT source AS key, CASE WHEN bad THEN 'descargado' ELSE 'ya_presente' END AS resultado,
       CASE WHEN NOT bad THEN md5(CAST(n AS VARCHAR)) END AS marca, CASE WHEN NOT bad THEN n * 33 END AS size
FROM (SELECT source, count(*) AS n, CAST(regexp_extract(source, '[0-9]+') AS INT) % 4 = 0 AS bad
      FROM documents GROUP BY source)""",
        "landing_changes": """
WITH s AS (
  SELECT source AS key, count(*) AS n, CAST(regexp_extract(source, '[0-9]+') AS INT) % 3 = 0 AS more
  FROM documents GROUP BY source)
SELECT 'corrida 1' AS corrida, key, 'nuevo' AS cambio, n * 33 AS length FROM s
UNION ALL SELECT 'corrida 2', key, 'cambiado', n * 66 FROM s WHERE more
UNION ALL SELECT 'estado', key, NULL, CASE WHEN more THEN n * 66 ELSE n * 33 END FROM s""",
        "tests_that_fail": with_mart(
            "SELECT 'zona repetida' AS caso, 'grain_unique' AS prueba, count(*) AS sujetos, 2 * count(*) AS violaciones "
            "FROM mart WHERE pu_location_id = 5 HAVING count(*) > 0 "
            "UNION ALL SELECT 'mart vacio', 'not_empty', 1, 1 "
            "UNION ALL SELECT 'falta un mes', 'gold_vs_silver', 1, CAST(sum(viajes) AS BIGINT) FROM mart "
            "WHERE mes = (SELECT min(mes) FROM mart) "
            "UNION ALL SELECT 'id repetido', 'id_unico', 2, 4"
        ),
        "income_text_other_scale": with_mart(
            "SELECT 'income_two_decimals' AS prueba, CASE WHEN ingreso >= 1000 THEN CAST(CAST(ingreso AS DECIMAL(20,0)) AS VARCHAR) "
            "ELSE CAST(CAST(ingreso AS DECIMAL(20,3)) AS VARCHAR) END AS sujeto, CAST(1 AS BIGINT) AS violaciones "
            "FROM mart WHERE ingreso >= 1000 OR hora = 18"
        ),
        "flag_list": with_silver(
            f"SELECT CAST(row_number() OVER () AS INTEGER) AS orden, marca, filas, sin_oro FROM ("
            f"UNPIVOT (SELECT CAST(count_if({ANY}) AS BIGINT) AS sin_oro, {flag_counts} FROM silver) "
            f"ON {', '.join(FLAGS)} INTO NAME marca VALUE filas)"
        ),
        "income_text": with_mart(
            "SELECT 'income_two_decimals' AS prueba, CAST(ingreso AS VARCHAR) AS sujeto, CAST(1 AS BIGINT) AS violaciones "
            "FROM mart WHERE NOT regexp_matches(CAST(ingreso AS VARCHAR), '^-?[0-9]+[.][0-9]{2}$')"
        ),
        "serve_month": with_mart(
            "SELECT mes, pu_location_id AS zona, hora, viajes, ingreso, distancia_total, duracion_media_seg, "
            "count(*) OVER () AS total FROM mart WHERE mes = '1995-03'"
        ),
        "serve_zone": with_mart(
            "SELECT mes, pu_location_id AS zona, hora, viajes, ingreso, distancia_total, duracion_media_seg, "
            "count(*) OVER () AS total FROM mart WHERE pu_location_id = 5"
        ),
        "serve_refusals": """
SELECT o_orderkey AS pedido,
       CASE WHEN o_orderkey % 7 = 0 THEN 'zona takes a whole number of 32 bits'
            WHEN o_orderkey % 11 <> 0 AND NOT (o_orderkey % 30 - 3 BETWEEN 0 AND 23)
              THEN 'hora takes a whole number from 0 to 23'
            WHEN o_orderkey % 13 = 0 OR o_orderkey % 9 - 1 < 0 THEN 'limite takes a whole number that is not negative'
       END AS motivo
FROM orders""",
        "catalog_names": with_silver(
            "SELECT 'filas' AS paso, count(*) AS valor FROM silver UNION ALL "
            "SELECT 'particiones', count(DISTINCT mes) FROM silver UNION ALL SELECT 'nombre tras borrar', 0 UNION ALL "
            "SELECT 'filas tras borrar', count(*) FROM silver UNION ALL SELECT 'tabla de un mes sin aterrizar', 0"
        ),
        "speed_profile_one_month": with_silver(
            "SELECT '1995-06' AS mes, max(n) AS n, "
            "max(CASE WHEN rn = CAST(ceil(CAST(0.5 AS DOUBLE) * n) AS BIGINT) THEN mph END) AS mph_p50, "
            "max(CASE WHEN rn = CAST(ceil(CAST(0.999 AS DOUBLE) * n) AS BIGINT) THEN mph END) AS mph_p999, "
            "max(mph) AS mph_max FROM (SELECT mph, row_number() OVER (ORDER BY mph) AS rn, count(*) OVER () AS n FROM mph)",
            extra=_MPH,
        ),
        "hourly_events_two_runs": _HOURLY,
        "hourly_events_compacted": _HOURLY,
        "hourly_events_by_arrival": _HOURLY,
        "contract_report": _contract_report(),
        "silver_report": with_silver(
            f"SELECT count(*) AS leidas, CAST(count_if({ANY}) AS BIGINT) AS marcadas, count(*) AS escritas, "
            "'' AS sobrantes, true AS tabla_creada, true AS coherente, CAST(0 AS BIGINT) AS nulos_por_cast FROM silver"
        ),
        "incremental_vs_full": with_mart(f"SELECT {_MART_COLS} FROM mart"),
        "canary_count": with_silver("SELECT count(*) AS filas_en_silver FROM silver"),
        "serve_trips": with_mart("SELECT * FROM served", extra=_SERVE),
        "serve_json": with_mart(f"SELECT {_json_text()} AS json FROM served", extra=_SERVE),
        "mart_state": with_mart("SELECT 'ok' AS estado, count(*) AS filas FROM mart"),
        "landing_outcome": _landing("SELECT key, status, resultado, motivo FROM classified"),
        "landing_forced": _landing("SELECT key, status, resultado, motivo FROM classified", forced=True),
        "landing_incomplete": _landing(
            "SELECT key, etag, declared_size, length, resultado, completo FROM verified", extra=_LANDED
        ),
        "landing_next_ledger": _landing(
            "SELECT key, etag, size FROM ledger WHERE key NOT IN (SELECT key FROM verified WHERE completo) "
            "UNION ALL SELECT key, etag, declared_size AS size FROM verified WHERE completo",
            extra=_LANDED,
        ),
        "pending_months": (
            "WITH published AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS mes FROM lineitem), "
            "landed AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS mes FROM orders), "
            "expected AS (SELECT strftime(d, '%Y-%m') AS mes FROM (SELECT unnest(generate_series("
            "CAST(min(mes) || '-01' AS DATE), CAST(max(mes) || '-01' AS DATE) + INTERVAL 3 MONTH, INTERVAL 1 MONTH)) AS d "
            "FROM published)), "
            "first_gap AS (SELECT min(mes) AS g FROM expected WHERE mes NOT IN (SELECT mes FROM published)) "
            "SELECT mes FROM expected WHERE mes < coalesce((SELECT g FROM first_gap), '9999-12') "
            "AND mes NOT IN (SELECT mes FROM landed)"
        ),
        "zone_names": with_mart(
            f"SELECT m.mes, m.pu_location_id, m.hora, m.viajes, m.ingreso, m.distancia_total, m.duracion_media_seg, "
            f"z.Borough AS borough, z.Zone AS zona_nombre, z.service_zone "
            f"FROM mart m LEFT JOIN zones z ON m.pu_location_id = z.LocationID",
            extra=_ZONES,
        ),
        "zone_gaps": with_silver(
            "SELECT 'hueco' AS problema, i AS location_id, CAST(0 AS BIGINT) AS n "
            "FROM (SELECT CAST(unnest(generate_series(1, (SELECT max(LocationID) FROM cat))) AS INT) AS i) "
            "WHERE i NOT IN (SELECT LocationID FROM cat) "
            "UNION ALL SELECT 'duplicado', LocationID, count(*) FROM cat GROUP BY LocationID HAVING count(*) > 1 "
            "UNION ALL SELECT 'sin_zona', pu_location_id, count(*) FROM silver "
            "WHERE pu_location_id NOT IN (SELECT LocationID FROM cat) GROUP BY pu_location_id",
            extra=_ZONES + ",\ncat AS (SELECT * FROM zones WHERE LocationID <> 13)",
        ),
        "special_zones": with_mart(
            "SELECT pu_location_id, CAST(sum(viajes) AS BIGINT) AS viajes FROM mart "
            "WHERE pu_location_id IN (SELECT LocationID FROM zones WHERE Borough = 'Unknown' OR Zone = 'Outside of NYC') "
            "GROUP BY pu_location_id",
            extra=_ZONES,
        ),
        "speed_profile": with_silver(
            "SELECT mes, max(n) AS n, "
            "max(CASE WHEN rn = CAST(ceil(CAST(0.5 AS DOUBLE) * n) AS BIGINT) THEN mph END) AS mph_p50, "
            "max(CASE WHEN rn = CAST(ceil(CAST(0.999 AS DOUBLE) * n) AS BIGINT) THEN mph END) AS mph_p999, "
            "max(mph) AS mph_max FROM ranked GROUP BY mes",
            extra=_MPH,
        ),
        "negative_by_payment": with_silver(
            "SELECT payment_type, count(*) AS viajes, CAST(sum(total_amount) AS DECIMAL(20,2)) AS importe "
            "FROM silver WHERE total_amount < 0 GROUP BY payment_type"
        ),
        "null_together": with_silver(
            "SELECT vendor_id, (CASE WHEN passenger_count IS NULL THEN '1' ELSE '0' END || "
            "CASE WHEN ratecode_id IS NULL THEN '1' ELSE '0' END || "
            "CASE WHEN store_and_fwd_flag IS NULL THEN '1' ELSE '0' END || "
            "CASE WHEN congestion_surcharge IS NULL THEN '1' ELSE '0' END || "
            "CASE WHEN airport_fee IS NULL THEN '1' ELSE '0' END) AS patron_nulos, count(*) AS filas "
            "FROM silver GROUP BY 1, 2"
        ),
        "flagged_with_null_passengers": with_silver(
            f"SELECT filas, marcadas, marcadas_con_nulos, {_pct('marcadas')} AS pct_marcadas, "
            f"{_pct('marcadas_con_nulos')} AS pct_con_nulos FROM (SELECT count(*) AS filas, "
            f"CAST(count_if({ANY}) AS BIGINT) AS marcadas, "
            f"CAST(count_if({ANY} OR passenger_count IS NULL) AS BIGINT) AS marcadas_con_nulos FROM silver)"
        ),
        "distance_outlier": with_silver(
            f"SELECT trip_distance, pickup_datetime, dropoff_datetime, mes, {DUR} AS duracion_seg FROM silver "
            "ORDER BY trip_distance DESC NULLS LAST, pickup_datetime DESC NULLS LAST, "
            "dropoff_datetime DESC NULLS LAST, mes DESC NULLS LAST LIMIT 1"
        ),
        "hourly_events": _HOURLY,
        "hourly_events_stream": _HOURLY,
        "missing_hours": (
            f"WITH {_EVENTS_LANDED}, "
            "expected AS (SELECT unnest(generate_series(CAST(date_trunc('month', min(ts)) AS TIMESTAMP), "
            "CAST(date_trunc('month', max(ts)) AS TIMESTAMP) + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hora "
            "FROM landed_events) "
            "SELECT hora FROM expected WHERE hora NOT IN "
            "(SELECT DISTINCT CAST(date_trunc('hour', ts) AS TIMESTAMP) FROM landed_events)"
        ),
    }
