"""Flight-shaped views over the driver tables.

The view text is plain SQL that runs unchanged in Spark (as temp views) and in DuckDB (as CTEs of
the oracle queries).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skytally.operators.joins import spread_input

FACT_TABLES = ["lineitem", "events"]
BASE_TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

VIEWS = {
    "v_airports": """
SELECT n_nationkey AS row_ix, CASE WHEN n_nationkey % 5 < 3 THEN 'FR' ELSE 'GB' END AS iso_country,
       CASE WHEN n_nationkey % 5 < 3 THEN 'LF' ELSE 'EG' END || lpad(CAST(n_nationkey AS STRING), 2, '0') AS icao_code,
       CASE WHEN n_nationkey < 10 THEN substr('CDGORYNCEMRSLYSTLSBODLHRJFKMAD', CAST(1 + 3 * n_nationkey AS INT), 3) END AS iata_code,
       CASE WHEN n_nationkey % 2 = 0 THEN 'LF' || lpad(CAST(n_nationkey % 4 AS STRING), 2, '0') END AS gps_code,
       'ID' || CAST(n_nationkey AS STRING) AS ident,
       CAST(41 + n_nationkey * 0.5 AS DOUBLE) AS latitude_deg, CAST(-5 + n_nationkey * 0.25 AS DOUBLE) AS longitude_deg
FROM nation""",
    "v_hist": """
SELECT l.l_orderkey * 10 + l.l_linenumber AS flight_id,
       'OP' || lpad(CAST(s.s_suppkey % 12 AS STRING), 2, '0') AS operator, p.p_brand AS aircraft_type,
       a.icao_code AS origin, b.icao_code AS destination,
       a.latitude_deg AS adep_lat, a.longitude_deg AS adep_lon, b.latitude_deg AS ades_lat, b.longitude_deg AS ades_lon,
       l.l_quantity * 8 AS requested_fl,
       o.o_orderdate + CAST((l.l_orderkey * 37 + l.l_linenumber * 11) % 1440 AS INT) * INTERVAL '1' MINUTE AS filed_dep,
       CASE WHEN l.l_partkey % 50 = 0 THEN NULL
            ELSE CAST((l.l_partkey * 7 + l.l_suppkey * 13 + l.l_linenumber) % 91 - 40 AS INT) END AS delay_minutes
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN customer c ON c.c_custkey = o.o_custkey JOIN part p ON p.p_partkey = l.l_partkey
JOIN v_airports a ON a.row_ix = s.s_nationkey JOIN v_airports b ON b.row_ix = c.c_nationkey""",
    "v_obs": """
SELECT event_id, user_id, replace(CAST(CAST(ts AS DATE) AS STRING), '-', '') AS run_id, ts AS departure_scheduled,
       CASE event_type WHEN 'view' THEN 'active' WHEN 'click' THEN 'scheduled' WHEN 'purchase' THEN 'landed'
                       WHEN 'signup' THEN 'cancelled' END AS flight_status,
       CASE WHEN user_id % 20 = 0 THEN NULL ELSE 'A' || CAST(user_id % 8 AS STRING) END AS airline_iata,
       'A' || CAST(user_id AS STRING) AS flight_iata,
       CASE WHEN event_id % 17 = 0 THEN '' ELSE substr('CDGORYNCEMRSLYSTLSBODLHRJFKMAD', CAST(1 + 3 * (user_id % 10) AS INT), 3) END AS departure_iata,
       CASE WHEN user_id % 10 % 5 < 3 THEN 'LF' ELSE 'EG' END || lpad(CAST(user_id % 10 AS STRING), 2, '0') AS departure_icao,
       substr('CDGORYNCEMRSLYSTLSBODLHRJFKMAD', CAST(1 + 3 * ((user_id * 3 + CAST(regexp_extract(props, '[0-9]+', 0) AS INT)) % 10) AS INT), 3) AS arrival_iata,
       CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 0 ELSE CAST(floor(value) AS INT) END AS departure_delay,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(floor(value / 2) AS INT) END AS arrival_delay,
       CASE WHEN event_id % 5 = 0 THEN (event_id % 10 = 0) END AS live_is_ground,
       CASE WHEN user_id % 2 = 0 THEN 'Europe/Paris' WHEN user_id % 7 = 0 THEN NULL ELSE 'America/New_York' END AS departure_timezone,
       CASE WHEN event_id % 2 = 0 THEN 'Europe/Madrid' ELSE 'Asia/Tokyo' END AS arrival_timezone
FROM events""",
    "v_points": """
SELECT l_orderkey * 10 + l_linenumber AS flight_id, CAST(l_suppkey % 4 AS INT) AS sequence_number,
       CAST(40 + l_quantity / 8 AS DOUBLE) AS latitude, CAST(l_discount * 100 AS DOUBLE) AS longitude
FROM lineitem""",
    "v_pred": """
SELECT event_id, flight_iata, 'X' || flight_iata AS flight_icao, flight_status, departure_iata, arrival_iata, departure_scheduled,
       departure_delay, arrival_delay,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id * 7 % 100 AS DOUBLE) / 100 END AS delay_probability,
       (event_id * 7 % 100) >= 50 AS predicted_is_delayed,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE departure_scheduled + INTERVAL '5' MINUTE END AS prediction_created_at
FROM v_obs""",
    "v_runs": """
SELECT event_id AS run_id, 'aviationstack' AS source,
       CASE event_type WHEN 'error' THEN 'airlines' WHEN 'signup' THEN 'airports' ELSE 'flights' END AS endpoint,
       'load_' || event_type AS stage, ts AS finished_at, value AS duration_seconds, user_id AS records_processed,
       CASE WHEN event_id % 9 = 0 THEN 'failed' ELSE 'success' END AS status
FROM events""",
}
NEEDS = {"v_hist": ["v_airports"], "v_pred": ["v_obs"]}


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A derived view of the given scale-factor folder.

    ``spread`` is for row-wise document and text work over inputs of very few splits.
    """
    for base in BASE_TABLES:
        rows = spark.read.parquet(f"{sf_dir}/{base}.parquet")
        if spread and base in FACT_TABLES:
            # Rows of lineitem meet other tables, and the joins deal them again; those of events become documents.
            rows = spread_input(rows) if base == "events" else spread_input(rows, None)
        rows.createOrReplaceTempView(base)
    for needed in NEEDS.get(name, []):
        spark.sql(VIEWS[needed]).createOrReplaceTempView(needed)
    return spark.sql(VIEWS[name])


def with_views(sql: str, *names: str) -> str:
    """``sql`` with the named views, and those they need, as leading CTEs."""
    ordered: list[str] = []
    for name in names:
        for part in [*NEEDS.get(name, []), name]:
            if part not in ordered:
                ordered.append(part)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
