"""Reference SQL (DuckDB dialect) for every registered key that SQL can express.

Written from the layer definitions, not from the Spark code: each text starts from
the shared test tables (pre-registered views) and applies the binding rules, the
layer logic and the output presentation (DOUBLE rounded to 9 then 6 places, DATE and
TIMESTAMP as ISO text, DECIMAL as DOUBLE).
"""

from __future__ import annotations

R6 = "round(round({}, 9), 6)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---- bindings -------------------------------------------------------------------
RAW_COUNTRIES = """raw_countries AS (
  SELECT regexp_extract(line, '^(.{2}) (.+)$', 1) AS code, regexp_extract(line, '^(.{2}) (.+)$', 2) AS name
  FROM (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || ' ' || n_name AS line FROM nation))"""
RAW_STATES = """raw_states AS (
  SELECT regexp_extract(line, '^(.{2}) (.+)$', 1) AS code, regexp_extract(line, '^(.{2}) (.+)$', 2) AS name
  FROM (SELECT lpad(CAST(r_regionkey AS VARCHAR), 2, '0') || ' ' || r_name AS line FROM region))"""
C_COUNTRIES = "c_countries AS (SELECT trim(code) AS id, trim(name) AS name FROM raw_countries)"
C_STATES = "c_states AS (SELECT trim(code) AS id, trim(name) AS name FROM raw_states)"

RAW_STATIONS = """station_lines AS (
  SELECT concat_ws(' ',
    lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0'),
    lpad(CAST(CAST(((c.c_custkey * 37) % 1800 - 900) / 10.0 AS DECIMAL(8,4)) AS VARCHAR), 8, ' '),
    lpad(CAST(CAST(((c.c_custkey * 91) % 3600 - 1800) / 10.0 AS DECIMAL(9,4)) AS VARCHAR), 9, ' '),
    lpad(CAST(CAST(floor(c.c_acctbal) AS DECIMAL(6,1)) AS VARCHAR), 6, ' '),
    CASE WHEN c.c_mktsegment = 'BUILDING' THEN lpad(CAST(n.n_regionkey AS VARCHAR), 2, '0') ELSE '  ' END,
    rpad(c.c_name, 30, ' '),
    CASE WHEN c.c_custkey % 10 = 0 THEN 'GSN' ELSE '   ' END,
    CASE WHEN c.c_custkey % 15 = 0 THEN 'HCN' ELSE '   ' END,
    lpad(CAST(c.c_custkey % 100000 AS VARCHAR), 5, '0')) AS line
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
raw_stations AS (
  SELECT substring(line, 1, 11) AS station_id, substring(line, 13, 8) AS latitude,
         substring(line, 22, 9) AS longitude, substring(line, 32, 6) AS elevation,
         substring(line, 39, 2) AS state, substring(line, 42, 30) AS name,
         substring(line, 73, 3) AS gsn_flag, substring(line, 77, 3) AS hcn_crn_flag,
         substring(line, 81, 5) AS wmo_id
  FROM station_lines)"""
C_STATIONS = """c_stations AS (
  SELECT trim(station_id) AS id,
         CAST(trim(latitude) AS DECIMAL(9,6)) AS latitude,
         CAST(trim(longitude) AS DECIMAL(9,6)) AS longitude,
         CAST(trim(elevation) AS DECIMAL(8,1)) AS elevation,
         trim(state) AS state_id, substring(station_id, 1, 2) AS country_id,
         trim(name) AS name, trim(gsn_flag) AS gsn_flag, trim(hcn_crn_flag) AS hcn_crn_flag,
         trim(wmo_id) AS wmo_id
  FROM raw_stations)"""

RAW_OBS = """raw_obs AS (
  SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(o.o_custkey AS VARCHAR), 9, '0') AS "ID",
         CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER) AS "DATE",
         CASE WHEN l.l_linenumber = 2 THEN CAST(floor(l.l_quantity) * 10 AS INTEGER) - 250
              ELSE CAST(floor(l.l_quantity) * 10 AS INTEGER) END AS "DATA_VALUE",
         CASE WHEN l.l_quantity = 1 THEN 'T' END AS "M_FLAG",
         CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'X' END AS "Q_FLAG",
         l.l_linestatus AS "S_FLAG",
         CASE l.l_orderkey % 4 WHEN 1 THEN '' WHEN 2 THEN '700' WHEN 3 THEN '2400' END AS "OBS_TIME",
         CASE l.l_linenumber WHEN 1 THEN 'TMAX' WHEN 2 THEN 'TMIN' WHEN 3 THEN 'PRCP' WHEN 4 THEN 'SNOW'
              WHEN 5 THEN 'TAVG' WHEN 6 THEN 'SNWD' WHEN 7 THEN 'WT01' END AS "ELEMENT",
         CAST(year(o.o_orderdate) AS INTEGER) AS "YEAR"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)"""
C_OBS = """c_obs AS (
  SELECT "YEAR" AS observation_year, CAST("ID" AS VARCHAR) AS station_id,
         CAST(strptime(CAST("DATE" AS VARCHAR), '%Y%m%d') AS DATE) AS observation_date,
         CASE WHEN "OBS_TIME" IS NOT NULL AND "OBS_TIME" <> ''
              THEN CAST(CAST(strptime(CAST("DATE" AS VARCHAR), '%Y%m%d') AS DATE) AS TIMESTAMP)
                   + to_hours(CAST(substring(lpad("OBS_TIME", 4, '0'), 1, 2) AS INTEGER))
                   + to_minutes(CAST(substring(lpad("OBS_TIME", 4, '0'), 3, 2) AS INTEGER))
         END AS observed_at,
         "DATA_VALUE" AS observation_value, "M_FLAG" AS measurement_flag, "Q_FLAG" AS quality_flag,
         "S_FLAG" AS source_flag, CAST("ELEMENT" AS VARCHAR) AS measure
  FROM raw_obs)"""

RAW_INVENTORY = """inventory_lines AS (
  SELECT concat_ws(' ', "ID",
    lpad(CAST(CAST(((k * 37) % 1800 - 900) / 10.0 AS DECIMAL(8,4)) AS VARCHAR), 8, ' '),
    lpad(CAST(CAST(((k * 91) % 3600 - 1800) / 10.0 AS DECIMAL(9,4)) AS VARCHAR), 9, ' '),
    rpad("ELEMENT", 4, ' '), CAST(first_year AS VARCHAR), CAST(last_year AS VARCHAR)) AS line
  FROM (SELECT "ID", "ELEMENT", min("YEAR") AS first_year, max("YEAR") AS last_year,
               CAST(substring("ID", 3, 9) AS BIGINT) AS k
        FROM raw_obs GROUP BY "ID", "ELEMENT")),
raw_inventory AS (
  SELECT substring(line, 1, 11) AS station_id, substring(line, 13, 8) AS latitude,
         substring(line, 22, 9) AS longitude, substring(line, 32, 4) AS element,
         substring(line, 37, 4) AS first_year, substring(line, 42, 4) AS last_year
  FROM inventory_lines)"""
C_INVENTORY = """c_inventory AS (
  SELECT trim(station_id) AS station_id,
         CAST(trim(latitude) AS DECIMAL(9,6)) AS latitude, CAST(trim(longitude) AS DECIMAL(9,6)) AS longitude,
         trim(element) AS element, CAST(first_year AS INTEGER) AS first_year, CAST(last_year AS INTEGER) AS last_year
  FROM raw_inventory)"""

CU_STATIONS = """cu_stations AS (
  SELECT s.id, s.country_id, co.name AS country_name, s.state_id, st.name AS state_name,
         s.latitude, s.longitude, s.elevation, s.name, s.gsn_flag, s.hcn_crn_flag, s.wmo_id
  FROM c_stations s
  LEFT JOIN c_countries co ON s.country_id = co.id
  LEFT JOIN c_states st ON s.state_id = st.id)"""
CU_OBS = """cu_obs AS (
  SELECT o.observation_year, o.observation_date, o.observed_at, o.station_id, o.measure, o.observation_value,
         CASE WHEN o.measure IN ('TMAX', 'TMIN', 'TAVG', 'PRCP') THEN o.observation_value / 10.0
              ELSE CAST(o.observation_value AS DOUBLE) END AS observation_value_normalized,
         o.measurement_flag, o.quality_flag, o.source_flag,
         s.country_id, s.country_name, s.state_id, s.latitude, s.longitude, s.elevation
  FROM c_obs o LEFT JOIN cu_stations s ON o.station_id = s.id)"""
CU_SY = """cu_sy AS (
  SELECT observation_year, station_id, country_id, country_name,
         avg(CASE WHEN measure = 'TMAX' THEN observation_value_normalized END) AS avg_tmax_celsius,
         avg(CASE WHEN measure = 'TMIN' THEN observation_value_normalized END) AS avg_tmin_celsius,
         min(CASE WHEN measure = 'TMIN' THEN observation_value_normalized END) AS min_tmin_celsius,
         sum(CASE WHEN measure = 'PRCP' THEN observation_value_normalized END) AS total_precip_mm,
         sum(CASE WHEN measure = 'SNOW' THEN observation_value_normalized END) AS total_snowfall_mm,
         count(*) AS observation_count
  FROM cu_obs WHERE quality_flag IS NULL
  GROUP BY observation_year, station_id, country_id, country_name)"""
RP_COUNTRY_YEAR = """rp_country_year AS (
  SELECT * FROM (
    SELECT observation_year, country_id, country_name,
           CAST(count_if(avg_tmax_celsius IS NOT NULL OR avg_tmin_celsius IS NOT NULL OR total_precip_mm IS NOT NULL) AS BIGINT) AS station_count,
           avg(avg_tmax_celsius) AS avg_tmax_celsius, avg(avg_tmin_celsius) AS avg_tmin_celsius,
           avg(total_precip_mm) AS avg_yearly_precip_mm
    FROM cu_sy GROUP BY observation_year, country_id, country_name) WHERE station_count > 0)"""
RP_GLOBAL_YEAR = """rp_global_year AS (
  SELECT observation_year,
         CAST(count_if(avg_tmax_celsius IS NOT NULL OR avg_tmin_celsius IS NOT NULL OR total_precip_mm IS NOT NULL) AS BIGINT) AS station_count,
         CAST(count(DISTINCT country_id) AS BIGINT) AS country_count,
         CAST(sum(observation_count) AS BIGINT) AS observation_count,
         avg(avg_tmax_celsius) AS avg_tmax_celsius, avg(avg_tmin_celsius) AS avg_tmin_celsius,
         avg(total_precip_mm) AS avg_precip_mm
  FROM cu_sy GROUP BY observation_year)"""
RP_SNOW_COLD = """rp_snow_cold AS (
  SELECT * FROM (
    SELECT observation_year, country_id, country_name,
           avg(total_snowfall_mm) AS avg_yearly_snowfall_mm, min(min_tmin_celsius) AS min_tmin_celsius
    FROM cu_sy GROUP BY observation_year, country_id, country_name)
  WHERE avg_yearly_snowfall_mm IS NOT NULL OR min_tmin_celsius IS NOT NULL)"""
RP_COVERAGE = """rp_coverage AS (
  SELECT country_id, country_name, count(id) AS station_count,
         CAST(avg(CASE WHEN elevation > -900 THEN elevation END) AS DOUBLE) AS avg_elevation_m,
         CAST(avg(latitude) AS DOUBLE) AS avg_latitude, CAST(avg(longitude) AS DOUBLE) AS avg_longitude
  FROM cu_stations GROUP BY country_id, country_name)"""

STATIONS_CHAIN = [RAW_COUNTRIES, RAW_STATES, C_COUNTRIES, C_STATES, RAW_STATIONS, C_STATIONS, CU_STATIONS]
OBS_CHAIN = [RAW_OBS, C_OBS]
SY_CHAIN = STATIONS_CHAIN + OBS_CHAIN + [CU_OBS, CU_SY]

CU_STATIONS_OUT = """SELECT id, country_id, country_name, state_id, state_name,
  round(round(CAST(latitude AS DOUBLE), 9), 6) AS latitude, round(round(CAST(longitude AS DOUBLE), 9), 6) AS longitude,
  round(round(CAST(elevation AS DOUBLE), 9), 6) AS elevation, name, gsn_flag, hcn_crn_flag, wmo_id FROM cu_stations"""


def _ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}"


def _d(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d') AS {c}"


def _r(c: str) -> str:
    return f"round(round(CAST({c} AS DOUBLE), 9), 6) AS {c}"


ORACLE: dict[str, str] = {}

ORACLE["cleansed_countries"] = _with(RAW_COUNTRIES, C_COUNTRIES) + "SELECT * FROM c_countries"
ORACLE["cleansed_states"] = _with(RAW_STATES, C_STATES) + "SELECT * FROM c_states"
ORACLE["cleansed_stations"] = _with(RAW_STATIONS, C_STATIONS) + (
    f"SELECT id, {_r('latitude')}, {_r('longitude')}, {_r('elevation')}, state_id, country_id, name, "
    "gsn_flag, hcn_crn_flag, wmo_id FROM c_stations"
)
ORACLE["cleansed_inventory"] = _with(RAW_OBS, RAW_INVENTORY, C_INVENTORY) + (
    f"SELECT station_id, {_r('latitude')}, {_r('longitude')}, element, first_year, last_year FROM c_inventory"
)
ORACLE["cleansed_observations"] = _with(*OBS_CHAIN) + (
    f"SELECT observation_year, station_id, {_d('observation_date')}, {_ts('observed_at')}, observation_value, "
    "measurement_flag, quality_flag, source_flag, measure FROM c_obs"
)
ORACLE["curated_stations"] = _with(*STATIONS_CHAIN) + CU_STATIONS_OUT
ORACLE["curated_observations"] = _with(*STATIONS_CHAIN, *OBS_CHAIN, CU_OBS) + (
    f"SELECT observation_year, {_d('observation_date')}, {_ts('observed_at')}, station_id, measure, "
    f"observation_value, {_r('observation_value_normalized')}, measurement_flag, quality_flag, source_flag, "
    f"country_id, country_name, state_id, {_r('latitude')}, {_r('longitude')}, {_r('elevation')} FROM cu_obs"
)
ORACLE["curated_station_year"] = _with(*SY_CHAIN) + (
    "SELECT observation_year, station_id, country_id, country_name, "
    f"{_r('avg_tmax_celsius')}, {_r('avg_tmin_celsius')}, {_r('min_tmin_celsius')}, "
    f"{_r('total_precip_mm')}, {_r('total_snowfall_mm')}, CAST(observation_count AS BIGINT) AS observation_count "
    "FROM cu_sy"
)
ORACLE["report_country_year"] = _with(*SY_CHAIN, RP_COUNTRY_YEAR) + (
    "SELECT observation_year, country_id, country_name, station_count, "
    f"{_r('avg_tmax_celsius')}, {_r('avg_tmin_celsius')}, {_r('avg_yearly_precip_mm')} FROM rp_country_year"
)
ORACLE["report_global_year"] = _with(*SY_CHAIN, RP_GLOBAL_YEAR) + (
    "SELECT observation_year, station_count, country_count, observation_count, "
    f"{_r('avg_tmax_celsius')}, {_r('avg_tmin_celsius')}, {_r('avg_precip_mm')} FROM rp_global_year "
    "ORDER BY observation_year"
)
ORACLE["report_snow_cold"] = _with(*SY_CHAIN, RP_SNOW_COLD) + (
    f"SELECT observation_year, country_id, country_name, {_r('avg_yearly_snowfall_mm')}, "
    f"{_r('min_tmin_celsius')} FROM rp_snow_cold"
)
ORACLE["report_station_coverage"] = _with(*STATIONS_CHAIN, RP_COVERAGE) + (
    f"SELECT country_id, country_name, station_count, {_r('avg_elevation_m')}, {_r('avg_latitude')}, "
    f"{_r('avg_longitude')} FROM rp_coverage ORDER BY station_count DESC, country_id"
)

SEEDS = """seeds AS (
  SELECT 'measurement_flags' AS flag_type, id, 'language ' || id AS description FROM (SELECT DISTINCT lang AS id FROM documents)
  UNION ALL
  SELECT 'quality_flags', id, 'event type ' || id FROM (SELECT DISTINCT event_type AS id FROM events)
  UNION ALL
  SELECT 'source_flags', id, 'line status ' || id FROM (SELECT DISTINCT l_linestatus AS id FROM lineitem))"""
ORACLE["cleansed_flags"] = _with(SEEDS) + "SELECT flag_type, id, description FROM seeds"

ORACLE["dash_country_tmax"] = _with(*SY_CHAIN, RP_COUNTRY_YEAR) + (
    "SELECT country_name, round(round(avg(avg_tmax_celsius), 9), 6) AS avg_tmax_celsius FROM rp_country_year "
    "GROUP BY country_name ORDER BY country_name LIMIT 10000"
)
ORACLE["dash_top_precip"] = _with(*SY_CHAIN, RP_COUNTRY_YEAR) + (
    "SELECT country_name, round(round(avg(avg_yearly_precip_mm), 9), 6) AS avg_yearly_precip_mm FROM rp_country_year "
    "GROUP BY country_name ORDER BY avg(avg_yearly_precip_mm) DESC NULLS LAST, country_name LIMIT 1000"
)
ORACLE["dash_snowiest"] = _with(*SY_CHAIN, RP_SNOW_COLD) + (
    "SELECT country_name, round(round(avg(avg_yearly_snowfall_mm), 9), 6) AS avg_yearly_snowfall_mm FROM rp_snow_cold "
    "GROUP BY country_name ORDER BY avg(avg_yearly_snowfall_mm) DESC NULLS LAST, country_name LIMIT 1000"
)
ORACLE["dash_coverage"] = _with(*STATIONS_CHAIN, RP_COVERAGE) + (
    "SELECT country_name, CAST(sum(station_count) AS BIGINT) AS station_count FROM rp_coverage "
    "GROUP BY country_name ORDER BY sum(station_count) DESC NULLS LAST, country_name LIMIT 1000"
)
ORACLE["dash_trend"] = _with(*SY_CHAIN, RP_GLOBAL_YEAR) + (
    "SELECT observation_year, round(round(avg(avg_tmax_celsius), 9), 6) AS avg_tmax_celsius, "
    "round(round(avg(avg_tmin_celsius), 9), 6) AS avg_tmin_celsius FROM rp_global_year "
    "GROUP BY observation_year ORDER BY observation_year LIMIT 10000"
)
ORACLE["dash_kpis"] = _with(*SY_CHAIN, RP_GLOBAL_YEAR, RP_COVERAGE) + (
    "SELECT (SELECT CAST(count(*) AS BIGINT) FROM rp_coverage) AS countries_covered, "
    "(SELECT CAST(sum(station_count) AS BIGINT) FROM rp_coverage) AS weather_stations, "
    "(SELECT CAST(sum(observation_count) AS BIGINT) FROM rp_global_year) AS observations, "
    "(SELECT round(round(avg(avg_tmax_celsius), 9), 6) FROM rp_global_year) AS global_avg_max_temp"
)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

# ---- sources ----------------------------------------------------------------------
RUN_TS_SQL = "'2024-01-01 00:00:00.000000' AS ingested_at"
RAW_OBS_COLS = '"ID", "DATE", "DATA_VALUE", "M_FLAG", "Q_FLAG", "S_FLAG", "OBS_TIME", "ELEMENT", "YEAR"'

ORACLE["src_parquet_hive"] = _with(RAW_OBS) + f"SELECT {RAW_OBS_COLS} FROM raw_obs"
ORACLE["part_prune"] = _with(RAW_OBS) + f'SELECT {RAW_OBS_COLS} FROM raw_obs WHERE "YEAR" = 1997'
ORACLE["src_fixed_width"] = _with(RAW_STATIONS) + f"SELECT *, {RUN_TS_SQL} FROM raw_stations"
ORACLE["src_expression"] = _with(RAW_STATIONS) + (
    "SELECT station_id AS id, round(round(CAST(trim(elevation) AS DOUBLE), 9), 6) AS elevation, "
    f"gsn_flag = 'GSN' AS in_network, {RUN_TS_SQL} FROM raw_stations"
)
ORACLE["src_regexp"] = _with(RAW_COUNTRIES) + f"SELECT code, name, {RUN_TS_SQL} FROM raw_countries"
for _k in ("src_csv", "src_csv_header", "src_tsv", "src_json_lines"):
    ORACLE[_k] = _with(RAW_OBS) + f"SELECT {RAW_OBS_COLS}, {RUN_TS_SQL} FROM raw_obs"
ORACLE["src_orc"] = _with(RAW_OBS) + f"SELECT {RAW_OBS_COLS} FROM raw_obs"
ORACLE["src_arrow"] = _with(RAW_OBS) + f"SELECT {RAW_OBS_COLS} FROM raw_obs"
ORACLE["src_seed"] = _with(SEEDS) + "SELECT flag_type, id, description FROM seeds"

ORACLE["src_rejects"] = """
WITH c AS (SELECT c_mktsegment AS segment, count(*) AS records, count(*) FILTER (WHERE c_custkey % 7 = 0) AS rejected FROM customer GROUP BY 1)
SELECT segment, records, rejected, nullif(rejected, 0) AS kept, CAST(sum(records) OVER () AS BIGINT) AS all_records,
       CAST(sum(rejected) OVER () AS BIGINT) AS all_rejected FROM c"""

# ---- loads and partitions ----------------------------------------------------------
ORACLE["sink_full_refresh"] = ORACLE["cleansed_stations"]
ORACLE["sink_full_refresh_schema"] = "SELECT o_orderkey, o_custkey FROM orders"
ORACLE["sink_view"] = "SELECT s_suppkey AS id, trim(s_name) AS name FROM supplier"
ORACLE["sink_copy"] = "SELECT o_orderkey, o_custkey FROM orders"
ORACLE["sink_partition_replace"] = _with(RAW_OBS) + (
    f'SELECT {RAW_OBS_COLS} FROM raw_obs WHERE NOT ("YEAR" = 1997 AND "Q_FLAG" IS NOT NULL)'
)
ORACLE["sink_insert_overwrite"] = ORACLE["cleansed_observations"]
_YEAR_COUNTS = 'SELECT \'{}\' AS seen, "YEAR", count(*) AS n, count("Q_FLAG") AS failed FROM raw_obs {} GROUP BY "YEAR"'
ORACLE["sink_overwrite_atomic"] = _with(RAW_OBS) + " UNION ALL ".join(
    [_YEAR_COUNTS.format("before", ""), _YEAR_COUNTS.format("after", 'WHERE NOT ("YEAR" BETWEEN 1996 AND 1997 AND "Q_FLAG" IS NOT NULL)')]
)
ORACLE["sink_expire"] = """
SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS first_key, CAST(1 AS BIGINT) AS versions
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '3-MEDIUM') OR o_custkey % 2 = 0 GROUP BY o_orderpriority"""
ORACLE["part_backfill"] = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS "YEAR", CAST(CASE WHEN year(l_shipdate) = 1996 THEN 0 ELSE 1 END AS INTEGER) AS run,
       count(*) AS n, round(round(sum(l_quantity), 9), 6) AS quantity
FROM lineitem WHERE year(l_shipdate) BETWEEN 1994 AND 1998 GROUP BY 1, 2"""

API_RECORDS = """api_rec AS (
  SELECT r.*, p.pages FROM (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS "YEAR", CAST(floor(o_orderkey / 1000) + 1 AS INTEGER) AS page,
           o_orderkey AS id, CAST(year(o_orderdate) AS VARCHAR) AS date, o_totalprice AS value
    FROM orders) r
  JOIN (SELECT CAST(year(o_orderdate) AS INTEGER) AS "YEAR", CAST(max(floor(o_orderkey / 1000) + 1) AS INTEGER) AS pages
        FROM orders GROUP BY 1) p ON r."YEAR" = p."YEAR")"""
ORACLE["sink_append"] = _with(API_RECORDS) + (
    'SELECT id, date, round(round(value, 9), 6) AS value, "YEAR" FROM api_rec UNION ALL '
    'SELECT id, date, round(round(value, 9), 6) AS value, "YEAR" FROM api_rec'
)
ORACLE["sink_replace"] = _with(API_RECORDS) + 'SELECT id, date, round(round(value, 9), 6) AS value, "YEAR" FROM api_rec'
ORACLE["src_api_pages"] = _with(API_RECORDS) + 'SELECT "YEAR", page, pages, id, date, round(round(value, 9), 6) AS value FROM api_rec'
ORACLE["src_api_completeness"] = _with(API_RECORDS) + (
    'SELECT "YEAR", max(pages) AS declared_pages, count(DISTINCT page) AS landed_pages, '
    'CAST(max(pages) - count(DISTINCT page) AS BIGINT) AS missing_pages, '
    '(max(pages) - count(DISTINCT page)) = 0 AS complete FROM api_rec GROUP BY "YEAR"'
)
ORACLE["src_landing_manifest"] = _with(API_RECORDS) + (
    'SELECT "YEAR", count(DISTINCT page) AS files, count(DISTINCT page) AS pages FROM api_rec GROUP BY "YEAR"'
)

ORACLE["src_api_unpartitioned"] = _with(API_RECORDS) + "SELECT page, id, round(round(value, 9), 6) AS value FROM api_rec"
ORACLE["src_prefix_recursive"] = (
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier"
)

ORDER_BOUNDS = "b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)"
ORACLE["part_time_keys"] = _with(ORDER_BOUNDS) + (
    "SELECT 'year' AS period, strftime(t, '%Y') AS partition_key "
    "FROM (SELECT unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi), INTERVAL 1 YEAR)) AS t FROM b) "
    "UNION ALL SELECT 'month', strftime(t, '%Y-%m') "
    "FROM (SELECT unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS t FROM b) "
    "UNION ALL SELECT 'week', strftime(t, '%Y-%m-%d') "
    "FROM (SELECT unnest(generate_series(date_trunc('week', lo), date_trunc('week', hi), INTERVAL 7 DAY)) AS t FROM b) "
    "UNION ALL SELECT 'day', strftime(t, '%Y-%m-%d') "
    "FROM (SELECT unnest(generate_series(date_trunc('day', lo), date_trunc('day', hi), INTERVAL 1 DAY)) AS t FROM b)"
)
ORACLE["part_multi_keys"] = _with(ORDER_BOUNDS) + (
    "SELECT strftime(t, '%Y') AS \"YEAR\", s AS \"S_FLAG\" "
    "FROM (SELECT unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi), INTERVAL 1 YEAR)) AS t FROM b), "
    "(SELECT unnest(['F', 'O']) AS s)"
)
ORACLE["part_missing"] = (
    "WITH b AS (SELECT (SELECT min(o_orderdate) FROM orders) AS lo, (SELECT max(l_shipdate) FROM lineitem) AS hi) "
    "SELECT strftime(t, '%Y-%m') AS partition_key "
    "FROM (SELECT unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS t FROM b) "
    "WHERE strftime(t, '%Y-%m') NOT IN (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') FROM orders)"
)

# ---- data quality -------------------------------------------------------------------
ORACLE["dq_not_null"] = _with(*OBS_CHAIN) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS failures FROM c_obs"
    for c in ("station_id", "observation_date", "measure", "quality_flag")
)


def _dup_count(model: str, src: str, cols: str) -> str:
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols.split(","))
    return (
        f"SELECT '{model}' AS model, '{cols}' AS column_name, "
        f"CAST((SELECT count(*) FROM (SELECT {cols} FROM {src} WHERE {nn} GROUP BY {cols} HAVING count(*) > 1)) AS BIGINT) AS failures"
    )


ORACLE["dq_unique"] = _with(RAW_STATIONS, C_STATIONS) + " UNION ALL ".join(
    [
        _dup_count("customer", "customer", "c_custkey"),
        _dup_count("orders", "orders", "o_orderkey"),
        _dup_count("lineitem", "lineitem", "l_orderkey"),
        _dup_count("cleansed.stations", "c_stations", "id"),
    ]
)


def _orphans(child: str, ccol: str, parent: str, pcol: str) -> str:
    return (
        f"CAST((SELECT count(*) FROM {child} WHERE {ccol} IS NOT NULL AND {ccol} NOT IN "
        f"(SELECT {pcol} FROM {parent} WHERE {pcol} IS NOT NULL)) AS BIGINT)"
    )


ORACLE["dq_relationships"] = _with(RAW_COUNTRIES, C_COUNTRIES, RAW_STATIONS, C_STATIONS, *OBS_CHAIN, RAW_INVENTORY, C_INVENTORY) + (
    " UNION ALL ".join(
        [
            f"SELECT 'cleansed.observations' AS model, 'station_id' AS column_name, 'cleansed.stations' AS parent, {_orphans('c_obs', 'station_id', 'c_stations', 'id')} AS failures",
            f"SELECT 'cleansed.inventory', 'station_id', 'cleansed.stations', {_orphans('c_inventory', 'station_id', 'c_stations', 'id')}",
            f"SELECT 'cleansed.stations', 'country_id', 'cleansed.countries', {_orphans('c_stations', 'country_id', 'c_countries', 'id')}",
            f"SELECT 'lineitem', 'l_orderkey', 'orders', {_orphans('lineitem', 'l_orderkey', 'orders', 'o_orderkey')}",
            f"SELECT 'documents', 'doc_id', 'labels', {_orphans('documents', 'doc_id', 'labels', 'doc_id')}",
        ]
    )
)
ORACLE["dq_unique_combo"] = (
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
    "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
)

# (model, relation in the SQL chain, column, test[, parent model, parent relation, parent column])
_SUITE = [
    ("cleansed.countries", "c_countries", "id", "not_null"), ("cleansed.countries", "c_countries", "id", "unique"),
    ("cleansed.states", "c_states", "id", "not_null"), ("cleansed.states", "c_states", "id", "unique"),
    ("cleansed.stations", "c_stations", "id", "not_null"), ("cleansed.stations", "c_stations", "id", "unique"),
    ("cleansed.stations", "c_stations", "country_id", "relationships", "c_countries", "id"),
    ("cleansed.inventory", "c_inventory", "station_id", "not_null"),
    ("cleansed.inventory", "c_inventory", "station_id", "relationships", "c_stations", "id"),
    ("cleansed.inventory", "c_inventory", "element", "not_null"),
    ("cleansed.observations", "c_obs", "station_id", "not_null"),
    ("cleansed.observations", "c_obs", "station_id", "relationships", "c_stations", "id"),
    ("cleansed.observations", "c_obs", "observation_date", "not_null"),
    ("cleansed.observations", "c_obs", "measure", "not_null"),
    ("curated.stations", "cu_stations", "id", "not_null"), ("curated.stations", "cu_stations", "id", "unique"),
    ("curated.observations", "cu_obs", "station_id", "not_null"), ("curated.observations", "cu_obs", "measure", "not_null"),
    ("curated.station_year", "cu_sy", "station_id", "not_null"),
    ("curated.station_year", "cu_sy", "observation_year,station_id", "unique_combination"),
    ("reporting.country_year", "rp_country_year", "observation_year", "not_null"),
    ("reporting.country_year", "rp_country_year", "country_id", "not_null"),
    ("reporting.global_year", "rp_global_year", "observation_year", "not_null"),
    ("reporting.global_year", "rp_global_year", "observation_year", "unique"),
    ("reporting.snow_cold", "rp_snow_cold", "observation_year", "not_null"),
    ("reporting.snow_cold", "rp_snow_cold", "country_id", "not_null"),
    ("reporting.station_coverage", "rp_coverage", "country_id", "not_null"),
    ("reporting.station_coverage", "rp_coverage", "country_id", "unique"),
] + [
    (f"raw.{s}", f"(SELECT * FROM seeds WHERE flag_type = '{s}')", "id", t)
    for s in ("measurement_flags", "quality_flags", "source_flags")
    for t in ("not_null", "unique")
]


def _suite_row(entry) -> str:
    model, rel, col, test = entry[:4]
    if test == "not_null":
        f = f"CAST((SELECT count(*) FROM {rel} WHERE {col} IS NULL) AS BIGINT)"
    elif test in ("unique", "unique_combination"):
        nn = " AND ".join(f"{c} IS NOT NULL" for c in col.split(","))
        f = f"CAST((SELECT count(*) FROM (SELECT {col} FROM {rel} WHERE {nn} GROUP BY {col} HAVING count(*) > 1)) AS BIGINT)"
    else:
        f = _orphans(rel, col, entry[4], entry[5])
    return f"SELECT '{model}' AS model, '{col}' AS column_name, '{test}' AS test, {f} AS failures"


ORACLE["dq_suite"] = _with(
    *SY_CHAIN, RAW_INVENTORY, C_INVENTORY, RP_COUNTRY_YEAR, RP_GLOBAL_YEAR, RP_SNOW_COLD, RP_COVERAGE, SEEDS
) + " UNION ALL ".join(_suite_row(e) for e in _SUITE)

# ---- metric layer -------------------------------------------------------------------
ORACLE["sem_measures_by_dimension"] = _with(*STATIONS_CHAIN, *OBS_CHAIN, CU_OBS) + (
    'SELECT country_name, measure, count(*) AS "count", CAST(sum(observation_value) AS BIGINT) AS observation_value '
    "FROM cu_obs GROUP BY country_name, measure"
)
ORACLE["sem_filter_equals"] = _with(*STATIONS_CHAIN) + (
    'SELECT country_name, state_name, count(*) AS "count" FROM cu_stations '
    "WHERE country_id IN ('01', '05', '10') GROUP BY country_name, state_name"
)
ORACLE["sem_filter_bool"] = _with(*STATIONS_CHAIN, *OBS_CHAIN, CU_OBS) + (
    'SELECT measure, count(*) AS "count" FROM cu_obs '
    "WHERE quality_flag IN ('X') OR (measurement_flag IN ('T') AND source_flag IN ('O')) GROUP BY measure"
)
ORACLE["sem_filter_measure"] = _with(*SY_CHAIN) + (
    'SELECT * FROM (SELECT country_name, count(*) AS "count", CAST(sum(observation_count) AS BIGINT) AS observation_count '
    'FROM cu_sy GROUP BY country_name) WHERE "count" > 300'
)
ORACLE["sem_time_dimension"] = _with(*STATIONS_CHAIN, *OBS_CHAIN, CU_OBS) + (
    "SELECT measure, strftime(CAST(date_trunc('year', observation_date) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') "
    'AS observation_date_year, count(*) AS "count" FROM cu_obs GROUP BY 1, 2'
)
ORACLE["sem_order_limit"] = _with(*STATIONS_CHAIN, *OBS_CHAIN, CU_OBS) + (
    'SELECT station_id, count(*) AS "count" FROM cu_obs GROUP BY station_id '
    'ORDER BY "count" DESC, station_id ASC LIMIT 10'
)

ORACLE["sem_date_range"] = _with(*STATIONS_CHAIN, *OBS_CHAIN, CU_OBS) + (
    'SELECT measure, count(*) AS "count" FROM cu_obs '
    "WHERE observation_date BETWEEN DATE '1996-03-01' AND DATE '1997-06-30' GROUP BY measure"
)
ORACLE["sem_filter_hidden_measure"] = _with(*SY_CHAIN) + (
    'SELECT country_name, count(*) AS "count" FROM cu_sy GROUP BY country_name HAVING sum(observation_count) > 2000'
)
ORACLE["sem_order_time"] = _with(*STATIONS_CHAIN, *OBS_CHAIN, CU_OBS) + (
    "SELECT strftime(CAST(date_trunc('month', observation_date) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') "
    'AS observation_date_month, count(*) AS "count" FROM cu_obs GROUP BY 1 ORDER BY 1 DESC LIMIT 12'
)
_ST_WHERE = {
    "notequals": "country_id IS NULL OR country_id NOT IN ('01', '05')",
    "contains": "lower(state_name) LIKE '%ri%' OR lower(state_name) LIKE '%si%'",
    "notcontains": "state_name IS NULL OR NOT (lower(state_name) LIKE '%ri%' OR lower(state_name) LIKE '%si%')",
    "startswith": "state_name LIKE 'A%'",
    "endswith": "state_name LIKE '%A' OR state_name LIKE '%T'",
    "set": "state_name IS NOT NULL",
    "notset": "state_name IS NULL",
}
for _k, _w in _ST_WHERE.items():
    _by = "state_name" if _k.endswith(("contains", "with")) else "country_name"
    ORACLE[f"sem_op_{_k}"] = _with(*STATIONS_CHAIN) + (
        f'SELECT {_by}, count(*) AS "count" FROM cu_stations WHERE {_w} GROUP BY {_by}'
    )
for _k, _w in {"gte": ">= 300", "lt": "< 300", "lte": "<= 300"}.items():
    ORACLE[f"sem_op_{_k}"] = _with(*SY_CHAIN) + (
        f'SELECT country_name, count(*) AS "count" FROM cu_sy GROUP BY country_name HAVING count(*) {_w}'
    )
_OBS_WHERE = {
    "indaterange": "BETWEEN DATE '1996-03-01' AND DATE '1997-06-30'",
    "beforedate": "< DATE '1996-03-01'",
    "afterdate": "> DATE '1997-06-30'",
}
for _k, _w in _OBS_WHERE.items():
    ORACLE[f"sem_op_{_k}"] = _with(*STATIONS_CHAIN, *OBS_CHAIN, CU_OBS) + (
        f'SELECT measure, count(*) AS "count" FROM cu_obs WHERE observation_date {_w} GROUP BY measure'
    )

ORACLE["stream_incremental_marts"] = ORACLE["report_country_year"]

# ---- incremental stream ----------------------------------------------------------------
ORACLE["stream_incremental_cleanse"] = (
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, trim(event_type) AS event_type, "
    "round(round(value, 9), 6) AS value, props, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS event_date FROM events"
)
