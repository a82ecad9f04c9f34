"""The registered queries, on vessel messages derived from the events table, and their SQL.

Times leave as TIMESTAMP_NTZ and computed doubles are rounded, so that both engines give equal values.
"""

from __future__ import annotations

import datetime
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions import decode, geo
from wakeline.operators import clean, demux, dims, live, marts, ports, scd, state, trips
from wakeline.plans.materialize import merged
from wakeline.sources import derive, lookups

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Where the incremental queries cut the pings into two batches.
CUT = datetime.datetime(2024, 1, 2, 12, 0, 0, tzinfo=datetime.timezone.utc)
CUT_SQL = "TIMESTAMP '2024-01-02 12:00:00'"


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession) -> str:
    """A new folder that all nodes share: in spark.checkpoint.dir; a session of one machine may leave that unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/wakeline-{uuid.uuid4().hex}"


def _kept(df: DataFrame) -> DataFrame:
    """``df`` written and read back."""
    at = _folder(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def _out(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Comparable columns: zoneless times, flat structs, rounded doubles."""
    columns = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f.name)
        if kind == "timestamp":
            columns.append(c.cast("timestamp_ntz").alias(f.name))
        elif kind.startswith("struct"):
            columns += [c[n].alias(f"{f.name}_{n.lower()}") for n in f.dataType.names]
        elif f.name in (digits or {}):
            columns.append(F.round(c.cast("double"), digits[f.name]).alias(f.name))
        else:
            columns.append(c)
    return df.select(*columns)


def _countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.countries_of_nations(_table(spark, sf_dir, "nation"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.position_reports(derive.positions(_events(spark, sf_dir)), _countries(spark, sf_dir), lookups.nav_status(spark))


def _statics(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive.statics(_events(spark, sf_dir))
    return clean.ship_statics(raw, _countries(spark, sf_dir), lookups.fix_types(spark), lookups.ship_types(spark))


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.station_reports(derive.stations(_events(spark, sf_dir)), _countries(spark, sf_dir), lookups.fix_types(spark))


# --- SQL of the derived messages, clause by clause -------------------------------------------------


def _values(names: list[str] | tuple[str, ...], first: int) -> str:
    return "VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate((x.replace("'", "''") for x in names), first))


_TIME = "make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 10)"
_MMSI = "CASE WHEN user_id % 29 = 0 THEN 999000000 + user_id ELSE 201000000 + (user_id * 1000003) % 554999999 END"
_TEXT = f"strftime({_TIME}, '%Y-%m-%d %H:%M:%S.%f') || '000 +0000 UTC'"
_RAW_POSITION = f"""
raw_position AS (SELECT 'SHIP ' || user_id AS ship_name, {_TEXT} AS time_utc, {_TIME} AS recorded_time, CAST({_MMSI} AS BIGINT) AS mmsi,
  CAST(event_id % 361 AS DOUBLE) AS cog,
  CASE WHEN event_id % 61 = 0 THEN 91.0e0 ELSE 10.0e0 + (user_id % 40) + (event_id % 100) / 1000.0e0 + CASE WHEN event_id % 97 = 0 THEN 5.0e0 ELSE 0.0e0 END END AS latitude,
  CASE WHEN event_id % 61 = 0 THEN 181.0e0 ELSE -100.0e0 + (user_id % 150) + (event_id % 77) / 1000.0e0 END AS longitude,
  CAST(event_id % 17 AS INT) AS navigational_status, CAST(event_id % 256 - 128 AS INT) AS rate_of_turn,
  CASE WHEN event_id % 53 = 0 THEN 102.3e0 ELSE round(value / 10.0e0, 1) END AS sog,
  CAST(CASE WHEN event_id % 47 = 0 THEN 511 ELSE event_id % 360 END AS INT) AS true_heading, CAST(user_id AS BIGINT) AS user_id,
  event_id % 3 <> 0 AS valid, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 2 = 0 END AS position_accuracy, event_id % 5 = 0 AS raim,
  CAST(event_id % 4 AS INT) AS repeat_indicator, CAST(event_id % 1000 AS INT) AS communication_state,
  CAST(event_id % 4 AS INT) AS special_manoeuvre_indicator, CAST(1 + event_id % 3 AS INT) AS message_id, CAST(event_id % 60 AS INT) AS timestamp_val
  FROM events)"""
_RAW_STATIC = f"""
raw_static AS (SELECT 'SHIP ' || user_id AS ship_name, {_TEXT} AS time_utc, {_TIME} AS recorded_time, CAST({_MMSI} AS BIGINT) AS mmsi,
  CAST(event_id % 3 AS INT) AS ais_version, CASE WHEN event_id % 11 = 0 THEN '@@@@@@@' ELSE 'CS' || (user_id % 7) END AS call_sign,
  CASE WHEN event_id % 13 = 0 THEN repeat('@', 20) ELSE 'PORT' || (event_id % 5) END AS destination,
  CAST(event_id % 40 AS INT) AS dimension_a, CAST(event_id % 40 AS INT) AS dimension_b, CAST(event_id % 20 AS INT) AS dimension_c, CAST(event_id % 10 AS INT) AS dimension_d,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_id % 2 = 0 END AS dte,
  CAST(event_id % 33 AS INT) AS eta_day, CAST(event_id % 25 AS INT) AS eta_hour, CAST(event_id % 61 AS INT) AS eta_minute, CAST(event_id % 14 AS INT) AS eta_month,
  CAST(event_id % 17 AS INT) AS fix_type, CAST(CASE WHEN event_id % 7 = 0 THEN 0 ELSE 9000000 + user_id END AS BIGINT) AS imo_number,
  CASE WHEN event_id % 8 = 0 THEN 0.0e0 ELSE (event_id % 150) / 10.0e0 END AS maximum_static_draught, CAST(5 AS INT) AS message_id,
  'SHIP ' || user_id AS name, CAST(event_id % 4 AS INT) AS repeat_indicator, CAST(event_id % 101 AS INT) AS type, CAST(user_id AS BIGINT) AS user_id,
  event_id % 3 <> 0 AS valid FROM events WHERE event_type = 'signup')"""
_RAW_STATION = f"""
raw_station AS (SELECT 'SHIP ' || user_id AS ship_name, {_TEXT} AS time_utc, {_TIME} AS recorded_time, CAST(2010000 + (user_id * 10007) % 5549999 AS BIGINT) AS mmsi,
  CAST(event_id % 1000 AS INT) AS communication_state, CAST(event_id % 17 AS INT) AS fix_type, 10.0e0 + (user_id % 40) AS latitude,
  event_id % 2 = 1 AS long_range_enable, -100.0e0 + (user_id % 150) AS longitude, CAST(CASE WHEN event_id % 5 = 0 THEN 11 ELSE 4 END AS INT) AS message_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 2 = 0 END AS position_accuracy, event_id % 5 = 0 AS raim,
  CAST(event_id % 4 AS INT) AS repeat_indicator, CAST(user_id AS BIGINT) AS user_id,
  CAST(day({_TIME}) AS INT) AS utc_day, CAST(hour({_TIME}) AS INT) AS utc_hour, CAST(minute({_TIME}) AS INT) AS utc_minute, CAST(month({_TIME}) AS INT) AS utc_month,
  CAST(second({_TIME}) AS INT) AS utc_second, CAST(year({_TIME}) AS INT) AS utc_year, event_id % 3 <> 0 AS valid FROM events WHERE event_type = 'error')"""
_DICTIONARIES = f"""
countries AS (SELECT CAST(201 + n_nationkey + 25 * i AS INT) AS mid_code, trim(n_name) AS country_name FROM nation, range(0, 23) t(i)),
navs(code, nav_status_desc) AS ({_values(lookups.NAV_STATUS, 0)}), fixes(code, fix_text) AS ({_values(lookups.FIX_TYPES, 0)}),
types(code, ship_type_description) AS ({_values(lookups.SHIP_TYPES, 1)})"""
_ACCURACY = f"CASE WHEN position_accuracy THEN '{decode.ACCURATE}' ELSE '{decode.COARSE}' END AS position_accuracy"
_POSITION = f"""{_RAW_POSITION}, {_DICTIONARIES},
position AS (SELECT mmsi, ship_name, country_name, recorded_time, message_id, CASE WHEN latitude = 91.0e0 THEN NULL ELSE latitude END AS latitude,
  CASE WHEN longitude = 181.0e0 THEN NULL ELSE longitude END AS longitude, {_ACCURACY},
  CASE WHEN sog = 102.3e0 THEN NULL ELSE sog END AS speed_over_ground, CASE WHEN cog = 360.0e0 THEN NULL ELSE cog END AS course_over_ground,
  CASE WHEN true_heading = 511 THEN NULL ELSE true_heading END AS true_heading,
  CASE WHEN rate_of_turn = -128 THEN NULL WHEN rate_of_turn = 127 THEN 709.0e0 WHEN rate_of_turn = -127 THEN -709.0e0
    ELSE sign(rate_of_turn) * pow(abs(rate_of_turn) / 4.733e0, 2) END AS rate_of_turn,
  navigational_status, nav_status_desc,
  CASE special_manoeuvre_indicator WHEN 0 THEN '{decode.MANOEUVRE[0]}' WHEN 1 THEN '{decode.MANOEUVRE[1]}' WHEN 2 THEN '{decode.MANOEUVRE[2]}' ELSE 'Unknown' END AS special_manoeuvre_indicator,
  valid, raim, repeat_indicator, communication_state
  FROM raw_position LEFT JOIN countries ON mid_code = mmsi // 1000000 LEFT JOIN navs ON code = navigational_status
  WHERE mmsi BETWEEN 201000000 AND 755999999)"""
_STATIC_BODY = """
static AS (SELECT mmsi, CASE WHEN imo_number = 0 THEN NULL ELSE imo_number END AS imo_number, CASE WHEN call_sign = '@@@@@@@' THEN NULL ELSE call_sign END AS call_sign,
  ship_name, country_name, type AS ship_type_code, ship_type_description,
  CASE WHEN z THEN NULL ELSE dimension_a END AS dimension_a, CASE WHEN z THEN NULL ELSE dimension_b END AS dimension_b,
  CASE WHEN z THEN NULL ELSE dimension_c END AS dimension_c, CASE WHEN z THEN NULL ELSE dimension_d END AS dimension_d,
  CASE WHEN maximum_static_draught = 0 THEN NULL ELSE maximum_static_draught END AS maximum_static_draught,
  CASE WHEN destination = repeat('@', 20) THEN NULL ELSE destination END AS destination,
  CASE WHEN eta_month BETWEEN 1 AND 12 AND eta_day BETWEEN 1 AND 31 AND eta_hour BETWEEN 0 AND 23 AND eta_minute BETWEEN 0 AND 59 THEN
    TRY_CAST(year(recorded_time) || '-' || lpad(eta_month::VARCHAR, 2, '0') || '-' || lpad(eta_day::VARCHAR, 2, '0') || ' ' || lpad(eta_hour::VARCHAR, 2, '0') || ':' || lpad(eta_minute::VARCHAR, 2, '0') || ':00' AS TIMESTAMP) END AS eta,
  fix_type AS fix_type_code, fix_text AS fix_type_description, recorded_time, ais_version, CASE WHEN dte THEN 'Not Available' ELSE 'Available' END AS dte,
  valid, repeat_indicator, message_id
  FROM (SELECT *, dimension_a = 0 AND dimension_b = 0 AND dimension_c = 0 AND dimension_d = 0 AS z FROM raw_static)
  LEFT JOIN countries ON mid_code = mmsi // 1000000 LEFT JOIN fixes ON fixes.code = fix_type LEFT JOIN types ON types.code = type
  WHERE mmsi BETWEEN 201000000 AND 755999999)"""
_STATIC = f"{_RAW_STATIC}, {_DICTIONARIES}, {_STATIC_BODY}"
_BOTH = f"{_POSITION}, {_RAW_STATIC}, {_STATIC_BODY}"
_STATION = f"""{_RAW_STATION}, {_DICTIONARIES},
station AS (SELECT mmsi, ship_name, country_name, recorded_time, communication_state, fix_type AS fix_type_code, fix_text AS fix_type_desc, latitude, longitude, {_ACCURACY},
  raim, repeat_indicator, long_range_enable, message_id, valid
  FROM raw_station LEFT JOIN countries ON mid_code = mmsi // 10000 LEFT JOIN fixes ON code = fix_type
  WHERE mmsi BETWEEN 2010000 AND 7559999 AND message_id = 4)"""


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """The same clamped law of cosines, null if any part is."""
    cosine = f"cos(radians({lat1})) * cos(radians({lat2})) * cos(radians({lon1}) - radians({lon2})) + sin(radians({lat1})) * sin(radians({lat2}))"
    return f"(CASE WHEN {lat1} IS NOT NULL AND {lon1} IS NOT NULL AND {lat2} IS NOT NULL AND {lon2} IS NOT NULL THEN 6371.0e0 * acos(least(1.0e0, greatest(-1.0e0, {cosine}))) END)"


def _segments(pings: str, out: str, state_: str | None = None) -> str:
    """CTEs that segment ``pings`` into ``out``; state_ is a CTE with one row a vessel."""
    source = (
        f"(SELECT p.*, latest_trip_id, s.trip_end_time AS l_time, s.end_latitude AS l_lat, s.end_longitude AS l_lon, s.speed_over_ground AS l_speed FROM {pings} p LEFT JOIN {state_} s ON p.mmsi = s.mmsi WHERE s.trip_end_time IS NULL OR p.recorded_time >= s.trip_end_time)"
        if state_
        else f"(SELECT *, NULL::BIGINT AS latest_trip_id, NULL::TIMESTAMP AS l_time, NULL::DOUBLE AS l_lat, NULL::DOUBLE AS l_lon, NULL::DOUBLE AS l_speed FROM {pings})"
    )
    w = "OVER (PARTITION BY mmsi ORDER BY recorded_time ASC NULLS LAST)"
    return f"""
{out}_lag AS (SELECT *, coalesce(lag(speed_over_ground) {w}, l_speed) AS b_speed, coalesce(lag(latitude) {w}, l_lat) AS b_lat, coalesce(lag(longitude) {w}, l_lon) AS b_lon,
  coalesce(lag(recorded_time) {w}, l_time) AS b_time FROM {source}),
{out}_flag AS (SELECT *, CASE WHEN b_speed IS NULL THEN 1 WHEN b_lat IS NULL OR b_lon IS NULL THEN 1
  WHEN speed_over_ground > 1.5e0 AND b_speed <= 1.5e0 THEN 1 WHEN speed_over_ground <= 0.5e0 AND b_speed > 0.5e0 THEN 1
  WHEN date_sub('hour', b_time, recorded_time) >= 4 THEN 1 WHEN {_km('latitude', 'longitude', 'b_lat', 'b_lon')} > 50.0e0 THEN 1 ELSE 0 END AS flag
  FROM {out}_lag WHERE l_time IS NULL OR recorded_time > l_time),
{out} AS (SELECT *, CAST(sum(flag) {w} + coalesce(latest_trip_id, 0) AS BIGINT) AS trip_id FROM {out}_flag)"""


def _rollup(pings: str, out: str) -> str:
    w = "OVER (PARTITION BY mmsi, trip_id ORDER BY recorded_time ASC NULLS LAST)"
    return f"""
{out}_lag AS (SELECT *, lag(latitude) {w} AS p_lat, lag(longitude) {w} AS p_lon FROM {pings}),
{out} AS (SELECT mmsi, trip_id, min(recorded_time) AS trip_start_time, max(recorded_time) AS trip_end_time,
  arg_min_null(latitude, recorded_time) AS start_latitude, arg_min_null(longitude, recorded_time) AS start_longitude,
  arg_max_null(latitude, recorded_time) AS end_latitude, arg_max_null(longitude, recorded_time) AS end_longitude,
  sum(CASE WHEN p_lat IS NOT NULL AND p_lon IS NOT NULL THEN {_km('latitude', 'longitude', 'p_lat', 'p_lon')} ELSE 0.0e0 END) AS total_distance_km,
  avg(speed_over_ground) AS average_speed_over_ground, max(speed_over_ground) AS max_speed_over_ground, count(*) AS ping_count
  FROM {out}_lag GROUP BY mmsi, trip_id)"""


_HOURS = "CAST(CAST(date_sub('second', trip_start_time, trip_end_time) / 3600.0e0 AS DECIMAL(21,1)) AS DOUBLE) AS trip_duration_hours"
_TRIP = f"mmsi, trip_id, trip_start_time, trip_end_time, {_HOURS}, start_latitude, start_longitude, end_latitude, end_longitude, round(total_distance_km, 4) AS total_distance_km, round(average_speed_over_ground, 6) AS average_speed_over_ground, max_speed_over_ground, CAST(ping_count AS BIGINT) AS ping_count"
_DIGITS = {"total_distance_km": 4, "average_speed_over_ground": 6, "trip_duration_hours": 1, "rate_of_turn": 6, "trip_distance": 4, "trip_avg_speed": 6, "trip_duration": 1}
_SEGMENTED = f"{_POSITION}, {_segments('position', 'seg')}"
_TRIPS = f"{_SEGMENTED}, {_rollup('seg', 'trip')}"
_PING_COLUMNS = "mmsi, ship_name, country_name, recorded_time, message_id, latitude, longitude, position_accuracy, speed_over_ground, course_over_ground, true_heading, round(rate_of_turn, 6) AS rate_of_turn, navigational_status, nav_status_desc, special_manoeuvre_indicator, valid, raim, repeat_indicator, communication_state"
_STATE_OF = """
SELECT p.mmsi, latest_trip_id, trip_start_time, p.trip_end_time, start_latitude, start_longitude, end_latitude, end_longitude, speed_over_ground,
  trip_distance, trip_avg_speed, trip_max_speed, trip_ping_count FROM
 (SELECT mmsi, max(recorded_time) AS trip_end_time, max(trip_id) AS latest_trip_id, arg_max_null(latitude, recorded_time) AS end_latitude,
   arg_max_null(longitude, recorded_time) AS end_longitude, arg_max_null(speed_over_ground, recorded_time) AS speed_over_ground FROM {seg} GROUP BY mmsi) p
 LEFT JOIN (SELECT mmsi, arg_max_null(trip_start_time, trip_id) AS trip_start_time, arg_max_null(start_latitude, trip_id) AS start_latitude,
   arg_max_null(start_longitude, trip_id) AS start_longitude, arg_max_null(total_distance_km, trip_id) AS trip_distance,
   arg_max_null(average_speed_over_ground, trip_id) AS trip_avg_speed, arg_max_null(max_speed_over_ground, trip_id) AS trip_max_speed,
   arg_max_null(ping_count, trip_id) AS trip_ping_count FROM {trip} GROUP BY mmsi) t ON p.mmsi = t.mmsi"""
_KEY = "mmsi || '-' || epoch_us(recorded_time)"
_CHANGES = f"""
change_lag AS (SELECT *, row_number() OVER w AS rn, {', '.join(f'lag({c}) OVER w AS b_{c}' for c in ('imo_number', 'call_sign', 'ship_name', 'ship_type_code', 'dimension_a', 'dimension_b', 'dimension_c', 'dimension_d', 'destination', 'eta', 'fix_type_code', 'dte'))}
  FROM static WINDOW w AS (PARTITION BY mmsi ORDER BY recorded_time ASC NULLS LAST)),
change AS (SELECT * FROM change_lag WHERE rn = 1 OR {' OR '.join(f'{c} IS DISTINCT FROM b_{c}' for c in ('imo_number', 'call_sign', 'ship_name', 'ship_type_code', 'dimension_a', 'dimension_b', 'dimension_c', 'dimension_d', 'destination', 'eta', 'fix_type_code', 'dte'))}),
version AS (SELECT *, recorded_time AS valid_from, lead(recorded_time) OVER (PARTITION BY mmsi ORDER BY recorded_time) AS valid_to FROM change)"""
_STATIC_COLUMNS = "mmsi, imo_number, call_sign, ship_name, country_name, ship_type_code, ship_type_description, dimension_a, dimension_b, dimension_c, dimension_d, maximum_static_draught, destination, eta, fix_type_code, fix_type_description, ais_version, dte, valid, repeat_indicator, message_id"
_SHIP_OF_V = "v.imo_number, v.call_sign, v.ship_name, v.country_name, v.ship_type_code, v.ship_type_description, v.dimension_a AS distance_to_bow, v.dimension_b AS distance_to_stern, v.dimension_c AS distance_to_port, v.dimension_d AS distance_to_starboard, v.dimension_a + v.dimension_b AS total_length_meters, v.dimension_c + v.dimension_d AS total_width_meters, v.maximum_static_draught, v.destination, v.eta, v.fix_type_code, v.fix_type_description, v.dte"
_HOLDS = "{at} >= v.valid_from AND {at} < coalesce(v.valid_to, TIMESTAMP '2099-12-31')"

# --- splitting and cleaning ------------------------------------------------------------------------


@register(f"WITH {_RAW_POSITION} SELECT * EXCLUDE (recorded_time) FROM raw_position")
def demux_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(demux.positions(demux.envelope("PositionReport", derive.positions(_events(spark, sf_dir)))))


@register(f"WITH {_RAW_STATIC} SELECT * EXCLUDE (recorded_time) FROM raw_static")
def demux_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(demux.statics(demux.envelope("ShipStaticData", derive.statics(_events(spark, sf_dir)))))


@register(f"WITH {_RAW_STATION} SELECT * EXCLUDE (recorded_time) FROM raw_station")
def demux_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(demux.stations(demux.envelope("BaseStationReport", derive.stations(_events(spark, sf_dir)))))


@register(f"WITH {_POSITION} SELECT {_PING_COLUMNS} FROM position")
def clean_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(_positions(spark, sf_dir), _DIGITS)


@register(f"WITH {_STATIC} SELECT {_STATIC_COLUMNS}, recorded_time FROM static")
def clean_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(_statics(spark, sf_dir))


@register(f"WITH {_STATION} SELECT * FROM station")
def clean_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(_stations(spark, sf_dir))


@register(
    "SELECT CAST(i AS INT) AS code, round(CASE WHEN i = -128 THEN NULL WHEN i = 127 THEN 709.0e0 WHEN i = -127 THEN -709.0e0 ELSE sign(i) * pow(abs(i) / 4.733e0, 2) END, 6) AS degrees FROM range(-128, 128) t(i)"
)
def rate_of_turn_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = spark.range(-128, 128).select(F.col("id").cast("int").alias("code"))
    return codes.select("code", F.round(decode.rate_of_turn(F.col("code")), 6).alias("degrees"))


@register(f"WITH {_RAW_POSITION}, {_DICTIONARIES} SELECT country_name, count(*) AS n FROM raw_position LEFT JOIN countries ON mid_code = mmsi // 1000000 GROUP BY country_name")
def mmsi_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive.positions(_events(spark, sf_dir)).select(decode.mid(F.col("mmsi"), 1_000_000).alias("mid_code"))
    named = clean.lookup(raw, _countries(spark, sf_dir), "mid_code", "mid_code", "country_name", "country_name")
    return named.groupBy("country_name").agg(F.count("*").alias("n"))


def _code_counts(name: str, codes: str, dictionary: Callable, key: str, text: str, sql_dictionary: str) -> None:
    """A lookup of every event's code, counted by text."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = _events(spark, sf_dir).select(F.expr(codes).cast("int").alias("code"))
        return clean.lookup(raw, dictionary(spark), "code", key, text, "text").groupBy("code", "text").agg(F.count("*").alias("n"))

    query.__name__ = name
    register(f"WITH d(k, text) AS ({sql_dictionary}) SELECT CAST({codes} AS INT) AS code, text, count(*) AS n FROM events LEFT JOIN d ON k = {codes} GROUP BY 1, 2")(query)


_code_counts("nav_status_lookup", "event_id % 17", lookups.nav_status, "status_code", "status_code_description", _values(lookups.NAV_STATUS, 0))
_code_counts("fix_type_lookup", "event_id % 17", lookups.fix_types, "fix_type_code", "fix_type_description", _values(lookups.FIX_TYPES, 0))
_code_counts("ship_type_lookup", "event_id % 101", lookups.ship_types, "type_code", "type_description", _values(lookups.SHIP_TYPES, 1))


@register("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@register(f"WITH {_POSITION} SELECT {_KEY} AS ping_id, mmsi, recorded_time FROM position")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _positions(spark, sf_dir)
    return _out(rows.select(decode.event_key(F.col("mmsi"), F.col("recorded_time")).alias("ping_id"), "mmsi", "recorded_time"))


# --- trips -----------------------------------------------------------------------------------------


@register(f"WITH {_SEGMENTED} SELECT mmsi, recorded_time, b_speed AS previous_speed, b_lat AS previous_latitude, b_lon AS previous_longitude, b_time AS previous_time FROM seg_lag")
def ping_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips.with_previous(_positions(spark, sf_dir), trips.no_state(spark))
    return _out(rows.select("mmsi", "recorded_time", "previous_speed", "previous_latitude", "previous_longitude", "previous_time"))


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.segment(_positions(spark, sf_dir), trips.no_state(spark))


@register(f"WITH {_SEGMENTED} SELECT {_PING_COLUMNS}, trip_id FROM seg")
def trip_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(_segmented(spark, sf_dir), _DIGITS)


@register(f"WITH {_TRIPS} SELECT {_TRIP} FROM trip")
def trip_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(trips.rollup(_segmented(spark, sf_dir)), _DIGITS)


@register(
    f"""WITH {_POSITION}, first_half AS (SELECT * FROM position WHERE recorded_time < {CUT_SQL}), second_half AS (SELECT * FROM position WHERE recorded_time >= {CUT_SQL} - INTERVAL 2 DAY),
{_segments('first_half', 's1')}, {_rollup('s1', 't1')}, st AS ({_STATE_OF.format(seg='s1', trip='t1')}), {_segments('second_half', 's2', 'st')}, {_rollup('s2', 't2')},
m AS (SELECT t2.mmsi, t2.trip_id, coalesce(st.trip_start_time, t2.trip_start_time) AS trip_start_time, t2.trip_end_time,
  coalesce(st.start_latitude, t2.start_latitude) AS start_latitude, coalesce(st.start_longitude, t2.start_longitude) AS start_longitude, t2.end_latitude, t2.end_longitude,
  t2.total_distance_km + coalesce(trip_distance, 0.0e0) + coalesce({_km('t2.start_latitude', 't2.start_longitude', 'st.end_latitude', 'st.end_longitude')}, 0.0e0) AS total_distance_km,
  (average_speed_over_ground * ping_count + coalesce(trip_avg_speed * trip_ping_count, 0.0e0)) / nullif(ping_count + coalesce(trip_ping_count, 0), 0) AS average_speed_over_ground,
  CASE WHEN max_speed_over_ground IS NOT NULL THEN greatest(max_speed_over_ground, coalesce(trip_max_speed, 0.0e0)) END AS max_speed_over_ground,
  ping_count + coalesce(trip_ping_count, 0) AS ping_count
  FROM t2 LEFT JOIN st ON t2.mmsi = st.mmsi AND t2.trip_id = st.latest_trip_id)
SELECT {_TRIP} FROM (SELECT * FROM m UNION ALL BY NAME SELECT * FROM t1 WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.mmsi = t1.mmsi AND m.trip_id = t1.trip_id))"""
)
def trip_incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches: the second resumes from the state of the first, and its trips replace open ones."""
    pings = _positions(spark, sf_dir)
    none = trips.no_state(spark)
    # As in production, the second batch reads what the first has written.
    first = _kept(trips.segment(pings.where(F.col("recorded_time") < F.lit(CUT)), none))
    old = _kept(trips.trips(first, none))
    known = _kept(state.latest(first, old))
    new = trips.trips(_kept(trips.segment(pings, known, CUT)), known)
    return _out(merged(old, new, ["mmsi", "trip_id"]), _DIGITS)


@register(
    f"WITH {_TRIPS}, st AS ({_STATE_OF.format(seg='seg', trip='trip')}) SELECT st.* EXCLUDE (trip_distance, trip_avg_speed, trip_ping_count), round(trip_distance, 4) AS trip_distance, round(trip_avg_speed, 6) AS trip_avg_speed, CAST(trip_ping_count AS BIGINT) AS trip_ping_count, "
    "CAST(CAST(date_sub('second', trip_start_time, t_end) / 3600.0e0 AS DECIMAL(21,1)) AS DOUBLE) AS trip_duration FROM st LEFT JOIN (SELECT mmsi, arg_max_null(trip_end_time, trip_id) AS t_end FROM trip GROUP BY mmsi) USING (mmsi)"
)
def ship_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = _segmented(spark, sf_dir)
    return _out(state.latest(seg, trips.rollup(seg)), _DIGITS)


@register(f"WITH {_POSITION} SELECT {_PING_COLUMNS} FROM position WHERE recorded_time >= (SELECT max(recorded_time) FROM position) - INTERVAL 2 DAY")
def watermark_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The look-back bound, fetched as a value and pushed down as a literal."""
    from wakeline.sources.readers import since

    rows = _positions(spark, sf_dir)
    return _out(since(rows, rows.agg(F.max("recorded_time")).first()[0], 2), _DIGITS)


# --- static data, marts, dimensions ----------------------------------------------------------------


@register(f"WITH {_STATIC}, {_CHANGES} SELECT {_STATIC_COLUMNS}, recorded_time, {_KEY} AS change_id FROM change")
def metadata_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(scd.changes(_statics(spark, sf_dir)))


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.versions(scd.changes(_statics(spark, sf_dir)))


@register(f"WITH {_STATIC}, {_CHANGES} SELECT {_STATIC_COLUMNS}, valid_from, valid_to FROM version")
def metadata_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(_versions(spark, sf_dir))


@register(
    f"""WITH {_BOTH}, {_segments('position', 'seg')}, {_CHANGES} SELECT p.mmsi, p.trip_id, p.recorded_time, {_SHIP_OF_V}, p.latitude, p.longitude, p.position_accuracy, p.speed_over_ground,
  p.course_over_ground, p.true_heading, round(p.rate_of_turn, 6) AS rate_of_turn, p.navigational_status, p.nav_status_desc, p.special_manoeuvre_indicator, p.raim, p.mmsi || '-' || epoch_us(p.recorded_time) AS ping_id
  FROM seg p LEFT JOIN version v ON p.mmsi = v.mmsi AND {_HOLDS.format(at='p.recorded_time')}
  QUALIFY row_number() OVER (PARTITION BY p.mmsi, p.recorded_time ORDER BY v.valid_from DESC NULLS LAST) = 1"""
)
def ping_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(marts.ping_mart(_segmented(spark, sf_dir), _versions(spark, sf_dir)), _DIGITS)


@register(
    f"WITH {_BOTH}, {_segments('position', 'seg')}, {_rollup('seg', 'trip')}, {_CHANGES}, facts AS (SELECT {_TRIP} FROM trip) SELECT f.*, {_SHIP_OF_V} FROM facts f LEFT JOIN version v ON f.mmsi = v.mmsi AND {_HOLDS.format(at='f.trip_end_time')}"
)
def trip_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(marts.trip_mart(trips.rollup(_segmented(spark, sf_dir)), _versions(spark, sf_dir)), _DIGITS)


@register(f"WITH {_STATION} SELECT {', '.join(dims.STATION_COLUMNS)} FROM station QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY recorded_time DESC NULLS LAST) = 1")
def dim_basestation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(dims.stations(_stations(spark, sf_dir)))


@register(
    "SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(quarter(d) AS INT) AS quarter, isodow(d) IN (6, 7) AS is_weekend FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d)"
)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dates(spark)


@register(
    "SELECT CAST(lpad(h::VARCHAR, 2, '0') || lpad(m::VARCHAR, 2, '0') || lpad(s::VARCHAR, 2, '0') AS BIGINT) AS time_id, CAST(h AS INT) AS hour, CAST(m AS INT) AS minute, CAST(s AS INT) AS second, CASE WHEN h BETWEEN 6 AND 11 THEN 'Morning' WHEN h BETWEEN 12 AND 17 THEN 'Afternoon' WHEN h BETWEEN 18 AND 23 THEN 'Evening' ELSE 'Night' END AS time_of_day_shift FROM range(0, 24) a(h), range(0, 60) b(m), range(0, 60) c(s)"
)
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.times(spark)


# --- live view -------------------------------------------------------------------------------------

_LIVE = """p.mmsi, p.ship_name, p.country_name, p.recorded_time, p.message_id, p.longitude, p.latitude, p.position_accuracy, p.speed_over_ground, p.course_over_ground, p.true_heading,
  round(p.rate_of_turn, 6) AS rate_of_turn, p.navigational_status, p.nav_status_desc, p.special_manoeuvre_indicator, p.raim, s.imo_number, s.call_sign, s.ship_type_code, s.ship_type_description,
  s.dimension_a, s.dimension_b, s.dimension_c, s.dimension_d, coalesce(s.dimension_a, 0) + coalesce(s.dimension_b, 0) AS ship_length, coalesce(s.dimension_c, 0) + coalesce(s.dimension_d, 0) AS ship_width,
  s.maximum_static_draught, s.destination, s.eta, s.fix_type_code, s.fix_type_description, s.dte"""
_AS_OF = f"SELECT {_LIVE} FROM position p ASOF LEFT JOIN static s ON p.mmsi = s.mmsi AND p.recorded_time >= s.recorded_time"
_LAST = "QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY recorded_time DESC NULLS LAST) = 1"


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.as_of(_positions(spark, sf_dir), _statics(spark, sf_dir))


@register(f"WITH {_BOTH} {_AS_OF}")
def live_ships_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(_live(spark, sf_dir), _DIGITS)


@register(f"WITH {_BOTH}, live AS ({_AS_OF}) SELECT *, recorded_time + INTERVAL 21600 SECOND AS expires_at FROM live {_LAST}")
def live_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(live.latest_by_key(_live(spark, sf_dir)), _DIGITS)


@register(
    f"WITH {_BOTH}, live AS ({_AS_OF}) SELECT *, recorded_time + INTERVAL 21600 SECOND AS expires_at FROM live WHERE recorded_time + INTERVAL 21600 SECOND > {CUT_SQL} {_LAST}"
)
def live_unexpired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(live.latest_by_key(_live(spark, sf_dir), F.lit(CUT)), _DIGITS)


@register(
    f"WITH {_BOTH}, live AS ({_AS_OF}) SELECT * FROM live WHERE latitude BETWEEN 15 AND 30 AND speed_over_ground BETWEEN 2 AND 12 AND special_manoeuvre_indicator = 'Unknown' AND contains(lower(ship_name), 'ship 1')"
)
def live_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges, a tag and a word; the cap of results is the feature's own."""
    found = live.search(_live(spark, sf_dir), {"latitude": (15, 30), "speed_over_ground": (2, 12)}, {"special_manoeuvre_indicator": "Unknown"}, {"ship_name": "ship 1"})
    return _out(found, _DIGITS)


@register(
    f"WITH {_STATION} SELECT mmsi, ship_name, country_name, recorded_time, fix_type_code, fix_type_desc, latitude, longitude AS longtitude, position_accuracy, raim, long_range_enable, message_id FROM station {_LAST}"
)
def live_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(live.latest_by_key(live.live_stations(_stations(spark, sf_dir))).drop("expires_at"))


@register(
    f"WITH {_POSITION}, a AS (SELECT mmsi, recorded_time, latitude FROM position WHERE recorded_time < {CUT_SQL} {_LAST}), b AS (SELECT mmsi, recorded_time, latitude FROM position WHERE recorded_time >= {CUT_SQL} {_LAST}) SELECT * FROM b UNION ALL SELECT * FROM a WHERE mmsi NOT IN (SELECT mmsi FROM b)"
)
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge of two batches on a key: the later batch replaces, other rows stay."""
    rows = _positions(spark, sf_dir)
    last = lambda df: live.latest_by_key(df).select("mmsi", "recorded_time", "latitude")
    a, b = last(rows.where(F.col("recorded_time") < F.lit(CUT))), last(rows.where(F.col("recorded_time") >= F.lit(CUT)))
    return _out(merged(a, b, ["mmsi"]))


# --- ports -----------------------------------------------------------------------------------------


def elements(supplier: DataFrame) -> DataFrame:
    """Map elements of suppliers: each is a way, every tenth a relation of itself and its successor."""
    k = F.col("s_suppkey")

    def ring(of: Column) -> Column:
        point = lambda i: F.struct((F.lit(10.0) + of % 40 + i * i / F.lit(100.0)).alias("lat"), (F.lit(-100.0) + of % 150 + i / F.lit(100.0)).alias("lon"))
        open_ = F.transform(F.sequence(F.lit(0).cast("long"), of % 3 + 2), point)
        return F.when(of % 4 == 0, F.concat(open_, F.slice(open_, 1, 1))).otherwise(open_)

    zone = (k % 8).cast("int").alias("zone")
    tags = lambda name: F.create_map(F.lit("name"), name).alias("tags")
    member = lambda kind, of: F.struct(F.lit(kind).alias("type"), of.alias("ref"), ring(of).alias("geometry"))
    none = F.expr("cast(null as array<struct<type:string,ref:bigint,geometry:array<struct<lat:double,lon:double>>>>)").alias("members")
    supplier = supplier.withColumn("s_suppkey", k.cast("long"))
    ways = supplier.select(zone, F.lit("way").alias("type"), k.alias("id"), F.when(k % 5 != 0, tags(F.col("s_name"))).alias("tags"), ring(k).alias("geometry"), none)
    relations = supplier.where(k % 10 == 0).select(
        zone, F.lit("relation").alias("type"), k.alias("id"), tags(F.concat(F.lit("REL "), k.cast("string"))), F.expr("cast(null as array<struct<lat:double,lon:double>>)").alias("geometry"), F.array(member("way", k), member("node", k + 2), member("way", k + 1)).alias("members")
    )
    return relations.unionByName(ways)


_WAYS = """
cand AS (SELECT s_suppkey AS way, s_suppkey % 8 AS zone, 1 AS kind, 0 AS pos, CASE WHEN s_suppkey % 5 <> 0 THEN s_name ELSE '' END AS name FROM supplier
  UNION ALL SELECT s_suppkey, s_suppkey % 8, 0, 0, 'REL ' || s_suppkey FROM supplier WHERE s_suppkey % 10 = 0
  UNION ALL SELECT s_suppkey + 1, s_suppkey % 8, 0, 2, 'REL ' || s_suppkey FROM supplier WHERE s_suppkey % 10 = 0),
ways AS (SELECT *, 'way_' || way AS port_id, way % 3 + 3 AS open_points, way % 4 = 0 AS closed FROM cand QUALIFY row_number() OVER (PARTITION BY way ORDER BY zone, kind, pos) = 1),
boxes AS (SELECT *, 10.0e0 + way % 40 AS min_lat, 10.0e0 + way % 40 + (open_points - 1) * (open_points - 1) / 100.0e0 AS max_lat, -100.0e0 + way % 150 AS min_lon, -100.0e0 + way % 150 + (open_points - 1) / 100.0e0 AS max_lon FROM ways)"""


def _ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ports.flatten(elements(_table(spark, sf_dir, "supplier")))


@register(f"WITH {_WAYS} SELECT port_id, name, CAST(open_points + CASE WHEN closed THEN 1 ELSE 0 END AS INT) AS n_points FROM ways")
def ports_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ports(spark, sf_dir).select("port_id", "name", F.size(F.from_json("geometry_json", ports.POINTS)).alias("n_points"))


@register(f"WITH {_WAYS} SELECT port_id, min_lat, max_lat, min_lon, max_lon FROM boxes")
def ports_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ports.enrich(_ports(spark, sf_dir)).select("port_id", "min_lat", "max_lat", "min_lon", "max_lon")


@register(f"WITH {_WAYS} SELECT port_id, CAST(open_points + 1 AS INT) AS n_points, true AS closed FROM ways")
def ports_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = F.from_json("geometry_json", "type string, coordinates array<array<array<double>>>")["coordinates"][0]
    rows = ports.enrich(_ports(spark, sf_dir)).withColumn("c", points)
    return rows.select("port_id", F.size("c").alias("n_points"), (F.element_at("c", 1) == F.element_at("c", -1)).alias("closed"))


def _geohash_sql(lat: str, lon: str, precision: int = 5) -> str:
    n = 5 * precision
    bits = {0: (n + 1) // 2, 1: n // 2}
    cell = lambda v, low, span, b: f"CAST(least({(1 << b) - 1}, greatest(0, ceil(({v} - ({low})) / {span} * {float(1 << b)!r}e0) - 1)) AS BIGINT)"
    of = {0: cell(lon, "-180.0e0", "360.0e0", bits[0]), 1: cell(lat, "-90.0e0", "180.0e0", bits[1])}
    letters = []
    for c in range(precision):
        parts = [f"((({of[i % 2]} >> {bits[i % 2] - 1 - i // 2}) & 1) << {4 - i % 5})" for i in range(5 * c, 5 * c + 5)]
        letters.append(f"substr('{geo.BASE32}', CAST({' + '.join(parts)} AS BIGINT) + 1, 1)")
    return " || ".join(letters)


@register(f"WITH {_WAYS} SELECT port_id, {_geohash_sql('((min_lat + max_lat) / 2.0e0)', '((min_lon + max_lon) / 2.0e0)')} AS grid_id FROM boxes")
def ports_geohash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ports.enrich(_ports(spark, sf_dir)).select("port_id", "grid_id")


# --- streams ---------------------------------------------------------------------------------------


def _stream_of(df: DataFrame, folder: str) -> DataFrame:
    """A table replayed as a stream of files."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.readStream.schema(df.schema).parquet(folder)


@register(f"WITH {_RAW_POSITION} SELECT * EXCLUDE (recorded_time) FROM raw_position")
def streaming_demux(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw stream split into three tables in one scan; the position table comes back."""
    from wakeline.streaming import jobs

    at = _folder(spark)
    events = _events(spark, sf_dir)
    parts = [("PositionReport", derive.positions), ("ShipStaticData", derive.statics), ("BaseStationReport", derive.stations)]
    envelopes = [demux.envelope(kind, make(events)) for kind, make in parts]
    stream = _stream_of(envelopes[0].unionByName(envelopes[1]).unionByName(envelopes[2]), f"{at}/raw")
    outputs = {k: f"{at}/{k}" for k in ("position", "static", "station")}
    jobs.split(stream, outputs, f"{at}/checkpoint", once=True).awaitTermination()
    return _out(spark.read.parquet(outputs["position"]).drop("batch"))


@register(f"WITH {_BOTH} {_AS_OF}")
def streaming_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stateful as-of join on two streams. A record of no vessel at the end of each moves the watermark on."""
    from wakeline.streaming import asof

    at = _folder(spark)
    pings, static = _positions(spark, sf_dir), _statics(spark, sf_dir)
    end = pings.agg(F.max("recorded_time")).first()[0]

    def replay(df: DataFrame, name: str) -> DataFrame:
        close = spark.range(1).select(*[(F.lit(0) if f.name == "mmsi" else F.lit(end) + F.expr("interval 1 day") if f.name == "recorded_time" else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
        return _stream_of(df.unionByName(close).repartition(4), f"{at}/{name}")

    query = asof.as_of(replay(pings, "pings"), replay(static, "static")).writeStream.format("parquet").option("path", f"{at}/out")
    query.option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return _out(spark.read.parquet(f"{at}/out").where("mmsi <> 0"), _DIGITS)


@register(f"WITH {_POSITION} SELECT mmsi, recorded_time, latitude FROM position {_LAST}")
def streaming_live_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings appended to a landing table as a stream, and from there, as a stream too, kept by vessel."""
    from wakeline.plans.materialize import Table
    from wakeline.streaming import jobs

    at = _folder(spark)
    pings = _positions(spark, sf_dir).select("mmsi", "recorded_time", "latitude")
    jobs.ingest(_stream_of(pings, f"{at}/pings"), f"{at}/landing", f"{at}/c1", once=True).awaitTermination()
    table = Table(spark, f"{at}/live", "mmsi bigint, recorded_time timestamp, latitude double")
    landed = spark.readStream.schema(f"{table.schema}, event_date date").parquet(f"{at}/landing").drop("event_date")
    jobs.keep_latest(landed, table, f"{at}/c2", once=True).awaitTermination()
    return _out(table.read())


@register(f"WITH {_RAW_POSITION} SELECT * EXCLUDE (recorded_time) FROM raw_position")
def demux_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages as lines of JSON, among error notices and texts that are no JSON, split after parsing."""
    from wakeline.sources import readers

    at, events = _folder(spark), _events(spark, sf_dir)
    lines = demux.envelope("PositionReport", derive.positions(events)).select(F.to_json(F.struct("*")).alias("value"))
    noise = events.limit(2).select(F.explode(F.array(F.lit('{"error": "Api Key Is Not Valid"}'), F.lit("no json"), F.lit(""))).alias("value"))
    lines.unionByName(noise).write.text(at)
    return _out(demux.positions(readers.envelope_lines(spark, at)))


@register(f"WITH {_STATION} SELECT {', '.join(dims.STATION_COLUMNS)} FROM station WHERE recorded_time >= {CUT_SQL} {_LAST}")
def dim_basestation_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base stations of the reports from a bound on, as an incremental run takes them."""
    return _out(dims.stations(_stations(spark, sf_dir), CUT))


@register(
    "SELECT s_suppkey AS id FROM supplier WHERE (s_nationkey % 3 = 0 OR s_nationkey % 5 = 0) AND 10.0e0 + s_suppkey % 40 BETWEEN 15 AND 35 AND -100.0e0 + s_suppkey % 150 BETWEEN -80 AND 10"
)
def ports_wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map elements whose tags make them ports, inside a zone."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    tags = F.map_from_arrays(F.array(F.lit("industrial"), F.lit("landuse")), F.array(F.when(n % 3 == 0, "port"), F.when(n % 5 == 0, "harbour")))
    rows = _table(spark, sf_dir, "supplier").select(k.alias("id"), tags.alias("tags"), (F.lit(10.0) + k % 40).alias("lat"), (F.lit(-100.0) + k % 150).alias("lon"))
    wanted = ports.is_port(F.col("tags"), [("industrial", "port"), ("landuse", "harbour")]) & ports.in_box(F.col("lat"), F.col("lon"), 15, -80, 35, 10)
    return rows.where(wanted).select("id")


@register(
    "SELECT 'way_' || s_suppkey AS port_id, s_name AS name, '{\"type\":\"Polygon\",\"coordinates\":[[[1.5,2.5],[3.5,4.5],[1.5,2.5]]]}' AS geometry_json FROM supplier WHERE s_suppkey % 4 = 0"
)
def ports_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names freed of what is not ASCII, polygons as GeoJSON text; broken, empty and missing geometries are left out."""
    k = F.col("s_suppkey")
    geometry = F.when(k % 4 == 0, "[[1.5,2.5],[3.5,4.5]]").when(k % 4 == 1, "[[1.5,").when(k % 4 == 2, "[]")
    raw = _table(spark, sf_dir, "supplier").select(F.concat(F.lit("way_"), k.cast("string")).alias("port_id"), F.concat(F.lit("é"), "s_name", F.lit("港")).alias("name"), geometry.alias("geometry_json"))
    return ports.enrich(raw).select("port_id", "name", "geometry_json")
