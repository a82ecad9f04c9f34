"""The incremental modelling run: facts, versions, marts, dimensions, and the state last.

State and watermark are read once at the start. All models are functions of DataFrames; this module
only ties them to tables. A run first notes the version of every table; whatever run comes after one that
died puts these versions back before it begins, so that a run counts as a whole or not at all, wherever
it was stopped. A run that ended is not repeated.
"""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.operators import dims, marts, scd, state, trips
from wakeline.plans.materialize import Files, Table

FACT_PINGS = f"{schemas.LANDING_POSITION}, trip_id bigint"
FACT_TRIPS = (
    "mmsi bigint, trip_id bigint, trip_start_time timestamp, trip_end_time timestamp, trip_duration_hours decimal(21,1), "
    "start_latitude double, start_longitude double, end_latitude double, end_longitude double, total_distance_km double, "
    "average_speed_over_ground double, max_speed_over_ground double, ping_count bigint"
)
CHANGES = f"{schemas.LANDING_STATIC}, change_id string"
_SIZE = "distance_to_bow int, distance_to_stern int, distance_to_port int, distance_to_starboard int, total_length_meters int, total_width_meters int"
_LAST = "maximum_static_draught double, destination string, eta timestamp, fix_type_code int, fix_type_description string, dte string"
_SHIP = "imo_number bigint, call_sign string, ship_name string, country_name string"
TRIP_MART = f"{FACT_TRIPS}, {_SHIP}, ship_type_code int, ship_type_description string, {_SIZE}, {_LAST}"
PING_MART = (
    f"mmsi bigint, trip_id bigint, recorded_time timestamp, {_SHIP}, latitude double, longitude double, position_accuracy string, "
    "speed_over_ground double, course_over_ground double, true_heading int, rate_of_turn double, navigational_status int, "
    "nav_status_desc string, special_manoeuvre_indicator string, raim boolean, ship_type_code int, ship_type_description string, "
    f"{_SIZE}, {_LAST}, ping_id string"
)
STATIONS = (
    "mmsi bigint, country_name string, recorded_time timestamp, fix_type_code int, fix_type_desc string, latitude double, "
    "longitude double, position_accuracy string, raim boolean, long_range_enable boolean"
)


class Warehouse:
    """The tables of a lakehouse folder."""

    def __init__(self, spark: SparkSession, root: str):
        t = lambda name, schema, day=None: Table(spark, f"{root.rstrip('/')}/{name}", schema, day)
        self.spark, self.root = spark, root.rstrip("/")
        self.fact_position_reports = t("fact_position_reports", FACT_PINGS, "recorded_time")
        self.fact_ship_trips = t("fact_ship_trips", FACT_TRIPS, "trip_start_time")
        self.ship_metadata_change = t("ship_metadata_change", CHANGES)
        self.mart_trips = t("mart_trips", TRIP_MART, "trip_start_time")
        self.mart_position_pings = t("mart_position_pings", PING_MART, "recorded_time")
        self.ship_latest_state = t("ship_latest_state", schemas.STATE)
        self.dim_basestation = t("dim_basestation", STATIONS)

    def all(self) -> dict[str, Table]:
        return {k: v for k, v in vars(self).items() if isinstance(v, Table)}

    def dim_shipstatic_metadata(self) -> DataFrame:
        """The versions, always computed from the present changes."""
        return scd.versions(self.ship_metadata_change.read())


def _begin(tables: Warehouse, runs: Files, run_id: str) -> bool:
    """Undo what a run that died has published, and note where this one starts; False if it has ended before."""
    found = runs.read("_open")
    if found is not None:
        left = json.loads(found)
        if runs.read(left["run"]) is None:
            for name, version in left["versions"].items():
                tables.all()[name].restore(version)
        runs.drop("_open")
    if runs.read(run_id) is not None:
        return False
    if not runs.put("_open", json.dumps({"run": run_id, "versions": {k: t.version() for k, t in tables.all().items()}})):
        raise OSError(f"{runs.path}: another run is open")
    return True


def run_batch(
    tables: Warehouse, positions: DataFrame, static: DataFrame, stations: DataFrame, run_id: str, delay_days: int = 2, full_refresh: bool = False
) -> None:
    """One run over the landing tables. A full refresh starts without state and rebuilds everything."""
    spark, runs = tables.spark, Files(tables.spark, f"{tables.root}/_runs")
    if not _begin(tables, runs, run_id):
        return
    fresh = full_refresh or not tables.ship_latest_state.exists()
    before = trips.no_state(spark) if fresh else tables.ship_latest_state.read()
    mark = None if fresh else state.watermark(before)
    first = None if mark is None else (mark - datetime.timedelta(days=delay_days + 1)).date()  # a day more, whatever the time zone
    if full_refresh:
        for t in tables.all().values():
            t.rebuild(spark.createDataFrame([], t.schema))
    tables.fact_position_reports.append(trips.segment(positions, before, mark, delay_days), run_id)
    facts = tables.fact_position_reports.read(first)
    tables.fact_ship_trips.upsert(trips.trips(facts, before, mark, delay_days), ["mmsi", "trip_id"], unique=True)
    change = scd.changes(static, mark, delay_days)
    tables.ship_metadata_change.upsert(change, ["change_id"], [F.col("recorded_time"), F.xxhash64("call_sign", "destination", "eta")])
    version = tables.dim_shipstatic_metadata()
    tables.mart_trips.upsert(marts.trip_mart(tables.fact_ship_trips.read(), version, mark, delay_days), ["mmsi", "trip_id"], unique=True)
    tables.mart_position_pings.upsert(marts.ping_mart(facts, version, mark, delay_days), ["ping_id"], unique=True)
    known = tables.dim_basestation.read()
    bound = known.agg(F.max("recorded_time")).first()[0]
    tables.dim_basestation.upsert(dims.stations(stations, bound), ["mmsi"], unique=True)
    new_state = state.latest(facts, tables.fact_ship_trips.read(), mark, delay_days)
    tables.ship_latest_state.upsert(new_state, ["mmsi"], unique=True)
    runs.put(run_id, "")
    runs.drop("_open")
    for t in tables.all().values():
        t.vacuum()
