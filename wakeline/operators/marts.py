"""Marts: trips and pings, each with the static data that held at its time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.decode import event_key
from wakeline.operators.scd import join_version
from wakeline.operators.trips import TRIP_COLUMNS
from wakeline.sources.readers import since


def _ship(*names: str) -> list[Column]:
    return [F.col(f"v.{n}").alias(n) for n in names]


def _size() -> list[Column]:
    """The four distances, and their sums; an unknown distance makes the sum unknown."""
    d = F.col("v.dimension")
    names = dict(zip("ABCD", ("distance_to_bow", "distance_to_stern", "distance_to_port", "distance_to_starboard"), strict=True))
    return [
        *[d[k].alias(n) for k, n in names.items()],
        (d["A"] + d["B"]).alias("total_length_meters"),
        (d["C"] + d["D"]).alias("total_width_meters"),
    ]


LAST = ("maximum_static_draught", "destination", "eta", "fix_type_code", "fix_type_description", "dte")


def trip_mart(fact_trips: DataFrame, version: DataFrame, watermark: object = None, delay_days: int = 2) -> DataFrame:
    rows = join_version(since(fact_trips, watermark, delay_days, "trip_end_time"), version, "trip_end_time")
    ship = _ship("imo_number", "call_sign", "ship_name", "country_name", "ship_type_code", "ship_type_description")
    return rows.select(*TRIP_COLUMNS, *ship, *_size(), *_ship(*LAST))


PING = (
    "latitude",
    "longitude",
    "position_accuracy",
    "speed_over_ground",
    "course_over_ground",
    "true_heading",
    "rate_of_turn",
    "navigational_status",
    "nav_status_desc",
    "special_manoeuvre_indicator",
    "raim",
)


def ping_mart(fact_pings: DataFrame, version: DataFrame, watermark: object = None, delay_days: int = 2) -> DataFrame:
    """One row a vessel and time: of several versions the latest counts."""
    pings = since(fact_pings, watermark, delay_days).drop("ship_name", "country_name")
    w = Window.partitionBy("mmsi", "recorded_time").orderBy(F.col("v.valid_from").desc_nulls_last())
    one = join_version(pings, version, "recorded_time").withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return one.select(
        "mmsi",
        "trip_id",
        "recorded_time",
        *_ship("imo_number", "call_sign", "ship_name", "country_name"),
        *PING,
        *_ship("ship_type_code", "ship_type_description"),
        *_size(),
        *_ship(*LAST),
        event_key(F.col("mmsi"), F.col("recorded_time")).alias("ping_id"),
    )
