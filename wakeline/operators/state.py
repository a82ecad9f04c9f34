"""The per-vessel state that the next batch resumes from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.sources.readers import since


def latest(fact_pings: DataFrame, fact_trips: DataFrame, watermark: object = None, delay_days: int = 2) -> DataFrame:
    """One row a vessel: its last ping, and the facts of its trip of the highest number."""
    c = F.col
    pings = since(fact_pings, watermark, delay_days).groupBy("mmsi").agg(
        F.max("recorded_time").alias("trip_end_time"),
        F.max("trip_id").alias("latest_trip_id"),
        F.max_by(F.struct("latitude", "longitude", "speed_over_ground"), "recorded_time").alias("p"),
    )
    names = {
        "trip_start_time": "trip_start_time",
        "start_latitude": "start_latitude",
        "start_longitude": "start_longitude",
        "trip_duration_hours": "trip_duration",
        "average_speed_over_ground": "trip_avg_speed",
        "total_distance_km": "trip_distance",
        "max_speed_over_ground": "trip_max_speed",
        "ping_count": "trip_ping_count",
    }
    facts = since(fact_trips, watermark, delay_days, "trip_end_time").groupBy("mmsi").agg(F.max_by(F.struct(*names), "trip_id").alias("t"))
    joined = pings.join(facts, "mmsi", "left")
    t = {new: c(f"t.{old}").alias(new) for old, new in names.items()}
    return joined.select(
        "mmsi",
        "latest_trip_id",
        t["trip_start_time"],
        "trip_end_time",
        t["start_latitude"],
        t["start_longitude"],
        c("p.latitude").alias("end_latitude"),
        c("p.longitude").alias("end_longitude"),
        c("p.speed_over_ground").alias("speed_over_ground"),
        *[t[n] for n in ("trip_duration", "trip_avg_speed", "trip_distance", "trip_max_speed", "trip_ping_count")],
    )


def watermark(state: DataFrame) -> object:
    """The highest time in the state, as a value; None without state. One row comes to the driver."""
    return state.agg(F.max("trip_end_time")).first()[0]
