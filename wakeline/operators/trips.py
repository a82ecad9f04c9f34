"""Trip segmentation that resumes from per-vessel state, and trip facts merged across batches.

All window functions of the segmentation share one partitioning and order, so the plan has one shuffle
by vessel and one sort. The state table has one row a vessel and joins before the window by vessel too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.functions.geo import distance_km
from wakeline.sources.readers import since

MOVING_KNOTS, RESTING_KNOTS = 1.5, 0.5
GAP_HOURS, JUMP_KM = 4, 50.0


def no_state(spark: SparkSession) -> DataFrame:
    """The state before the first batch: typed, and empty."""
    return spark.createDataFrame([], schemas.STATE)


def _last_ping(state: DataFrame) -> DataFrame:
    return state.select(
        "mmsi",
        "latest_trip_id",
        F.col("trip_end_time").alias("latest_recorded_time"),
        F.col("end_latitude").alias("latest_latitude"),
        F.col("end_longitude").alias("latest_longitude"),
        F.col("speed_over_ground").alias("latest_speed"),
    )


def with_previous(pings: DataFrame, state: DataFrame) -> DataFrame:
    """Pings not older than their vessel's state, each with the values of the ping before.

    Where the batch has no value before, that of the state counts, also for a null inside the batch.
    """
    fresh = pings.join(_last_ping(state), "mmsi", "left").where(
        F.col("latest_recorded_time").isNull() | (F.col("recorded_time") >= F.col("latest_recorded_time"))
    )
    w = Window.partitionBy("mmsi").orderBy(F.col("recorded_time").asc_nulls_last())
    before = {
        "previous_speed": ("speed_over_ground", "latest_speed"),
        "previous_latitude": ("latitude", "latest_latitude"),
        "previous_longitude": ("longitude", "latest_longitude"),
        "previous_time": ("recorded_time", "latest_recorded_time"),
    }
    return fresh.withColumns({n: F.coalesce(F.lag(x).over(w), F.col(s)) for n, (x, s) in before.items()})


def starts_trip() -> Column:
    """1 where a ping opens a trip: the first rule that applies decides."""
    c = F.col
    speed, before = c("speed_over_ground"), c("previous_speed")
    hours = F.timestamp_diff("HOUR", c("previous_time"), c("recorded_time"))
    jump = distance_km(c("latitude"), c("longitude"), c("previous_latitude"), c("previous_longitude"))
    return (
        F.when(before.isNull(), 1)
        .when(c("previous_latitude").isNull() | c("previous_longitude").isNull(), 1)
        .when((speed > MOVING_KNOTS) & (before <= MOVING_KNOTS), 1)
        .when((speed <= RESTING_KNOTS) & (before > RESTING_KNOTS), 1)
        .when(hours >= GAP_HOURS, 1)
        .when(jump > JUMP_KM, 1)
        .otherwise(0)
    )


def segment(pings: DataFrame, state: DataFrame, watermark: object = None, delay_days: int = 2) -> DataFrame:
    """New pings with their trip_id. Pings at or before their vessel's state are dropped.

    The bounding ping of the last batch enters the lag and is removed after it; the filters can't swap.
    Pings of equal time belong to one trip: the running sum has a range frame.
    """
    lagged = with_previous(since(pings, watermark, delay_days), state)
    new = lagged.where(F.col("latest_recorded_time").isNull() | (F.col("recorded_time") > F.col("latest_recorded_time")))
    w = Window.partitionBy("mmsi").orderBy(F.col("recorded_time").asc_nulls_last())
    trip = F.sum(starts_trip().cast("long")).over(w) + F.coalesce(F.col("latest_trip_id"), F.lit(0))
    return new.withColumn("trip_id", trip.cast("long")).select(*pings.columns, "trip_id")


def _hours(start: Column, end: Column) -> Column:
    """Duration in tenths of an hour, rounded half up."""
    return (F.timestamp_diff("SECOND", start, end) / F.lit(3600.0)).cast("decimal(21,1)")


def rollup(pings: DataFrame) -> DataFrame:
    """Facts of the trips in a batch of segmented pings."""
    c = F.col
    w = Window.partitionBy("mmsi", "trip_id").orderBy(c("recorded_time").asc_nulls_last())
    lagged = pings.withColumns({"prev_lat": F.lag("latitude").over(w), "prev_lon": F.lag("longitude").over(w)})
    step = distance_km(c("latitude"), c("longitude"), c("prev_lat"), c("prev_lon"))
    step = F.when(c("prev_lat").isNotNull() & c("prev_lon").isNotNull(), step).otherwise(F.lit(0.0))
    facts = lagged.groupBy("mmsi", "trip_id").agg(
        F.min("recorded_time").alias("trip_start_time"),
        F.max("recorded_time").alias("trip_end_time"),
        F.min_by("latitude", "recorded_time").alias("start_latitude"),
        F.min_by("longitude", "recorded_time").alias("start_longitude"),
        F.max_by("latitude", "recorded_time").alias("end_latitude"),
        F.max_by("longitude", "recorded_time").alias("end_longitude"),
        F.sum(step).alias("total_distance_km"),
        F.avg("speed_over_ground").alias("average_speed_over_ground"),
        F.max("speed_over_ground").alias("max_speed_over_ground"),
        F.count("*").alias("ping_count"),
    )
    return facts.withColumn("trip_duration_hours", _hours(c("trip_start_time"), c("trip_end_time"))).select(*TRIP_COLUMNS)


TRIP_COLUMNS = (
    "mmsi",
    "trip_id",
    "trip_start_time",
    "trip_end_time",
    "trip_duration_hours",
    "start_latitude",
    "start_longitude",
    "end_latitude",
    "end_longitude",
    "total_distance_km",
    "average_speed_over_ground",
    "max_speed_over_ground",
    "ping_count",
)


def merge_open(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Trips of a batch, with what the state holds of the trip that was open joined on.

    The start stays the earlier one; distances add up, with the way between the batches; the mean speed
    is weighted by pings, nulls included in the weights; a null maximum of the batch stays null.
    """
    c = F.col
    old = state.select(
        "mmsi",
        c("latest_trip_id").alias("trip_id"),
        *[c(n).alias(f"old_{n}") for n in ("trip_start_time", "start_latitude", "start_longitude", "end_latitude", "end_longitude")],
        *[c(f"trip_{n}").alias(f"old_{n}") for n in ("avg_speed", "distance", "max_speed", "ping_count")],
    )
    seam = distance_km(c("start_latitude"), c("start_longitude"), c("old_end_latitude"), c("old_end_longitude"))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    count = c("ping_count") + F.coalesce(c("old_ping_count"), F.lit(0))
    speed = (c("average_speed_over_ground") * c("ping_count") + zero(c("old_avg_speed") * c("old_ping_count"))) / F.nullif(count, F.lit(0))
    start = F.coalesce(c("old_trip_start_time"), c("trip_start_time"))
    joined = batch.join(old, ["mmsi", "trip_id"], "left")
    return joined.select(
        "mmsi",
        "trip_id",
        start.alias("trip_start_time"),
        "trip_end_time",
        _hours(start, c("trip_end_time")).alias("trip_duration_hours"),
        F.coalesce(c("old_start_latitude"), c("start_latitude")).alias("start_latitude"),
        F.coalesce(c("old_start_longitude"), c("start_longitude")).alias("start_longitude"),
        "end_latitude",
        "end_longitude",
        (c("total_distance_km") + zero(c("old_distance")) + zero(seam)).alias("total_distance_km"),
        speed.alias("average_speed_over_ground"),
        F.when(c("max_speed_over_ground").isNotNull(), F.greatest(c("max_speed_over_ground"), zero(c("old_max_speed")))).alias("max_speed_over_ground"),
        count.alias("ping_count"),
    )


def trips(fact_pings: DataFrame, state: DataFrame, watermark: object = None, delay_days: int = 2) -> DataFrame:
    """Facts of all trips that have pings newer than their vessel's state."""
    last = state.select("mmsi", F.col("trip_end_time").alias("latest_recorded_time"))
    recent = since(fact_pings, watermark, delay_days).join(last, "mmsi", "left")
    recent = recent.where(F.col("latest_recorded_time").isNull() | (F.col("recorded_time") > F.col("latest_recorded_time")))
    return merge_open(rollup(recent.drop("latest_recorded_time")), state)
