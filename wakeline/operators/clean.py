"""Cleaning: valid identities, country and code lookups, sentinels decoded, times parsed.

Lookups are left joins with dictionaries, on batches and on streams alike. They come after the filter.
Spark sends a dictionary to all executors where it is below its threshold for that, as those of code
ranges are; the plan is then scan, filter, hash joins and one projection without any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions import decode


def lookup(df: DataFrame, dictionary: DataFrame, key: str, code: str, name: str, alias: str) -> DataFrame:
    """Add ``alias``: the dictionary's name of the code in ``key``; null where it has none."""
    side = dictionary.select(F.col(code).alias("_code"), F.col(name).alias(alias))
    return df.join(side, F.col(key) == F.col("_code"), "left").drop("_code")


def position_reports(raw: DataFrame, countries: DataFrame, nav_status: DataFrame) -> DataFrame:
    valid = raw.where(F.col("mmsi").between(*decode.SHIP_MMSI)).withColumn("mid_code", decode.mid(F.col("mmsi"), 1_000_000))
    named = lookup(valid, countries, "mid_code", "mid_code", "country_name", "country_name")
    named = lookup(named, nav_status, "navigational_status", "status_code", "status_code_description", "nav_status_desc")
    c = F.col
    return named.select(
        "mmsi",
        "ship_name",
        "country_name",
        decode.utc(c("time_utc")).alias("recorded_time"),
        "message_id",
        decode.without(c("latitude"), 91.0).alias("latitude"),
        decode.without(c("longitude"), 181.0).alias("longitude"),
        decode.accuracy(c("position_accuracy")).alias("position_accuracy"),
        decode.without(c("sog"), 102.3).alias("speed_over_ground"),
        decode.without(c("cog"), 360.0).alias("course_over_ground"),
        decode.without(c("true_heading"), 511).alias("true_heading"),
        decode.rate_of_turn(c("rate_of_turn")).alias("rate_of_turn"),
        "navigational_status",
        "nav_status_desc",
        decode.manoeuvre(c("special_manoeuvre_indicator")).alias("special_manoeuvre_indicator"),
        "valid",
        "raim",
        "repeat_indicator",
        "communication_state",
    )


def ship_statics(raw: DataFrame, countries: DataFrame, fix_types: DataFrame, ship_types: DataFrame) -> DataFrame:
    c = F.col
    valid = raw.where(c("mmsi").between(*decode.SHIP_MMSI)).withColumn("mid_code", decode.mid(c("mmsi"), 1_000_000))
    valid = valid.withColumn("recorded_time", decode.utc(c("time_utc")))
    named = lookup(valid, countries, "mid_code", "mid_code", "country_name", "country_name")
    named = lookup(named, fix_types, "fix_type", "fix_type_code", "fix_type_description", "fix_type_description")
    named = lookup(named, ship_types, "type", "type_code", "type_description", "ship_type_description")
    return named.select(
        "mmsi",
        decode.without(c("imo_number"), 0).alias("imo_number"),
        decode.without(c("call_sign"), "@" * 7).alias("call_sign"),
        "ship_name",
        "country_name",
        c("type").alias("ship_type_code"),
        "ship_type_description",
        decode.known_dimension(c("dimension")).alias("dimension"),
        decode.without(c("maximum_static_draught"), 0.0).alias("maximum_static_draught"),
        decode.without(c("destination"), "@" * 20).alias("destination"),
        decode.arrival(c("eta"), c("recorded_time")).alias("eta"),
        c("fix_type").alias("fix_type_code"),
        "fix_type_description",
        "recorded_time",
        "ais_version",
        decode.data_terminal(c("dte")).alias("dte"),
        "valid",
        "repeat_indicator",
        "message_id",
    )


def station_reports(raw: DataFrame, countries: DataFrame, fix_types: DataFrame) -> DataFrame:
    """Base stations proper (message 4). Their coordinates are not cleared of sentinels."""
    c = F.col
    valid = raw.where(c("mmsi").between(*decode.STATION_MMSI) & (c("message_id") == 4)).withColumn("mid_code", decode.mid(c("mmsi"), 10_000))
    named = lookup(valid, countries, "mid_code", "mid_code", "country_name", "country_name")
    named = lookup(named, fix_types, "fix_type", "fix_type_code", "fix_type_description", "fix_type_desc")
    return named.select(
        "mmsi",
        "ship_name",
        "country_name",
        decode.utc(c("time_utc")).alias("recorded_time"),
        "communication_state",
        c("fix_type").alias("fix_type_code"),
        "fix_type_desc",
        "latitude",
        "longitude",
        decode.accuracy(c("position_accuracy")).alias("position_accuracy"),
        "raim",
        "repeat_indicator",
        "long_range_enable",
        "message_id",
        "valid",
    )
