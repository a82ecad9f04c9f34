"""Dimensions: dates, times of day, base stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STATION_COLUMNS = (
    "mmsi",
    "country_name",
    "recorded_time",
    "fix_type_code",
    "fix_type_desc",
    "latitude",
    "longitude",
    "position_accuracy",
    "raim",
    "long_range_enable",
)


def dates(spark: SparkSession, first: str = "2020-01-01", last: str = "2030-12-31") -> DataFrame:
    day = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))).alias("d")
    d = F.col("d")
    return spark.range(1).select(day).select(
        F.date_format(d, "yyyyMMdd").cast("long").alias("date_id"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.expr("extract(DAYOFWEEK_ISO FROM d)").isin(6, 7).alias("is_weekend"),
    )


def times(spark: SparkSession) -> DataFrame:
    """Every second of a day: the product of hours, minutes and seconds, 86,400 rows whatever the data."""
    unit = lambda n, name: spark.range(n).select(F.col("id").cast("int").alias(name))
    two = lambda name: F.lpad(F.col(name).cast("string"), 2, "0")
    h = F.col("hour")
    shift = F.when(h.between(6, 11), "Morning").when(h.between(12, 17), "Afternoon").when(h.between(18, 23), "Evening").otherwise("Night")
    all_ = unit(24, "hour").crossJoin(unit(60, "minute")).crossJoin(unit(60, "second"))
    return all_.select(F.concat(two("hour"), two("minute"), two("second")).cast("long").alias("time_id"), "hour", "minute", "second", shift.alias("time_of_day_shift"))


def stations(reports: DataFrame, bound: object = None) -> DataFrame:
    """The last report of every base station, of those from ``bound`` on."""
    recent = reports if bound is None else reports.where(F.col("recorded_time") >= F.lit(bound))
    w = Window.partitionBy("mmsi").orderBy(F.col("recorded_time").desc_nulls_last(), F.xxhash64(*STATION_COLUMNS))  # ties by a fixed rule
    return recent.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*STATION_COLUMNS)
