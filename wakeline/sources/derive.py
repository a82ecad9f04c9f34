"""Vessel messages derived from the events table: a fixed recipe, for tests, queries and benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH_MICROS = 1_704_067_200_000_000


def _time() -> Column:
    """Event times, with their distance from the start of 2024 divided by ten."""
    micros = F.expr(f"{EPOCH_MICROS} + (unix_micros(cast(ts as timestamp)) - {EPOCH_MICROS}) div 10")
    return F.timestamp_micros(micros)


def _time_text() -> Column:
    return F.concat(F.date_format(_time(), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("000 +0000 UTC"))


def _ship() -> Column:
    return F.expr("CASE WHEN user_id % 29 = 0 THEN 999000000 + user_id ELSE 201000000 + (user_id * 1000003) % 554999999 END").cast("long")


def _parts(e: DataFrame, **columns: str) -> DataFrame:
    shared = [F.expr("concat('SHIP ', cast(user_id as string))").alias("ship_name"), _time_text().alias("time_utc")]
    return e.select(*shared, *[F.expr(x).alias(n) for n, x in columns.items()])


def positions(events: DataFrame) -> DataFrame:
    """A raw position report of every event."""
    return _parts(
        events.withColumn("mmsi", _ship()),
        mmsi="mmsi",
        cog="cast(event_id % 361 as double)",
        latitude="case when event_id % 61 = 0 then 91.0e0 else 10.0e0 + (user_id % 40) + (event_id % 100) / 1000.0e0 + case when event_id % 97 = 0 then 5.0e0 else 0.0e0 end end",
        longitude="case when event_id % 61 = 0 then 181.0e0 else -100.0e0 + (user_id % 150) + (event_id % 77) / 1000.0e0 end",
        navigational_status="cast(event_id % 17 as int)",
        rate_of_turn="cast(event_id % 256 - 128 as int)",
        sog="case when event_id % 53 = 0 then 102.3e0 else round(value / 10.0e0, 1) end",
        true_heading="cast(case when event_id % 47 = 0 then 511 else event_id % 360 end as int)",
        user_id="cast(user_id as bigint)",
        valid="event_id % 3 <> 0",
        position_accuracy="case when event_id % 11 = 0 then null else event_id % 2 = 0 end",
        raim="event_id % 5 = 0",
        repeat_indicator="cast(event_id % 4 as int)",
        communication_state="cast(event_id % 1000 as int)",
        special_manoeuvre_indicator="cast(event_id % 4 as int)",
        message_id="cast(1 + event_id % 3 as int)",
        timestamp_val="cast(event_id % 60 as int)",
    )


def statics(events: DataFrame) -> DataFrame:
    """Raw static data of the signup events."""
    return _parts(
        events.where("event_type = 'signup'").withColumn("mmsi", _ship()),
        mmsi="mmsi",
        ais_version="cast(event_id % 3 as int)",
        call_sign="case when event_id % 11 = 0 then '@@@@@@@' else concat('CS', cast(user_id % 7 as string)) end",
        destination="case when event_id % 13 = 0 then repeat('@', 20) else concat('PORT', cast(event_id % 5 as string)) end",
        dimension="named_struct('A', cast(event_id % 40 as int), 'B', cast(event_id % 40 as int), 'C', cast(event_id % 20 as int), 'D', cast(event_id % 10 as int))",
        dte="case when event_id % 9 = 0 then null else event_id % 2 = 0 end",
        eta="named_struct('Day', cast(event_id % 33 as int), 'Hour', cast(event_id % 25 as int), 'Minute', cast(event_id % 61 as int), 'Month', cast(event_id % 14 as int))",
        fix_type="cast(event_id % 17 as int)",
        imo_number="cast(case when event_id % 7 = 0 then 0 else 9000000 + user_id end as bigint)",
        maximum_static_draught="case when event_id % 8 = 0 then 0.0e0 else (event_id % 150) / 10.0e0 end",
        message_id="cast(5 as int)",
        name="concat('SHIP ', cast(user_id as string))",
        repeat_indicator="cast(event_id % 4 as int)",
        type="cast(event_id % 101 as int)",
        user_id="cast(user_id as bigint)",
        valid="event_id % 3 <> 0",
    )


def stations(events: DataFrame) -> DataFrame:
    """Raw base-station reports of the error events."""
    return _parts(
        events.where("event_type = 'error'").withColumn("mmsi", F.expr("cast(2010000 + (user_id * 10007) % 5549999 as bigint)")).withColumn("at", _time()),
        mmsi="mmsi",
        communication_state="cast(event_id % 1000 as int)",
        fix_type="cast(event_id % 17 as int)",
        latitude="10.0e0 + (user_id % 40)",
        long_range_enable="event_id % 2 = 1",
        longitude="-100.0e0 + (user_id % 150)",
        message_id="cast(case when event_id % 5 = 0 then 11 else 4 end as int)",
        position_accuracy="case when event_id % 11 = 0 then null else event_id % 2 = 0 end",
        raim="event_id % 5 = 0",
        repeat_indicator="cast(event_id % 4 as int)",
        user_id="cast(user_id as bigint)",
        utc_day="day(at)",
        utc_hour="hour(at)",
        utc_minute="minute(at)",
        utc_month="month(at)",
        utc_second="cast(second(at) as int)",
        utc_year="year(at)",
        valid="event_id % 3 <> 0",
    )
