"""One raw message stream split into three typed ones. The same functions serve batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _meta() -> list[Column]:
    return [F.col("MetaData.MMSI").alias("mmsi"), F.col("MetaData.ShipName").alias("ship_name"), F.col("MetaData.time_utc").alias("time_utc")]


def _take(envelopes: DataFrame, kind: str, fields: dict[str, str]) -> DataFrame:
    """Messages of one kind whose payload is there, flattened. Nested structs stay whole."""
    payload = F.col(f"Message.{kind}")
    return envelopes.where((F.col("MessageType") == kind) & payload.isNotNull()).select(
        *_meta(), *[F.col(f"Message.{kind}.{source}").alias(name) for name, source in fields.items()]
    )


POSITION = {
    "cog": "Cog",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "navigational_status": "NavigationalStatus",
    "rate_of_turn": "RateOfTurn",
    "sog": "Sog",
    "true_heading": "TrueHeading",
    "user_id": "UserID",
    "valid": "Valid",
    "position_accuracy": "PositionAccuracy",
    "raim": "Raim",
    "repeat_indicator": "RepeatIndicator",
    "communication_state": "CommunicationState",
    "special_manoeuvre_indicator": "SpecialManoeuvreIndicator",
    "message_id": "MessageID",
    "timestamp_val": "Timestamp",
}
STATIC = {
    "ais_version": "AisVersion",
    "call_sign": "CallSign",
    "destination": "Destination",
    "dimension": "Dimension",
    "dte": "Dte",
    "eta": "Eta",
    "fix_type": "FixType",
    "imo_number": "ImoNumber",
    "maximum_static_draught": "MaximumStaticDraught",
    "message_id": "MessageID",
    "name": "Name",
    "repeat_indicator": "RepeatIndicator",
    "type": "Type",
    "user_id": "UserID",
    "valid": "Valid",
}
STATION = {
    "communication_state": "CommunicationState",
    "fix_type": "FixType",
    "latitude": "Latitude",
    "long_range_enable": "LongRangeEnable",
    "longitude": "Longitude",
    "message_id": "MessageID",
    "position_accuracy": "PositionAccuracy",
    "raim": "Raim",
    "repeat_indicator": "RepeatIndicator",
    "user_id": "UserID",
    "utc_day": "UtcDay",
    "utc_hour": "UtcHour",
    "utc_minute": "UtcMinute",
    "utc_month": "UtcMonth",
    "utc_second": "UtcSecond",
    "utc_year": "UtcYear",
    "valid": "Valid",
}


def positions(envelopes: DataFrame) -> DataFrame:
    return _take(envelopes, "PositionReport", POSITION)


def statics(envelopes: DataFrame) -> DataFrame:
    return _take(envelopes, "ShipStaticData", STATIC)


def stations(envelopes: DataFrame) -> DataFrame:
    return _take(envelopes, "BaseStationReport", STATION)


def envelope(kind: str, raw: DataFrame) -> DataFrame:
    """The inverse of a split, for replays and tests: raw typed rows as envelopes with one payload."""
    from wakeline import schemas

    fields = {"PositionReport": POSITION, "ShipStaticData": STATIC, "BaseStationReport": STATION}
    types = {"PositionReport": schemas.POSITION_REPORT, "ShipStaticData": schemas.SHIP_STATIC, "BaseStationReport": schemas.BASE_STATION}
    payloads = [
        (F.struct(*[F.col(n).alias(s) for n, s in fields[k].items()]) if k == kind else F.lit(None)).cast(types[k]).alias(k)
        for k in fields
    ]
    meta = F.struct(
        F.col("mmsi").alias("MMSI"),
        F.col("ship_name").alias("ShipName"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.col("time_utc"),
    )
    return raw.select(F.lit(kind).alias("MessageType"), meta.alias("MetaData"), F.struct(*payloads).alias("Message"), F.lit(None).cast("string").alias("error"))
