"""Declared schemas of the raw streams, as DDL texts that Spark reads."""

from __future__ import annotations

DIMENSION = "struct<A:int,B:int,C:int,D:int>"
ETA = "struct<Day:int,Hour:int,Minute:int,Month:int>"

#: Payload structs of the raw envelope.
POSITION_REPORT = (
    "struct<Cog:double,Latitude:double,Longitude:double,NavigationalStatus:int,RateOfTurn:int,Sog:double,"
    "TrueHeading:int,UserID:bigint,Valid:boolean,PositionAccuracy:boolean,Raim:boolean,RepeatIndicator:int,"
    "CommunicationState:int,SpecialManoeuvreIndicator:int,MessageID:int,Timestamp:int>"
)
SHIP_STATIC = (
    f"struct<AisVersion:int,CallSign:string,Destination:string,Dimension:{DIMENSION},Dte:boolean,Eta:{ETA},FixType:int,"
    "ImoNumber:bigint,MaximumStaticDraught:double,MessageID:int,Name:string,RepeatIndicator:int,Type:int,UserID:bigint,Valid:boolean>"
)
BASE_STATION = (
    "struct<CommunicationState:int,FixType:int,Latitude:double,LongRangeEnable:boolean,Longitude:double,MessageID:int,"
    "PositionAccuracy:boolean,Raim:boolean,RepeatIndicator:int,UserID:bigint,UtcDay:int,UtcHour:int,UtcMinute:int,"
    "UtcMonth:int,UtcSecond:int,UtcYear:int,Valid:boolean>"
)
ENVELOPE = (
    "MessageType string, MetaData struct<MMSI:bigint,ShipName:string,latitude:double,longitude:double,time_utc:string>, "
    f"Message struct<PositionReport:{POSITION_REPORT},ShipStaticData:{SHIP_STATIC},BaseStationReport:{BASE_STATION}>, error string"
)

RAW_POSITION = (
    "mmsi bigint, ship_name string, time_utc string, cog double, latitude double, longitude double, navigational_status int, "
    "rate_of_turn int, sog double, true_heading int, user_id bigint, valid boolean, position_accuracy boolean, raim boolean, "
    "repeat_indicator int, communication_state int, special_manoeuvre_indicator int, message_id int, timestamp_val int"
)
RAW_STATIC = (
    f"mmsi bigint, ship_name string, time_utc string, ais_version int, call_sign string, destination string, dimension {DIMENSION}, "
    f"dte boolean, eta {ETA}, fix_type int, imo_number bigint, maximum_static_draught double, message_id int, name string, "
    "repeat_indicator int, type int, user_id bigint, valid boolean"
)
RAW_STATION = (
    "mmsi bigint, ship_name string, time_utc string, communication_state int, fix_type int, latitude double, long_range_enable boolean, "
    "longitude double, message_id int, position_accuracy boolean, raim boolean, repeat_indicator int, user_id bigint, utc_day int, "
    "utc_hour int, utc_minute int, utc_month int, utc_second int, utc_year int, valid boolean"
)

LANDING_POSITION = (
    "mmsi bigint, ship_name string, country_name string, recorded_time timestamp, message_id int, latitude double, longitude double, "
    "position_accuracy string, speed_over_ground double, course_over_ground double, true_heading int, rate_of_turn double, "
    "navigational_status int, nav_status_desc string, special_manoeuvre_indicator string, valid boolean, raim boolean, "
    "repeat_indicator int, communication_state int"
)
LANDING_STATIC = (
    "mmsi bigint, imo_number bigint, call_sign string, ship_name string, country_name string, ship_type_code int, "
    f"ship_type_description string, dimension {DIMENSION}, maximum_static_draught double, destination string, eta timestamp, "
    "fix_type_code int, fix_type_description string, recorded_time timestamp, ais_version int, dte string, valid boolean, "
    "repeat_indicator int, message_id int"
)
LANDING_STATION = (
    "mmsi bigint, ship_name string, country_name string, recorded_time timestamp, communication_state int, fix_type_code int, "
    "fix_type_desc string, latitude double, longitude double, position_accuracy string, raim boolean, repeat_indicator int, "
    "long_range_enable boolean, message_id int, valid boolean"
)
#: One row a vessel: its last ping and the totals of its open trip.
STATE = (
    "mmsi bigint, latest_trip_id bigint, trip_start_time timestamp, trip_end_time timestamp, start_latitude double, "
    "start_longitude double, end_latitude double, end_longitude double, speed_over_ground double, trip_duration decimal(21,1), "
    "trip_avg_speed double, trip_distance double, trip_max_speed double, trip_ping_count bigint"
)
ELEMENTS = (
    "zone int, type string, id bigint, tags map<string,string>, geometry array<struct<lat:double,lon:double>>, "
    "members array<struct<type:string,ref:bigint,geometry:array<struct<lat:double,lon:double>>>>"
)
