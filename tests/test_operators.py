"""Decode rules, trips, versions, marts, ports and sinks on small literal tables."""

from __future__ import annotations

import datetime as dt
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wakeline import config, schemas
from wakeline.functions import decode, geo
from wakeline.operators import clean, demux, dims, live, ports, scd, state, trips
from wakeline.plans.batch import Warehouse, run_batch
from wakeline.plans.materialize import Table
from wakeline.sources import lookups, readers

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(minutes: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minutes)


def values(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_rate_of_turn(spark):
    got = values(spark, "x int", [(None,), (-128,), (-127,), (-1,), (0,), (1,), (126,), (127,)], decode.rate_of_turn(F.col("x")))
    want = [None, None, -709.0, -((1 / 4.733) ** 2), 0.0, (1 / 4.733) ** 2, (126 / 4.733) ** 2, 709.0]
    assert all(a[0] is None if b is None else math.isclose(a[0], b) for a, b in zip(got, want, strict=True))


RAW_POSITION = (235_000_001, "S", "2024-01-01 00:00:01.123456789 +0000 UTC", 359.9, 90.9, 180.9, 16, -128, 102.2, 510, 1, True, None, True, 0, 0, None, 1, 1)


def position(spark, nations, **changed):
    names = [c.strip().split()[0] for c in schemas.RAW_POSITION.split(",")]
    row = dict(zip(names, RAW_POSITION, strict=True)) | changed
    raw = spark.createDataFrame([tuple(row[n] for n in names)], schemas.RAW_POSITION)
    found = clean.position_reports(raw, nations, lookups.nav_status(spark)).collect()
    return found[0] if found else None


@pytest.fixture(scope="module")
def nations(spark):
    return spark.createDataFrame([(201, "Low", "LO"), (235, "Mid", "MI"), (755, "High", "HI")], lookups.COUNTRY_SCHEMA)


def test_position_sentinels(spark, nations):
    r = position(spark, nations)
    assert (r.country_name, r.latitude, r.longitude, r.speed_over_ground, r.course_over_ground, r.true_heading) == ("Mid", 90.9, 180.9, 102.2, 359.9, 510)
    assert (r.rate_of_turn, r.nav_status_desc, r.position_accuracy, r.special_manoeuvre_indicator) == (None, None, decode.COARSE, "Unknown")
    assert r.recorded_time == dt.datetime(2024, 1, 1, 0, 0, 1, 123456)
    r = position(spark, nations, cog=360.0, latitude=91.0, longitude=181.0, sog=102.3, true_heading=511, position_accuracy=True, special_manoeuvre_indicator=2, navigational_status=0)
    assert (r.latitude, r.longitude, r.speed_over_ground, r.course_over_ground, r.true_heading) == (None,) * 5
    assert (r.position_accuracy, r.special_manoeuvre_indicator, r.nav_status_desc) == (decode.ACCURATE, decode.MANOEUVRE[2], lookups.NAV_STATUS[0])


@pytest.mark.parametrize(("mmsi", "country"), [(None, ""), (200_999_999, ""), (201_000_000, "Low"), (755_999_999, "High"), (756_000_000, "")])
def test_ship_identity_bounds(spark, nations, mmsi, country):
    r = position(spark, nations, mmsi=mmsi)
    assert (r.country_name if r else "") == country


@pytest.mark.parametrize(("mmsi", "message", "there"), [(None, 4, 0), (2_009_999, 4, 0), (2_010_000, 4, 1), (7_559_999, 4, 1), (7_560_000, 4, 0), (2_010_000, 11, 0)])
def test_station_bounds(spark, nations, mmsi, message, there):
    row = (mmsi, "B", "2024-01-01 00:00:00 +0000 UTC", 0, 1, 91.0, True, 181.0, message, False, True, 0, 1, 1, 0, 0, 1, 0, 2024, True)
    got = clean.station_reports(spark.createDataFrame([row], schemas.RAW_STATION), nations, lookups.fix_types(spark)).collect()
    assert len(got) == there and all((r.latitude, r.longitude, r.fix_type_desc) == (91.0, 181.0, "GPS") for r in got)


def static(spark, nations, **changed):
    row = {"mmsi": 235_000_001, "ship_name": "S", "time_utc": "2024-12-31 00:00:00 +0000 UTC", "ais_version": 1, "call_sign": "C", "destination": "D", "dimension": (1, 2, 3, 4), "dte": None}
    row |= {"eta": (2, 3, 4, 1), "fix_type": 1, "imo_number": 7, "maximum_static_draught": 1.5, "message_id": 5, "name": "S", "repeat_indicator": 0, "type": 0, "user_id": 1, "valid": True} | changed
    raw = spark.createDataFrame([tuple(row.values())], schemas.RAW_STATIC)
    return clean.ship_statics(raw, nations, lookups.fix_types(spark), lookups.ship_types(spark)).first()


def test_static_sentinels(spark, nations):
    r = static(spark, nations)
    assert (r.call_sign, r.destination, tuple(r.dimension), r.imo_number, r.maximum_static_draught, r.dte) == ("C", "D", (1, 2, 3, 4), 7, 1.5, "Available")
    assert r.eta == dt.datetime(2024, 1, 2, 3, 4) and r.ship_type_description is None and r.fix_type_description == "GPS"
    r = static(spark, nations, call_sign="@" * 7, destination="@" * 20, dimension=(0, 0, 0, 0), dte=True, eta=(0, 24, 60, 0), imo_number=0, maximum_static_draught=0.0, type=99)
    assert (r.call_sign, r.destination, r.dimension, r.imo_number, r.maximum_static_draught, r.dte, r.eta) == (None, None, None, None, None, "Not Available", None)
    assert r.ship_type_description == "Other types of ship, no additional information"
    r = static(spark, nations, call_sign="@" * 6, dimension=(0, 0, 1, 0), eta=(30, 0, 0, 2))
    assert (r.call_sign, tuple(r.dimension), r.eta) == ("@" * 6, (0, 0, 1, 0), None)
    assert static(spark, nations, dimension=None, eta=(1, 1, 1, 13)).eta is None


def test_dictionaries(spark):
    assert [lookups.nav_status(spark).count(), lookups.fix_types(spark).count(), lookups.ship_types(spark).count()] == [16, 16, 99]
    names = dict(map(tuple, lookups.ship_types(spark).collect()))
    assert names[30] == "Fishing vessel" and names[61].startswith("Passenger ships, carrying DG and/or MHB, HS, or MP cargo,") and names[99].endswith("no additional information")


def test_countries_come_from_a_file(spark, tmp_path):
    (tmp_path / "mid.csv").write_text("mid_code,country_name,country_code\n232,Somewhere,SW\n")
    assert [tuple(r) for r in lookups.countries(spark, str(tmp_path / "mid.csv")).collect()] == [(232, "Somewhere", "SW")]


def test_raw_messages_are_split(spark, tmp_path):
    good = {"MessageType": "PositionReport", "MetaData": {"MMSI": 1, "ShipName": "A", "time_utc": "t"}, "Message": {"PositionReport": {"Cog": 1.5, "Sog": "x"}}}
    other = good | {"MessageType": "ShipStaticData"}
    lines = [json.dumps(good), json.dumps(other), "no json", json.dumps({"error": "limit"}), json.dumps(good | {"Message": {"PositionReport": None}})]
    (tmp_path / "raw.txt").write_text("\n".join(lines))
    raw = readers.envelope_lines(spark, str(tmp_path))
    got = demux.positions(raw).collect()
    assert [(r.mmsi, r.cog, r.sog) for r in got] == [(1, 1.5, None)]
    assert demux.statics(raw).count() == 0 and demux.stations(raw).count() == 0


def test_missing_variable_is_an_error():
    assert config.fill("a {X_1} b", {"X_1": "v"}) == "a v b"
    with pytest.raises(ValueError):
        config.fill("{MISSING}", {})


def test_distance_is_never_nan(spark):
    rows = [(x / 7, y / 3) for x in range(-200, 200, 13) for y in range(-300, 300, 17)]
    d = spark.createDataFrame(rows, "a double, o double").select(geo.distance_km(F.col("a"), F.col("o"), F.col("a"), F.col("o")).alias("d"))
    assert d.where("isnan(d) or d > 0.01").count() == 0
    assert values(spark, "a double, o double", [(None, 1.0)], geo.distance_km(F.col("a"), F.col("o"), F.lit(1.0), F.lit(1.0))) == [(None,)]


def test_geohash_vectors(spark):
    rows = [(57.64911, 10.40744), (42.605, -5.603), (-25.382708, -49.265506)]
    assert [r[0] for r in values(spark, "a double, o double", rows, geo.geohash(F.col("a"), F.col("o")))] == ["u4pru", "ezs42", "6gkzw"]


PING = "mmsi bigint, recorded_time timestamp, latitude double, longitude double, speed_over_ground double"


def segment(spark, rows, known=None):
    pings = spark.createDataFrame([(m, at(t), *rest) for m, t, *rest in rows], PING)
    return {(r.mmsi, (r.recorded_time - T0.replace(tzinfo=None)).total_seconds() / 60): r.trip_id for r in trips.segment(pings, known if known is not None else trips.no_state(spark)).collect()}


def test_trip_rules(spark):
    steps = [
        (0, 10.0, 10.0, 0.5, 1),
        (1, 10.0, 10.0, 0.51, 1),
        (2, 10.0, 10.0, 1.5, 1),
        (3, 10.0, 10.0, 1.51, 2),
        (4, 10.0, 10.0, 0.51, 2),
        (5, 10.0, 10.0, 0.5, 3),
        (5 + 239, 10.0, 10.0, 0.5, 3),
        (5 + 239 + 240, 10.0, 10.0, 0.5, 4),
        (500, 10.44, 10.0, 0.5, 4),
        (501, 10.9, 10.0, 0.5, 5),
        (502, None, 10.0, 0.5, 5),
        (503, 10.9, 10.0, 0.5, 6),
        (504, 10.9, 10.0, None, 6),
        (505, 10.9, 10.0, 0.5, 7),
    ]
    got = segment(spark, [(1, t, a, o, s) for t, a, o, s, _ in steps])
    assert [got[(1, t)] for t, *_ in steps] == [x[-1] for x in steps]


def test_tied_pings_share_a_trip(spark):
    rows = spark.createDataFrame([(1, at(0), 10.0, 10.0, 0.1), (1, at(1), 10.0, 10.0, 2.0), (1, at(1), 10.0, 10.0, 0.1)], PING)
    got = [r.trip_id for r in trips.segment(rows, trips.no_state(spark)).orderBy("recorded_time").collect()]
    assert got[1] == got[2]


def known_state(spark, minutes, speed=1.0, trip=7):
    row = (1, trip, at(0), at(minutes), 10.0, 10.0, 10.0, 10.0, speed, None, 1.0, 2.0, 3.0, 4)
    return spark.createDataFrame([row], schemas.STATE)


def test_state_bounds_new_pings(spark):
    rows = [(1, 9, 10.0, 10.0, 2.0), (1, 10, 10.0, 10.0, 2.0), (1, 11, 10.0, 10.0, 2.0), (2, 1, 10.0, 10.0, 1.0)]
    assert segment(spark, rows, known_state(spark, 10)) == {(1, 11.0): 7, (2, 1.0): 1}


def test_open_trip_is_merged(spark):
    pings = spark.createDataFrame([(1, at(20), 10.1, 10.0, 2.0, 7), (1, at(30), 10.1, 10.0, None, 7)], PING + ", trip_id bigint")
    r = trips.trips(pings, known_state(spark, 10)).first()
    seam = 6371 * math.radians(0.1)
    assert (r.trip_start_time, r.ping_count, r.start_latitude, r.max_speed_over_ground) == (T0.replace(tzinfo=None), 6, 10.0, 3.0)
    assert math.isclose(r.total_distance_km, 2.0 + seam, abs_tol=1e-3) and math.isclose(r.average_speed_over_ground, (2.0 * 2 + 1.0 * 4) / 6)
    assert float(r.trip_duration_hours) == 0.5
    none = spark.createDataFrame([(1, at(20), 10.1, 10.0, None, 7)], PING + ", trip_id bigint")
    r = trips.trips(none, known_state(spark, 10)).first()
    assert r.max_speed_over_ground is None and r.average_speed_over_ground is None


def _static_rows(spark, rows):
    """(mmsi, minutes, call_sign, draught)"""
    base = {"imo_number": 1, "ship_name": "S", "country_name": "C", "ship_type_code": 1, "ship_type_description": "t", "dimension": (1, 2, 3, 4), "destination": "D", "eta": at(0)}
    base |= {"fix_type_code": 1, "fix_type_description": "f", "ais_version": 1, "dte": "x", "valid": True, "repeat_indicator": 0, "message_id": 5}
    names = [f.name for f in spark.createDataFrame([], schemas.LANDING_STATIC).schema.fields]
    out = [base | {"mmsi": m, "recorded_time": at(t), "call_sign": c, "maximum_static_draught": d} for m, t, c, d in rows]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in out], schemas.LANDING_STATIC)


def test_versions_and_interval_join(spark):
    change = scd.changes(_static_rows(spark, [(1, 0, "A", 1.0), (1, 5, "A", 2.0), (1, 10, None, 1.0), (1, 20, None, 1.0), (1, 30, "B", 1.0), (2, 0, "Z", 1.0)]))
    version = scd.versions(change)
    assert [(r.call_sign, r.valid_to is None) for r in version.where("mmsi = 1").orderBy("valid_from").collect()] == [("A", False), (None, False), ("B", True)]
    pings = spark.createDataFrame([(1, at(t)) for t in (-1, 0, 9, 10, 30, 99)], "mmsi bigint, recorded_time timestamp")
    got = scd.join_version(pings, version, "recorded_time").orderBy("recorded_time").select(F.col("v").isNull(), "v.call_sign").collect()
    assert [tuple(r) for r in got] == [(True, None), (False, "A"), (False, "A"), (False, None), (False, "B"), (False, "B")]


def test_dimensions(spark):
    d, t = dims.dates(spark), dims.times(spark)
    assert (d.count(), t.count()) == (4018, 86400)
    assert tuple(d.where("date_id = 20240106").first()) == (20240106, 2024, 1, 6, 1, True)
    assert tuple(t.where("time_id = 60500").first()) == (60500, 6, 5, 0, "Morning")


def test_port_elements(spark):
    p = lambda *pts: [{"lat": a, "lon": o} for a, o in pts]
    rows = [
        (1, "way", 5, {"name": "Own"}, p((1.0, 2.0), (3.0, 4.0)), None),
        (0, "relation", 9, {"name": "Große Bucht"}, None, [("way", 5, p((1.0, 2.0), (3.0, 5.0), (1.0, 2.0))), ("node", 6, p((0.0, 0.0))), ("way", 7, None), ("way", 8, [])]),
        (1, "way", 7, None, p((0.5, -0.5),), None),
    ]
    got = {r.port_id: r for r in ports.flatten(spark.createDataFrame(rows, schemas.ELEMENTS)).collect()}
    assert set(got) == {"way_5", "way_7"} and got["way_5"].name == "Große Bucht" and got["way_7"].name == ""
    raw = spark.createDataFrame([("a", "Große", "[[2.0,1.0],[5.0,3.0]]"), ("b", "x", "[]"), ("c", "x", "{bad"), ("d", "y", "[[1.0,1.0],[2.0,2.0],[1.0,1.0]]")], "port_id string, name string, geometry_json string")
    out = {r.port_id: r for r in ports.enrich(raw).collect()}
    assert set(out) == {"a", "d"} and out["a"].name == "Groe" and (out["a"].min_lat, out["a"].max_lon) == (1.0, 5.0)
    assert len(json.loads(out["a"].geometry_json)["coordinates"][0]) == 3 == len(json.loads(out["d"].geometry_json)["coordinates"][0])


def test_port_files(spark, tmp_path):
    raw = spark.createDataFrame([("a", 'n "q", x', "[[2.0,1.0],[5.0,3.0]]")], "port_id string, name string, geometry_json string")
    ports.write_csv(raw, str(tmp_path / "p"))
    assert ports.read_csv(spark, str(tmp_path / "p")).collect() == raw.collect()


def test_live_search_and_expiry(spark):
    rows = spark.createDataFrame([(1, at(0), "Alpha", 5.0), (1, at(1), "Alpha", 6.0), (2, at(0), "beta", 5.0)], "mmsi bigint, recorded_time timestamp, ship_name string, latitude double")
    assert sorted((r.mmsi, r.latitude) for r in live.latest_by_key(rows).collect()) == [(1, 6.0), (2, 5.0)]
    assert [r.mmsi for r in live.latest_by_key(rows, F.lit(at(360.5))).collect()] == [1]
    assert live.search(rows, {"latitude": (5, 5)}, {"mmsi": 2}, {"ship_name": "BET"}).count() == 1


# --- sinks and the incremental run -----------------------------------------------------------------


def test_table_sinks(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "k bigint, at timestamp, v int", "at")
    assert t.read().count() == 0 and not t.exists()
    rows = lambda *r: spark.createDataFrame(r, "k bigint, at timestamp, v int")
    t.append(rows((1, at(0), 1), (2, at(2000), 1)), "run1")
    t.append(rows((3, at(0), 1)), "run2")
    t.append(rows((3, at(0), 9)), "run2")
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, 1), (2, 1), (3, 9)]
    t.upsert(rows((2, at(1), 5), (4, at(1), 5)), ["k"])
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, 1), (2, 5), (3, 9), (4, 5)]
    with pytest.raises(ValueError):
        t.upsert(rows((2, at(1), 5), (2, at(2), 6)), ["k"])
    t.upsert(rows((2, at(1), 5), (2, at(2), 6)), ["k"], [F.col("at").desc()])
    assert t.read().where("k = 2").first().v == 6


def landing(spark, pings):
    names = [f.name for f in spark.createDataFrame([], schemas.LANDING_POSITION).schema.fields]
    base = dict.fromkeys(names)
    return spark.createDataFrame([tuple((base | p)[n] for n in names) for p in pings], schemas.LANDING_POSITION)


def _pings(seed: int, n: int):
    import random

    r = random.Random(seed)
    t, out = {1: 0.0, 2: 0.0}, []
    for _ in range(n):
        m = r.choice((1, 2))
        t[m] += r.choice((1, 5, 300))
        out.append({"mmsi": m, "recorded_time": at(t[m]), "latitude": 10 + r.random(), "longitude": 10.0, "speed_over_ground": r.choice((0.1, 1.0, 2.0))})
    return sorted(out, key=lambda p: p["recorded_time"])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 1000), st.integers(1, 39))
def test_splitting_a_stream_changes_no_trip(spark, seed, cut):
    pings = _pings(seed, 40)
    whole = trips.segment(landing(spark, pings), trips.no_state(spark))
    want = trips.trips(whole, trips.no_state(spark)).collect()
    bound = pings[cut]["recorded_time"]
    first, rest = [p for p in pings if p["recorded_time"] < bound], [p for p in pings if p["recorded_time"] >= bound]
    none = trips.no_state(spark)
    facts = {}
    a = trips.segment(landing(spark, first), none) if first else None
    known = none
    if a is not None:
        old = trips.trips(a, none)
        facts |= {(r.mmsi, r.trip_id): r for r in old.collect()}
        known = state.latest(a, old)
    facts |= {(r.mmsi, r.trip_id): r for r in trips.trips(trips.segment(landing(spark, rest), known), known).collect()}
    assert set(facts) == {(r.mmsi, r.trip_id) for r in want}
    for r in want:
        x = facts[(r.mmsi, r.trip_id)]
        assert (x.trip_start_time, x.trip_end_time, x.ping_count, x.trip_duration_hours) == (r.trip_start_time, r.trip_end_time, r.ping_count, r.trip_duration_hours)
        assert math.isclose(x.total_distance_km, r.total_distance_km, abs_tol=1e-6) and math.isclose(x.average_speed_over_ground, r.average_speed_over_ground)


def test_incremental_run(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    pings = _pings(3, 60)
    half = pings[30]["recorded_time"]
    stat = _static_rows(spark, [(1, 0, "A", 1.0), (1, 100, "B", 1.0), (2, 50, "C", 1.0)])
    stations = spark.createDataFrame([], schemas.LANDING_STATION)
    early = landing(spark, [p for p in pings if p["recorded_time"] < half])
    run_batch(w, early, stat, stations, "r1")
    first = sorted(map(str, w.fact_ship_trips.read().collect()))
    run_batch(w, early, stat, stations, "r1")
    assert sorted(map(str, w.fact_ship_trips.read().collect())) == first
    run_batch(w, landing(spark, pings), stat, stations, "r2")
    assert w.fact_position_reports.read().count() == 60 == w.mart_position_pings.read().count()
    want = {(r.mmsi, r.trip_id): r.ping_count for r in trips.rollup(trips.segment(landing(spark, pings), trips.no_state(spark))).collect()}
    assert {(r.mmsi, r.trip_id): r.ping_count for r in w.fact_ship_trips.read().collect()} == want
    assert {(r.mmsi, r.trip_id) for r in w.mart_trips.read().collect()} == set(want)
    assert w.ship_latest_state.read().count() == 2 and w.ship_metadata_change.read().count() == 3
    run_batch(w, landing(spark, pings), stat, stations, "r3", full_refresh=True)
    assert {(r.mmsi, r.trip_id): r.ping_count for r in w.fact_ship_trips.read().collect()} == want
