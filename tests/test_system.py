"""Runs that die anywhere and are repeated, the standing jobs, stopping and resuming, retention."""

from __future__ import annotations

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.operators import live, marts, ports, scd
from wakeline.plans import batch
from wakeline.plans.batch import Warehouse, run_batch
from wakeline.plans.materialize import Files, Table
from wakeline.sources import lookups
from wakeline.streaming import jobs, system

from .test_operators import _pings, _static_rows, at, landing


class Died(Exception):
    pass


def contents(w: Warehouse) -> dict:
    return {k: sorted(map(str, t.read().collect())) for k, t in w.all().items()}


def test_a_run_that_dies_anywhere_counts_as_none(spark, tmp_path, monkeypatch):
    """The second of two runs is killed after every version it publishes, then repeated."""
    pings = _pings(3, 24)
    half = pings[12]["recorded_time"]
    stat = _static_rows(spark, [(1, 0, "A", 1.0), (1, 100, "B", 1.0), (2, 50, "C", 1.0)])
    stations = spark.createDataFrame([], schemas.LANDING_STATION)
    early, late = landing(spark, [p for p in pings if p["recorded_time"] < half]), landing(spark, pings)
    want = Warehouse(spark, f"{tmp_path}/want")
    run_batch(want, early, stat, stations, "r1")
    run_batch(want, late, stat, stations, "r2")
    want = contents(want)
    w = Warehouse(spark, f"{tmp_path}/w")
    run_batch(w, early, stat, stations, "r1")
    publish, steps = Table._publish, len(w.all())
    for last in range(1, steps + 1):
        count = 0

        def dying(self, parts):
            nonlocal count
            publish(self, parts)
            count += 1
            if count == last:  # noqa: B023
                raise Died

        monkeypatch.setattr(Table, "_publish", dying)
        with pytest.raises(Died):
            run_batch(w, late, stat, stations, "r2")
    monkeypatch.setattr(Table, "_publish", publish)
    run_batch(w, late, stat, stations, "r2")
    assert contents(w) == want
    run_batch(w, late, stat, stations, "r2")
    assert contents(w) == want
    # A run that ended but whose note was left behind is not undone.
    Files(spark, f"{tmp_path}/w/_runs").put("_open", json.dumps({"run": "r2", "versions": dict.fromkeys(w.all())}))
    run_batch(w, late, stat, stations, "r2")
    assert contents(w) == want


def test_first_run_that_died_starts_without_state(spark, tmp_path, monkeypatch):
    pings = landing(spark, _pings(5, 10))
    stat, stations = _static_rows(spark, [(1, 0, "A", 1.0)]), spark.createDataFrame([], schemas.LANDING_STATION)
    w = Warehouse(spark, f"{tmp_path}/w")
    monkeypatch.setattr(batch.Files, "put", lambda self, name, text, put=Files.put: (_ for _ in ()).throw(Died()) if name == "r1" else put(self, name, text))
    with pytest.raises(Died):
        run_batch(w, pings, stat, stations, "r1")
    monkeypatch.undo()
    run_batch(w, pings, stat, stations, "r1")
    assert w.fact_position_reports.read().count() == 10


def test_upsert_writes_only_the_days_it_touches(spark, tmp_path):
    t = Table(spark, f"{tmp_path}/t", "k bigint, at timestamp, v int", "at")
    rows = lambda *r: spark.createDataFrame(r, "k bigint, at timestamp, v int")
    t.rebuild(rows((1, at(0), 1), (2, at(3000), 1), (3, at(6000), 1), (4, None, 1)))
    before = set(t.parts())
    t.upsert(rows((2, at(6000), 5)), ["k"])
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, 1), (2, 5), (3, 1), (4, 1)]
    assert len(before & set(t.parts())) == 2
    assert sorted(r.k for r in t.read(at(6000).date()).collect()) == [2, 3, 4]
    t.upsert(rows((4, at(0), 7)), ["k"])
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, 1), (2, 5), (3, 1), (4, 7)]
    t.restore(0)
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, 1), (2, 1), (3, 1), (4, 1)]
    t.vacuum(1)
    assert t.read().count() == 4 and len([n for n in t.files.names() if not n.startswith("_")]) == 1


def envelopes(n: int, start: int = 0) -> list[dict]:
    out = []
    for i in range(start, start + n):
        when = (datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=60 * i)).strftime("%Y-%m-%d %H:%M:%S.%f") + "000 +0000 UTC"
        ship, station = 235_000_001 + i % 2, 2_350_001
        meta = lambda mmsi, when=when: {"MMSI": mmsi, "ShipName": "S", "latitude": 1.0, "longitude": 2.0, "time_utc": when}
        out.append({"MessageType": "PositionReport", "MetaData": meta(ship), "Message": {"PositionReport": {"Latitude": 1.0, "Longitude": 2.0, "Sog": 3.0, "Cog": 4.0, "NavigationalStatus": 0, "TrueHeading": 5, "RateOfTurn": 0, "Valid": True, "PositionAccuracy": True, "Raim": False, "RepeatIndicator": 0, "CommunicationState": 0, "SpecialManoeuvreIndicator": 0, "MessageID": 1}}})
        if i % 4 == 0:
            out.append({"MessageType": "ShipStaticData", "MetaData": meta(ship), "Message": {"ShipStaticData": {"CallSign": f"C{i}", "Destination": "X", "Dimension": {"A": 1, "B": 2, "C": 3, "D": 4}, "Type": 70, "FixType": 1, "ImoNumber": 7, "Valid": True, "Name": "S", "MessageID": 5, "Dte": True, "MaximumStaticDraught": 1.0, "AisVersion": 1, "RepeatIndicator": 0}}})
        if i % 5 == 0:
            out.append({"MessageType": "BaseStationReport", "MetaData": meta(station), "Message": {"BaseStationReport": {"FixType": 1, "Latitude": 1.0, "Longitude": 2.0, "Valid": True, "MessageID": 4, "PositionAccuracy": True, "Raim": False, "RepeatIndicator": 0, "CommunicationState": 0, "LongRangeEnable": False}}})
    return out


def feed(files: Files, name: str, messages: list) -> None:
    files.put(f"topics/envelopes/{name}", "\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages) + "\n")


def test_nine_jobs_stop_and_resume(spark, tmp_path):
    countries = spark.createDataFrame([(235, "Mid", "MI")], lookups.COUNTRY_SCHEMA)
    root, loads = f"{tmp_path}/system", []
    load = lambda: loads.append(1) or system.dictionaries(spark, countries)
    files = Files(spark, root)
    feed(files, "a.json", [*envelopes(12), {"error": "x"}, "no json"])
    s = system.System(spark, root, system.standing_jobs(spark, root, load))
    assert [j.name for j in s.jobs] == ["stream_separator", "clean_position", "clean_static", "clean_station", "ingest_position", "ingest_static", "ingest_station", "live_ships", "live_stations"]
    s.start(once=True)
    s.wait()
    landed = lambda: system.landed(spark, f"{root}/landing/position", schemas.LANDING_POSITION)
    assert landed().count() == 12 and landed().select("country_name").distinct().first()[0] == "Mid"
    assert len(loads) == 1
    # New messages: every job goes on in its newest checkpoint and takes nothing twice.
    feed(files, "b.json", envelopes(6, 12))
    again = system.System(spark, root, system.standing_jobs(spark, root, load))
    again.start(once=True)
    assert landed().count() == 18 == landed().select("recorded_time").distinct().count()
    assert system.landed(spark, f"{root}/landing/static", schemas.LANDING_STATIC).count() == 5
    assert system.landed(spark, f"{root}/landing/station", schemas.LANDING_STATION).count() == 4
    topic = lambda name: [json.loads(r.value) for r in spark.read.option("recursiveFileLookup", True).schema("key string, value string").json(f"{root}/topics/{name}").collect()]
    assert len(topic("live_stations")) == 4 and "longtitude" in topic("live_stations")[0]
    ships = topic("live_ships")
    assert 0 < len(ships) <= 18 and len({x["recorded_time"] for x in ships}) == len(ships)
    assert all(system.latest_checkpoint(files, j.name) for j in s.jobs)


def test_running_job_stops_between_batches(spark, tmp_path):
    root = f"{tmp_path}/one"
    files = Files(spark, root)
    feed(files, "a.json", envelopes(5))
    made = system.standing_jobs(spark, root, lambda: system.dictionaries(spark, spark.createDataFrame([], lookups.COUNTRY_SCHEMA)))[:1]
    s = system.System(spark, root, made, interval=0.1)
    s.start()
    until = time.time() + 60
    while time.time() < until and not Files(spark, f"{root}/topics/raw_position").names():
        time.sleep(0.2)
    s.stop()
    s.wait()
    assert not s.running
    first = system.latest_checkpoint(files, "stream_separator")
    feed(files, "b.json", envelopes(3, 5))
    s.start(once=True)
    assert system.latest_checkpoint(files, "stream_separator") == first
    assert spark.read.option("recursiveFileLookup", True).json(f"{root}/topics/raw_position").count() == 8
    s.start(resume=False, once=True)
    assert system.latest_checkpoint(files, "stream_separator") != first


def test_failed_job_raises(spark, tmp_path):
    def fail(_rows, _number):
        raise ValueError("bad batch")

    spark.range(3).write.json(f"{tmp_path}/in")
    s = system.System(spark, f"{tmp_path}/s", [system.Job("bad", lambda: spark.readStream.schema("id long").json(f"{tmp_path}/in"), fail)], interval=0.1)
    s.start()
    with pytest.raises(Exception, match="bad batch"):
        s.wait(0.2)


def test_dictionaries_are_read_again():
    now, seen = [0.0], []
    r = system.Refreshed(lambda: seen.append(now[0]) or {}, 10, lambda: now[0])
    for t in (0, 5, 9.9, 10, 15, 20):
        now[0] = t
        r.get()
    assert seen == [0, 10, 20]


def test_retention_and_compaction(spark, tmp_path):
    path = f"{tmp_path}/topic"
    for n in range(3):
        system.publish(spark.createDataFrame([(1, n), (10 + n, n)], "mmsi long, v int"), path, n)
    now = time.time()
    assert system.retain(spark, path, 3600, now=now) == []
    read = lambda: sorted((r.key, json.loads(r.value)["v"]) for r in spark.read.option("recursiveFileLookup", True).json(path).collect())
    system.retain(spark, path, 3600, compact=True, now=now + 7200)
    assert read() == sorted([('{"mmsi":1}', 2), ('{"mmsi":10}', 0), ('{"mmsi":11}', 1), ('{"mmsi":12}', 2)])
    system.retain(spark, path, 3600, now=now + 7200)
    assert Files(spark, path).names() == [] or not [n for n in Files(spark, path).names() if n.startswith("batch=")]


def test_streamed_landing_and_live_table(spark, tmp_path):
    rows = spark.createDataFrame([(1, at(0), 1), (1, at(9), 2), (2, at(5), 3)], "mmsi bigint, recorded_time timestamp, v int")
    source = f"{tmp_path}/in"
    rows.write.parquet(source)
    stream = lambda: spark.readStream.schema(rows.schema).parquet(source)
    jobs.ingest(stream(), f"{tmp_path}/land", f"{tmp_path}/c1", once=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/land").count() == 3
    t = Table(spark, f"{tmp_path}/live", "mmsi bigint, recorded_time timestamp, v int")
    jobs.keep_latest(stream(), t, f"{tmp_path}/c2", once=True).awaitTermination()
    spark.createDataFrame([(1, at(3), 8), (2, at(7), 9)], rows.schema).write.mode("append").parquet(source)
    jobs.keep_latest(stream(), t, f"{tmp_path}/c2", once=True).awaitTermination()
    jobs.wait(spark)
    assert sorted((r.mmsi, r.v) for r in t.read().collect()) == [(1, 2), (2, 9)]


def test_version_join_is_the_interval_join(spark):
    """Against the join by its definition: borders, gaps before the first, open ends, ties, unknown keys and times."""
    stat = _static_rows(spark, [(1, 10, "A", 1.0), (1, 20, "B", 1.0), (1, 30, "C", 1.0), (2, 15, "D", 1.0)])
    version = scd.versions(scd.changes(stat))
    left = spark.createDataFrame([(m, None if t is None else at(t), k) for k, (m, t) in enumerate([(1, 5), (1, 10), (1, 19), (1, 20), (1, 99), (2, 14), (2, 15), (3, 15), (None, 15), (1, None), (1, 20)])], "mmsi bigint, t timestamp, k int")
    got = {r.k: r.v.call_sign if r.v else None for r in scd.join_version(left, version, "t").collect()}
    plain = left.alias("l").join(version.alias("r"), (F.col("l.mmsi") == F.col("r.mmsi")) & scd.holds_at(F.col("l.t"), F.col("r.valid_from"), F.col("r.valid_to")), "left")
    assert got == {r.k: r.call_sign for r in plain.select("k", "call_sign").collect()}
    assert marts.join_version is scd.join_version


def test_port_predicates(spark):
    rows = spark.createDataFrame([({"industrial": "port"}, 1.0, 2.0), ({"landuse": "harbour"}, 1.0, 9.0), ({}, 1.0, 2.0), (None, 5.0, 2.0)], "tags map<string,string>, lat double, lon double")
    port = ports.is_port(F.col("tags"), [("industrial", "port"), ("landuse", "harbour")])
    assert [r[0] for r in rows.select(port).collect()] == [True, True, False, False]
    assert [r[0] for r in rows.select(ports.in_box(F.col("lat"), F.col("lon"), 0, 0, 2, 5)).collect()] == [True, False, True, False]


def test_search_takes_the_first_by_vessel(spark):
    rows = spark.createDataFrame([(m, at(1)) for m in (5, 3, 4)], "mmsi bigint, recorded_time timestamp").repartition(3)
    assert sorted(r.mmsi for r in live.search(rows, limit=2).collect()) == [3, 4]


@pytest.mark.parametrize(("code", "name"), [(1, "Science/Research vessel"), (36, "Sailing vessel"), (67, "Passenger (excursion) ship (i.e. harbour cruise boat, whale watcher, etc.)"), (84, "Tanker(s), carrying DG and/or MHB, HS, or MP, IMO hazard or pollutant category OS"), (99, "Other types of ship, no additional information")])
def test_ship_types_by_code(code, name):
    assert len(lookups.SHIP_TYPES) == 99 and lookups.SHIP_TYPES[code - 1] == name
