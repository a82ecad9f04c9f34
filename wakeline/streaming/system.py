"""The nine standing jobs, started in order, resumed from their newest checkpoints, and stopped in good order.

Topics are folders of JSON lines under one root, so that the whole system runs wherever a file system is
shared; ``wakeline.sources.readers.kafka`` and ``jobs.to_kafka`` take their place where brokers are.
A job's checkpoints lie in ``checkpoints/<job>/<start>``: a resumed job goes on in the newest of them, one
that is started afresh gets another. Stopping waits until the batch in hand is done.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline import schemas
from wakeline.operators import clean, demux, live
from wakeline.plans.materialize import Files
from wakeline.sources import lookups, readers
from wakeline.streaming import asof

Start = Callable[[SparkSession, str], DataFrame]
#: Default seconds between checkpoints: a micro-batch is what a job commits at once.
INTERVAL = 10
#: Seconds after which the dictionaries are read again.
REFRESH = 3600


@dataclass(frozen=True)
class Job:
    """A job: its rows as a stream, and what each batch of them does."""

    name: str
    rows: Callable[[], DataFrame]
    write: Callable[[DataFrame, int], None]


class Refreshed:
    """Dictionaries for the batches of a stream, read again when older than ``seconds``."""

    def __init__(self, load: Callable[[], dict[str, DataFrame]], seconds: float = REFRESH, clock: Callable[[], float] = time.monotonic):
        self.load, self.seconds, self.clock = load, seconds, clock
        self.at: float | None = None

    def get(self) -> dict[str, DataFrame]:
        if self.at is None or self.clock() - self.at >= self.seconds:
            self.tables, self.at = self.load(), self.clock()
        return self.tables


def latest_checkpoint(files: Files, job: str) -> str | None:
    """The newest checkpoint folder of a job by its time of change, None if it has none."""
    folder = files.at(f"checkpoints/{job}")
    if not files.fs.exists(folder):
        return None
    found = [(s.getModificationTime(), s.getPath().getName()) for s in files.fs.listStatus(folder) if s.isDirectory()]
    return f"{files.path}/checkpoints/{job}/{max(found)[1]}" if found else None


class System:
    """Jobs in their order of submission."""

    def __init__(self, spark: SparkSession, root: str, jobs: list[Job], interval: float = INTERVAL):
        self.spark, self.jobs, self.interval = spark, jobs, interval
        self.files = Files(spark, root)
        self.running: dict[str, StreamingQuery] = {}

    def start(self, resume: bool = True, once: bool = False, names: list[str] | None = None) -> None:
        """Submit the jobs one after the other. once: each ends when it has taken all there is."""
        for job in self.jobs:
            if names is not None and job.name not in names:
                continue
            at = latest_checkpoint(self.files, job.name) if resume else None
            at = at or f"{self.files.path}/checkpoints/{job.name}/start-{time.time_ns()}"
            writer = job.rows().writeStream.queryName(job.name).option("checkpointLocation", at).foreachBatch(job.write)
            writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{self.interval} seconds")
            self.running[job.name] = writer.start()
            if once:
                self.running[job.name].awaitTermination()

    def stop(self, names: list[str] | None = None, patience: float = 600) -> None:
        """Stop jobs in the order of submission, each once its batch in hand is committed."""
        for name in [j.name for j in self.jobs if names is None or j.name in names]:
            query = self.running.pop(name, None)
            if query is None:
                continue
            until = time.monotonic() + patience
            while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
                time.sleep(0.05)
            query.stop()

    def wait(self, poll: float = 10) -> None:
        """Until no job is active; the error of a failed one is raised."""
        while active := [q for q in self.running.values() if q.isActive]:
            active[0].awaitTermination(poll)
        for query in self.running.values():
            if query.exception():
                raise query.exception()


def topic_of(files: Files, name: str) -> str:
    return f"{files.path}/topics/{name}"


def publish(rows: DataFrame, path: str, number: int) -> None:
    """A batch of keyed messages; a batch that is repeated replaces itself."""
    message = rows.select(F.to_json(F.struct("mmsi")).alias("key"), F.to_json(F.struct("*"), asof.TIMES).alias("value"))
    message.write.mode("overwrite").json(f"{path}/batch={number:012d}")


def subscribe(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Messages of a topic with a declared schema; a malformed one fails the job."""
    spark.createDataFrame([], "key string, value string").write.mode("append").json(path)
    lines = spark.readStream.schema("key string, value string").option("recursiveFileLookup", True).json(path)
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"} | asof.TIMES).alias("m")).select("m.*")


def land(rows: DataFrame, path: str, number: int) -> None:
    """A batch in a landing table by days; a batch that is repeated replaces itself."""
    rows.withColumn("event_date", F.to_date("recorded_time")).write.mode("overwrite").partitionBy("event_date").option("compression", "zstd").parquet(f"{path}/batch={number:012d}")


def landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, event_date date").parquet(path).drop("batch")


def standing_jobs(spark: SparkSession, root: str, load: Callable[[], dict[str, DataFrame]], refresh: float = REFRESH) -> list[Job]:
    """The splitter, three cleaners, three landing writers and two presentations, over topics under ``root``.

    ``load`` gives the dictionaries ``countries``, ``nav_status``, ``fix_types`` and ``ship_types``.
    """
    files, tables = Files(spark, root), Refreshed(load, refresh)
    topic = lambda name: topic_of(files, name)

    def split(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for kind, take in (("position", demux.positions), ("static", demux.statics), ("station", demux.stations)):
                publish(take(batch), topic(f"raw_{kind}"), number)
        finally:
            batch.unpersist()

    def raw() -> DataFrame:
        return readers.envelope_lines(spark, topic("envelopes"), stream=True)

    cleaners = {
        "position": (schemas.RAW_POSITION, lambda df, t: clean.position_reports(df, t["countries"], t["nav_status"])),
        "static": (schemas.RAW_STATIC, lambda df, t: clean.ship_statics(df, t["countries"], t["fix_types"], t["ship_types"])),
        "station": (schemas.RAW_STATION, lambda df, t: clean.station_reports(df, t["countries"], t["fix_types"])),
    }
    cleaned = {"position": schemas.LANDING_POSITION, "static": schemas.LANDING_STATIC, "station": schemas.LANDING_STATION}
    jobs = [Job("stream_separator", raw, split)]
    for kind, (schema, make) in cleaners.items():
        rows = lambda kind=kind, schema=schema: subscribe(spark, topic(f"raw_{kind}"), schema)
        jobs.append(Job(f"clean_{kind}", rows, lambda b, n, kind=kind, make=make: publish(make(b, tables.get()), topic(f"clean_{kind}"), n)))
    for kind, schema in cleaned.items():
        rows = lambda kind=kind, schema=schema: subscribe(spark, topic(f"clean_{kind}"), schema)
        jobs.append(Job(f"ingest_{kind}", rows, lambda b, n, kind=kind: land(b, f"{files.path}/landing/{kind}", n)))
    pings = lambda: asof.as_of(subscribe(spark, topic("clean_position"), cleaned["position"]), subscribe(spark, topic("clean_static"), cleaned["static"]))
    jobs.append(Job("live_ships", pings, lambda b, n: publish(b, topic("live_ships"), n)))
    reports = lambda: live.live_stations(subscribe(spark, topic("clean_station"), cleaned["station"]))
    jobs.append(Job("live_stations", reports, lambda b, n: publish(b, topic("live_stations"), n)))
    return jobs


def dictionaries(spark: SparkSession, countries: DataFrame) -> dict[str, DataFrame]:
    return {"countries": countries, "nav_status": lookups.nav_status(spark), "fix_types": lookups.fix_types(spark), "ship_types": lookups.ship_types(spark)}


def retain(spark: SparkSession, path: str, seconds: float, compact: bool = False, now: float | None = None) -> list[str]:
    """Retention of a topic: batches older than ``seconds`` go. compact: the last message of every key in them is kept.

    Batches that a consumer has not read yet must be younger than ``seconds``, as on any topic of bounded age.
    """
    files = Files(spark, path)
    limit = ((time.time() if now is None else now) - seconds) * 1000
    if not files.fs.exists(files.at(".")):
        return []
    old = [s.getPath().getName() for s in files.fs.listStatus(files.at(".")) if s.isDirectory() and s.getPath().getName().startswith("batch=") and s.getModificationTime() < limit]
    old.sort()
    if compact and old:
        schema = "key string, value string, batch long"
        everything = spark.read.schema(schema).option("basePath", path).json([f"{path}/{n}" for n in files.names() if n.startswith("batch=")])
        last = everything.groupBy("key").agg(F.max_by("value", "batch").alias("value"), F.max("batch").alias("batch"))
        kept = last.where(F.col("batch") <= int(old[-1].partition("=")[2])).select("key", "value")
        kept.write.mode("overwrite").json(f"{path}/_compacted")
        files.drop(old[-1])
        files.fs.rename(files.at("_compacted"), files.at(old[-1]))
        old.pop()
    for name in old:
        files.drop(name)
    return old
