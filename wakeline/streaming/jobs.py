"""Streaming jobs: split the raw stream, write landing tables, keep the live view.

Every job takes a checkpoint folder; stopping it and starting it again resumes where it ended. The same
cleaning functions serve batches and streams, as lookups are joins with static dictionaries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline.operators import demux, live
from wakeline.plans.materialize import Table


def _start(df: DataFrame, name: str, checkpoint: str, each: Callable[[DataFrame, int], None], once: bool) -> StreamingQuery:
    writer = df.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(each)
    return (writer.trigger(availableNow=True) if once else writer).start()


def split(envelopes: DataFrame, outputs: dict[str, str], checkpoint: str, once: bool = False) -> StreamingQuery:
    """One scan of the raw stream into three tables: outputs by position, static and station.

    A batch is persisted while its three parts are written. Each part goes to a folder named after the
    batch and overwrites it, so a batch repeated after a crash adds nothing twice.
    """
    parts = {"position": demux.positions, "static": demux.statics, "station": demux.stations}

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for kind, take in parts.items():
                take(batch).repartition("mmsi").write.mode("overwrite").parquet(f"{outputs[kind]}/batch={number}")
        finally:
            batch.unpersist()

    return _start(envelopes, "split", checkpoint, each, once)


def ingest(clean: DataFrame, path: str, checkpoint: str, name: str = "ingest", once: bool = False) -> StreamingQuery:
    """Append a cleaned stream to a landing table, partitioned by day, exactly once."""
    writer = clean.withColumn("event_date", F.to_date("recorded_time")).writeStream.queryName(name)
    writer = writer.format("parquet").partitionBy("event_date").option("compression", "zstd")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def keep_latest(rows: DataFrame, table: Table, checkpoint: str, name: str = "live", once: bool = False) -> StreamingQuery:
    """Upsert a stream by vessel; of several rows, and of the stored one, the latest stays.

    The stored table is read once for the times it knows and once for the rows that stay.
    """

    def each(batch: DataFrame, number: int) -> None:
        stored = table.read()
        last = live.latest_by_key(batch.select(*stored.columns)).drop("expires_at")
        known = stored.select("mmsi", F.col("recorded_time").alias("_known"))
        newer = last.join(known, "mmsi", "left").where(F.col("_known").isNull() | (F.col("recorded_time") >= F.col("_known")))
        table.upsert(newer.drop("_known"), ["mmsi"], unique=True)
        table.vacuum()

    return _start(rows, name, checkpoint, each, once)


def to_kafka(rows: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """A keyed topic of JSON values, key included in the value. Needs the Kafka connector on the class path."""
    message = rows.select(F.to_json(F.struct("mmsi")).alias("key"), F.to_json(F.struct("*")).alias("value"))
    return message.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).start()


def wait(spark: SparkSession) -> None:
    """Until every job has ended; a failed one raises."""
    while spark.streams.active:
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
