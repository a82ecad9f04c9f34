"""Readers of raw messages and landing tables, batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import schemas


def parse_envelope(value: Column) -> Column:
    """A raw message from JSON. A bad field is null, a text that is no JSON a struct of nulls."""
    return F.from_json(value, schemas.ENVELOPE, {"mode": "PERMISSIVE"})


def parse_strict(value: Column, schema: str) -> Column:
    """A message of a cleaned topic: malformed text is an error."""
    return F.from_json(value, schema, {"mode": "FAILFAST"})


def without_errors(envelopes: DataFrame) -> DataFrame:
    """Messages that are no error notices."""
    return envelopes.where(F.col("error").isNull()) if "error" in envelopes.columns else envelopes


def envelope_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Raw messages from files of one JSON text a line; a stream starts from the first file."""
    lines = (spark.readStream if stream else spark.read).text(path)
    return without_errors(lines.select(parse_envelope(F.col("value")).alias("m")).select("m.*"))


def kafka(spark: SparkSession, servers: str, topic: str, group: str, stream: bool = True) -> DataFrame:
    """A topic from its earliest offset as (key, value) texts. Needs the Kafka connector on the class path."""
    reader = (spark.readStream if stream else spark.read).format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("startingOffsets", "earliest").option("kafka.group.id", group)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def raw_stream(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """A stream of JSON files with a declared schema."""
    return spark.readStream.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)


def landing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A landing table partitioned by event_date; its other columns have the declared types."""
    return spark.read.schema(f"{schema}, event_date date").parquet(path)


def since(df: DataFrame, bound: object, days: int, at: str = "recorded_time") -> DataFrame:
    """Rows from ``days`` before ``bound`` on; all without a bound.

    The bound is a literal, so it reaches the scan; tables with an event_date are pruned by it as well.
    """
    if bound is None:
        return df
    low = F.lit(bound) - F.make_dt_interval(F.lit(days))
    if "event_date" in df.columns:
        df = df.where(F.col("event_date") >= F.to_date(low))
    return df.where(F.col(at) >= low)
