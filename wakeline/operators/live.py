"""The live view: pings with the static data known at their time, the latest row of each vessel, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TTL_SECONDS = 21_600
MAX_RESULTS = 50_000

SHIP = (
    "imo_number",
    "call_sign",
    "ship_type_code",
    "ship_type_description",
    "dimension",
    "maximum_static_draught",
    "destination",
    "eta",
    "fix_type_code",
    "fix_type_description",
    "dte",
)
PING = (
    "mmsi",
    "ship_name",
    "country_name",
    "recorded_time",
    "message_id",
    "longitude",
    "latitude",
    "position_accuracy",
    "speed_over_ground",
    "course_over_ground",
    "true_heading",
    "rate_of_turn",
    "navigational_status",
    "nav_status_desc",
    "special_manoeuvre_indicator",
    "raim",
)


def live_columns(dimension: Column | None = None) -> list[Column]:
    """The live view's ship columns from ``dimension`` and its neighbours. Unknown distances count as 0 in sums.

    Length is bow plus stern, width port plus starboard; both are set by name.
    """
    d = F.col("dimension") if dimension is None else dimension
    zero = lambda k: F.coalesce(d[k], F.lit(0))
    return [
        *[F.col(c) for c in SHIP[:4]],
        *[d[k].alias(f"dimension_{k.lower()}") for k in "ABCD"],
        (zero("A") + zero("B")).alias("ship_length"),
        (zero("C") + zero("D")).alias("ship_width"),
        *[F.col(c) for c in SHIP[5:]],
    ]


def as_of(pings: DataFrame, static: DataFrame) -> DataFrame:
    """Every ping with the last static record at or before its time (left as-of join).

    Both sides are laid into one sequence a vessel, in which the last static record is carried forward:
    one shuffle and one sort, whatever the number of versions.
    """
    record = F.struct(*SHIP)
    a = static.select("mmsi", F.col("recorded_time").alias("_at"), F.lit(0).alias("_side"), record.alias("_s"), F.lit(None).cast(pings.select(F.struct(*PING)).schema[0].dataType).alias("_p"))
    b = pings.select("mmsi", F.col("recorded_time").alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(static.select(record).schema[0].dataType).alias("_s"), F.struct(*PING).alias("_p"))
    w = Window.partitionBy("mmsi").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = a.unionByName(b).withColumn("_s", F.last("_s", ignorenulls=True).over(w)).where("_side = 1")
    return carried.select("_p.*", "_s.*").select(*PING, *live_columns())


def latest_by_key(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """The last row of each vessel with the time it expires at; expired rows are left out if ``now`` is given."""
    w = Window.partitionBy("mmsi").orderBy(F.col("recorded_time").desc_nulls_last(), F.xxhash64(*rows.columns))  # ties by a fixed rule
    last = rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    out = last.withColumn("expires_at", F.col("recorded_time") + F.make_dt_interval(secs=F.lit(TTL_SECONDS)))
    return out if now is None else out.where(F.col("expires_at") > now)


def search(rows: DataFrame, ranges: dict[str, tuple[float, float]] | None = None, tags: dict[str, str] | None = None, text: dict[str, str] | None = None, limit: int = MAX_RESULTS) -> DataFrame:
    """Rows inside numeric ranges, with equal tags, and with texts that hold a word, in any case; the first ``limit`` by vessel and time."""
    for name, (low, high) in (ranges or {}).items():
        rows = rows.where(F.col(name).between(low, high))
    for name, value in (tags or {}).items():
        rows = rows.where(F.col(name) == value)
    for name, word in (text or {}).items():
        rows = rows.where(F.lower(F.col(name)).contains(word.lower()))
    return rows.orderBy(*[c for c in ("mmsi", "recorded_time") if c in rows.columns]).limit(limit)


def live_stations(stations: DataFrame) -> DataFrame:
    """The live base-station view; it publishes the longitude as ``longtitude``."""
    return stations.select(
        "mmsi", "ship_name", "country_name", "recorded_time", "fix_type_code", "fix_type_desc", "latitude", F.col("longitude").alias("longtitude"), "position_accuracy", "raim", "long_range_enable", "message_id"
    )
