"""Changes of static data, and the versions they make (slowly changing dimension, type 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.decode import event_key
from wakeline.sources.readers import since

#: Columns whose change opens a version. Draught, type text, version and validity do not.
TRACKED = ("imo_number", "call_sign", "ship_name", "ship_type_code", "dimension", "destination", "eta", "fix_type_code", "dte")
OPEN_END = "2099-12-31"


def changes(static: DataFrame, watermark: object = None, delay_days: int = 2) -> DataFrame:
    """Records that differ from the one before; the first of a vessel in the batch always counts."""
    w = Window.partitionBy("mmsi").orderBy(F.col("recorded_time").asc_nulls_last())
    before = F.lag(F.struct("recorded_time", *TRACKED)).over(w)
    lagged = since(static, watermark, delay_days).withColumn("_b", before)
    differs = F.col("_b.recorded_time").isNull()
    for name in TRACKED:
        differs = differs | ~F.col(name).eqNullSafe(F.col(f"_b.{name}"))
    return lagged.where(differs).select(*static.columns, event_key(F.col("mmsi"), F.col("recorded_time")).alias("change_id"))


def versions(change: DataFrame) -> DataFrame:
    """Each change with the half-open interval in which it holds; the last one is open (null)."""
    w = Window.partitionBy("mmsi").orderBy(F.col("recorded_time").asc_nulls_last())
    kept = [c for c in change.columns if c not in ("recorded_time", "change_id")]
    return change.select(*kept, F.col("recorded_time").alias("valid_from"), F.lead("recorded_time").over(w).alias("valid_to"))


def holds_at(at: Column, valid_from: Column, valid_to: Column) -> Column:
    return (at >= valid_from) & (at < F.coalesce(valid_to, F.lit(OPEN_END).cast("timestamp")))


def join_version(left: DataFrame, version: DataFrame, at: str) -> DataFrame:
    """Left rows with the version that holds at their time as struct ``v``; null where there is none.

    Both sides are laid into one sequence a vessel, in which the last version is carried forward: one
    shuffle and one sort, however many versions a vessel has. Versions of a vessel don't overlap.
    """
    names = [c for c in version.columns if c != "mmsi"]
    holds = version.where(F.col("mmsi").isNotNull() & F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))
    nothing = lambda df, columns: F.lit(None).cast(df.select(F.struct(*columns)).schema[0].dataType)
    a = holds.select("mmsi", F.col("valid_from").alias("_at"), F.lit(0).alias("_side"), F.struct(*names).alias("_v"), nothing(left, left.columns).alias("_row"))
    b = left.select("mmsi", F.col(at).alias("_at"), F.lit(1).alias("_side"), nothing(version, names).alias("_v"), F.struct(*left.columns).alias("_row"))
    w = Window.partitionBy("mmsi").orderBy(F.col("_at").asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = a.unionByName(b).withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_side = 1")
    fits = F.col("mmsi").isNotNull() & holds_at(F.col("_at"), F.col("_v.valid_from"), F.col("_v.valid_to"))
    return carried.select("_row.*", F.when(fits, F.col("_v")).alias("v"))
