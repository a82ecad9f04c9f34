"""Sentinel values of vessel messages turned into nulls, labels and physical units.

All literals are doubles, so no comparison or division falls back to decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIP_MMSI = (201_000_000, 755_999_999)
STATION_MMSI = (2_010_000, 7_559_999)

#: Labels of the decoded codes (fixed values).
MANOEUVRE = {0: "Not available (default)", 1: "Not engaged in special manoeuvre", 2: "Engaged in special manoeuvre"}
ACCURATE, COARSE = "High (<= 10m)", "Low (> 10m)"


def without(column: Column, sentinel: object) -> Column:
    """Null where the value is the sentinel."""
    return F.when(column == F.lit(sentinel), None).otherwise(column)


def rate_of_turn(code: Column) -> Column:
    """Degrees a minute from the coded turn; -128 is unknown, +-127 mean off the scale."""
    value = code.cast("double")
    scaled = F.signum(value) * F.pow(F.abs(value) / F.lit(4.733), F.lit(2.0))
    return (
        F.when(code == -128, None).when(code == 127, F.lit(709.0)).when(code == -127, F.lit(-709.0)).otherwise(scaled)
    )


def manoeuvre(code: Column) -> Column:
    out = F.when(code == 0, MANOEUVRE[0])
    for k in (1, 2):
        out = out.when(code == k, MANOEUVRE[k])
    return out.otherwise("Unknown")


def accuracy(flag: Column) -> Column:
    """A null flag counts as coarse."""
    return F.when(flag, ACCURATE).otherwise(COARSE)


def data_terminal(flag: Column) -> Column:
    """A null flag counts as available."""
    return F.when(flag, "Not Available").otherwise("Available")


def utc(text: Column) -> Column:
    """Time of a `YYYY-MM-DD HH:MM:SS.fffffffff +0000 UTC` text; the part from ' +' on is cut off."""
    return F.try_to_timestamp(F.split_part(text, F.lit(" +"), F.lit(1)))


def mid(mmsi: Column, places: int) -> Column:
    """The country digits: integer division, 1000000 for ships and 10000 for stations."""
    return F.floor(mmsi / F.lit(places)).cast("int")


def known_dimension(dimension: Column) -> Column:
    """The whole struct is unknown if all four distances are 0."""
    zero = (dimension["A"] == 0) & (dimension["B"] == 0) & (dimension["C"] == 0) & (dimension["D"] == 0)
    return F.when(zero, None).otherwise(dimension)


def arrival(eta: Column, recorded: Column) -> Column:
    """Timestamp of an ETA in the year of the record; null if a part is out of range or the day doesn't exist.

    There is no turn of the year: an ETA in January recorded in December lies in the past.
    """
    two = lambda name: F.lpad(eta[name].cast("string"), 2, "0")
    text = F.concat(
        F.year(recorded).cast("string"), F.lit("-"), two("Month"), F.lit("-"), two("Day"), F.lit(" "), two("Hour"), F.lit(":"), two("Minute"), F.lit(":00")
    )
    fits = eta["Month"].between(1, 12) & eta["Day"].between(1, 31) & eta["Hour"].between(0, 23) & eta["Minute"].between(0, 59)
    return F.when(fits, F.try_to_timestamp(text))


def event_key(mmsi: Column, at: Column) -> Column:
    """Opaque key of a vessel and a time, exact to the microsecond."""
    return F.concat_ws("-", mmsi.cast("string"), F.unix_micros(at).cast("string"))
