"""Port boundaries: map elements flattened to ways, and enriched with box, grid cell and closed polygon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.geo import bounding_box, closed_ring, geohash

#: Tag values that make an element a port, with a bounding box (south, west, north, east) a zone.
POINTS = "array<array<double>>"
PRECISION = 5


def is_port(tags: Column, predicates: list[tuple[str, str]]) -> Column:
    """True if any of the (tag, value) predicates holds."""
    found = F.lit(False)
    for name, value in predicates:
        found = found | F.coalesce(tags[name] == value, F.lit(False))
    return found


def in_box(lat: Column, lon: Column, south: float, west: float, north: float, east: float) -> Column:
    return lat.between(south, north) & lon.between(west, east)


def _points(geometry: Column) -> Column:
    return F.transform(geometry, lambda p: F.array(p["lon"], p["lat"]))


def flatten(elements: DataFrame) -> DataFrame:
    """port_id, name and geometry_json of every way that has points, each once.

    Ways in a relation take its name and come before standalone ways; of several, the first zone's,
    then the first element's counts, by its id. ``elements``: zone, type, id, tags, geometry, members.
    """
    placed = elements.withColumn("_n", F.col("id"))
    name = F.coalesce(F.col("tags")["name"], F.lit(""))
    members = placed.where("type = 'relation'").select("zone", F.lit(0).alias("kind"), "_n", name.alias("name"), F.posexplode("members").alias("pos", "m"))
    members = members.where("m.type = 'way'").select("zone", "kind", "_n", "pos", F.col("m.ref").alias("way"), "name", F.col("m.geometry").alias("geometry"))
    ways = placed.where("type = 'way'").select("zone", F.lit(1).alias("kind"), "_n", F.lit(0).alias("pos"), F.col("id").alias("way"), name.alias("name"), "geometry")
    all_ = members.unionByName(ways).where(F.size("geometry") > 0)
    w = Window.partitionBy("way").orderBy("zone", "kind", "_n", "pos")
    first = all_.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return first.select(F.concat(F.lit("way_"), F.col("way").cast("string")).alias("port_id"), "name", F.to_json(_points(F.col("geometry"))).alias("geometry_json"))


def enrich(raw: DataFrame, precision: int = PRECISION) -> DataFrame:
    """Ports with their box, grid cell and GeoJSON polygon. Rows of bad or empty geometry are left out."""
    rows = raw.withColumn("_c", F.from_json("geometry_json", POINTS)).where(F.size("_c") > 0)
    box = bounding_box(F.col("_c"))
    rows = rows.withColumns(box)
    lat, lon = (F.col("min_lat") + F.col("max_lat")) / F.lit(2.0), (F.col("min_lon") + F.col("max_lon")) / F.lit(2.0)
    polygon = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(closed_ring(F.col("_c"))).alias("coordinates")))
    return rows.select(
        "port_id",
        F.regexp_replace("name", r"[^\x00-\x7F]", "").alias("name"),
        geohash(lat, lon, precision).alias("grid_id"),
        *box,
        polygon.alias("geometry_json"),
    )


def read_csv(spark, path: str) -> DataFrame:
    """Raw ports (port_id, name, geometry_json) with a header."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema("port_id string, name string, geometry_json string").csv(path)


def write_csv(ports: DataFrame, path: str) -> None:
    ports.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
