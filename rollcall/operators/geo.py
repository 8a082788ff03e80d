"""Geometries as arrays of polygons of rings of vertices: joins by name, bounds, rounding, masks, projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import place_key

# Places whose geometry has another spelling, and the outer ring of masks.
ALIASES = {
    "SEME-PODJI": "Seme-Kpodji", "AKPRO-MISSERETE": "Akpo-Misserete", "BOUKOUMBE": "Boukombe", "COBLY": "Kobli",
    "KLOUEKANMEY": "Klouekanme", "OUASSA-PEHUNCO": "Pehunco", "TOUKOUNTOUNA": "Toucountouna",
}
WORLD = [[-180.0, -85.0], [180.0, -85.0], [180.0, 85.0], [-180.0, 85.0], [-180.0, -85.0]]
MASK_NAME = "__mask__"


def matched(places: DataFrame, shapes: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """name and coordinates of every place (name); shapes: shape_name, coordinates. A place without shape fails the query."""
    aliases = ALIASES if aliases is None else aliases
    alias = F.col("name")
    for name, shape in aliases.items():
        alias = F.when(F.col("name") == name, F.lit(shape)).otherwise(alias)
    keyed = shapes.groupBy(place_key(F.col("shape_name")).alias("k")).agg(F.max_by("coordinates", "shape_name").alias("coordinates"))
    joined = places.withColumn("k", place_key(alias)).join(keyed, "k", "left")
    return joined.select("name", F.coalesce("coordinates", F.raise_error(F.concat(F.lit("no shape for "), "name")).cast("array<array<array<array<double>>>>")).alias("coordinates"))


def rings(coordinates: Column) -> Column:
    """All rings of all polygons."""
    return F.flatten(coordinates)


def rounded(coordinates: Column, decimals: int = 3) -> Column:
    return F.transform(coordinates, lambda p: F.transform(p, lambda r: F.transform(r, lambda v: F.transform(v, lambda c: F.bround(c, decimals)))))


def bounds(coordinates: Column) -> Column:
    """struct(west, south, east, north)."""
    vertices = F.flatten(rings(coordinates))
    x, y = F.transform(vertices, lambda v: F.get(v, 0)), F.transform(vertices, lambda v: F.get(v, 1))
    return F.struct(F.array_min(x).alias("west"), F.array_min(y).alias("south"), F.array_max(x).alias("east"), F.array_max(y).alias("north"))


def envelope(bounded: DataFrame, column: str = "bounds") -> DataFrame:
    b = lambda n: F.col(f"{column}.{n}")
    return bounded.agg(F.min(b("west")).alias("west"), F.min(b("south")).alias("south"), F.max(b("east")).alias("east"), F.max(b("north")).alias("north"))


def mask(coordinates: Column) -> Column:
    """One polygon: the world, with the rings as holes."""
    world = F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in WORLD])
    return F.concat(F.array(world), rings(coordinates))


def unit_square(coordinates: Column, box: Column) -> Column:
    """Rings in a square of side 1 around the box, north up, longitudes shortened by the cosine of the middle latitude."""
    shrink = F.cos(F.radians((box["south"] + box["north"]) / 2))
    width, height = (box["east"] - box["west"]) * shrink, box["north"] - box["south"]
    side = F.greatest(width, height)
    return F.transform(rings(coordinates), lambda r: F.transform(r, lambda v: F.array((F.get(v, 0) - box["west"]) * shrink / side, (box["north"] - F.get(v, 1)) / side)))


def feature(name: Column, coordinates: Column, decimals: int = 3) -> Column:
    """A GeoJSON feature as text."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(name.alias("name")).alias("properties"), F.struct(F.lit("MultiPolygon").alias("type"), rounded(coordinates, decimals).alias("coordinates")).alias("geometry")))


def mask_feature(coordinates: Column, decimals: int = 3) -> Column:
    """The mask around a country as a GeoJSON feature."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit(MASK_NAME).alias("name")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), mask(rounded(coordinates, decimals)).alias("coordinates")).alias("geometry")))


def collection(shapes: DataFrame, country: DataFrame, decimals: int = 3) -> DataFrame:
    """One row `geojson`: a collection of the features of shapes (name, coordinates), by name, and after them the mask around country (coordinates).

    The map of a directory's places, so one row holds it.
    """
    features = shapes.select(F.lit(0).alias("o"), "name", feature(F.col("name"), F.col("coordinates"), decimals).alias("f"))
    features = features.unionByName(country.select(F.lit(1).alias("o"), F.lit(MASK_NAME).alias("name"), mask_feature(F.col("coordinates"), decimals).alias("f")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "name", "f"))), lambda x: x["f"]), ",")
    return features.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), joined, F.lit("]}")).alias("geojson"))
