"""Points and planning areas: polygon tables, ray casting, area joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RINGS = "array<array<array<double>>>"


def polygon_table(features: DataFrame, document: str, area: str) -> DataFrame:
    """GeoJSON features (one per row) to one row per polygon with its box.

    ``area`` is the property that names the area; names are upper case and
    trimmed. Multi-polygons give several rows, other geometries none.
    """
    doc = F.col(document)
    kind = F.get_json_object(doc, "$.geometry.type")
    coordinates = F.get_json_object(doc, "$.geometry.coordinates")
    polygons = F.when(kind == "Polygon", F.array(F.from_json(coordinates, _RINGS))).when(
        kind == "MultiPolygon", F.from_json(coordinates, f"array<{_RINGS}>")
    )
    rows = features.select(
        F.upper(F.trim(F.get_json_object(doc, f"$.properties.{area}"))).alias("area"),
        F.posexplode(polygons).alias("part", "rings"),
    )
    points = F.flatten("rings")
    lons, lats = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return rows.select(
        "area", "part", "rings",
        F.array_min(lons).alias("min_lon"), F.array_max(lons).alias("max_lon"),
        F.array_min(lats).alias("min_lat"), F.array_max(lats).alias("max_lat"),
    )


def in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Even-odd rule: an odd number of ring edges lies to the right."""
    shifted = F.concat(F.slice(ring, -1, 1), F.slice(ring, 1, F.size(ring) - 1))

    def crosses(a: Column, b: Column) -> Column:
        between = (a[1] > lat) != (b[1] > lat)
        at = F.try_divide((b[0] - a[0]) * (lat - a[1]), b[1] - a[1]) + a[0]
        return F.when(between & (lon < at), 1).otherwise(0)

    crossings = F.aggregate(F.zip_with(ring, shifted, crosses), F.lit(0), lambda s, x: s + x)
    return crossings % 2 == 1


def in_polygon(lon: Column, lat: Column, rings: Column) -> Column:
    """Inside the first ring and outside all later ones."""
    holes = F.slice(rings, 2, F.greatest(F.size(rings), F.lit(1)))
    return in_ring(lon, lat, rings[0]) & ~F.exists(holes, lambda hole: in_ring(lon, lat, hole))


def area_join(
    points: DataFrame, polygons: DataFrame, lon: str, lat: str, cell: float, how: str = "left",
    point_id: str | None = None,
) -> DataFrame:
    """Attach areas to points.

    Boxes are unfolded over grid cells of the given size and joined on the
    cell, so no point meets a polygon far away. Choose ``cell`` near the usual
    box width. With ``point_id`` each point keeps the first area by name and
    part; without it every matching polygon gives a row.
    """

    def cells(low: str, high: str) -> Column:
        return F.sequence(
            F.floor(F.col(low) / F.lit(cell)).cast("long"), F.floor(F.col(high) / F.lit(cell)).cast("long")
        )

    gridded = polygons.withColumn("__cx", F.explode(cells("min_lon", "max_lon"))).withColumn(
        "__cy", F.explode(cells("min_lat", "max_lat"))
    )
    placed = points.withColumns({
        "__cx": F.floor(F.col(lon) / F.lit(cell)).cast("long"),
        "__cy": F.floor(F.col(lat) / F.lit(cell)).cast("long"),
    })
    x, y = F.col(lon), F.col(lat)
    inside = (
        (F.col("p.__cx") == F.col("g.__cx")) & (F.col("p.__cy") == F.col("g.__cy"))
        & x.between(F.col("min_lon"), F.col("max_lon")) & y.between(F.col("min_lat"), F.col("max_lat"))
        & in_polygon(x, y, F.col("rings"))
    )
    matched = placed.alias("p").join(gridded.alias("g"), inside, how)
    kept = [F.col(f"p.{c}").alias(c) for c in points.columns]
    if point_id is None:
        return matched.select(*kept, "area")
    rest = [c for c in points.columns if c != point_id]
    first = matched.groupBy(F.col(f"p.{point_id}").alias(point_id)).agg(
        F.first(F.struct(*[F.col(f"p.{c}") for c in rest])).alias("__p"),
        F.min(F.struct("area", "part"))["area"].alias("area"),
    )
    return first.select(point_id, *[F.col("__p")[c].alias(c) for c in rest], "area")


def dissolve(polygons: DataFrame, parents: DataFrame) -> DataFrame:
    """Re-label polygons with the larger area they belong to.

    Membership needs no union of shapes: an area is the set of its polygons.
    ``part`` is a hash of a polygon's own area and part, the same on each run.
    """
    return (
        polygons.join(parents, "area").withColumn("part", F.xxhash64("area", "part"))
        .drop("area")
        .withColumnRenamed("parent", "area")
        .select("area", "part", "rings", "min_lon", "max_lon", "min_lat", "max_lat")
    )


def area_summary(polygons: DataFrame) -> DataFrame:
    """Polygons, rings and common box per area."""
    return polygons.groupBy("area").agg(
        F.count(F.lit(1)).alias("polygons"), F.sum(F.size("rings")).alias("rings"),
        F.min("min_lon").alias("min_lon"), F.max("max_lon").alias("max_lon"),
        F.min("min_lat").alias("min_lat"), F.max("max_lat").alias("max_lat"),
    )


def count_by_area(located: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Points per area and further keys; points outside all areas are dropped."""
    return located.filter(F.col("area").isNotNull()).groupBy("area", *keys).agg(F.count(F.lit(1)).alias(name))


def mean_by_area(located: DataFrame, keys: list[str], reading: str, station: str) -> DataFrame:
    """Mean reading, stations, and stations above zero per area."""
    return (
        located.filter(F.col("area").isNotNull())
        .groupBy("area", *keys)
        .agg(
            F.avg(reading).alias("mean_reading"),
            F.count_distinct(station).alias("station_count"),
            F.count_distinct(F.when(F.col(reading) > 0, F.col(station))).alias("raining_station_count"),
        )
    )
