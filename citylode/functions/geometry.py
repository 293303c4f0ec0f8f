"""GeoJSON geometry as edges, and the containment test, all in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POLYGON = "array<array<array<double>>>"
MULTIPOLYGON = "array<array<array<array<double>>>>"


def rings(geojson: Column) -> Column:
    """All rings (outer and holes) of a Polygon or MultiPolygon; NULL for other geometries."""
    kind = F.get_json_object(geojson, "$.type")
    coordinates = F.get_json_object(geojson, "$.coordinates")
    return (
        F.when(kind == "Polygon", F.from_json(coordinates, POLYGON))
        .when(kind == "MultiPolygon", F.flatten(F.from_json(coordinates, MULTIPOLYGON)))
    )


def edges(geojson: Column) -> Column:
    """Every ring's consecutive vertex pairs as array<struct<x1,y1,x2,y2>>."""

    def segment(a: Column, b: Column) -> Column:
        return F.struct(
            F.get(a, F.lit(0)).alias("x1"), F.get(a, F.lit(1)).alias("y1"),
            F.get(b, F.lit(0)).alias("x2"), F.get(b, F.lit(1)).alias("y2"),
        )

    def walk(ring: Column) -> Column:
        count = F.size(ring) - 1
        return F.zip_with(F.slice(ring, F.lit(1), count), F.slice(ring, F.lit(2), count), segment)

    usable = F.filter(rings(geojson), lambda ring: F.size(ring) >= 2)
    return F.flatten(F.transform(usable, walk))


def extent(edge_list: Column) -> list[Column]:
    """Bounding box of an edge list: min_x, min_y, max_x, max_y."""
    def reach(pick, axis: str) -> Column:
        return pick(F.transform(edge_list, lambda e: pick_both(e, pick, axis)))

    def pick_both(edge: Column, pick, axis: str) -> Column:
        both = F.least if pick is F.array_min else F.greatest
        return both(edge[axis + "1"], edge[axis + "2"])

    return [
        reach(F.array_min, "x").alias("min_x"), reach(F.array_min, "y").alias("min_y"),
        reach(F.array_max, "x").alias("max_x"), reach(F.array_max, "y").alias("max_y"),
    ]


def inside(edge_list: Column, x: Column, y: Column) -> Column:
    """Even-odd test: an odd number of edges lies to the right of the point.

    Half-open on the boundary: of two zones sharing an edge, exactly one holds a point on it. Holes
    are rings like any other. The span test comes first, so the division never meets a flat edge.
    """
    def hit(edge: Column) -> Column:
        spans = (edge["y1"] > y) != (edge["y2"] > y)
        crossing = (edge["x2"] - edge["x1"]) * (y - edge["y1"]) / (edge["y2"] - edge["y1"]) + edge["x1"]
        return F.when(spans, F.when(x < crossing, 1).otherwise(0)).otherwise(0)

    return F.aggregate(edge_list, F.lit(0), lambda total, edge: total + hit(edge)) % 2 == 1
