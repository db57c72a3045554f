"""Points, polygons and distances as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import as_number

# Kilometres per degree in the two distance variants.
KM_PER_DEGREE = 111.0
KM_PER_DEGREE_RADIUS = 111.32

_RINGS = "array<array<array<double>>>"
_POLYGONS = f"array<{_RINGS}>"


def split_point(col: Column) -> tuple[Column, Column]:
    """``"lat,lon"`` text to two doubles, cut at the first comma."""
    parts = F.split(col.cast("string"), ",", 2)
    return as_number(F.get(parts, 0)), as_number(F.get(parts, 1))


def distance_km(lat1, lon1, lat2, lon2, km: float = KM_PER_DEGREE) -> Column:
    """Planar distance; longitude shrinks with the cosine of the first latitude."""
    dx = (lon2 - lon1) * F.lit(km) * F.cos(F.radians(lat1))
    dy = (lat2 - lat1) * F.lit(km)
    return F.sqrt(dx * dx + dy * dy)


def degrees_for(km: float, latitude: float, per_degree: float = KM_PER_DEGREE) -> tuple[float, float]:
    """Half-sizes (lat, lon) in degrees of a box around a disc at a latitude."""
    return km / per_degree, km / (per_degree * max(math.cos(math.radians(latitude)), 1e-6))


def polygons_of(col: Column) -> Column:
    """GeoJSON text to an array of polygons (rings of [lon, lat]); null if not an area."""
    kind = F.get_json_object(col, "$.type")
    body = F.get_json_object(col, "$.coordinates")
    single = F.from_json(body, _RINGS)
    many = F.from_json(body, _POLYGONS)
    return F.when(kind == "Polygon", F.when(single.isNotNull(), F.array(single))).when(kind == "MultiPolygon", many)


def polygon_text(col: Column) -> Column:
    """The text itself when it is a Polygon or MultiPolygon, else null."""
    text = F.trim(col.cast("string"))
    return F.when(polygons_of(text).isNotNull(), text)


def first_polygon_text(columns: list[str], available: list[str]) -> Column:
    present = [polygon_text(F.col(f"`{c}`")) for c in columns if c in available]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


# Where a point may sit in a row, in order of trust.
POINT_PAIRS = [("longitude", "latitude"), ("lon", "lat"), ("x", "y")]
POINT_TEXTS = ["geometry_xy", "Geo Point", "geo_point_2d", "geo_point", "geometry", "geo_shape"]
LON_FIRST_TEXTS = {"geometry", "geo_shape"}
POLYGON_TEXTS = ["Geo Shape", "geo_shape", "geometry", "geometry_xy"]
GEOMETRY_COLUMNS = [
    "latitude", "longitude", "lat", "lon", "x", "y", "geometry_xy", "Geo Point",
    "geo_point_2d", "geo_point", "geometry", "geo_shape", "Geo Shape",
]


def _pair(lon: Column, lat: Column) -> Column:
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


def point_from_any(available: list[str]) -> Column:
    """First usable point of a row as ``struct<lon, lat>``.

    Number pairs come first, then GeoJSON points, then comma texts; the comma texts are
    latitude first except in the two columns that hold longitude first.
    """
    tries = [
        _pair(as_number(F.col(f"`{x}`")), as_number(F.col(f"`{y}`")))
        for x, y in POINT_PAIRS
        if x in available and y in available
    ]
    for name in POINT_TEXTS:
        if name not in available:
            continue
        text = F.trim(F.col(f"`{name}`").cast("string"))
        tries.append(
            _pair(
                as_number(F.get_json_object(text, "$.coordinates[0]")),
                as_number(F.get_json_object(text, "$.coordinates[1]")),
            )
        )
        a, b = split_point(text)
        tries.append(_pair(a, b) if name in LON_FIRST_TEXTS else _pair(b, a))
    return F.coalesce(*tries) if tries else F.lit(None).cast("struct<lon:double,lat:double>")


def in_rings(lon: Column, lat: Column, polygons: Column) -> Column:
    """Even-odd test of a point against polygons; holes are rings like the others."""

    def crossings(ring: Column) -> Column:
        edges = F.arrays_zip(
            F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b")
        )

        def crosses(edge: Column) -> Column:
            ax, ay = F.get(edge["a"], 0), F.get(edge["a"], 1)
            bx, by = F.get(edge["b"], 0), F.get(edge["b"], 1)
            straddles = (ay > lat) != (by > lat)
            at = ax + F.try_divide((lat - ay) * (bx - ax), by - ay)
            return F.coalesce(straddles & (lon < at), F.lit(False))

        return F.size(F.filter(edges, crosses))

    def inside(polygon: Column) -> Column:
        total = F.aggregate(polygon, F.lit(0), lambda acc, ring: acc + crossings(ring))
        return total % 2 == 1

    return F.coalesce(F.exists(polygons, inside), F.lit(False))


def outer_box(polygons: Column) -> Column:
    """Bounding box of the outer rings as ``struct<x0, y0, x1, y1>``."""
    corners = F.flatten(F.transform(polygons, lambda p: F.get(p, 0)))
    xs = F.transform(corners, lambda c: F.get(c, 0))
    ys = F.transform(corners, lambda c: F.get(c, 1))
    return F.struct(
        F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"),
        F.array_max(ys).alias("y1"),
    )
