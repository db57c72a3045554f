"""An index of polygon edges, so that a point meets a few edges of an area and never a whole ring.

An area's height is cut into slabs of equal height, and every edge is put into the slabs that it crosses. Whether a
point lies inside is the parity of the edges that a ray to the east crosses, which is a sum: a point is joined with the
edges of its slab alone, and the crossings are counted per part of the area. Slabs are as many as the edges ask for,
but no more than keep the copies of long edges to a few times the edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: Edges that a slab should hold, and copies per edge that are accepted for it.
EDGES_PER_SLAB = 64
COPIES = 4


def _slab(lat: Column) -> Column:
    """The slab of a latitude. Every step rises with it, so a point between an edge's ends is in one of its slabs."""
    at = F.floor((lat - F.col("_low")) / F.col("_height") * F.col("_slabs"))
    return F.least(F.greatest(at, F.lit(0)), F.col("_slabs") - 1).cast("int")


def edge_index(areas: DataFrame, code: str = "_code", polygons: str = "_p") -> tuple[DataFrame, DataFrame]:
    """Staged: the slabs of every area (``_code``, ``_low``, ``_height``, ``_slabs``), and its edges by slab (``_code``,
    ``_slab``, ``_part``, ``_ax``, ``_ay``, ``_bx``, ``_by``). Holes are rings of their part. Level edges and rings
    without a corner are never crossed; an area of only such edges has no slab. Codes of areas must differ."""
    parts = areas.select(F.col(code).alias("_code"), F.posexplode(polygons).alias("_part", "_rings"))
    rings = parts.select("_code", "_part", F.explode("_rings").alias("_ring")).where(F.size("_ring") > 1)
    ends = F.arrays_zip(
        F.expr("slice(_ring, 1, size(_ring) - 1)").alias("a"), F.expr("slice(_ring, 2, size(_ring) - 1)").alias("b")
    )
    edges = rings.select("_code", "_part", F.explode(ends).alias("e")).select(
        "_code", "_part",
        F.get("e.a", 0).alias("_ax"), F.get("e.a", 1).alias("_ay"), F.get("e.b", 0).alias("_bx"), F.get("e.b", 1).alias("_by"),
    )
    edges = stage(edges.where("_ax is not null and _bx is not null and _ay <> _by"))
    low, high = F.least("_ay", "_by"), F.greatest("_ay", "_by")
    sizes = edges.groupBy("_code").agg(
        F.min(low).alias("_low"), (F.max(high) - F.min(low)).alias("_height"), F.count(F.lit(1)).alias("_n"), F.sum(high - low).alias("_rise")
    )
    wanted = F.least(F.ceil(F.col("_n") / EDGES_PER_SLAB), F.floor(F.col("_n") * (COPIES - 1) * F.col("_height") / F.col("_rise")))
    slabs = stage(sizes.select("_code", "_low", "_height", F.greatest(wanted, F.lit(1)).cast("int").alias("_slabs")))
    laid = edges.join(slabs, "_code").withColumn("_slab", F.explode(F.sequence(_slab(low), _slab(high))))
    return slabs, stage(laid.select("_code", "_slab", "_part", "_ax", "_ay", "_bx", "_by"))


def crossed(lon: Column, lat: Column) -> Column:
    """Whether the ray from a point to the east crosses an edge."""
    straddles = (F.col("_ay") > lat) != (F.col("_by") > lat)
    at = F.col("_ax") + F.try_divide((lat - F.col("_ay")) * (F.col("_bx") - F.col("_ax")), F.col("_by") - F.col("_ay"))
    return F.coalesce(straddles & (lon < at), F.lit(False))


def inside(
    candidates: DataFrame, slabs: DataFrame, edges: DataFrame, keys: Sequence[str], lon: str = "_lon", lat: str = "_lat"
) -> DataFrame:
    """``keys`` and ``_inside`` of every candidate (a point's ``keys`` with the ``_code`` of an area), by parity of any part."""
    placed = candidates.join(slabs, "_code", "left").withColumn("_slab", _slab(F.col(lat)))
    met = placed.join(edges, ["_code", "_slab"], "left")
    hits = F.sum(crossed(F.col(lon), F.col(lat)).cast("int"))
    parities = met.groupBy(*keys, "_part").agg((hits % 2 == 1).alias("_odd"))
    return parities.groupBy(*keys).agg(F.coalesce(F.max("_odd"), F.lit(False)).alias("_inside"))
