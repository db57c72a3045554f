"""Nearest, radius and containment joins.

Nearest references are found by one search tree for every size. References, in the order of a curve that keeps
neighbours together, are cut into leaves of some hundred; leaves and then nodes are grouped under nodes with tight
boxes until a group of references has one small list of nodes. A place walks down that tree twice. First it follows one
box per level, where its own place on the curve falls, and takes the nearest reference of the leaf where it ends as its
bound. Then it follows every box that is no farther away than this bound: all its rows share it, so few are left on every
level, however many levels there are. Two levels serve some ten thousand references of a group, three a million.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import KM_PER_DEGREE, degrees_for, distance_km, outer_box
from ..session import stage
from .edges import edge_index, inside

#: References in a leaf, and boxes in a node: the bounds of the arrays that rows carry.
LEAF_REFS = 256
NODE_BOXES = 64
CURVE_BITS = 16
#: Places that a task searches at once. They are few bytes for much work, so tasks are counted by rows.
TASK_PLACES = 8_192

Metric = Callable[[Column, Column, Column, Column], Column]


def squared_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dy, dx = lat2 - lat1, lon2 - lon1
    return dy * dy + dx * dx


def _located(df: DataFrame, lat: str, lon: str) -> Column:
    return F.col(lat).isNotNull() & F.col(lon).isNotNull()


def nearest(
    points: DataFrame,
    refs: DataFrame,
    by: Sequence[str] = (),
    lat: str = "lat",
    lon: str = "lon",
    code: str = "code",
    ref_lat: str = "lat",
    ref_lon: str = "lon",
    metric: Metric = distance_km,
    out_code: str = "nearest_code",
    out_distance: str = "nearest_distance",
    leaf_refs: int = LEAF_REFS,
    node_boxes: int = NODE_BOXES,
) -> DataFrame:
    """Add the nearest reference's code and distance to every point.

    ``by`` restricts candidates to the same group. Ties go to the smallest code. A point without position, or whose
    group has no reference, keeps nulls. Equal places are searched once, and every point gets its place's answer, so
    points need no identity. Runs jobs that write the tree.
    """
    by = list(by)
    groups = [f"_g{i}" for i in range(len(by))] or ["_g0"]
    known = refs.where(_located(refs, ref_lat, ref_lon) & F.col(code).isNotNull())
    for key in by:
        known = known.where(F.col(key).isNotNull())
    named = [F.col(k).alias(g) for k, g in zip(by, groups)] or [F.lit(0).alias("_g0")]
    at = [F.col(ref_lat).cast("double").alias("_rlat"), F.col(ref_lon).cast("double").alias("_rlon")]
    # One reference per exact position, the smallest code, so equal positions never pile up.
    spots = known.select(*named, *at, F.col(code).alias("_code")).groupBy(*groups, "_rlat", "_rlon").agg(F.min("_code").alias("_code"))
    spots = stage(spots)
    leaves, uppers, roots = _search_tree(spots, groups, leaf_refs, node_boxes)

    q_lat, q_lon = F.col("_qlat"), F.col("_qlon")
    own = [F.col(k).alias(g) for k, g in zip(by, groups)] or [F.lit(0).alias("_g0")]
    place = [*own, F.col(lat).cast("double").alias("_qlat"), F.col(lon).cast("double").alias("_qlon")]
    at = [*groups, "_qlat", "_qlon"]
    places = stage(points.where(_located(points, lat, lon)).select(*place).distinct())
    tasks = max(1, -(-places.count() // TASK_PLACES))

    # Box corners are real coordinates, so both ends hold for the metric. Boxes and references are exploded before they are
    # measured: arithmetic on rows is compiled, arithmetic inside arrays is not.
    box, ref = F.col("_box"), F.col("_ref")
    near = (F.least(F.greatest(q_lat, box["s"]), box["n"]), F.least(F.greatest(q_lon, box["w"]), box["e"]))
    far = (
        F.when(F.abs(box["s"] - q_lat) > F.abs(box["n"] - q_lat), box["s"]).otherwise(box["n"]),
        F.when(F.abs(box["w"] - q_lon) > F.abs(box["e"] - q_lon), box["w"]).otherwise(box["e"]),
    )

    def boxes(met: DataFrame, *more: str) -> DataFrame:
        return met.select(*at, *more, "_ub", F.explode("_boxes").alias("_box"))

    def measured(met: DataFrame) -> DataFrame:
        return met.select(*at, "_ub", F.explode("_refs").alias("_ref")).withColumn("_d", metric(q_lat, q_lon, ref["lat"], ref["lon"]))

    def best_box(met: DataFrame) -> DataFrame:
        """The last box that begins at the place's position on the curve or before it, else the first one."""
        ends = boxes(met, "_qz").withColumn("_hi", metric(q_lat, q_lon, *far))
        order = F.when(box["z"] <= F.col("_qz"), box["z"]).otherwise(-1 - box["z"])
        found = ends.groupBy(*at, "_qz").agg(F.min("_ub").alias("_was"), F.min("_hi").alias("_hi"), F.max_by(box["node"], order).alias("_node"))
        return found.select(*at, "_qz", F.least("_was", "_hi").alias("_ub"), "_node")

    def open_boxes(met: DataFrame) -> DataFrame:
        lo = metric(q_lat, q_lon, *near)
        return boxes(met).where(lo <= F.col("_ub")).select(*at, "_ub", box["node"].alias("_node"))

    start = _on_curve(places, spots, "_qlat", "_qlon", "_qz").withColumn("_ub", F.lit(None).cast("double"))
    one = best_box(start.repartition(tasks, *at).join(roots, groups))
    for level in uppers:
        one = best_box(one.join(level, "_node"))
    bound = measured(one.join(leaves, "_node")).groupBy(*at).agg(F.least(F.min("_ub"), F.min("_d")).alias("_ub"))
    bound = stage(bound).repartition(tasks, *at)
    frontier = open_boxes(bound.join(roots, groups))
    for level in uppers:
        frontier = open_boxes(frontier.join(level, "_node"))
    final = measured(frontier.join(leaves, "_node")).where(F.col("_d") <= F.col("_ub"))
    best = final.groupBy(*at).agg(F.min(F.struct(F.col("_d").alias("d"), ref["code"].alias("code"))).alias("_best"))
    same = F.col(lat).cast("double").eqNullSafe(q_lat) & F.col(lon).cast("double").eqNullSafe(q_lon)
    for key, g in zip(by, groups):
        same = same & (F.col(f"_point.{key}") == F.col(f"_found.{g}"))
    found = points.alias("_point").join(best.alias("_found"), same, "left")
    return found.select("_point.*", F.col("_best.code").alias(out_code), F.col("_best.d").alias(out_distance))


def _on_curve(rows: DataFrame, spots: DataFrame, lat: str, lon: str, out: str) -> DataFrame:
    """Add a position's place on the curve through the frame of all references; what lies outside goes to its rim."""
    frame = spots.agg(
        F.struct(
            F.min("_rlat").alias("s"), F.min("_rlon").alias("w"),
            F.greatest(F.max("_rlat") - F.min("_rlat"), F.max("_rlon") - F.min("_rlon"), F.lit(1e-9)).alias("span"),
        )
    ).scalar()
    cells = (1 << CURVE_BITS) - 1
    curve = F.lit(0).cast("bigint")
    for i in range(CURVE_BITS):
        for place, name in enumerate(("_x", "_y")):
            curve = curve + F.shiftleft(F.shiftright(name, i).bitwiseAND(F.lit(1).cast("bigint")), 2 * i + place)

    def cell(value: str, origin: str) -> Column:
        at = F.floor((F.col(value) - F.col(f"_f.{origin}")) / F.col("_f.span") * cells).cast("bigint")
        return F.least(F.greatest(at, F.lit(0)), F.lit(cells)).cast("bigint")

    placed = rows.withColumn("_f", frame).withColumns({"_x": cell(lon, "w"), "_y": cell(lat, "s")})
    return placed.withColumn(out, curve).drop("_f", "_x", "_y")


def _search_tree(spots: DataFrame, groups: list[str], leaf_refs: int, node_boxes: int):
    """Leaves (``_node``, ``_refs``), the levels above from the top down (``_node``, ``_boxes``), and a list per group."""
    rows = _on_curve(spots, spots, "_rlat", "_rlon", "_z").select(
        *groups, "_z", F.col("_rlat").alias("s"), F.col("_rlat").alias("n"), F.col("_rlon").alias("w"), F.col("_rlon").alias("e"),
        F.struct(F.col("_rlat").alias("lat"), F.col("_rlon").alias("lon"), F.col("_code").alias("code")).alias("_item"),
    )
    box = [F.min("s").alias("s"), F.max("n").alias("n"), F.min("w").alias("w"), F.max("e").alias("e")]
    made, take, items = [], leaf_refs, "_refs"
    count = spots.count()
    while True:
        # Runs of neighbours along the curve; a run lies in one range partition, so no group is put in order whole.
        dealt = rows.repartitionByRange(max(1, count // (take * 1_000)), *groups, "_z").withColumn("_p", F.spark_partition_id())
        spot = F.row_number().over(Window.partitionBy("_p", *groups).orderBy("_z", "s", "w")) - 1
        runs = stage(dealt.withColumn("_run", F.floor(spot / take)))
        level = runs.groupBy(*groups, "_p", "_run").agg(F.min("_z").alias("_z"), *box, F.collect_list("_item").alias(items))
        level = stage(level.drop("_p", "_run").withColumn("_node", F.monotonically_increasing_id()))
        made.append(level.select("_node", items))
        nodes = level.select(*groups, "_z", "s", "n", "w", "e", F.struct("s", "n", "w", "e", F.col("_z").alias("z"), F.col("_node").alias("node")).alias("_item"))
        most = nodes.groupBy(*groups).agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0] or 0
        above = nodes.count()
        if most <= node_boxes or above == count:
            roots = stage(nodes.groupBy(*groups).agg(F.collect_list("_item").alias("_boxes")))
            return made[0], made[:0:-1], roots
        rows, count, take, items = nodes, above, node_boxes, "_boxes"


def count_within(
    zones: DataFrame,
    points: DataFrame,
    id_column: str,
    radius_km: float,
    lat: str = "lat",
    lon: str = "lon",
    point_lat: str = "lat",
    point_lon: str = "lon",
    km: float = KM_PER_DEGREE,
    out: str = "n_within",
) -> DataFrame:
    """Add to each zone the number of points within a radius of its centre.

    Points are first counted per exact position and per grid cell. A cell wholly inside
    the circle adds its count, one wholly outside is dropped, and only the cells the
    circle cuts are opened, so a dense place is added up rather than paired.
    """
    step = radius_km / km / 3.0
    spots = (
        points.where(_located(points, point_lat, point_lon))
        .groupBy(F.col(point_lat).alias("_plat"), F.col(point_lon).alias("_plon"))
        .agg(F.count(F.lit(1)).alias("_k"))
        .withColumns({"_ix": F.floor(F.col("_plon") / step), "_iy": F.floor(F.col("_plat") / step)})
    )
    spots = stage(spots)
    cells = spots.groupBy("_ix", "_iy").agg(
        F.sum("_k").alias("_k"),
        F.min("_plat").alias("_s"),
        F.max("_plat").alias("_n"),
        F.min("_plon").alias("_w"),
        F.max("_plon").alias("_e"),
    )
    cells = stage(cells)

    centre = zones.where(_located(zones, lat, lon)).select(
        id_column, F.col(lat).cast("double").alias("_zlat"), F.col(lon).cast("double").alias("_zlon")
    )
    half_lat = F.lit(radius_km / km * 1.0001)
    half_lon = F.lit(radius_km / km * 1.0001) / F.greatest(F.cos(F.radians("_zlat")), F.lit(1e-6))

    def strip(mid: str, half: Column) -> Column:
        return F.sequence(F.floor((F.col(mid) - half) / step), F.floor((F.col(mid) + half) / step))

    z_lat, z_lon = F.col("_zlat"), F.col("_zlon")
    around = centre.withColumn("_ix", F.explode(strip("_zlon", half_lon))).withColumn(
        "_iy", F.explode(strip("_zlat", half_lat))
    )
    near = (F.least(F.greatest(z_lat, F.col("_s")), F.col("_n")), F.least(F.greatest(z_lon, F.col("_w")), F.col("_e")))
    far = (
        F.when(F.abs(F.col("_s") - z_lat) > F.abs(F.col("_n") - z_lat), F.col("_s")).otherwise(F.col("_n")),
        F.when(F.abs(F.col("_w") - z_lon) > F.abs(F.col("_e") - z_lon), F.col("_w")).otherwise(F.col("_e")),
    )
    met = stage(
        around.join(cells, ["_ix", "_iy"])
        .withColumns(
            {"_lo": distance_km(z_lat, z_lon, *near, km=km), "_hi": distance_km(z_lat, z_lon, *far, km=km)}
        )
        .where(F.col("_lo") <= radius_km)
        .select(id_column, "_zlat", "_zlon", "_ix", "_iy", "_k", (F.col("_hi") <= radius_km).alias("_whole"))
    )
    whole = met.where("_whole").select(id_column, "_k")
    cut = (
        met.where("not _whole")
        .drop("_k")
        .join(spots, ["_ix", "_iy"])
        .where(distance_km(z_lat, z_lon, F.col("_plat"), F.col("_plon"), km=km) <= radius_km)
        .select(id_column, "_k")
    )
    counts = whole.unionByName(cut).groupBy(id_column).agg(F.sum("_k").alias(out))
    return zones.join(counts, id_column, "left").fillna(0, subset=[out])


def within_distance(
    points: DataFrame, at_lat: float, at_lon: float, max_km: float, lat: str = "lat", lon: str = "lon", out: str = "distance_km"
) -> DataFrame:
    """Points within a distance of one place; the box test reaches the scan first."""
    d_lat, d_lon = degrees_for(max_km, at_lat)
    boxed = points.where(
        F.col(lat).between(at_lat - d_lat, at_lat + d_lat) & F.col(lon).between(at_lon - d_lon, at_lon + d_lon)
    )
    here = (F.lit(float(at_lat)), F.lit(float(at_lon)))
    return boxed.withColumn(out, distance_km(*here, F.col(lat), F.col(lon))).where(F.col(out) <= max_km)


def in_box(lat: Column, lon: Column, south: float, north: float, west: float, east: float) -> Column:
    return lat.between(south, north) & lon.between(west, east)


def containing_areas(
    points: DataFrame,
    areas: DataFrame,
    id_columns: Sequence[str] = ("id",),
    lat: str = "lat",
    lon: str = "lon",
    code: str = "code",
    polygons: str = "polygons",
    out: str = "area_code",
    out_box: str | None = None,
) -> DataFrame:
    """Add the code of the area around each point, and of the box around it if asked.

    Every area is laid over the cells of a grid of its own size class (the power of two above its box), so it covers
    four cells at most, whatever the others' sizes; a point looks into one cell per class that occurs. Only areas
    whose box holds the point are tested exactly, edge by edge of the point's slab (``edges``): no ring travels with a
    point. Several hits: smallest code. The box answer considers single polygons only. ``id_columns`` must identify a
    point, ``code`` an area.
    """
    ids = list(id_columns)
    # Parsed once; the boxes are then taken from stored rings.
    parsed = stage(areas.select(F.col(code).alias("_code"), F.col(polygons).alias("_p")))
    shaped = parsed.where("_p is not null").select("_code", outer_box(F.col("_p")).alias("_b"), (F.size("_p") == 1).alias("_single"))
    slabs, edges = edge_index(parsed.where("_p is not null"))
    # Classes of equal cell size, from 2^-40 up to the whole globe: a list of at most some fifty numbers.
    widest = F.greatest(F.expr("_b.x1 - _b.x0"), F.expr("_b.y1 - _b.y0"), F.lit(2.0**-40))
    classed = stage(shaped.withColumn("_class", F.ceil(F.log2(widest)).cast("int")))
    classes = classed.agg(F.collect_set("_class")).scalar()

    def cell(value: Column) -> Column:
        return F.floor(value / F.pow(F.lit(2.0), F.col("_class").cast("double")))

    tiles = classed.withColumn("_ix", F.explode(F.sequence(cell(F.col("_b.x0")), cell(F.col("_b.x1"))))).withColumn(
        "_iy", F.explode(F.sequence(cell(F.col("_b.y0")), cell(F.col("_b.y1"))))
    )
    placed = points.where(_located(points, lat, lon)).select(*ids, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
    placed = placed.withColumn("_classes", classes).withColumn("_class", F.explode("_classes")).drop("_classes")
    placed = placed.withColumns({"_ix": cell(F.col("_lon")), "_iy": cell(F.col("_lat"))})
    x, y = F.col("_lon"), F.col("_lat")
    boxed = placed.join(tiles, ["_class", "_ix", "_iy"]).where(
        x.between(F.col("_b.x0"), F.col("_b.x1")) & y.between(F.col("_b.y0"), F.col("_b.y1"))
    )
    tested = inside(boxed, slabs, edges, [*ids, "_code", "_single"])
    answers = [F.min(F.when(F.col("_inside"), F.col("_code"))).alias(out)]
    if out_box:
        answers.append(F.min(F.when(F.col("_single"), F.col("_code"))).alias(out_box))
    return points.join(tested.groupBy(*ids).agg(*answers), ids, "left")


def assign_area(
    points: DataFrame,
    areas: DataFrame,
    id_columns: Sequence[str] = ("id",),
    lat: str = "lat",
    lon: str = "lon",
    code: str = "code",
    polygons: str = "polygons",
    centre_lat: str = "lat_c",
    centre_lon: str = "lon_c",
    out: str = "area_code",
) -> DataFrame:
    """Area of each point: the polygon around it, else its box, else the nearest centre."""
    hit = containing_areas(points, areas, id_columns, lat, lon, code, polygons, "_in", "_box")
    full = nearest(
        hit,
        areas,
        lat=lat,
        lon=lon,
        code=code,
        ref_lat=centre_lat,
        ref_lon=centre_lon,
        metric=squared_degrees,
        out_code="_near",
        out_distance="_far",
    )
    step = F.when(F.col("_in").isNotNull(), "polygon").when(F.col("_box").isNotNull(), "box").when(
        F.col("_near").isNotNull(), "nearest"
    )
    return full.withColumns({out: F.coalesce("_in", "_box", "_near"), "matched_by": step}).drop(
        "_in", "_box", "_near", "_far"
    )
