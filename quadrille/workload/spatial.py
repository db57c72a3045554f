"""Points, nearest references, radius counts and containment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import point_from_any, polygon_text, polygons_of, outer_box, split_point
from ..functions.numbers import half_even
from ..operators.spatial import (
    assign_area, containing_areas, count_within, nearest, squared_degrees, within_distance,
)
from ..plans import clean
from ..plans import indicators as kpi
from .prices import rounded
from .registry import Tables, query
from .standins import HALF_LAT, HALF_LON, POINTS, QUARTERS, dist_sql, points, quarters, stations, with_sql

PS = dist_sql("p.lat", "p.lon", "s.lat", "s.lon")


@query("nearest_distance", with_sql(POINTS, select=f"""
select id, round_even(min({PS}), 6) as km from points p, stations s group by id"""))
def nearest_distance(t: Tables) -> DataFrame:
    out = nearest(points(t), stations(t), out_code="_code", out_distance="km")
    return rounded(out.select("id", "km"))


IN_GROUP = with_sql(POINTS, select=f"""
select id, zone, code, round_even(d, 6) as km from (
  select p.id, p.zone, s.code, {PS} as d, row_number() over (partition by p.id order by {PS}, s.code) as rn
  from points p join stations s on p.zone = s.zone) x where rn = 1""")


@query("nearest_in_group", IN_GROUP)
def nearest_in_group(t: Tables) -> DataFrame:
    out = nearest(points(t), stations(t), by=["zone"], out_code="code", out_distance="km")
    return rounded(out.select("id", "zone", "code", "km"))


@query("nearest_in_group_pyramid", IN_GROUP)
def nearest_in_group_pyramid(t: Tables) -> DataFrame:
    """The same answer by a tree of small leaves and nodes, so that it has several levels."""
    out = nearest(points(t), stations(t), by=["zone"], out_code="code", out_distance="km", leaf_refs=4, node_boxes=3)
    return rounded(out.select("id", "zone", "code", "km"))


CENTRES = """centres as (
  select zone, round_even(avg(lat), 6) as lat_c, round_even(avg(lon), 6) as lon_c from stations group by all)"""


def centres(t: Tables) -> DataFrame:
    return stations(t).groupBy("zone").agg(
        half_even(F.avg("lat"), 6).alias("lat_c"), half_even(F.avg("lon"), 6).alias("lon_c")
    )


@query("group_centroid", with_sql(POINTS, CENTRES, select="select * from centres"))
def group_centroid(t: Tables) -> DataFrame:
    return centres(t)


@query("nearest_centroid", with_sql(POINTS, CENTRES, select="""
select id, zone_c from (select p.id, c.zone as zone_c, row_number() over (partition by p.id order by
  (lat_c - lat) * (lat_c - lat) + (lon_c - lon) * (lon_c - lon), c.zone) as rn from points p, centres c) x where rn = 1"""))
def nearest_centroid(t: Tables) -> DataFrame:
    refs = centres(t).withColumnRenamed("zone", "code")
    out = nearest(
        points(t), refs, ref_lat="lat_c", ref_lon="lon_c", metric=squared_degrees, out_code="zone_c", out_distance="_d"
    )
    return out.select("id", "zone_c")


@query("count_within_radius", with_sql(QUARTERS, POINTS, select=f"""
select code_insee_quartier, count(case when {dist_sql('q.lat_q', 'q.lon_q', 'p.lat', 'p.lon', '111.32')} <= 0.8 then 1 end) as n
from quarters q, points p group by all"""))
def count_within_radius(t: Tables) -> DataFrame:
    zones = quarters(t).select("code_insee_quartier", "lat_q", "lon_q")
    out = count_within(zones, points(t), "code_insee_quartier", 0.8, "lat_q", "lon_q", km=111.32, out="n")
    return out.select("code_insee_quartier", "n")


HERE = (48.852, 2.348)


@query("within_distance", with_sql(POINTS, select=f"""
select id, zone, round_even(d, 6) as distance_km from (
  select id, zone, {dist_sql(str(HERE[0]) + '::double', str(HERE[1]) + '::double', 'p.lat', 'p.lon')} as d from points p) x where d <= 1.0"""))
def within_one_km(t: Tables) -> DataFrame:
    out = within_distance(points(t), *HERE, 1.0)
    return rounded(out.select("id", "zone", "distance_km")).orderBy("distance_km", "id")


@query("coverage_within_radius", with_sql(POINTS, select=f"""
, n as (select p.id, p.zone, min({PS}) as d from points p, stations s group by all)
select zone, round_even(avg(d), 6) as distance_moyenne_km, round_even(avg(case when d <= 0.5 then 1.0 else 0.0 end), 6) as part_couverte
from n group by all"""))
def coverage_within_radius(t: Tables) -> DataFrame:
    near = nearest(points(t), stations(t), out_code="_code", out_distance="km")
    return rounded(kpi.coverage(near, ["zone"], "km", 0.5))


INNER, OUTER = (48.845, 48.855, 2.345, 2.355), (48.83, 48.87, 2.33, 2.37)


@query("bbox_filter", with_sql(POINTS, select="""
select id, lat, lon from points
where ((lat between 48.845 and 48.855 and lon between 2.345 and 2.355) or zone in ('01', '10'))
  and lat between 48.83 and 48.87 and lon between 2.33 and 2.37"""))
def bbox_filter(t: Tables) -> DataFrame:
    """Inside the inner box or named after the city, and inside the outer box."""
    name = F.when(F.col("zone").isin("01", "10"), F.concat(F.lit("Gare de PARIS "), F.col("zone"))).otherwise("Halte")
    named = points(t).withColumn("nom", name)
    return clean.bbox_filter(named, [F.col("nom")], "lat", "lon", "Paris", INNER, OUTER).select("id", "lat", "lon")


def diamond(lat, lon):
    """A closed diamond around a centre as GeoJSON text."""

    def spot(x, y):
        return F.concat(F.lit("["), half_even(x, 6).cast("string"), F.lit(","), half_even(y, 6).cast("string"), F.lit("]"))

    ring = [spot(lon - HALF_LON, lat), spot(lon, lat - HALF_LAT), spot(lon + HALF_LON, lat), spot(lon, lat + HALF_LAT)]
    return F.concat(
        F.lit('{"type":"Polygon","coordinates":[['), F.concat_ws(",", *ring, ring[0]), F.lit("]]}")
    )


def areas(t: Tables) -> DataFrame:
    """The fine zones as diamonds: GeoJSON text, parsed rings and centre."""
    shaped = quarters(t).select(
        F.col("code_insee_quartier").alias("code"),
        diamond(F.col("lat_q"), F.col("lon_q")).alias("shape"),
        F.col("lat_q").alias("lat_c"),
        F.col("lon_q").alias("lon_c"),
    )
    shaped = t.once("areas", lambda: shaped)
    return shaped.withColumn("polygons", polygons_of(F.col("shape")))


def located(t: Tables) -> DataFrame:
    """Points moved off the grid lines, where two answers would be equally right."""
    return points(t).withColumns({"lat": F.col("lat") + 3e-7, "lon": F.col("lon") + 3e-7})


HITS = f"""{POINTS}, {QUARTERS}, hits as (
  select p.id, min(case when abs(p.lon + 3e-7 - lon_q) / {HALF_LON}::double + abs(p.lat + 3e-7 - lat_q) / {HALF_LAT}::double < 1
      then code_insee_quartier end) as inside,
    min(case when abs(p.lon + 3e-7 - lon_q) <= {HALF_LON} and abs(p.lat + 3e-7 - lat_q) <= {HALF_LAT}
      then code_insee_quartier end) as box,
    min_by(code_insee_quartier, (lat_q - p.lat - 3e-7) ** 2 + (lon_q - p.lon - 3e-7) ** 2) as near
  from points p, quarters q group by p.id)"""


@query("point_in_polygon", with_sql(HITS, select="select id, inside as code from hits"))
def point_in_polygon(t: Tables) -> DataFrame:
    return containing_areas(located(t), areas(t), out="area").select("id", F.col("area").alias("code"))


@query("point_in_bbox", with_sql(HITS, select="select id, box as code from hits"))
def point_in_bbox(t: Tables) -> DataFrame:
    return containing_areas(located(t), areas(t), out="_in", out_box="area").select("id", F.col("area").alias("code"))


@query("assign_zone", with_sql(HITS, select="""
select id, coalesce(inside, box, near) as code,
  case when inside is not null then 'polygon' when box is not null then 'box' else 'nearest' end as matched_by from hits"""))
def assign_zone(t: Tables) -> DataFrame:
    """Polygon, else box, else nearest centre."""
    out = assign_area(located(t), areas(t), out="area")
    return out.select("id", F.col("area").alias("code"), "matched_by")


@query("parse_polygon", with_sql(QUARTERS, select=f"""
select code_insee_quartier as code, case when cast(substr(code_insee_quartier, 4, 2) as integer) % 4 in (0, 1) then true else false end as is_area,
  case when cast(substr(code_insee_quartier, 4, 2) as integer) % 4 in (0, 1) then round_even(lon_q - {HALF_LON}, 6) end as x0,
  case when cast(substr(code_insee_quartier, 4, 2) as integer) % 4 in (0, 1) then round_even(lat_q + {HALF_LAT}, 6) end as y1
from quarters"""))
def parse_polygon(t: Tables) -> DataFrame:
    """Polygon, MultiPolygon, broken text and a point: only the first two are areas."""
    kind = F.substring("code", 4, 2).cast("int") % 4
    many = F.regexp_replace(
        F.regexp_replace("shape", r'"Polygon","coordinates":', '"MultiPolygon","coordinates":['), r"\}$", "]}"
    )
    text = (
        F.when(kind == 0, F.col("shape"))
        .when(kind == 1, many)
        .when(kind == 2, F.regexp_replace("shape", r"\]\]\}$", ""))
        .otherwise('{"type":"Point","coordinates":[2.35,48.85]}')
    )
    rows = areas(t).select("code", text.alias("text"))
    box = outer_box(polygons_of(F.col("text")))
    return rows.select(
        "code", polygon_text(F.col("text")).isNotNull().alias("is_area"), box["x0"].alias("x0"), box["y1"].alias("y1")
    )


@query("point_from_any", with_sql(POINTS, select="""
select id, case when id % 4 = 3 then null else lon end as lon, case when id % 4 = 3 then null else lat end as lat from points"""))
def point_anywhere(t: Tables) -> DataFrame:
    """A point kept in number columns, in a GeoJSON text or in a comma text, or nowhere."""
    kind = F.col("id") % 4
    lat, lon = F.col("lat").cast("string"), F.col("lon").cast("string")
    json = F.concat(F.lit('{"type":"Point","coordinates":['), lon, F.lit(","), lat, F.lit("]}"))
    rows = points(t).select(
        "id",
        F.when(kind == 0, lon).otherwise("").alias("longitude"),
        F.when(kind == 0, lat).otherwise("inconnu").alias("latitude"),
        F.when(kind == 1, F.concat(lat, F.lit(" , "), lon)).when(kind == 3, "nan").alias("geo_point_2d"),
        F.when(kind == 2, json).otherwise("None").alias("geometry"),
    )
    point = point_from_any(rows.columns)
    return rows.select("id", point["lon"].alias("lon"), point["lat"].alias("lat"))


@query("split_point", with_sql(POINTS, select="""
select id, case when id % 3 = 2 then null else lat end as lat, case when id % 3 > 0 then null else lon end as lon from points"""))
def split_points(t: Tables) -> DataFrame:
    """``lat,lon``; a text without comma has a latitude only; a text without number has none."""
    kind, lat, lon = F.col("id") % 3, F.col("lat").cast("string"), F.col("lon").cast("string")
    text = F.when(kind == 0, F.concat(lat, F.lit(", "), lon)).when(kind == 1, lat).otherwise("inconnu,2.35x")
    rows = points(t).select("id", text.alias("text"))
    first, second = split_point(F.col("text"))
    return rows.select("id", first.alias("lat"), second.alias("lon"))


@query("social_housing_by_nearest", with_sql(POINTS, QUARTERS, select=f"""
, programmes as (select vec_id as id, {"lpad(cast(label % 20 + 1 as varchar), 2, '0')"} as arrondissement, lat + 3.17e-7 as lat, lon + 3.17e-7 as lon,
    cast(vec_id % 50 + 1 as integer) as nb, cast(2000 + vec_id % 3 as integer) as annee, cast(label as varchar) as landlord
  from embeddings join points on vec_id = id), m as (
  select p.*, code_insee_quartier, nom_quartier, row_number() over (partition by id order by
    {dist_sql('p.lat', 'p.lon', 'q.lat_q', 'q.lon_q')}, code_insee_quartier) as rn
  from programmes p join quarters q on p.arrondissement = q.arrondissement)
select annee, arrondissement, code_insee_quartier, nom_quartier, sum(nb)::bigint as logements_finances_total,
  round_even(avg(nb), 2) as logements_finances_moyen, count(*) as nb_programmes, count(distinct landlord) as nb_bailleurs,
  round_even(avg(lat), 6) as latitude_moyenne, round_even(avg(lon), 6) as longitude_moyenne
from m where rn = 1 group by annee, arrondissement, code_insee_quartier, nom_quartier"""))
def social_housing_by_nearest(t: Tables) -> DataFrame:
    """Programmes given to the nearest fine zone of their own zone, then summed.

    The small offset keeps mean positions off the half-way points of the rounding.
    """
    programmes = points(t).join(t.embeddings.select(F.col("vec_id").alias("id"), "label"), "id").select(
        F.lpad((F.col("label") % 20 + 1).cast("string"), 2, "0").alias("arrondissement"),
        (F.col("lat") + 3.17e-7).alias("latitude"),
        (F.col("lon") + 3.17e-7).alias("longitude"),
        (F.col("id") % 50 + 1).cast("int").alias("nb_logements_finances"),
        (F.col("id") % 3 + 2000).cast("int").alias("annee"),
        F.col("label").cast("string").alias("bailleur_social"),
    )
    return kpi.social_housing_by_quarter(programmes, quarters(t))
