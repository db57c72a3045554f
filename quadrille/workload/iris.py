"""Sales in statistical zones, and the target table of one row per zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import polygons_of
from ..functions.numbers import half_even
from ..operators.spatial import containing_areas
from ..plans import clean
from ..plans import indicators as kpi
from ..session import stage
from .prices import rounded
from .registry import Tables, query
from .standins import HALF_LAT, HALF_LON, LAT0, LAT_STEP, LON0, LON_STEP, QUARTERS, RENTS, code_of, q, quarters, rents, with_sql, z, zone_of

STRIPS = 5
WIDTH = 0.002


def shapes(t: Tables) -> DataFrame:
    """Five strips to a fine zone: plain ones, one with a hole in its middle, one of two parts."""

    def ring(x0, x1, y0, y1):
        spots = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        text = [F.concat(F.lit("["), half_even(x, 6).cast("string"), F.lit(","), half_even(y, 6).cast("string"), F.lit("]")) for x, y in spots]
        return F.concat(F.lit("["), F.concat_ws(",", *text), F.lit("]"))

    rows = quarters(t).select("arrondissement", "code_insee_quartier", "lat_q", "lon_q", F.explode(F.sequence(F.lit(0), F.lit(STRIPS - 1))).alias("k"))
    west, lat = F.col("lon_q") - HALF_LON + F.lit(WIDTH) * F.col("k"), F.col("lat_q")
    whole = ring(west, west + WIDTH, lat - HALF_LAT, lat + HALF_LAT)
    hole = ring(west + 0.0005, west + 0.0015, lat - 0.002, lat + 0.002)
    parts = [ring(west, west + WIDTH, lat - HALF_LAT, lat - 0.001), ring(west, west + WIDTH, lat + 0.001, lat + HALF_LAT)]

    def shape(kind: str, *pieces):
        return F.concat(F.lit('{"type":"%s","coordinates":[' % kind), *pieces, F.lit("]}"))

    text = (
        F.when(F.col("k") == 2, shape("Polygon", whole, F.lit(","), hole))
        .when(F.col("k") == 4, shape("MultiPolygon", F.lit("["), parts[0], F.lit("],["), parts[1], F.lit("]")))
        .otherwise(shape("Polygon", whole))
    )
    code = F.concat("code_insee_quartier", F.lpad(F.col("k").cast("string"), 2, "0"))
    return rows.select(code.alias("code_iris"), "code_insee_quartier", "arrondissement", polygons_of(text).alias("polygons"))


def sale_points(t: Tables) -> DataFrame:
    """Valid sales with a point in or near their fine zone, off all edges."""
    key = F.col("l_suppkey")
    index = (key % 20) * 4 + F.floor(key / 20).cast("bigint") % 4
    east = ((F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 1000) / 1000 * 0.012 - 0.006
    north = ((F.col("l_orderkey") * 53 + F.col("l_partkey")) % 1000) / 1000 * 0.010 - 0.005
    kind = F.when(F.col("l_returnflag") == "A", "Appartement").when(F.col("l_returnflag") == "N", " Maison ").otherwise("Dépendance")
    rows = t.lineitem.select(
        F.monotonically_increasing_id().alias("id"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("valeur_fonciere"),
        F.col("l_quantity").alias("surface_reelle_bati"),
        kind.alias("type_local"),
        zone_of(key).alias("arrondissement"),
        code_of(key).alias("code_insee_quartier"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("prix_m2"),
        (half_even(F.lit(LAT0) + F.lit(LAT_STEP) * (index % 10) + HALF_LAT + north, 6) + 3e-7).alias("lat"),
        (half_even(F.lit(LON0) + F.lit(LON_STEP) * F.floor(index / 10) + HALF_LON + east, 6) + 3e-7).alias("lon"),
    )
    return stage(clean.filter_valid_sales(rows))


PLACED = f"""{QUARTERS}, {RENTS}, shapes as (
  select code_insee_quartier || lpad(cast(k as varchar), 2, '0') as code_iris, code_insee_quartier, arrondissement, k, lat_q,
    round_even(lon_q - {HALF_LON} + {WIDTH} * k, 6)::double as west from quarters, range({STRIPS}) r(k)), sale_points as (
  select row_number() over () as id, l_orderkey, l_linenumber, {z('l_suppkey')} as arrondissement, {q('l_suppkey')} as code_insee_quartier, l_extendedprice / l_quantity as prix_m2,
    round_even({LAT0} + {LAT_STEP} * (((l_suppkey % 20) * 4 + (l_suppkey // 20) % 4) % 10) + {HALF_LAT}
      + ((l_orderkey * 53 + l_partkey) % 1000) / 1000::double * 0.010 - 0.005, 6)::double + 3e-7 as lat,
    round_even({LON0} + {LON_STEP} * (((l_suppkey % 20) * 4 + (l_suppkey // 20) % 4) // 10) + {HALF_LON}
      + ((l_orderkey * 37 + l_linenumber * 11) % 1000) / 1000::double * 0.012 - 0.006, 6)::double + 3e-7 as lon
  from lineitem where l_quantity > 9 and l_quantity < 500 and l_extendedprice > 10000 and l_returnflag in ('A', 'N')), placed as (
  select p.*, s.code_iris, coalesce(s.code_insee_quartier, p.code_insee_quartier) as fine, coalesce(s.arrondissement, p.arrondissement) as coarse
  from sale_points p left join shapes s on lon > west and lon < west + {WIDTH} and abs(lat - lat_q) < {HALF_LAT}
    and not (k = 2 and lon > west + 0.0005 and lon < west + 0.0015 and abs(lat - lat_q) < 0.002) and not (k = 4 and abs(lat - lat_q) < 0.001))"""


@query("sales_in_iris", with_sql(PLACED, select="""
select l_orderkey, l_linenumber, code_iris, round_even(prix_m2, 6) as prix_m2 from placed"""))
def sales_in_iris(t: Tables) -> DataFrame:
    """Every sale with the statistical zone whose polygon holds its point: holes and second parts count."""
    found = containing_areas(sale_points(t), shapes(t), code="code_iris", out="code_iris")
    return rounded(found.select("l_orderkey", "l_linenumber", "code_iris", "prix_m2"))


@query("kpi_by_iris", with_sql(PLACED, select=f"""
, price as (select niveau, cle, avg(prix_m2) as p, quantile_cont(prix_m2, 0.5) as m, count(*) as n
  from (select unnest(['iris', 'quartier', 'arrondissement']) as niveau, unnest([code_iris, fine, coarse]) as cle, prix_m2 from placed)
  where cle is not null group by all), rent as (select niveau, cle, avg(loyer_reference) as r, count(*) as n
  from (select unnest(['quartier', 'arrondissement']) as niveau, unnest([code_insee_quartier, arrondissement]) as cle, loyer_reference from rents)
  group by all), homes as (select lpad(cast(label % 20 + 1 as varchar), 2, '0') as arrondissement, sum(vec_id % 50 + 1)::bigint as n from embeddings group by all),
wide as (select s.code_iris, coalesce(i.n, 0) as nb, homes.n as homes,
    case when i.n >= 5 then i.p when f.n >= 5 then f.p else c.p end as p, case when i.n >= 5 then i.m when f.n >= 5 then f.m else c.m end as m,
    case when i.n >= 5 then 'iris' when f.n >= 5 then 'quartier' when c.n > 0 then 'arrondissement' end as at_price,
    case when g.n >= 5 then g.r else h.r end as r, case when g.n >= 5 then 'quartier' when h.n > 0 then 'arrondissement' end as at_rent
  from shapes s left join price i on i.niveau = 'iris' and i.cle = s.code_iris
  left join price f on f.niveau = 'quartier' and f.cle = s.code_insee_quartier
  left join price c on c.niveau = 'arrondissement' and c.cle = s.arrondissement
  left join rent g on g.niveau = 'quartier' and g.cle = s.code_insee_quartier
  left join rent h on h.niveau = 'arrondissement' and h.cle = s.arrondissement
  left join homes on homes.arrondissement = s.arrondissement)
select code_iris, round_even(p, 4) as prix_m2_moyen, round_even(m, 4) as prix_m2_median, nb as nb_transactions, round_even(r, 4) as loyer_moyen,
  round_even(r * 1200 / p, 4) as rentabilite, round_even(p / r, 4) as tension_immobiliere, coalesce(homes, 0) as nb_logements_sociaux,
  at_price as niveau_prix, at_rent as niveau_loyer from wide"""))
def kpi_by_iris(t: Tables) -> DataFrame:
    """The target table: eight figures per statistical zone, and the levels that price and rent come from."""
    housing = t.embeddings.select(
        F.lpad((F.col("label") % 20 + 1).cast("string"), 2, "0").alias("arrondissement"),
        (F.col("vec_id") % 50 + 1).alias("nb_logements_finances"),
    )
    return rounded(kpi.kpi_by_iris(sale_points(t), rents(t), housing, shapes(t)), 4)
