"""The domain tables, derived from the provided ones, in Spark and as SQL text.

The provided keys are laid over 20 coarse zones of 4 fine zones of 5 statistical zones:
a mapping of every row, not a selection. A sale or a rent therefore knows its place
without a join, as a cleaned table does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import half_even, unit_price
from .registry import Tables

LAT0, LON0, LAT_STEP, LON_STEP = 48.81, 2.31, 0.008, 0.01
HALF_LAT, HALF_LON = 0.004, 0.005


def zone_of(key: Column) -> Column:
    return F.lpad((key % 20 + 1).cast("string"), 2, "0")


def quarter_no(key: Column) -> Column:
    return F.floor(key / 20).cast("bigint") % 4 + 1


def code_of(key: Column) -> Column:
    return F.concat(F.lit("751"), zone_of(key), F.lpad(quarter_no(key).cast("string"), 2, "0"))


def iris_of(key: Column) -> Column:
    return F.concat(code_of(key), F.lpad((F.floor(key / 80).cast("bigint") % 5).cast("string"), 2, "0"))


def z(key: str) -> str:
    return f"lpad(cast({key} % 20 + 1 as varchar), 2, '0')"


def q(key: str) -> str:
    return f"('751' || {z(key)} || lpad(cast(({key} // 20) % 4 + 1 as varchar), 2, '0'))"


def i(key: str) -> str:
    return f"({q(key)} || lpad(cast(({key} // 80) % 5 as varchar), 2, '0'))"


# -- sales --------------------------------------------------------------------------


def raw_sales(t: Tables) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", "Appartement").when(F.col("l_returnflag") == "N", " Maison ").otherwise(
        "Dépendance"
    )
    return t.lineitem.select(
        F.col("l_linestatus").alias("source"),
        F.col("l_shipdate").alias("date_mutation"),
        F.col("l_extendedprice").alias("valeur_fonciere"),
        F.col("l_quantity").alias("surface_reelle_bati"),
        kind.alias("type_local"),
        zone_of(F.col("l_suppkey")).alias("arrondissement"),
        code_of(F.col("l_suppkey")).alias("code_insee_quartier"),
        F.year("l_shipdate").alias("annee"),
        unit_price(F.col("l_extendedprice"), F.col("l_quantity")).alias("prix_m2"),
    )


RAW_SALES = f"""raw_sales as (
  select l_linestatus as source, l_shipdate as date_mutation, l_extendedprice as valeur_fonciere,
    l_quantity as surface_reelle_bati,
    case l_returnflag when 'A' then 'Appartement' when 'N' then ' Maison ' else 'Dépendance' end as type_local,
    {z('l_suppkey')} as arrondissement, {q('l_suppkey')} as code_insee_quartier,
    cast(year(l_shipdate) as integer) as annee, l_extendedprice / l_quantity as prix_m2
  from lineitem)"""

VALID_SALES = f"""{RAW_SALES}, valid_sales as (
  select * from raw_sales
  where surface_reelle_bati > 9 and surface_reelle_bati < 500 and valeur_fonciere > 10000
    and lower(trim(type_local)) in ('appartement', 'maison'))"""

SALES = f"""{VALID_SALES}, bounds as (
  select source, quantile_cont(prix_m2, 0.01) as lo, quantile_cont(prix_m2, 0.99) as hi
  from valid_sales group by source), sales as (
  select v.* from valid_sales v join bounds b on v.source = b.source where v.prix_m2 between b.lo and b.hi)"""


# -- rents --------------------------------------------------------------------------


def rents(t: Tables) -> DataFrame:
    """Rents of orders; every rent carries its fine-zone code."""
    return t.orders.select(
        F.year("o_orderdate").alias("annee"),
        zone_of(F.col("o_custkey")).alias("arrondissement"),
        code_of(F.col("o_custkey")).alias("code_insee_quartier"),
        F.col("o_totalprice").alias("loyer_reference"),
        (F.col("o_totalprice") * 1.25).alias("loyer_reference_majore"),
        (F.col("o_totalprice") * 0.75).alias("loyer_reference_minore"),
        (F.month("o_orderdate") % 4 + 1).cast("double").alias("nombre_pieces_principales"),
        F.concat(F.lit("Quartier "), F.substring("o_orderpriority", 1, 1)).alias("nom_quartier"),
        F.col("o_orderstatus").alias("type_location"),
        F.col("o_orderpriority").alias("epoque_construction"),
    )


RENTS = f"""rents as (
  select cast(year(o_orderdate) as integer) as annee, {z('o_custkey')} as arrondissement,
    {q('o_custkey')} as code_insee_quartier, o_totalprice as loyer_reference,
    o_totalprice * 1.25 as loyer_reference_majore, o_totalprice * 0.75 as loyer_reference_minore,
    cast(month(o_orderdate) % 4 + 1 as double) as nombre_pieces_principales,
    'Quartier ' || substr(o_orderpriority, 1, 1) as nom_quartier,
    o_orderstatus as type_location, o_orderpriority as epoque_construction
  from orders)"""


# -- zone dimension -----------------------------------------------------------------


def quarters(t: Tables) -> DataFrame:
    """80 fine zones on a grid, with an area summed from their customers."""
    return t.once("quarters dimension", lambda: _quarters(t))


def _quarters(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    index = (key % 20) * 4 + quarter_no(key) - 1
    base = t.customer.groupBy(
        zone_of(key).alias("arrondissement"),
        F.lpad(quarter_no(key).cast("string"), 2, "0").alias("code_quartier_id"),
        code_of(key).alias("code_insee_quartier"),
        index.alias("_n"),
    ).agg(F.sum(F.col("c_acctbal") + 1000.0).alias("surface_quartier_m2"))
    lat = half_even(F.lit(LAT0) + F.lit(LAT_STEP) * (F.col("_n") % 10) + HALF_LAT, 6)
    lon = half_even(F.lit(LON0) + F.lit(LON_STEP) * F.floor(F.col("_n") / 10) + HALF_LON, 6)
    return base.withColumns({"lat_q": lat, "lon_q": lon}).select(
        "arrondissement",
        "code_quartier_id",
        "code_insee_quartier",
        F.concat(F.lit("Place-Été "), F.col("code_insee_quartier")).alias("nom_quartier"),
        "surface_quartier_m2",
        F.concat_ws(",", F.col("lat_q").cast("string"), F.col("lon_q").cast("string")).alias("geometry_xy"),
        "lat_q",
        "lon_q",
    )


QUARTERS = f"""quarters as (
  select {z('c_custkey')} as arrondissement, lpad(cast((c_custkey // 20) % 4 + 1 as varchar), 2, '0') as code_quartier_id,
    {q('c_custkey')} as code_insee_quartier, 'Place-Été ' || {q('c_custkey')} as nom_quartier,
    sum(c_acctbal + 1000.0) as surface_quartier_m2,
    round_even({LAT0} + {LAT_STEP} * (((c_custkey % 20) * 4 + (c_custkey // 20) % 4) % 10) + {HALF_LAT}, 6)::double as lat_q,
    round_even({LON0} + {LON_STEP} * (((c_custkey % 20) * 4 + (c_custkey // 20) % 4) // 10) + {HALF_LON}, 6)::double as lon_q
  from customer group by all), shares as (
  select *, surface_quartier_m2 / sum(surface_quartier_m2) over (partition by arrondissement) as part_surface
  from quarters)"""


def iris(t: Tables) -> DataFrame:
    """400 statistical zones, each near its fine zone."""
    key = F.col("c_custkey")
    index = (key % 20) * 4 + quarter_no(key) - 1
    fifth = F.floor(key / 80).cast("bigint") % 5
    base = t.customer.groupBy(
        iris_of(key).alias("CODE_IRIS"),
        F.concat(F.lit("751"), zone_of(key)).alias("INSEE_COM"),
        F.concat(F.lit(" Iris "), (key % 3).cast("string")).alias("NOM_IRIS"),
        index.alias("_n"),
        fifth.alias("_f"),
    ).agg(F.count(F.lit(1)).alias("n"))
    lat = half_even(F.lit(LAT0) + F.lit(LAT_STEP) * (F.col("_n") % 10) + F.lit(0.0011) * F.col("_f"), 6)
    lon = half_even(F.lit(LON0) + F.lit(LON_STEP) * F.floor(F.col("_n") / 10) + F.lit(0.0023) * F.col("_f"), 6)
    return base.groupBy("CODE_IRIS", "INSEE_COM", lat.alias("lat"), lon.alias("lon")).agg(
        F.min("NOM_IRIS").alias("NOM_IRIS")
    ).select(
        "INSEE_COM", "CODE_IRIS", "NOM_IRIS",
        F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string")).alias("Geo Point"),
    )


IRIS = f"""iris as (
  select {i('c_custkey')} as code_iris, {z('c_custkey')} as arrondissement,
    min('Iris ' || cast(c_custkey % 3 as varchar)) as nom_iris,
    round_even({LAT0} + {LAT_STEP} * (((c_custkey % 20) * 4 + (c_custkey // 20) % 4) % 10) + 0.0011 * ((c_custkey // 80) % 5), 6)::double as lat,
    round_even({LON0} + {LON_STEP} * (((c_custkey % 20) * 4 + (c_custkey // 20) % 4) // 10) + 0.0023 * ((c_custkey // 80) % 5), 6)::double as lon
  from customer group by all)"""


# -- events -------------------------------------------------------------------------


def crime(t: Tables) -> DataFrame:
    return t.events.select(
        F.dayofmonth("ts").alias("annee"),
        zone_of(F.col("user_id")).alias("arrondissement"),
        F.col("event_type").alias("indicateur"),
        F.col("value").alias("taux_effectif"),
    )


CRIME = f"""crime as (
  select cast(day(ts) as integer) as annee, {z('user_id')} as arrondissement, event_type as indicateur,
    value as taux_effectif from events)"""


def located_events(t: Tables, kind: str) -> DataFrame:
    """Events of one kind with the zone and fine zone of their user."""
    return t.events.where(F.col("event_type") == kind).select(
        "event_id",
        zone_of(F.col("user_id")).alias("arrondissement"),
        code_of(F.col("user_id")).alias("code_insee_quartier"),
        "value",
        "props",
    )


# -- points -------------------------------------------------------------------------


def _axis(origin: float, at: int) -> Column:
    return half_even(F.lit(origin) + F.col("embedding")[at].cast("double") / 10, 6)


def points(t: Tables) -> DataFrame:
    """A cloud of places: one per vector, from its first two components."""
    return t.embeddings.select(
        F.col("vec_id").alias("id"),
        F.lpad((F.col("label") + 1).cast("string"), 2, "0").alias("zone"),
        _axis(48.85, 0).alias("lat"),
        _axis(2.35, 1).alias("lon"),
    )


def stations(t: Tables) -> DataFrame:
    """A second cloud: one place per vector, from its third and fourth components."""
    return t.embeddings.select(
        F.col("vec_id").alias("code"),
        F.lpad((F.col("label") + 1).cast("string"), 2, "0").alias("zone"),
        _axis(48.85, 2).alias("lat"),
        _axis(2.35, 3).alias("lon"),
    )


POINTS = """points as (
  select vec_id as id, lpad(cast(label + 1 as varchar), 2, '0') as zone,
    round_even(48.85 + embedding[1]::double / 10, 6) as lat, round_even(2.35 + embedding[2]::double / 10, 6) as lon
  from embeddings), stations as (
  select vec_id as code, lpad(cast(label + 1 as varchar), 2, '0') as zone,
    round_even(48.85 + embedding[3]::double / 10, 6) as lat, round_even(2.35 + embedding[4]::double / 10, 6) as lon
  from embeddings)"""


def dist_sql(lat1: str, lon1: str, lat2: str, lon2: str, km: str = "111.0") -> str:
    dx = f"(({lon2}) - ({lon1})) * {km}::double * cos(radians({lat1}))"
    dy = f"(({lat2}) - ({lat1})) * {km}::double"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def with_sql(*ctes: str, select: str) -> str:
    """A statement from CTE texts; a ``select`` that starts with a comma adds CTEs of its own."""
    return "with " + ",\n".join(ctes) + "\n" + select.strip()
