"""The cleaning jobs themselves: whole tables rendered as raw text under the raw headers, next to their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import clean
from .prices import rounded
from .registry import Tables, query
from .standins import QUARTERS, SALES, code_of, iris, q, quarters, with_sql, z, zone_of


def text(col: Column) -> Column:
    return col.cast("string")


def comma(col: Column) -> Column:
    """A number with a decimal comma."""
    return F.translate(text(col), ".", ",")


def raw_sale_files(t: Tables) -> list[DataFrame]:
    """Two sales files, every line of the table in one of them."""
    kind = F.when(F.col("l_returnflag") == "A", "Appartement").when(F.col("l_returnflag") == "N", " Maison ").otherwise("Dépendance")
    rows = t.lineitem.select(
        F.concat(F.lit("m"), text(F.col("l_orderkey"))).alias("ID_mutation"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Date mutation"),
        comma(F.col("l_extendedprice")).alias("Valeur foncière"),
        F.concat(F.lit("750"), zone_of(F.col("l_suppkey")), F.lit(".0")).alias("Code postal"),
        kind.alias("Type local"),
        text(F.col("l_quantity")).alias("Surface reelle bati"),
        F.col("l_linestatus").alias("file"),
    )
    return [rows.where(F.col("file") == name).drop("file") for name in ("F", "O")]


@query("clean_sales", with_sql(SALES, select="""
select distinct 'm' || s.l_orderkey as id_mutation, date_mutation::date::varchar as jour, valeur_fonciere, surface_reelle_bati,
  trim(type_local) as type_local, '750' || arrondissement as code_postal, arrondissement, annee, round_even(prix_m2, 6) as prix_m2
from sales s""").replace("select l_linestatus as source,", "select l_orderkey, l_linestatus as source,"))
def clean_sales(t: Tables) -> DataFrame:
    """Text parsing, filters, trim per file, union and exact dedupe."""
    out = clean.clean_sales(raw_sale_files(t)).withColumn("jour", F.date_format("date_mutation", "yyyy-MM-dd"))
    return rounded(out.drop("date_mutation"))


@query("clean_social_housing", f"""
select distinct {z('p_partkey')} as arrondissement, '750' || {z('p_partkey')} as code_postal, 2000 + (p_size % 25)::integer as annee_financement,
  p_size::bigint as nb_logements_finances, case when p_size % 2 = 0 then p_size // 2 else 0 end::bigint as nb_plus,
  p_name as bailleur_social, round_even(48.8 + p_size / 1000.0::double, 6) as latitude, 2.25::double as longitude from part""")
def clean_social_housing(t: Tables) -> DataFrame:
    """The same extract under two names: every programme once."""
    size = F.col("p_size")
    raw = t.part.select(
        F.concat(F.lit("750"), zone_of(F.col("p_partkey"))).alias("Code postal"),
        F.lit("Paris").alias("Ville"),
        text(2000 + size % 25).alias("Année du financement - agrément"),
        F.concat(F.lit(" "), F.col("p_name")).alias("Bailleur social"),
        F.concat(text(size), F.lit(",0")).alias("Nombre total de logements financés"),
        F.when(size % 2 == 0, text(F.floor(size / 2))).otherwise("").alias("Dont nombre de logements PLUS"),
        F.concat(text(F.round(48.8 + size / 1000.0, 6)), F.lit(", 2.25")).alias("geo_point_2d"),
        zone_of(F.col("p_partkey")).alias("Arrondissement"),
    )
    out = clean.clean_social_housing([raw, raw])
    return rounded(
        out.select(
            "arrondissement", "code_postal", "annee_financement", "nb_logements_finances", "nb_plus", "bailleur_social", "latitude", "longitude"
        )
    )


@query("clean_rents", f"""
select distinct cast(year(o_orderdate) as integer) as annee, {z('o_custkey')} as arrondissement, {q('o_custkey')} as code_insee_quartier,
  round_even(o_totalprice, 6) as loyer_reference, o_orderstatus as type_location, lower(o_orderpriority) <> '' as epoque from orders""")
def clean_rents(t: Tables) -> DataFrame:
    raw = t.orders.select(
        text(F.year("o_orderdate")).alias("Année"),
        text(F.col("o_custkey") % 20 + 1).alias("Secteurs géographiques"),
        code_of(F.col("o_custkey")).alias("Numéro INSEE du quartier"),
        comma(F.col("o_totalprice")).alias("Loyers de référence"),
        F.concat(F.lit(" "), F.col("o_orderstatus")).alias("Type de location"),
        F.col("o_orderpriority").alias("Époque de construction"),
    )
    out = clean.clean_rents(raw).withColumn("epoque", F.col("epoque_construction_norm") != "")
    return rounded(out.select("annee", "arrondissement", "code_insee_quartier", "loyer_reference", "type_location", "epoque")).distinct()


@query("clean_crime", f"""
select cast(year(ts) as integer) as annee, {z('user_id')} as arrondissement, event_type as indicateur,
  case when event_type = 'click' then 0 else event_id end::bigint as faits,
  round_even(case when event_type = 'error' then event_id / 4.0::double else value end, 6) as taux_effectif from events""")
def clean_crime(t: Tables) -> DataFrame:
    """Withheld main rates (errors) take the complementary rate; absent counts are zero. No two raw lines are equal."""
    kind = F.col("event_type")
    raw = t.events.select(
        F.concat(F.lit("751"), zone_of(F.col("user_id"))).alias("CODGEO_2025"),
        text(F.year("ts")).alias("annee"),
        F.concat(F.lit(" "), kind, F.lit(" ")).alias("indicateur"),
        F.when(kind != "click", text(F.col("event_id"))).alias("nombre"),
        F.when(kind != "error", comma(F.col("value"))).alias("taux_pour_mille"),
        comma(F.col("event_id") / 4).alias("complement_info_taux"),
    )
    return rounded(clean.clean_crime(raw).select("annee", "arrondissement", "indicateur", "faits", "taux_effectif"))


PLACE = "48.8::double + c_custkey / 100000.0::double"


def place(lat: Column, lon: str = "2.3") -> Column:
    return F.concat(text(lat), F.lit(f", {lon}"))


def customer_lat() -> Column:
    return F.lit(48.8) + F.col("c_custkey") / 100000.0


@query("clean_police_stations", f"""
select distinct {z('c_custkey')} as arrondissement, '750' || {z('c_custkey')} as code_postal, c_name as nom,
  round_even({PLACE}, 6) as latitude, 2.3::double as longitude from customer where c_custkey % 5 <> 0 and c_custkey % 7 <> 0""")
def clean_police_stations(t: Tables) -> DataFrame:
    """Suburban stations and those without a point go."""
    key = F.col("c_custkey")
    raw = t.customer.select(
        F.col("c_name").alias("Nom"),
        F.concat(F.when(key % 5 == 0, "920").otherwise("750"), zone_of(key)).alias("Code postal"),
        F.when(key % 7 != 0, place(customer_lat())).alias("geo_point_2d"),
    )
    out = clean.clean_police_stations(raw)
    return rounded(out.select("arrondissement", "code_postal", F.col("nom"), "latitude", "longitude"))


@query("clean_cameras", f"""
select distinct {z('c_custkey')} as arrondissement, c_custkey::varchar as numero, round_even({PLACE}, 6) as latitude
from customer where c_custkey % 7 <> 0""")
def clean_cameras(t: Tables) -> DataFrame:
    """Both ways to write a zone."""
    key = F.col("c_custkey")
    raw = t.customer.select(
        text(key).alias("NUMÉRO"),
        F.when(key % 2 == 0, text(key % 20 + 1)).otherwise(F.concat(F.lit("750"), zone_of(key))).alias("ARRONDISSEMENT"),
        F.when(key % 7 != 0, place(customer_lat())).alias("coordonnees"),
    )
    return rounded(clean.clean_cameras(raw).select("arrondissement", "numero", "latitude"))


@query("clean_reports", f"""
select distinct 2024::integer as annee, {z('user_id')} as arrondissement, event_type as type_objet, '750' || {z('user_id')} as code_postal,
  event_id::varchar as sous_type_objet from events where event_type <> 'signup'""")
def clean_reports(t: Tables) -> DataFrame:
    """Cancelled reports go, whatever their case and accents."""
    raw = t.events.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Date du signalement"),
        F.when(F.col("event_type") == "signup", " Annulé ").otherwise("Clos").alias("Etat"),
        F.col("event_type").alias("Type objet"),
        text(F.col("event_id")).alias("Sous type objet"),
        F.concat(F.lit("750"), zone_of(F.col("user_id"))).alias("Code postal"),
    )
    out = clean.clean_reports(raw)
    return out.select("annee", "arrondissement", "type_objet", "code_postal", "sous_type_objet")


@query("clean_stations", f"""
select distinct c_name as nom_gare, round_even({PLACE}, 6) as latitude, 2.3::double as longitude from customer where c_custkey % 7 <> 0""")
def clean_stations(t: Tables) -> DataFrame:
    raw = t.customer.select(
        F.when(F.col("c_custkey") % 7 != 0, place(customer_lat())).alias("Geo Point"),
        F.concat(F.lit(" "), F.col("c_name")).alias("nom_long"),
    )
    return rounded(clean.clean_stations(raw).select("nom_gare", "latitude", "longitude"))


@query("clean_works", f"""
select distinct p_name as titre_operation, p_type as categorie_operation, {z('p_partkey')} as arrondissement,
  cast(2000 + p_size % 20 as integer) as annee from part where p_size % 9 <> 0""")
def clean_works(t: Tables) -> DataFrame:
    """Works without a title go; the year is that of the first date column."""
    size = F.col("p_size")
    raw = t.part.select(
        F.when(size % 9 != 0, F.concat(F.lit(" "), F.col("p_name"))).alias("Titre"),
        F.col("p_type").alias("Catégorie"),
        text(F.col("p_partkey") % 20 + 1).alias("Arrondissement"),
        F.concat(text(2000 + size % 20), F.lit("-05-06")).alias("Date de livraison"),
    )
    return clean.clean_works(raw).select("titre_operation", "categorie_operation", "arrondissement", "annee")


@query("clean_quarters", with_sql(QUARTERS, select="""
select arrondissement, substr(code_insee_quartier, 6, 2) as code_quartier_id, code_insee_quartier, nom_quartier,
  round_even(surface_quartier_m2, 4) as surface_quartier_m2 from quarters"""))
def clean_quarters(t: Tables) -> DataFrame:
    """Codes written as decimals get their digits back."""
    raw = quarters(t).select(
        F.concat(text(F.col("arrondissement").cast("int")), F.lit(".0")).alias("C_AR"),
        text(F.substring("code_insee_quartier", 6, 2).cast("int")).alias("C_QU"),
        F.concat(F.col("code_insee_quartier"), F.lit(".0")).alias("C_QUINSEE"),
        F.col("nom_quartier").alias("L_QU"),
        text(F.col("surface_quartier_m2")).alias("SURFACE"),
        F.concat(text(F.col("lat_q")), F.lit(", "), text(F.col("lon_q"))).alias("Geometry X Y"),
    )
    out = clean.clean_quarters(raw).drop("geometry_xy")
    return rounded(out, 4)


@query("clean_iris", with_sql(f"""i as (select {q('c_custkey')} || lpad(cast((c_custkey // 80) % 5 as varchar), 2, '0') as code,
  '751' || {z('c_custkey')} as commune from customer)""", select="""
select distinct commune as "INSEE_COM", code as "CODE_IRIS" from i"""))
def clean_iris(t: Tables) -> DataFrame:
    raw = iris(t).unionByName(iris(t)).select(
        F.col("Geo Point"), F.col("INSEE_COM"), F.concat(F.col("CODE_IRIS"), F.lit(".0")).alias("CODE_IRIS"), F.col("NOM_IRIS")
    )
    return clean.clean_iris(raw).select("INSEE_COM", "CODE_IRIS")


@query("clean_zones", f"""
select {z('s_suppkey')} as arrondissement, '751' || {z('s_suppkey')} as numero_insee, max(s_suppkey)::varchar as plus_grand from supplier group by all""")
def clean_zones(t: Tables) -> DataFrame:
    """Zones by number; lines without one go."""
    key = F.col("s_suppkey")
    known = t.supplier.groupBy(zone_of(key).alias("z")).agg(text(F.max(key)).alias("n"))
    raw = known.select(
        text(F.col("z").cast("int")).alias("Numéro d’arrondissement"), F.concat(F.lit("751"), F.col("z")).alias("Code INSEE"), F.col("n").alias("Plus grand")
    )
    raw = raw.unionByName(raw.withColumn("Numéro d’arrondissement", F.lit(None).cast("string")))
    out = clean.clean_zones(raw)
    return out.select("arrondissement", F.col(out.columns[1]).alias("numero_insee"), F.col(out.columns[2]).alias("plus_grand"))
