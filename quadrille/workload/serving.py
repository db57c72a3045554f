"""Latest values, profiles, ranking and series over published tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import half_even, years_of_rent
from ..operators import serving
from ..operators.distribution import quantiles
from ..plans import indicators as kpi
from ..session import stage
from ..sources.geojson import point_json
from .prices import housing, rounded
from .registry import Tables, query
from .safety import COMFORT, CRIME_RISK, comfort
from .standins import RAW_SALES, RENTS, crime, q, quarters, raw_sales, rents, with_sql

CODE, ZONE, YEAR = serving.CODE, serving.ZONE, serving.YEAR
CATEGORIES = list(serving.CATEGORY_MEASURES)


def prices(t: Tables) -> DataFrame:
    return quantiles(raw_sales(t), [YEAR, CODE], "prix_m2", {"prix_m2_median": 0.5})


def rent_table(t: Tables) -> DataFrame:
    return quantiles(rents(t), [YEAR, CODE], "loyer_reference", {"loyer_reference_median": 0.5})


def social_table(t: Tables) -> DataFrame:
    return housing(t).groupBy(YEAR, CODE).agg(
        half_even(F.avg("nb_logements_finances"), 2).alias("logements_finances_moyen"),
        F.sum("nb_logements_finances").alias("logements_finances_total"),
    )


def safety_table(t: Tables) -> DataFrame:
    """Zone safety on the fine zones."""
    risk = kpi.crime_risk(crime(t)).withColumnRenamed("score_surete_delinq_100", "score_surete_quartier_moyen_100")
    members = quarters(t).select(ZONE, CODE)
    return members.join(risk, ZONE).select(YEAR, CODE, "score_surete_quartier_moyen_100")


def published(t: Tables, *names: str) -> dict[str, DataFrame]:
    """The published tables asked for; prices and rents are written once for reuse."""
    out: dict[str, DataFrame] = {}
    wanted = names or tuple(CATEGORIES)
    if {"prix_m2", "comparaison"} & set(wanted):
        out["prix_m2"] = stage(prices(t))
    if {"loyers", "comparaison"} & set(wanted):
        out["loyers"] = stage(rent_table(t))
    if "comparaison" in wanted:
        ratio = years_of_rent(F.col("prix_m2_median"), F.col("loyer_reference_median"))
        both = out["prix_m2"].join(out["loyers"], [YEAR, CODE])
        out["comparaison"] = both.select(YEAR, CODE, (ratio * 100000).alias("kpi_comparaison_achat_location"))
    if "logements_sociaux" in wanted:
        out["logements_sociaux"] = social_table(t)
    if "confort" in wanted:
        out["confort"] = comfort(t)
    if "surete" in wanted:
        out["surete"] = safety_table(t)
    return {k: v for k, v in out.items() if k in wanted}


GOLD = f"""{RAW_SALES}, {RENTS}, {COMFORT}, {CRIME_RISK}, t_prix_m2 as (
  select annee, code_insee_quartier, median(prix_m2) as v from raw_sales group by all), t_loyers as (
  select annee, code_insee_quartier, median(loyer_reference) as v from rents group by all), t_comparaison as (
  select annee, code_insee_quartier, p.v / (l.v * 12) * 100000 as v from t_prix_m2 p join t_loyers l using (annee, code_insee_quartier)),
social as (select cast(year(l_shipdate) as integer) as annee, {q('l_partkey')} as code_insee_quartier,
  round_even(avg(l_quantity), 2) as v, sum(l_quantity) as total from lineitem group by all), t_logements_sociaux as (
  select annee, code_insee_quartier, v from social), t_confort as (
  select 0 as annee, code_insee_quartier, score_confort_urbain_100 as v from confort), t_surete as (
  select annee, code_insee_quartier, 100 - score_risque_delinq_100 as v from quarters join crime_risk using (arrondissement)), stacked as (
  {" union all ".join(f"select '{c}' as category, annee, code_insee_quartier, v from t_{c}" for c in CATEGORIES)}), latest as (
  select category, code_insee_quartier, max_by(v, annee) as v, max(annee) as annee from stacked group by all), wide as (
  select arrondissement, code_insee_quartier, nom_quartier, {", ".join(f"max(case when category = '{c}' then v end) as {c}" for c in CATEGORIES)}
  from quarters left join latest using (code_insee_quartier) group by all)"""


@query("latest_per_key", with_sql(GOLD, select="""
select annee, code_insee_quartier, round_even(v, 6) as prix_m2_median from latest where category = 'prix_m2'"""))
def latest_per_key(t: Tables) -> DataFrame:
    return rounded(serving.latest(prices(t)))


@query("choropleth_scores", with_sql(GOLD, select="""
select category, code_insee_quartier, round_even(v, 6) as score from latest"""))
def choropleth_scores(t: Tables) -> DataFrame:
    """Latest value of every category and fine zone."""
    tables = published(t)
    parts = [serving.choropleth(tables, c).withColumn("category", F.lit(c)) for c in CATEGORIES]
    parts = [p.withColumn("score", F.col("score").cast("double")) for p in parts]
    return rounded(reduce(DataFrame.unionByName, parts).select("category", CODE, "score"))


@query("choropleth_zone_average", with_sql(GOLD, select="""
select arrondissement, round_even(avg(prix_m2), 6) as score_moyen, count(prix_m2) as nb from wide
where prix_m2 is not null group by all"""))
def choropleth_zone_average(t: Tables) -> DataFrame:
    scores = serving.choropleth(published(t, "prix_m2"), "prix_m2")
    wide = quarters(t).select(ZONE, CODE).join(scores, CODE)
    return rounded(wide.groupBy(ZONE).agg(F.avg("score").alias("score_moyen"), F.count("score").alias("nb")))


def _norm(category: str) -> str:
    low, high = f"min({category}) over w", f"max({category}) over w"
    if category in serving.SCORED:
        return category
    top = f"{high} - {category}" if category in serving.LOW_IS_GOOD else f"{category} - {low}"
    return f"case when {category} is null then null when {low} = {high} then 100 else ({top}) / ({high} - {low}) * 100 end"


RANKED = f"""norm as (select arrondissement, code_insee_quartier, nom_quartier, {", ".join(CATEGORIES)},
  {", ".join(f"{_norm(c)} as n_{c}" for c in CATEGORIES)} from wide window w as (partition by arrondissement)), scored as (
  select *, coalesce(({" + ".join(f"coalesce(n_{c}, 0)" for c in CATEGORIES)})
    / nullif({" + ".join(f"(n_{c} is not null)::integer" for c in CATEGORIES)}, 0), 0) as composite_score from norm), ranked as (
  select *, cast(row_number() over (partition by arrondissement order by composite_score desc, code_insee_quartier) as integer) as rank from scored)"""


def ranked(t: Tables) -> DataFrame:
    members = quarters(t).select(ZONE, CODE, "nom_quartier")
    return serving.ranking(members, published(t), CATEGORIES)


@query("zone_ranking", with_sql(GOLD, RANKED, select=f"""
select arrondissement, code_insee_quartier, nom_quartier, {", ".join(f"round_even({c}, 6) as {c}" for c in CATEGORIES)},
  round_even(composite_score, 6) as composite_score, rank from ranked"""))
def zone_ranking(t: Tables) -> DataFrame:
    """Fine zones of every zone ranked by the mean of six normalised categories."""
    return rounded(ranked(t))


@query("ranking_category_average", with_sql(GOLD, RANKED, select=f"""
select arrondissement, {", ".join(f"round_even(avg({c}), 6) as {c}" for c in CATEGORIES)} from ranked group by all"""))
def ranking_category_average(t: Tables) -> DataFrame:
    return rounded(ranked(t).groupBy(ZONE).agg(*[F.avg(c).alias(c) for c in CATEGORIES]))


@query("global_index", with_sql(GOLD, select="""
, b as (select code_insee_quartier, confort as a, surete as b,
  least(greatest(100 - (prix_m2 - 7000) / 9000 * 100, 0), 100) as c, least(greatest(100 - (loyers / 10000 - 20) / 20 * 100, 0), 100) as d,
  least(greatest(logements_sociaux / 3000 * 100, 0), 100) as e, least(greatest((comparaison - 15) / 15 * 100, 0), 100) as f from wide)
select code_insee_quartier, round_even(case when a is null and b is null and prix is null then 0 else
  (coalesce(a, 0) + coalesce(b, 0) + coalesce(c * (prix is not null)::integer, 0) + coalesce(d * (loyer is not null)::integer, 0)
   + coalesce(e * (soc is not null)::integer, 0) + coalesce(f * (comp is not null)::integer, 0))
  / ((a is not null)::integer + (b is not null)::integer + (prix is not null)::integer + (loyer is not null)::integer
   + (soc is not null)::integer + (comp is not null)::integer) end, 6) as indice
from b join (select code_insee_quartier, prix_m2 as prix, loyers as loyer, logements_sociaux as soc, comparaison as comp from wide) w
  using (code_insee_quartier)"""))
def global_index(t: Tables) -> DataFrame:
    """Mean of the categories on fixed bounds; rents are first brought to the scale of the bounds."""
    wide = quarters(t).select(CODE).join(serving.latest_scores(published(t), CATEGORIES), CODE, "left")
    values = {c: F.col(c) / 10000 if c == "loyers" else F.col(c) for c in CATEGORIES}
    return rounded(wide.select(CODE, serving.global_index(values).alias("indice")))


@query("multi_kpi_profile", with_sql(GOLD, select="""
select p.annee, p.code_insee_quartier, round_even(p.v, 6) as prix_m2_median, round_even(l.v, 6) as loyer_reference_median,
  round_even(c.v, 6) as score_confort_urbain_100, round_even(s.v, 6) as logements_finances_moyen
from t_prix_m2 p left join t_loyers l using (code_insee_quartier, annee) left join t_confort c on c.code_insee_quartier = p.code_insee_quartier
  left join t_logements_sociaux s on s.code_insee_quartier = p.code_insee_quartier and s.annee = p.annee"""))
def multi_kpi_profile(t: Tables) -> DataFrame:
    """Facts side by side: on code and year where yearly, on code where not."""
    tables = published(t, "prix_m2", "loyers", "confort", "logements_sociaux")
    wide = tables["prix_m2"].join(tables["loyers"], [CODE, YEAR], "left")
    wide = wide.join(tables["confort"].select(CODE, "score_confort_urbain_100"), CODE, "left")
    wide = wide.join(tables["logements_sociaux"].drop("logements_finances_total"), [CODE, YEAR], "left")
    return rounded(
        wide.select(
            YEAR, CODE, "prix_m2_median", "loyer_reference_median", "score_confort_urbain_100", "logements_finances_moyen"
        )
    )


@query("quarter_profile", with_sql(GOLD, select="""
select code_insee_quartier, max(case when category = 'prix_m2' then annee end) as annee_prix,
  round_even(max(case when category = 'prix_m2' then v end), 6) as prix_m2_median,
  max(case when category = 'surete' then annee end) as annee_surete,
  round_even(max(case when category = 'surete' then v end), 6) as score_surete,
  round_even(max(case when category = 'confort' then v end), 6) as score_confort
from latest where category in ('prix_m2', 'surete', 'confort') group by all"""))
def quarter_profile(t: Tables) -> DataFrame:
    """Latest row of each category of a fine zone; unknown categories are ignored."""
    names = ["prix_m2", "surete", "confort", "inconnue"]
    wide = serving.profile(published(t, "prix_m2", "surete", "confort"), names)
    return rounded(
        wide.select(
            CODE,
            F.col("prix_m2.annee").alias("annee_prix"),
            F.col("prix_m2.prix_m2_median").alias("prix_m2_median"),
            F.col("surete.annee").alias("annee_surete"),
            F.col("surete.score_surete_quartier_moyen_100").alias("score_surete"),
            F.col("confort.score_confort_urbain_100").alias("score_confort"),
        )
    )


@query("kpi_with_geometry", with_sql(GOLD, select="""
select annee, code_insee_quartier, round_even(v, 4) as prix_m2_median,
  '{"type":"Point","coordinates":[' || cast(lon_q as varchar) || ',' || cast(lat_q as varchar) || ']}' as geometry
from t_prix_m2 left join quarters using (code_insee_quartier)"""))
def kpi_with_geometry(t: Tables) -> DataFrame:
    """A fact with the geometry of its zone."""
    shapes = quarters(t).select(CODE, point_json(F.col("lon_q"), F.col("lat_q")).alias("geometry"))
    return rounded(prices(t).join(shapes, CODE, "left").select(YEAR, CODE, "prix_m2_median", "geometry"), 4)


@query("history_series", with_sql(GOLD, select="""
select code_insee_quartier, category, annee, round_even(case when category = 'logements_sociaux' then total else v end, 6) as value
from stacked left join (select annee as y, code_insee_quartier as c, total from social) s
  on s.y = annee and s.c = code_insee_quartier where category <> 'confort'"""))
def history_series(t: Tables) -> DataFrame:
    tables = published(t, "prix_m2", "loyers", "comparaison", "logements_sociaux", "surete")
    return rounded(serving.history(tables))


@query("lookup_zone_year", with_sql(GOLD, select="""
select annee, code_insee_quartier, round_even(v, 6) as prix_m2_median from t_prix_m2
where annee = 1997 and code_insee_quartier like '75107%'"""))
def lookup_zone_year(t: Tables) -> DataFrame:
    """Equality on the year, prefix on the code, in code order."""
    found = prices(t).where((F.col(YEAR) == 1997) & F.col(CODE).like("75107%"))
    return rounded(found.select(YEAR, CODE, "prix_m2_median")).orderBy(CODE)
