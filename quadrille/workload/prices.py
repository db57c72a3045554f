"""Prices, rents, projection, evolution and social housing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.distribution import describe, modes, percentile_ranks, quantiles, summarize, value_counts
from ..operators.hygiene import fill_zero, funnel, trim_quantiles
from ..operators.projection import project, share_of_group
from ..operators.scoring import distance_to_median_score, impute_group_median
from ..plans import clean
from ..plans import indicators as kpi
from ..functions.numbers import half_even
from ..functions.text import contains_folded
from ..session import stage
from .registry import Tables, query
from .standins import QUARTERS, RAW_SALES, RENTS, SALES, VALID_SALES, code_of, q, quarters, raw_sales, rents, with_sql, z, zone_of

R6 = 6


SALE_COLUMNS = ("source", "annee", "arrondissement", "prix_m2")


def sales(t: Tables, *columns: str) -> DataFrame:
    """Sales after the validity filters and the price trim per source.

    The valid sales are written once, as a cleaned layer would be, with the columns asked
    for: the trim and the indicators read them several times and filter text no more.
    """
    valid = clean.filter_valid_sales(raw_sales(t)).select(*(columns or SALE_COLUMNS))
    return trim_quantiles(stage(valid), "prix_m2", "source")


def rounded(df: DataFrame, digits: int = R6) -> DataFrame:
    """Doubles rounded for comparison; sums differ in their last digits between engines."""
    return df.withColumns(
        {f.name: half_even(F.col(f.name), digits) for f in df.schema.fields if f.dataType.simpleString() == "double"}
    )


@query("unit_price", with_sql(RAW_SALES, select="""
select source, valeur_fonciere, surface_reelle_bati, round_even(prix_m2, 6) as prix_m2 from raw_sales"""))
def unit_price(t: Tables) -> DataFrame:
    return rounded(raw_sales(t).select("source", "valeur_fonciere", "surface_reelle_bati", "prix_m2"))


@query("filter_valid_sales", with_sql(VALID_SALES, select="""
select source, arrondissement, count(*) as n, round_even(sum(valeur_fonciere), 2) as total
from valid_sales group by all"""))
def filter_valid_sales(t: Tables) -> DataFrame:
    kept = clean.filter_valid_sales(raw_sales(t))
    return kept.groupBy("source", "arrondissement").agg(
        F.count(F.lit(1)).alias("n"), half_even(F.sum("valeur_fonciere"), 2).alias("total")
    )


@query("quantile_trim", with_sql(VALID_SALES, select="""
, bounds as (select source, quantile_cont(prix_m2, 0.01) as lo, quantile_cont(prix_m2, 0.99) as hi
  from valid_sales group by source)
select v.source, count(*) as n, round_even(min(prix_m2), 6) as prix_min, round_even(max(prix_m2), 6) as prix_max
from valid_sales v join bounds b on v.source = b.source and v.prix_m2 between b.lo and b.hi group by v.source
"""))
def quantile_trim(t: Tables) -> DataFrame:
    return rounded(
        sales(t).groupBy("source").agg(
            F.count(F.lit(1)).alias("n"), F.min("prix_m2").alias("prix_min"), F.max("prix_m2").alias("prix_max")
        )
    )


@query("filter_funnel", with_sql(RAW_SALES, select="""
select step, name, rows, round_even(rows * 100.0::double / max(case when step = 0 then rows end) over (), 6) as pct from (
  select 0::integer as step, 'all' as name, count(*) as rows from raw_sales
  union all select 1, 'surface', count(*) from raw_sales where surface_reelle_bati > 9
  union all select 2, 'value', count(*) from raw_sales where surface_reelle_bati > 9 and valeur_fonciere > 10000
  union all select 3, 'home', count(*) from raw_sales where surface_reelle_bati > 9 and valeur_fonciere > 10000
    and trim(type_local) in ('Appartement', 'Maison')) s"""))
def filter_funnel(t: Tables) -> DataFrame:
    return rounded(
        funnel(
            raw_sales(t),
            {
                "surface": F.col("surface_reelle_bati") > 9,
                "value": F.col("valeur_fonciere") > 10000,
                "home": F.trim("type_local").isin("Appartement", "Maison"),
            },
        )
    )


@query("describe_percentiles", with_sql(VALID_SALES, select="""
select count(prix_m2) as n, round_even(avg(prix_m2), 4) as mean, round_even(stddev_samp(prix_m2), 4) as std,
  round_even(min(prix_m2), 4) as min, round_even(max(prix_m2), 4) as max, round_even(quantile_cont(prix_m2, 0.01), 4) as p01,
  round_even(quantile_cont(prix_m2, 0.05), 4) as p05, round_even(quantile_cont(prix_m2, 0.5), 4) as p50,
  round_even(quantile_cont(prix_m2, 0.95), 4) as p95, round_even(quantile_cont(prix_m2, 0.99), 4) as p99 from valid_sales"""))
def describe_percentiles(t: Tables) -> DataFrame:
    probs = {"p01": 0.01, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    return rounded(describe(clean.filter_valid_sales(raw_sales(t)), "prix_m2", probs), 4)


@query("value_counts", with_sql(RAW_SALES, select="""
select trim(type_local) as type_local, annee, count(*) as n from raw_sales group by all"""))
def value_counts_by_type(t: Tables) -> DataFrame:
    return value_counts(raw_sales(t).withColumn("type_local", F.trim("type_local")), "type_local", "annee")


@query("median_price_by_zone_year", with_sql(RAW_SALES, select="""
select annee, arrondissement, round_even(median(prix_m2), 6) as prix_m2_median, round_even(avg(prix_m2), 6) as prix_m2_moyen,
  count(*) as nb_ventes from raw_sales group by all"""))
def median_price_by_zone_year(t: Tables) -> DataFrame:
    return rounded(kpi.price_by_zone_year(raw_sales(t)))


@query("mean_price_by_zone", with_sql(SALES, select="""
select arrondissement, round_even(avg(prix_m2), 6) as prix_m2_moyen from sales group by all"""))
def mean_price_by_zone(t: Tables) -> DataFrame:
    return rounded(kpi.mean_price_by_zone(sales(t)))


@query("share_of_group", with_sql(QUARTERS, select="""
select arrondissement, code_insee_quartier, round_even(surface_quartier_m2, 4) as surface_quartier_m2,
  round_even(part_surface, 8) as part_surface from shares"""))
def share_by_area(t: Tables) -> DataFrame:
    wide = share_of_group(quarters(t), "arrondissement", "surface_quartier_m2", "part_surface")
    return wide.select(
        "arrondissement",
        "code_insee_quartier",
        half_even(F.col("surface_quartier_m2"), 4).alias("surface_quartier_m2"),
        half_even(F.col("part_surface"), 8).alias("part_surface"),
    )


@query("project_by_share", with_sql(RAW_SALES, QUARTERS, select="""
, counts as (select arrondissement, annee, count(*) as nb from raw_sales group by all)
select c.arrondissement, c.annee, c.nb, s.code_insee_quartier, round_even(s.part_surface, 8) as part_surface,
  cast(round_even(c.nb * s.part_surface, 0) as bigint) as nb_estime
from counts c left join shares s on c.arrondissement = s.arrondissement"""))
def project_by_share(t: Tables) -> DataFrame:
    counts = raw_sales(t).groupBy("arrondissement", "annee").agg(F.count(F.lit(1)).alias("nb"))
    fine = kpi.quarter_shares(quarters(t)).select("arrondissement", "code_insee_quartier", "part_surface")
    return project(counts, fine, "arrondissement", "part_surface", {"nb": "nb_estime"}).withColumn(
        "part_surface", half_even(F.col("part_surface"), 8)
    )


BY_QUARTER = f"""{SALES}, {QUARTERS}, by_zone as (
  select annee, arrondissement, median(prix_m2) as prix_m2_median, avg(prix_m2) as prix_m2_moyen, count(*) as nb_ventes
  from sales group by all), by_quarter as (
  select b.*, s.code_insee_quartier, s.surface_quartier_m2, s.part_surface,
    cast(round_even(nb_ventes * part_surface, 0) as bigint) as nb_ventes_estime
  from by_zone b left join shares s on b.arrondissement = s.arrondissement)"""


def price_by_quarter(t: Tables) -> DataFrame:
    return kpi.price_by_quarter_year(sales(t), quarters(t))


@query("kpi_price_by_subzone_year", with_sql(BY_QUARTER, select="""
select annee, arrondissement, code_insee_quartier, round_even(prix_m2_median, 6) as prix_m2_median,
  round_even(prix_m2_moyen, 6) as prix_m2_moyen, nb_ventes, nb_ventes_estime,
  round_even(surface_quartier_m2, 6) as surface_quartier_m2, round_even(part_surface, 6) as part_surface from by_quarter"""))
def kpi_price_by_subzone_year(t: Tables) -> DataFrame:
    """Yearly price per square metre of every fine zone."""
    return rounded(price_by_quarter(t))


@query("top_bottom_k", with_sql(BY_QUARTER, select="""
select * from (
  (select 'top' as side, code_insee_quartier, annee, round_even(prix_m2_median, 6) as prix_m2_median from by_quarter
   order by by_quarter.prix_m2_median desc, code_insee_quartier, annee limit 10)
  union all
  (select 'bottom' as side, code_insee_quartier, annee, round_even(prix_m2_median, 6) as prix_m2_median from by_quarter
   order by by_quarter.prix_m2_median, code_insee_quartier, annee limit 10)) x"""))
def top_bottom_k(t: Tables) -> DataFrame:
    """The ten dearest and the ten cheapest fine zone years."""
    table = price_by_quarter(t).select("code_insee_quartier", "annee", "prix_m2_median")
    rest = ["code_insee_quartier", "annee"]
    top = table.orderBy(F.desc("prix_m2_median"), *rest).limit(10).withColumn("side", F.lit("top"))
    bottom = table.orderBy("prix_m2_median", *rest).limit(10).withColumn("side", F.lit("bottom"))
    return rounded(top.unionByName(bottom))


RATIO = f"""{SALES}, {RENTS}, buy as (
  select annee, arrondissement, median(prix_m2) as prix_m2_median, avg(prix_m2) as prix_m2_moyen,
    count(*) as nb_transactions from sales group by all), rent as (
  select annee, arrondissement, median(loyer_reference) as loyer_reference_median,
    avg(loyer_reference) as loyer_reference_moyen, count(*) as nb_observations from rents group by all), ratio as (
  select annee, arrondissement, round_even(prix_m2_median, 4) as prix_m2_median, round_even(prix_m2_moyen, 4) as prix_m2_moyen,
    nb_transactions, round_even(loyer_reference_median, 4) as loyer_reference_median,
    round_even(loyer_reference_moyen, 4) as loyer_reference_moyen, nb_observations,
    round_even(prix_m2_median / (loyer_reference_median * 12), 4) as kpi_comparaison_achat_location
  from buy join rent using (annee, arrondissement))"""


def ratio(t: Tables) -> DataFrame:
    return kpi.price_to_rent_by_zone_year(sales(t), rents(t))


@query("price_to_rent", with_sql(RATIO, select="select * from ratio"))
def price_to_rent(t: Tables) -> DataFrame:
    return ratio(t)


@query("price_to_rent_subzone", with_sql(RATIO, QUARTERS, select="""
select r.*, code_insee_quartier, round_even(surface_quartier_m2, 6) as surface_quartier_m2, round_even(part_surface, 8) as part_surface,
  cast(round_even(nb_transactions * part_surface, 0) as bigint) as nb_transactions_estime,
  cast(round_even(nb_observations * part_surface, 0) as bigint) as nb_observations_estime
from ratio r left join shares using (arrondissement)"""))
def price_to_rent_subzone(t: Tables) -> DataFrame:
    out = kpi.price_to_rent_by_quarter_year(ratio(t), quarters(t))
    return out.withColumns(
        {"surface_quartier_m2": half_even(F.col("surface_quartier_m2"), 6), "part_surface": half_even(F.col("part_surface"), 8)}
    )


FIRST_YEAR, LAST_YEAR = 1996, 2000


@query("evolution_pct", with_sql(RATIO, select=f"""
, y as (select * from ratio)
select a.arrondissement,
  a.prix_m2_median as prix_m2_median_{FIRST_YEAR}, b.prix_m2_median as prix_m2_median_{LAST_YEAR},
  a.loyer_reference_median as loyer_reference_median_{FIRST_YEAR}, b.loyer_reference_median as loyer_reference_median_{LAST_YEAR},
  a.kpi_comparaison_achat_location as kpi_comparaison_achat_location_{FIRST_YEAR},
  b.kpi_comparaison_achat_location as kpi_comparaison_achat_location_{LAST_YEAR},
  round_even((b.prix_m2_median - a.prix_m2_median) / a.prix_m2_median * 100, 4) as evolution_achat_pct,
  round_even((b.loyer_reference_median - a.loyer_reference_median) / a.loyer_reference_median * 100, 4) as evolution_loyer_pct,
  round_even((b.kpi_comparaison_achat_location - a.kpi_comparaison_achat_location) / nullif(a.kpi_comparaison_achat_location, 0) * 100, 4) as evolution_kpi_comparaison_pct
from y a join y b on a.arrondissement = b.arrondissement and a.annee = {FIRST_YEAR} and b.annee = {LAST_YEAR}
"""))
def evolution_pct(t: Tables) -> DataFrame:
    by_zone = ratio(t).withColumn("code_insee_quartier", F.col("arrondissement"))
    return kpi.price_to_rent_evolution(by_zone, FIRST_YEAR, LAST_YEAR).drop("code_insee_quartier")


@query("yoy_change", with_sql(RAW_SALES, select="""
, m as (select arrondissement, annee, median(prix_m2) as prix_m2_median from raw_sales group by all)
select m.arrondissement, m.annee, round_even(m.prix_m2_median, 6) as prix_m2_median,
  round_even((m.prix_m2_median - p.prix_m2_median) / p.prix_m2_median * 100, 6) as variation_pct
from m left join m p on p.arrondissement = m.arrondissement and p.annee = m.annee - 1"""))
def yoy_change(t: Tables) -> DataFrame:
    yearly = quantiles(raw_sales(t), ["arrondissement", "annee"], "prix_m2", {"prix_m2_median": 0.5})
    return rounded(kpi.yearly_change(yearly, ["arrondissement"], "prix_m2_median", "variation_pct"))


@query("mix_by_type_size", with_sql(RAW_SALES, select="""
, c as (select arrondissement, annee, trim(type_local) || case when surface_reelle_bati < 20 then ' S'
    when surface_reelle_bati < 40 then ' M' else ' L' end as classe from raw_sales),
g as (select arrondissement, annee, classe, count(*) as nb from c group by all)
select *, round_even(nb * 100.0::double / sum(nb) over (partition by arrondissement, annee), 6) as part_pct from g
"""))
def mix_by_type_size(t: Tables) -> DataFrame:
    size = F.when(F.col("surface_reelle_bati") < 20, " S").when(F.col("surface_reelle_bati") < 40, " M").otherwise(" L")
    rows = raw_sales(t).withColumn("classe", F.concat(F.trim("type_local"), size))
    return rounded(kpi.mix_by(rows, ["arrondissement", "annee"], "classe"))


@query("rent_summary", with_sql(RENTS, select="""
, g as (select annee, arrondissement, code_insee_quartier, median(loyer_reference) as a, avg(loyer_reference) as b,
  count(*) as nb_observations, median(loyer_reference_majore) as c, median(loyer_reference_minore) as d,
  median(nombre_pieces_principales) as e from rents group by all),
m as (select annee, arrondissement, code_insee_quartier, v, k, row_number() over (
    partition by annee, arrondissement, code_insee_quartier, k order by count(*) desc, v) as rn
  from (select *, nom_quartier as v, 'nom' as k from rents union all select *, type_location, 'type' from rents
    union all select *, epoque_construction, 'epoque' from rents) u
  group by annee, arrondissement, code_insee_quartier, v, k)
select g.annee, g.arrondissement, g.code_insee_quartier, round_even(a, 4) as loyer_reference_median,
  round_even(b, 4) as loyer_reference_moyen, nb_observations, round_even(c, 4) as loyer_reference_majore_median,
  round_even(d, 4) as loyer_reference_minore_median, e as nombre_pieces_median,
  max(case when k = 'nom' then v end) as nom_quartier, max(case when k = 'type' then v end) as type_location_mode,
  max(case when k = 'epoque' then v end) as epoque_construction_mode
from g join m on g.annee = m.annee and g.code_insee_quartier = m.code_insee_quartier and rn = 1 group by all
"""))
def rent_summary(t: Tables) -> DataFrame:
    """Rents per fine zone and year: four medians and three modes."""
    return rounded(kpi.rents_by_quarter_year(rents(t)), 4)


@query("rent_by_zone", with_sql(RENTS, select="""
select arrondissement, annee, round_even(median(loyer_reference), 2) as loyer_reference_median,
  round_even(avg(loyer_reference), 2) as loyer_reference_moyen, min(loyer_reference) as loyer_reference_min,
  max(loyer_reference) as loyer_reference_max, count(*) as nb_observations from rents group by all"""))
def rent_by_zone(t: Tables) -> DataFrame:
    return kpi.rent_levels(rents(t), ["arrondissement", "annee"])


@query("mode_per_group", with_sql(RENTS, select="""
select arrondissement, annee, epoque_construction as epoque_mode from (
  select arrondissement, annee, epoque_construction, row_number() over (
    partition by arrondissement, annee order by count(*) desc, epoque_construction) as rn
  from rents group by arrondissement, annee, epoque_construction) x where rn = 1"""))
def mode_per_group(t: Tables) -> DataFrame:
    return modes(rents(t), ["arrondissement", "annee"], {"epoque_mode": "epoque_construction"})


@query("tension_index", with_sql(RAW_SALES, RENTS, select="""
select annee, arrondissement, round_even(p, 4) as prix_m2_moyen, round_even(l, 4) as loyer_moyen, round_even(p / l, 8) as tension,
  round_even(l * 1200 / p, 4) as rendement_brut_pct
from (select annee, arrondissement, avg(prix_m2) as p from raw_sales group by all) a
join (select annee, arrondissement, avg(loyer_reference) as l from rents group by all) b using (annee, arrondissement)"""))
def tension_index(t: Tables) -> DataFrame:
    out = kpi.tension(raw_sales(t), rents(t))
    return out.withColumns(
        {
            "prix_m2_moyen": half_even(F.col("prix_m2_moyen"), 4),
            "loyer_moyen": half_even(F.col("loyer_moyen"), 4),
            "tension": half_even(F.col("tension"), 8),
            "rendement_brut_pct": half_even(F.col("rendement_brut_pct"), 4),
        }
    )


@query("latest_year_filter", with_sql(RENTS, select="""
select arrondissement, epoque_construction, count(*) as n, round_even(sum(loyer_reference), 2) as total from rents
where annee = (select max(annee) from rents) and lower(epoque_construction) like '%not%' group by all"""))
def latest_year_filter(t: Tables) -> DataFrame:
    table = rents(t)
    newest = table.agg(F.max("annee")).scalar()
    kept = table.withColumn("_newest", newest).where(F.col("annee") == F.col("_newest"))
    kept = kept.where(contains_folded(F.col("epoque_construction"), "NOT"))
    return kept.groupBy("arrondissement", "epoque_construction").agg(
        F.count(F.lit(1)).alias("n"), half_even(F.sum("loyer_reference"), 2).alias("total")
    )


SPARSE_RENTS = f"""{QUARTERS}, {RENTS}, means as (
  select code_insee_quartier, avg(case when code_insee_quartier not like '%03'
    and code_insee_quartier not like '75105%' then loyer_reference end) as loyer from rents group by all), gaps as (
  select arrondissement, q.code_insee_quartier, loyer from quarters q left join means m using (code_insee_quartier)),
filled as (
  select g.arrondissement, code_insee_quartier, coalesce(loyer, med) as loyer0 from gaps g left join (
    select arrondissement, median(loyer) as med from gaps group by all) m on g.arrondissement = m.arrondissement),
imputed as (select arrondissement, code_insee_quartier, coalesce(loyer0, (select median(loyer0) from filled)) as loyer from filled)"""


def sparse_rents(t: Tables) -> DataFrame:
    """Mean rent per fine zone; one fine zone of each coarse zone and one whole coarse zone have none."""
    known = ~F.col("code_insee_quartier").endswith("03") & ~F.col("code_insee_quartier").startswith("75105")
    means = rents(t).groupBy("code_insee_quartier").agg(F.avg(F.when(known, F.col("loyer_reference"))).alias("loyer"))
    return quarters(t).select("arrondissement", "code_insee_quartier").join(means, "code_insee_quartier", "left")


@query("impute_group_median", with_sql(SPARSE_RENTS, select="""
select arrondissement, code_insee_quartier, round_even(loyer, 6) as loyer from imputed"""))
def impute_by_group(t: Tables) -> DataFrame:
    return rounded(impute_group_median(sparse_rents(t), "arrondissement", "loyer"))


@query("distance_to_median_score", with_sql(SPARSE_RENTS, select="""
, m as (select median(loyer) as med from imputed),
d as (select code_insee_quartier, abs(loyer - med) / med as delta from imputed, m)
select code_insee_quartier, round_even(least(greatest(10 * (1 - delta / (select max(delta) from d)), 0.01), 10), 6) as score from d
"""))
def distance_score(t: Tables) -> DataFrame:
    filled = impute_group_median(sparse_rents(t), "arrondissement", "loyer")
    return rounded(distance_to_median_score(filled, "loyer", "score").select("code_insee_quartier", "score"))


# -- social housing and population --------------------------------------------------


def housing(t: Tables) -> DataFrame:
    part = {f"nb_{n}": F.when(F.col("l_linenumber") == k, F.col("l_quantity")).otherwise(0.0)
            for k, n in enumerate(("pla_i", "plus", "plus_cd", "pls"), start=1)}
    return t.lineitem.select(
        F.year("l_shipdate").alias("annee"),
        zone_of(F.col("l_partkey")).alias("arrondissement"),
        code_of(F.col("l_partkey")).alias("code_insee_quartier"),
        F.col("l_quantity").alias("nb_logements_finances"),
        F.col("l_suppkey").alias("bailleur_social"),
        *[c.alias(n) for n, c in part.items()],
    )


@query("social_housing_summary", f"""
select cast(year(l_shipdate) as integer) as annee, {z('l_partkey')} as arrondissement,
  {q('l_partkey')} as code_insee_quartier, sum(l_quantity) as logements_finances_total,
  round_even(avg(l_quantity), 2) as logements_finances_moyen, count(*) as nb_programmes,
  count(distinct l_suppkey) as nb_bailleurs,
  sum(case when l_linenumber = 1 then l_quantity else 0 end) as nb_pla_i_total,
  sum(case when l_linenumber = 2 then l_quantity else 0 end) as nb_plus_total,
  sum(case when l_linenumber = 3 then l_quantity else 0 end) as nb_plus_cd_total,
  sum(case when l_linenumber = 4 then l_quantity else 0 end) as nb_pls_total
from lineitem group by all""")
def social_housing(t: Tables) -> DataFrame:
    return kpi.social_housing_summary(housing(t), ["annee", "arrondissement", "code_insee_quartier"])


@query("population_by_zone", f"""
select {z('c_custkey')} as arrondissement, round_even(sum(c_acctbal), 2) as population_totale, count(c_custkey) as nb_iris
from customer group by all""")
def population(t: Tables) -> DataFrame:
    people = t.customer.select(zone_of(F.col("c_custkey")).alias("arrondissement"), "c_acctbal", "c_custkey")
    return rounded(clean.population_by_zone(people, "arrondissement", "c_acctbal", "c_custkey"), 2)


@query("intensity_per_unit", f"""
select {z('l_suppkey')} as arrondissement, round_even(sum(l_extendedprice) / sum(l_quantity), 6) as conso_par_logement
from lineitem group by all""")
def intensity_per_unit(t: Tables) -> DataFrame:
    rows = t.lineitem.select(zone_of(F.col("l_suppkey")).alias("arrondissement"), "l_extendedprice", "l_quantity")
    return rounded(kpi.intensity(rows, ["arrondissement"], "l_extendedprice", "l_quantity", "conso_par_logement"))


@query("fill_zero_counts", with_sql(QUARTERS, select=f"""
select q.code_insee_quartier, coalesce(n, 0) as n from quarters q left join (
  select {q('user_id')} as code, count(*) as n from events group by all) e
on q.code_insee_quartier = e.code"""))
def fill_zero_counts(t: Tables) -> DataFrame:
    """Aggregates joined onto the zone dimension, gaps as zero."""
    counts = t.events.groupBy(code_of(F.col("user_id")).alias("code_insee_quartier")).agg(F.count(F.lit(1)).alias("n"))
    wide = quarters(t).select("code_insee_quartier").join(counts, "code_insee_quartier", "left")
    return fill_zero(wide, "n")


@query("percentile_rank_rows", """
select c_custkey, c_acctbal, round_even((rank() over (order by c_acctbal)
  + (count(*) over (partition by c_acctbal) - 1) / 2.0) / (count(*) over ())::double, 8) as rang from customer""")
def percentile_rank_rows(t: Tables) -> DataFrame:
    """Percentile rank over a fact-sized table, without one global window."""
    return percentile_ranks(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "rang").withColumn(
        "rang", half_even(F.col("rang"), 8)
    )
