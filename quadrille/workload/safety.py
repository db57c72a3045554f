"""Crime, safety, comfort and the five-axis index."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.zones import year_of
from ..operators.scoring import pivot_means
from ..plans import clean
from ..plans import indicators as kpi
from .prices import rounded
from .registry import Tables, query
from .standins import (
    CRIME, IRIS, POINTS, QUARTERS, RAW_SALES, code_of, crime, dist_sql, iris, located_events, q, quarters,
    raw_sales, stations, with_sql, z, zone_of,
)

KINDS = ["click", "error", "purchase", "signup", "view"]


def by_kind(**values: str) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])[F.col("event_type")]


def case_kind(**values: object) -> str:
    lines = " ".join(f"when '{k}' then {v!r}" if isinstance(v, str) else f"when '{k}' then {v}" for k, v in values.items())
    return f"case event_type {lines} end"


@query("pivot_indicators", with_sql(CRIME, select="select annee, arrondissement, " + ", ".join(
    f"round_even(avg(case when indicateur = '{k}' then taux_effectif end), 6) as {k}" for k in KINDS
) + " from crime group by all"))
def pivot_indicators(t: Tables) -> DataFrame:
    return rounded(pivot_means(crime(t), ["annee", "arrondissement"], "indicateur", "taux_effectif", KINDS))


CAMERAS = f"""cameras as (
  select {z('user_id')} as arrondissement, count(*) as nb_cameras from events where event_type = 'view' group by all),
camera_risk as (
  select arrondissement, nb_cameras, (1 - case when (select min(nb_cameras) = max(nb_cameras) from cameras) then 0.5::double
    else (nb_cameras - (select min(nb_cameras) from cameras))::double
      / (select max(nb_cameras) - min(nb_cameras) from cameras) end) * 100 as camera_risk_100 from cameras)"""


@query("minmax_score", with_sql(CAMERAS, select="""
select arrondissement, nb_cameras, round_even(camera_risk_100, 6) as camera_risk_100 from camera_risk"""))
def minmax_score(t: Tables) -> DataFrame:
    return rounded(kpi.camera_risk(located_events(t, "view")))


CRIME_RISK = f"""{CRIME}, means as (
  select annee, arrondissement, indicateur, avg(taux_effectif) as m from crime group by all), ends as (
  select indicateur, min(m) as lo, max(m) as hi from means group by all), crime_risk as (
  select annee, arrondissement, avg(case when lo = hi then 0.5 else (m - lo) / (hi - lo) end) * 100 as score_risque_delinq_100
  from means join ends using (indicateur) group by all)"""


@query("indicator_risk", with_sql(CRIME_RISK, select="""
select annee, arrondissement, round_even(score_risque_delinq_100, 6) as score_risque_delinq_100,
  round_even(100 - score_risque_delinq_100, 6) as score_surete_delinq_100 from crime_risk"""))
def indicator_risk(t: Tables) -> DataFrame:
    return rounded(kpi.crime_risk(crime(t)))


@query("coalesce_rate", f"""
select {z('user_id')} as arrondissement, event_type, count(*) as n, count(case when value > 50 then 1 end) as complete,
  round_even(avg(case when value > 50 then cast(regexp_extract(props, '([0-9]+)', 1) as double) else value end), 6) as taux
from events group by all""")
def coalesce_rate(t: Tables) -> DataFrame:
    """The main rate, withheld above a bound, filled by the complementary one."""
    main = F.when(F.col("value") <= 50, F.col("value"))
    other = F.get_json_object("props", "$.k").try_cast("double")
    rows = t.events.select(
        zone_of(F.col("user_id")).alias("arrondissement"),
        "event_type",
        main.alias("taux_pour_mille"),
        F.coalesce(main, other).alias("taux_effectif"),
    )
    return rounded(
        rows.groupBy("arrondissement", "event_type").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("taux_pour_mille").isNull()).alias("complete"),
            F.avg("taux_effectif").alias("taux"),
        )
    )


@query("crime_level", f"""
select {z('user_id')} as arrondissement, event_type, round_even(coalesce(avg(case when event_type <> 'error' then value end),
  sum(value) / sum(cast(regexp_extract(props, '([0-9]+)', 1) as double) + 1) * 1000), 6) as niveau
from events group by 1, 2""")
def crime_level(t: Tables) -> DataFrame:
    rows = t.events.select(
        zone_of(F.col("user_id")).alias("arrondissement"),
        "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("rate"),
        "value",
        (F.get_json_object("props", "$.k").cast("double") + 1).alias("people"),
    )
    return rounded(kpi.crime_level(rows, ["arrondissement", "event_type"], "rate", "value", "people"))


@query("count_by_zone_type_year", with_sql(CRIME, select="""
select arrondissement, indicateur, annee, count(*) as nb_signalements from crime group by all"""))
def count_by_zone_type_year(t: Tables) -> DataFrame:
    return clean.count_reports(crime(t), "arrondissement", "indicateur", "annee")


@query("year_of_event", """
select case when o_orderkey % 3 < 2 then cast(year(o_orderdate) as integer) end as annee, count(*) as n
from orders group by all""")
def year_of_event(t: Tables) -> DataFrame:
    """Year of a date written in one of two formats, or not a date at all."""
    text = (
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise("sans date")
    )
    rows = t.orders.select(text.alias("_text")).select(year_of(F.col("_text"), "dd/MM/yyyy").alias("annee"))
    return rows.groupBy("annee").agg(F.count(F.lit(1)).alias("n"))


def zone_event_counts(t: Tables) -> DataFrame:
    """Zone counts of three kinds of events."""
    return kpi.merge_counts(
        kpi.zone_counts(located_events(t, "error"), "incidents"),
        kpi.zone_counts(located_events(t, "purchase"), "travaux"),
        kpi.zone_counts(located_events(t, "signup"), "gares"),
    )


COUNTS = "counts as (select arrondissement, " + ", ".join(
    f"count(case when event_type = '{k}' then 1 end) as {n}"
    for k, n in (("error", "incidents"), ("purchase", "travaux"), ("signup", "gares"))
) + f""" from (select {z('user_id')} as arrondissement, event_type from events
  where event_type in ('error', 'purchase', 'signup')) e group by all)"""


@query("outer_merge_counts", with_sql(COUNTS, select="select * from counts"))
def outer_merge_counts(t: Tables) -> DataFrame:
    return zone_event_counts(t)


def _unit(name: str) -> str:
    return (
        f"case when min({name}) over () = max({name}) over () then 0.5 else "
        f"({name} - min({name}) over ()) / (max({name}) over () - min({name}) over ()) end"
    )


COMFORT = f"""{QUARTERS}, {COUNTS}, est as (
  select s.*, round_even(coalesce(incidents, 0) * part_surface, 0) as incidents_estime,
    round_even(coalesce(travaux, 0) * part_surface, 0) as travaux_estime,
    round_even(coalesce(gares, 0) * part_surface, 0) as gares_estime
  from shares s left join counts c using (arrondissement)), unit as (
  select *, {_unit('incidents_estime')} * 100 as risque_incidents_100, {_unit('gares_estime')} * 100 as g,
    {_unit('travaux_estime')} * 100 as w from est), confort as (
  select *, 0.5 * (100 - risque_incidents_100) + 0.25 * g + 0.25 * w as score_confort_urbain_100 from unit)"""


def comfort(t: Tables) -> DataFrame:
    return kpi.comfort_scores(zone_event_counts(t), quarters(t))


@query("comfort_score", with_sql(COMFORT, select="""
select arrondissement, code_insee_quartier, nom_quartier, round_even(surface_quartier_m2, 6) as surface_quartier_m2,
  round_even(part_surface, 6) as part_surface, incidents_estime, travaux_estime, gares_estime,
  round_even(risque_incidents_100, 6) as risque_incidents_100,
  round_even(score_confort_urbain_100, 6) as score_confort_urbain_100 from confort"""))
def comfort_score(t: Tables) -> DataFrame:
    return rounded(comfort(t))


@query("comfort_zone_average", with_sql(COMFORT, select="""
select arrondissement, round_even(avg(score_confort_urbain_100), 6) as score_confort_urbain_100_moyen,
  count(*) as nb_quartiers, round_even(sum(surface_quartier_m2), 4) as surface_m2 from confort group by all"""))
def comfort_zone_average(t: Tables) -> DataFrame:
    out = kpi.comfort_zone_average(comfort(t), "score_confort_urbain_100", "surface_quartier_m2")
    return rounded(out.select("*"), 6).withColumn("surface_m2", kpi.half_even(F.col("surface_m2"), 4))


SAFETY = f"""{IRIS}, {POINTS}, {CRIME_RISK}, {CAMERAS}, near as (
  select code_iris, nom_iris, i.arrondissement, i.lat, i.lon, min({dist_sql('i.lat', 'i.lon', 's.lat', 's.lon')}) as dist
  from iris i, stations s group by all), station_risk as (
  select *, case when (select min(dist) = max(dist) from near) then 0.5 else (dist - (select min(dist) from near))
    / (select max(dist) - min(dist) from near) end * 100 as commissariat_risk_100 from near), detail as (
  select s.*, annee, score_risque_delinq_100, nb_cameras, camera_risk_100,
    score_risque_delinq_100 * 0.7 + commissariat_risk_100 * 0.2 + camera_risk_100 * 0.1 as risque
  from station_risk s left join crime_risk using (arrondissement) left join camera_risk using (arrondissement))"""


def safety_detail(t: Tables) -> DataFrame:
    return kpi.safety_by_iris(
        kpi.iris_points(iris(t)),
        kpi.crime_risk(crime(t)),
        kpi.camera_risk(located_events(t, "view")),
        stations(t).withColumnRenamed("code", "station"),
    )


@query("safety_by_point", with_sql(SAFETY, select="""
select annee, code_iris, arrondissement, round_even(score_risque_delinq_100, 6) as score_risque_delinq_100, nb_cameras,
  round_even(camera_risk_100, 6) as camera_risk_100, round_even(dist, 6) as dist_commissariat_km,
  round_even(commissariat_risk_100, 6) as commissariat_risk_100, round_even(risque, 6) as score_risque_final_100,
  round_even(100 - risque, 6) as score_surete_final_100 from detail"""))
def safety_by_point(t: Tables) -> DataFrame:
    out = safety_detail(t).withColumnRenamed("CODE_IRIS", "code_iris")
    return rounded(
        out.select(
            "annee", "code_iris", "arrondissement", "score_risque_delinq_100", "nb_cameras", "camera_risk_100",
            "dist_commissariat_km", "commissariat_risk_100", "score_risque_final_100", "score_surete_final_100",
        )
    )


@query("safety_score", with_sql(SAFETY, QUARTERS, select=f""", attached as (
  select code_iris, code_insee_quartier from (select code_iris, code_insee_quartier, row_number() over (
    partition by code_iris order by {dist_sql('i.lat', 'i.lon', 'q.lat_q', 'q.lon_q')}, code_insee_quartier) as rn
  from iris i join quarters q on i.arrondissement = q.arrondissement) x where rn = 1)
select annee, arrondissement, code_insee_quartier, round_even(avg(100 - risque), 4) as score_surete_quartier_moyen_100,
  round_even(avg(risque), 4) as score_risque_quartier_moyen_100, round_even(min(100 - risque), 4) as score_surete_iris_min_100,
  round_even(max(100 - risque), 4) as score_surete_iris_max_100, round_even(stddev_samp(100 - risque), 4) as score_surete_iris_std_100,
  round_even(min(risque), 4) as score_risque_iris_min_100, round_even(max(risque), 4) as score_risque_iris_max_100,
  round_even(stddev_samp(risque), 4) as score_risque_iris_std_100, count(distinct code_iris) as nb_iris_rattaches,
  string_agg(distinct code_iris, ' | ' order by code_iris) as codes_iris_rattaches,
  string_agg(distinct nom_iris, ' | ' order by nom_iris) as noms_iris_rattaches,
  round_even(avg(dist), 4) as dist_commissariat_km_moyenne, max(nb_cameras) as nb_cameras_arrondissement
from detail join attached using (code_iris) where annee is not null group by annee, arrondissement, code_insee_quartier"""))
def safety_score(t: Tables) -> DataFrame:
    return kpi.safety_by_quarter(safety_detail(t), quarters(t))


@query("safety_by_zone", with_sql(SAFETY, select="""
select annee, arrondissement, round_even(avg(100 - risque), 6) as score_surete_zone_moyen_100,
  round_even(avg(risque), 6) as score_risque_zone_moyen_100, count(distinct code_iris) as nb_iris
from detail where annee is not null group by annee, arrondissement"""))
def safety_by_zone(t: Tables) -> DataFrame:
    return rounded(kpi.safety_by_zone(safety_detail(t)))


@query("security_housing_index", with_sql(RAW_SALES, CRIME, select=f""", j as (
  select * from (select arrondissement, avg(prix_m2) as tension from raw_sales group by all) a
  join (select arrondissement, avg(taux_effectif) as crime from crime group by all) b using (arrondissement)), n as (
  select arrondissement, {_unit('tension')} as tension_norm, {_unit('crime')} as crime_norm from j)
select arrondissement, round_even(tension_norm, 6) as tension_norm, round_even(crime_norm, 6) as crime_norm,
  round_even(0.6 * tension_norm + 0.4 * crime_norm, 6) as indice from n"""))
def security_housing_index(t: Tables) -> DataFrame:
    prices = raw_sales(t).groupBy("arrondissement").agg(F.avg("prix_m2").alias("tension"))
    rates = crime(t).groupBy("arrondissement").agg(F.avg("taux_effectif").alias("crime"))
    out = kpi.security_housing_index(prices.join(rates, "arrondissement"), "tension", "crime")
    return rounded(out.select("arrondissement", "tension_norm", "crime_norm", "indice"))


# -- five axes ----------------------------------------------------------------------

TYPES = {
    "click": "Objets abandonnés",
    "error": "Propreté",
    "purchase": "Mobiliers urbains",
    "signup": "Graffitis, tags, affiches et autocollants",
    "view": "Voirie et espace public",
}
SUBTYPES = {
    "click": "Graffiti sur mur, façade ou rideau",
    "error": "Sac de DÉCHETS",
    "purchase": "Déjection canine",
    "signup": "Infestation de punaises",
    "view": "Graffiti",
}
CATEGORIES = {
    "click": "Sport",
    "error": "Autre chantier",
    "purchase": "Écoles et crèches",
    "signup": "Sécurité et Prévention",
    "view": "Propreté",
}


def five_axis_quarters(t: Tables) -> DataFrame:
    return quarters(t).select(
        "arrondissement", "code_insee_quartier", F.col("surface_quartier_m2").alias("surface_m2"), "lat_q", "lon_q"
    )


def street_reports(t: Tables) -> DataFrame:
    return t.events.select(
        code_of(F.col("user_id")).alias("code_insee_quartier"),
        by_kind(**TYPES).alias("type_declaration"),
        by_kind(**SUBTYPES).alias("sous_type_declaration"),
    )


def public_works(t: Tables) -> DataFrame:
    postal = F.concat((F.col("user_id") % 20 + 75001).cast("string"), F.lit(".0"))
    return t.events.select(by_kind(**CATEGORIES).alias("categorie"), postal.alias("code_postal"))


def unfurnished_rents(t: Tables) -> DataFrame:
    return t.orders.select(
        F.year("o_orderdate").alias("annee"),
        code_of(F.col("o_custkey")).alias("code_insee_quartier"),
        F.when(F.col("o_orderstatus") == "O", "meublé").otherwise("Non meublé").alias("type_location"),
        (F.month("o_orderdate") % 4 + 1).alias("nombre_pieces"),
        F.col("o_totalprice").alias("loyer"),
    )


def station_points(t: Tables) -> DataFrame:
    return stations(t).select(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))


def pct_rank(value: str) -> str:
    return f"(rank() over (order by {value}) + (count(*) over (partition by {value}) - 1) / 2.0) / count(*) over ()"


def clipped(value: str) -> str:
    return f"least(greatest({value}, 0.01::double), 10.0::double)"


WEIGHTS = case_kind(click=1.5, error=1.0, purchase=1.5, signup=3.0, view=1.3)
WORKS = case_kind(click=1.0, error=0.5, purchase=1.8, signup=1.3, view=1.5)

AXIS1 = f"""d1 as (
  select q.code_insee_quartier, coalesce(n, 0) / surface_quartier_m2 as d from quarters q left join (
    select {q('user_id')} as c, count(*) as n from events where event_type in ('error', 'view') group by all) e
  on q.code_insee_quartier = e.c), s1 as (select code_insee_quartier, {clipped(f"10 * (1 - {pct_rank('d')})")} as s1 from d1)"""
AXIS2 = f"""i2 as (
  select {q('user_id')} as c, sum(({WEIGHTS})::double) as poids from events
  where event_type in ('click', 'purchase', 'signup') group by all), d2 as (
  select q.code_insee_quartier, coalesce(poids, 0) / surface_quartier_m2 as d
  from quarters q left join i2 on q.code_insee_quartier = i2.c), s2 as (
  select code_insee_quartier, {clipped(f"10 * (1 - {pct_rank('d')})")} as s2 from d2)"""
AXIS3 = f"""w3 as (
  select {z('user_id')} as arrondissement, sum(({WORKS})::double) as poids from events group by all), d3 as (
  select q.code_insee_quartier, coalesce(poids / count(*) over (partition by q.arrondissement), 0) / surface_quartier_m2 as d
  from quarters q left join w3 using (arrondissement)), s3 as (
  select code_insee_quartier, {clipped(f"10 * {pct_rank('d')}")} as s3 from d3)"""
AXIS4 = f"""l4 as (
  select {q('o_custkey')} as code_insee_quartier, avg(o_totalprice) as loyer from orders
  where year(o_orderdate) = (select max(year(o_orderdate)) from orders) and o_orderstatus <> 'O'
    and month(o_orderdate) % 4 + 1 = 2 group by all), g4 as (
  select arrondissement, q.code_insee_quartier, loyer from quarters q left join l4 using (code_insee_quartier)), f4 as (
  select code_insee_quartier, coalesce(loyer, median(loyer) over (partition by arrondissement)) as loyer from g4), h4 as (
  select code_insee_quartier, coalesce(loyer, (select median(loyer) from f4)) as loyer from f4), e4 as (
  select code_insee_quartier, abs(loyer - (select median(loyer) from h4)) / (select median(loyer) from h4) as e from h4), s4 as (
  select code_insee_quartier, {clipped('10 * (1 - e / (select max(e) from e4))')} as s4 from e4)"""
AXIS5 = f"""n5 as (
  select code_insee_quartier, count(case when {dist_sql('q.lat_q', 'q.lon_q', 's.lat', 's.lon', '111.32')} <= 0.8 then 1 end) as n
  from quarters q, stations s group by all), s5 as (select code_insee_quartier, {clipped(f"10 * {pct_rank('n')}")} as s5 from n5)"""


@query("percentile_rank_score", with_sql(QUARTERS, AXIS1, select="""
select code_insee_quartier, round_even(s1, 6) as s1 from s1"""))
def percentile_rank_score(t: Tables) -> DataFrame:
    out = kpi.cleanliness_axis(street_reports(t), five_axis_quarters(t))
    return rounded(out.select("code_insee_quartier", "s1"))


@query("weighted_incident_sum", with_sql(QUARTERS, AXIS2, select="""
select code_insee_quartier, round_even(s2, 6) as s2 from s2"""))
def weighted_incident_sum(t: Tables) -> DataFrame:
    out = kpi.incivility_axis(street_reports(t), five_axis_quarters(t))
    return rounded(out.select("code_insee_quartier", "s2"))


@query("weighted_category_density", with_sql(QUARTERS, AXIS3, select="""
select code_insee_quartier, round_even(s3, 6) as s3 from s3"""))
def weighted_category_density(t: Tables) -> DataFrame:
    out = kpi.works_axis(public_works(t), five_axis_quarters(t))
    return rounded(out.select("code_insee_quartier", "s3"))


@query("geometric_index", with_sql(QUARTERS, POINTS, AXIS1, AXIS2, AXIS3, AXIS4, AXIS5, select="""
select code_insee_quartier, round_even(s1, 6) as s1, round_even(s2, 6) as s2, round_even(s3, 6) as s3,
  round_even(s4, 6) as s4, round_even(s5, 6) as s5,
  round_even(pow(s1, 0.30) * pow(s2, 0.25) * pow(s3, 0.15) * pow(s4, 0.15) * pow(s5, 0.15), 3) as kpi_confort_urbain
from s1 join s2 using (code_insee_quartier) join s3 using (code_insee_quartier) join s4 using (code_insee_quartier)
  join s5 using (code_insee_quartier)"""))
def five_axes(t: Tables) -> DataFrame:
    """Five-axis comfort index of every fine zone."""
    out = kpi.urban_comfort_five_axes(
        street_reports(t), public_works(t), unfurnished_rents(t), station_points(t), five_axis_quarters(t)
    )
    names = ["s1", "s2", "s3", "s4", "s5", "kpi_confort_urbain"]
    return rounded(out.select("code_insee_quartier", *names))
