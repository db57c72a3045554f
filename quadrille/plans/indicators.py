"""Published indicators, computed from clean tables.

Inputs carry the clean column names; ``quarters`` is the fine-zone dimension. Nothing is
sorted here: order is a matter of the sink or the reader.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.geo import KM_PER_DEGREE_RADIUS, split_point
from ..functions.numbers import as_number, half_even, number_in, percent_change, whole, years_of_rent
from ..functions.text import contains_folded, name_key
from ..functions.zones import digits_padded, harmonized_zone, last_two, pad_left, postal_modulo, zone2, zone_of_commune
from ..operators.columns import first_existing, pick_column
from ..operators.distribution import medians, modes, quantiles, summarize
from ..operators.hygiene import first_per_key, present
from ..operators.projection import equal_split, evolution, project, share_of_group
from ..operators.scoring import (
    FIVE_AXES, density_rank_score, distance_to_median_score, geometric_index, impute_group_median, impute_median,
    indicator_risk, minmax, rank_score, weighted,
)
from ..operators.spatial import containing_areas, count_within, nearest, squared_degrees
from ..session import stage

YEAR, ZONE, CODE = "annee", "arrondissement", "code_insee_quartier"
AREA, PART = "surface_quartier_m2", "part_surface"

# Weights of the safety risk and of the comfort score.
SAFETY_WEIGHTS = {"score_risque_delinq_100": 0.7, "commissariat_risk_100": 0.2, "camera_risk_100": 0.1}
COMFORT_WEIGHTS = {"_calm": 0.5, "_stations": 0.25, "_works": 0.25}
STATION_RADIUS_KM = 0.8
SECURITY_HOUSING_WEIGHTS = {"tension_norm": 0.6, "crime_norm": 0.4}


def quarter_shares(quarters: DataFrame) -> DataFrame:
    """Fine zones with their part of the coarse zone's area."""
    typed = quarters.withColumns({ZONE: zone2(F.col(ZONE)), AREA: F.col(AREA).try_cast("double")}).where(
        F.col(ZONE).isNotNull()
    )
    return share_of_group(typed, ZONE, AREA, PART)


def with_quarter_points(quarters: DataFrame) -> DataFrame:
    lat, lon = split_point(F.col("geometry_xy"))
    return quarters.withColumns({"lat_q": lat, "lon_q": lon})


# -- prices and rents ---------------------------------------------------------------


def price_by_zone_year(sales: DataFrame) -> DataFrame:
    rows = present(sales.select(YEAR, zone2(F.col(ZONE)).alias(ZONE), "prix_m2"), YEAR, ZONE, "prix_m2")
    return summarize(rows, [YEAR, ZONE], "prix_m2", "prix_m2_median", "prix_m2_moyen", "nb_ventes")


def price_by_quarter_year(sales: DataFrame, quarters: DataFrame) -> DataFrame:
    """Zone-year prices replicated on the fine zones, sale counts split by area share."""
    fine = quarter_shares(quarters).select(ZONE, CODE, AREA, PART)
    wide = project(price_by_zone_year(sales), fine, ZONE, PART, {"nb_ventes": "nb_ventes_estime"})
    return wide.select(
        YEAR, ZONE, CODE, "prix_m2_median", "prix_m2_moyen", "nb_ventes", "nb_ventes_estime", AREA, PART
    )


def mean_price_by_zone(sales: DataFrame) -> DataFrame:
    return present(sales, ZONE).groupBy(ZONE).agg(F.avg("prix_m2").alias("prix_m2_moyen"))


def _year_in(df: DataFrame, name: str) -> Column:
    return F.col(name) if df.schema[name].dataType.simpleString() == "int" else whole(number_in(df, name))


def _rent_rows(rents: DataFrame, repair_zone: bool = True) -> DataFrame:
    """Typed rents; the zone is repaired from the fine-zone code where there is one."""
    year = pick_column(rents, ["annee", "ann"])
    zone = pick_column(rents, ["arrondissement", "secteurs geographiques"])
    rent = pick_column(rents, ["loyers de reference", "loyer reference"])
    if not (year and zone and rent):
        raise ValueError("rents need a year, a zone and a reference rent")
    zone_of = zone2(F.col(zone), postal=False)
    columns = {YEAR: _year_in(rents, year), "loyer_reference": number_in(rents, rent)}
    code = pick_column(rents, ["code insee quartier", "numero insee du quartier"])
    if code:
        # A clean table already holds seven-digit text under the clean name.
        insee = F.col(CODE) if code == CODE else digits_padded(F.col(code), 7)
        columns[CODE] = insee
        columns[ZONE] = harmonized_zone(insee, zone_of) if repair_zone else zone_of
    else:
        columns[ZONE] = zone_of
    optional = {
        "loyer_reference_majore": ["loyers de reference majores", "loyer_reference_majore"],
        "loyer_reference_minore": ["loyers de reference minores", "loyer_reference_minore"],
        "nombre_pieces_principales": ["nombre de pieces principales", "nombre_pieces_principales"],
    }
    texts = {
        "nom_quartier": ["nom du quartier", "nom_quartier"],
        "type_location": ["type de location", "type_location"],
        "epoque_construction": ["epoque de construction", "epoque_construction"],
    }
    for target, names in optional.items():
        found = pick_column(rents, names)
        if found:
            columns[target] = number_in(rents, found)
    for target, names in texts.items():
        found = pick_column(rents, names)
        if found:
            columns[target] = F.col(found)
    return rents.select(*[c.alias(n) for n, c in columns.items()])


def price_to_rent_by_zone_year(sales: DataFrame, rents: DataFrame, repair_zone: bool = True) -> DataFrame:
    """Years of rent a square metre costs; the ratio is taken before the rounding."""
    buy = price_by_zone_year(sales).withColumnRenamed("nb_ventes", "nb_transactions")
    rows = present(_rent_rows(rents, repair_zone).select(YEAR, ZONE, "loyer_reference"), YEAR, ZONE, "loyer_reference")
    rent = summarize(
        rows, [YEAR, ZONE], "loyer_reference", "loyer_reference_median", "loyer_reference_moyen", "nb_observations"
    )
    both = buy.join(rent, [YEAR, ZONE])
    ratio = years_of_rent(F.col("prix_m2_median"), F.col("loyer_reference_median"))
    return both.select(
        YEAR,
        ZONE,
        half_even(F.col("prix_m2_median"), 4).alias("prix_m2_median"),
        half_even(F.col("prix_m2_moyen"), 4).alias("prix_m2_moyen"),
        "nb_transactions",
        half_even(F.col("loyer_reference_median"), 4).alias("loyer_reference_median"),
        half_even(F.col("loyer_reference_moyen"), 4).alias("loyer_reference_moyen"),
        "nb_observations",
        half_even(ratio, 4).alias("kpi_comparaison_achat_location"),
    )


def price_to_rent_by_quarter_year(by_zone: DataFrame, quarters: DataFrame) -> DataFrame:
    """The zone-year ratio on every fine zone, with both counts split by area share."""
    fine = quarter_shares(quarters).select(ZONE, CODE, AREA, PART)
    wide = project(
        by_zone,
        fine,
        ZONE,
        PART,
        {"nb_transactions": "nb_transactions_estime", "nb_observations": "nb_observations_estime"},
    )
    return wide.select(
        YEAR, ZONE, CODE, "prix_m2_median", "prix_m2_moyen", "nb_transactions", "loyer_reference_median",
        "loyer_reference_moyen", "nb_observations", "kpi_comparaison_achat_location", AREA, PART,
        "nb_transactions_estime", "nb_observations_estime",
    )


def price_to_rent_evolution(by_quarter: DataFrame, before: int, after: int) -> DataFrame:
    return evolution(
        by_quarter,
        [ZONE, CODE],
        YEAR,
        before,
        after,
        {
            "prix_m2_median": "evolution_achat_pct",
            "loyer_reference_median": "evolution_loyer_pct",
            "kpi_comparaison_achat_location": "evolution_kpi_comparaison_pct",
        },
    )


def rents_by_quarter_year(rents: DataFrame) -> DataFrame:
    """Rent levels per fine zone and year: medians and modes of the columns present."""
    keys = [YEAR, ZONE, CODE]
    rows = stage(present(_rent_rows(rents), *keys, "loyer_reference"))
    middle = {
        "loyer_reference_median": "loyer_reference",
        "loyer_reference_majore_median": "loyer_reference_majore",
        "loyer_reference_minore_median": "loyer_reference_minore",
        "nombre_pieces_median": "nombre_pieces_principales",
    }
    common = {
        "nom_quartier": "nom_quartier",
        "type_location_mode": "type_location",
        "epoque_construction_mode": "epoque_construction",
    }
    middle = {o: c for o, c in middle.items() if c in rows.columns}
    common = {o: c for o, c in common.items() if c in rows.columns}
    facts = {"loyer_reference_median": {"mean": "loyer_reference_moyen", "count": "nb_observations"}}
    out = medians(rows, keys, middle, facts)
    if common:
        out = out.join(modes(rows, keys, common), keys, "left")
    order = [
        *keys, "loyer_reference_median", "loyer_reference_moyen", "nb_observations", "loyer_reference_majore_median",
        "loyer_reference_minore_median", "nombre_pieces_median", *common,
    ]
    return out.select(*[c for c in order if c in out.columns])


def rent_levels(rents: DataFrame, keys: list[str]) -> DataFrame:
    """Rent summary by any keys: median, mean, smallest, largest, with two decimals."""
    rows = present(rents, *keys, "loyer_reference")
    facts = {"min": "loyer_reference_min", "max": "loyer_reference_max", "count": "nb_observations", "mean": "_mean"}
    out = quantiles(rows, keys, "loyer_reference", {"_m": 0.5}, facts)
    return out.withColumns(
        {
            "loyer_reference_median": half_even(F.col("_m"), 2),
            "loyer_reference_moyen": half_even(F.col("_mean"), 2),
        }
    ).drop("_m", "_mean")


def tension(sales: DataFrame, rents: DataFrame) -> DataFrame:
    """Mean price over mean rent per zone and year, and the yearly gross yield in percent."""
    price = present(sales, YEAR, ZONE).groupBy(YEAR, ZONE).agg(F.avg("prix_m2").alias("prix_m2_moyen"))
    rent = present(rents, YEAR, ZONE).groupBy(YEAR, ZONE).agg(F.avg("loyer_reference").alias("loyer_moyen"))
    return price.join(rent, [YEAR, ZONE]).withColumns(
        {
            "tension": F.try_divide(F.col("prix_m2_moyen"), F.col("loyer_moyen")),
            "rendement_brut_pct": F.try_divide(F.col("loyer_moyen") * 1200, F.col("prix_m2_moyen")),
        }
    )


LEVELS = ("iris", "quartier", "arrondissement")
#: Observations that a level must hold for its price or rent to stand for the places within.
LEAST_OBSERVATIONS = 5


def by_levels(rows: DataFrame, codes: Mapping[str, str], value: str) -> DataFrame:
    """Median, mean and count of ``value`` at all levels from one pass: ``niveau``, ``cle``, ``mediane``, ``moyenne``, ``nb``.

    ``codes`` names the column of each level; a row without a code at a level does not count there."""
    spots = F.array(*[F.struct(F.lit(level).alias("niveau"), F.col(c).cast("string").alias("cle")) for level, c in codes.items()])
    long = rows.where(F.col(value).isNotNull()).select(F.explode(spots).alias("_s"), value).select("_s.*", value)
    return summarize(present(long, "cle"), ["niveau", "cle"], value, "mediane", "moyenne", "nb")


def finest(places: DataFrame, levels: DataFrame, codes: Mapping[str, str], out: Mapping[str, str], at: str, least: int) -> DataFrame:
    """``places`` with the figures (``out``: figure to column) of the finest level that has ``least`` observations, and
    that level's name; the coarsest level counts however few it has."""
    held, last = stage(levels), list(codes)[-1]
    for level, c in codes.items():
        figures = F.struct(*[F.col(f) for f in out], F.lit(level).alias("niveau")).alias(f"_{level}")
        own = held.where((F.col("niveau") == level) & ((F.col("nb") >= least) | F.lit(level == last)))
        places = places.join(own.select(F.col("cle").alias(c), figures), c, "left")
    best = F.coalesce(*[F.col(f"_{level}") for level in codes])
    places = places.withColumns({**{name: best[f] for f, name in out.items()}, at: best["niveau"]})
    return places.drop(*[f"_{level}" for level in codes])


def kpi_by_iris(
    sales: DataFrame, rents: DataFrame, housing: DataFrame, iris: DataFrame, id_columns: tuple[str, ...] = ("id",), least: int = LEAST_OBSERVATIONS
) -> DataFrame:
    """One row per statistical zone (``code_iris``, ``polygons``, fine and coarse zone) with the target table's figures.

    A sale belongs to the zone whose polygon holds its point; one that lies in none counts for the fine and coarse zone
    that it names itself. Prices are those of the zone, or of the finest coarser level with ``least`` sales; rents carry
    no finer place than the fine zone and start there; social housing is known by coarse zone. ``rentabilite`` is the
    yearly gross yield in percent, ``tension_immobiliere`` the price over the rent. A zone without a sale has 0
    transactions, one without any rent or price at any level has null figures.
    """
    shapes = stage(iris.select("code_iris", CODE, ZONE, "polygons"))
    where = shapes.select("code_iris", F.col(CODE).alias("_fine"), F.col(ZONE).alias("_coarse"))
    placed = containing_areas(sales, shapes, id_columns, code="code_iris", out="code_iris").join(where, "code_iris", "left")
    placed = stage(placed.select("code_iris", F.coalesce("_fine", CODE).alias(CODE), F.coalesce("_coarse", ZONE).alias(ZONE), "prix_m2"))
    codes = dict(zip(LEVELS, ("code_iris", CODE, ZONE)))
    prices = stage(by_levels(placed, codes, "prix_m2"))
    own = prices.where(F.col("niveau") == LEVELS[0]).select(F.col("cle").alias("code_iris"), F.col("nb").alias("nb_transactions"))
    out = shapes.select("code_iris", CODE, ZONE).join(own, "code_iris", "left").fillna(0, ["nb_transactions"])
    out = finest(out, prices, codes, {"moyenne": "prix_m2_moyen", "mediane": "prix_m2_median"}, "niveau_prix", least)
    coarser = {level: codes[level] for level in LEVELS[1:]}
    out = finest(out, by_levels(rents, coarser, "loyer_reference"), coarser, {"moyenne": "loyer_moyen"}, "niveau_loyer", least)
    homes = housing.groupBy(ZONE).agg(F.sum("nb_logements_finances").cast("bigint").alias("nb_logements_sociaux"))
    out = out.join(homes, ZONE, "left").fillna(0, ["nb_logements_sociaux"])
    price, rent = F.col("prix_m2_moyen"), F.col("loyer_moyen")
    return out.select(
        "code_iris", "prix_m2_moyen", "prix_m2_median", "nb_transactions", "loyer_moyen",
        F.try_divide(rent * 1200, price).alias("rentabilite"), F.try_divide(price, rent).alias("tension_immobiliere"),
        "nb_logements_sociaux", "niveau_prix", "niveau_loyer",
    )


# -- social housing -----------------------------------------------------------------


def match_programmes(housing: DataFrame, quarters: DataFrame) -> DataFrame:
    """Programmes with the nearest fine zone of their own coarse zone."""
    places = with_quarter_points(quarters).select(
        zone2(F.col(ZONE)).alias(ZONE), F.struct(CODE, "nom_quartier").alias("_place"), "lat_q", "lon_q"
    )
    found = nearest(
        housing, places, by=[ZONE], lat="latitude", lon="longitude", code="_place",
        ref_lat="lat_q", ref_lon="lon_q", out_code="_hit", out_distance="_far",
    )
    return found.withColumns({CODE: F.col(f"_hit.{CODE}"), "nom_quartier": F.col("_hit.nom_quartier")}).drop(
        "_hit", "_far"
    )


def social_housing_summary(housing: DataFrame, keys: list[str]) -> DataFrame:
    """Financed dwellings by key: totals, mean per programme, landlords, centre.

    A row missing any key is left out, which drops programmes without a matched fine zone.
    """
    rows = present(housing, *keys, "nb_logements_finances")
    measures = [
        F.sum("nb_logements_finances").alias("logements_finances_total"),
        half_even(F.avg("nb_logements_finances"), 2).alias("logements_finances_moyen"),
        F.count(F.lit(1)).alias("nb_programmes"),
    ]
    if "bailleur_social" in rows.columns:
        measures.append(F.count_distinct("bailleur_social").alias("nb_bailleurs"))
    for name in ("nb_pla_i", "nb_plus", "nb_plus_cd", "nb_pls"):
        if name in rows.columns:
            measures.append(F.sum(name).alias(f"{name}_total"))
    for name in ("latitude", "longitude"):
        if name in rows.columns:
            measures.append(half_even(F.avg(name), 6).alias(f"{name}_moyenne"))
    return rows.groupBy(*keys).agg(*measures)


def social_housing_by_quarter(housing: DataFrame, quarters: DataFrame) -> DataFrame:
    typed = housing.withColumn(ZONE, zone2(F.col(ZONE), postal=False))
    return social_housing_summary(match_programmes(typed, quarters), [YEAR, ZONE, CODE, "nom_quartier"])


# -- safety -------------------------------------------------------------------------


def crime_risk(crime: DataFrame) -> DataFrame:
    """Risk and safety out of 100 per year and zone, over all indicators present."""
    code = first_existing(crime, ["codgeo", "CODGEO_2025", "codgeo_2025"])
    rows = crime
    if code:
        commune = digits_padded(F.col(code), 5)
        zone = zone2(F.col(ZONE)) if ZONE in crime.columns else zone2(last_two(commune))
        rows = crime.where(commune.startswith("751")).withColumn(ZONE, zone)
    if "taux_effectif" not in rows.columns:
        rates = [as_number(F.col(c)) for c in ("taux_pour_mille", "complement_info_taux") if c in rows.columns]
        rows = rows.withColumn("taux_effectif", F.coalesce(*rates))
    return indicator_risk(
        rows, [YEAR, ZONE], "indicateur", "taux_effectif", "score_risque_delinq_100", "score_surete_delinq_100"
    )


def camera_risk(cameras: DataFrame) -> DataFrame:
    """Cameras per zone; few cameras count as risk."""
    counts = present(cameras.select(zone2(F.col(ZONE)).alias(ZONE)), ZONE).groupBy(ZONE).agg(
        F.count(F.lit(1)).alias("nb_cameras")
    )
    return minmax(counts, {"nb_cameras": "_s"}).withColumn("camera_risk_100", (1 - F.col("_s")) * 100).drop("_s")


def iris_points(iris: DataFrame) -> DataFrame:
    commune = digits_padded(F.col("INSEE_COM"), 5)
    lat, lon = split_point(F.col("Geo Point"))
    rows = iris.where(commune.startswith("751")).select(
        F.col("CODE_IRIS"), F.col("NOM_IRIS"), zone2(last_two(commune)).alias(ZONE), lat.alias("lat"), lon.alias("lon")
    )
    return present(rows, ZONE, "lat", "lon").dropDuplicates()


def safety_by_iris(
    points: DataFrame, crime_scores: DataFrame, camera_scores: DataFrame, stations: DataFrame
) -> DataFrame:
    """Risk and safety per statistical zone and year.

    The nearest station does not depend on the year, so it is found once per zone and the
    yearly scores are joined after. Its scale is the range over zone-year rows, and zones
    without any crime score have one row; both ranges are the same set of distances.
    """
    near = nearest(
        points, stations, code="station", out_code="_station", out_distance="dist_commissariat_km"
    )
    near = stage(near.drop("_station"))  # read for its range and for its rows
    scaled = minmax(near, {"dist_commissariat_km": "_s"})
    scaled = scaled.withColumn("commissariat_risk_100", F.col("_s") * 100).drop("_s")
    wide = scaled.join(crime_scores, ZONE, "left").join(camera_scores, ZONE, "left")
    return wide.withColumn("score_risque_final_100", weighted(SAFETY_WEIGHTS)).withColumn(
        "score_surete_final_100", 100 - F.col("score_risque_final_100")
    )


def attach_quarters(points: DataFrame, quarters: DataFrame) -> DataFrame:
    """Nearest fine zone of the same coarse zone; a wrong code is repaired by its short code."""
    places = with_quarter_points(quarters).withColumn(ZONE, zone2(F.col(ZONE)))
    places = places.withColumns(
        {
            "_short": F.col("code_quartier_id").try_cast("int"),
            "_long": F.regexp_replace(F.col(CODE).cast("string"), r"\.0+$", ""),
        }
    )
    places = present(places, "lat_q", "lon_q")
    repairs = first_per_key(
        present(places, "_short", "_long").select("_short", F.col("_long").alias("_repair")), ["_short"], ["_repair"]
    )
    refs = places.select(ZONE, "lat_q", "lon_q", F.struct("_long", "_short", "nom_quartier").alias("_place"))
    found = nearest(
        points, refs, by=[ZONE], code="_place", ref_lat="lat_q", ref_lon="lon_q",
        out_code="_hit", out_distance="_far",
    )
    named = found.withColumn("_short", F.col("_hit._short")).join(repairs, "_short", "left")
    code = F.when(F.col("_hit._long").startswith("75"), F.col("_hit._long")).otherwise(F.col("_repair"))
    return named.withColumns({CODE: code, "nom_quartier": F.col("_hit.nom_quartier")}).drop(
        "_hit", "_far", "_short", "_repair"
    )


def sorted_labels(col: str) -> Column:
    """Trimmed distinct texts of one fine zone in order, joined by `` | ``.

    The members of a fine zone are rows of the zone dimension, a few dozen at most.
    """
    text = F.trim(F.col(col).cast("string"))
    return F.array_join(F.array_sort(F.collect_set(F.nullif(text, F.lit("")))), " | ")


def safety_by_quarter(iris_scores: DataFrame, quarters: DataFrame) -> DataFrame:
    """Safety per fine zone and year with spread over its statistical zones.

    ``iris_scores`` comes from :func:`safety_by_iris`.
    """
    iris_scores = stage(iris_scores)  # read for the places and for the scores
    static = iris_scores.select("CODE_IRIS", ZONE, "lat", "lon").dropDuplicates(["CODE_IRIS"])
    placed = attach_quarters(static, quarters).select("CODE_IRIS", CODE)
    rows = present(iris_scores.join(placed, "CODE_IRIS"), YEAR, ZONE, CODE)
    measures = []
    for kind in ("surete", "risque"):
        score = f"score_{kind}_final_100"
        measures += [
            half_even(F.avg(score), 4).alias(f"score_{kind}_quartier_moyen_100"),
            half_even(F.min(score), 4).alias(f"score_{kind}_iris_min_100"),
            half_even(F.max(score), 4).alias(f"score_{kind}_iris_max_100"),
            half_even(F.stddev_samp(score), 4).alias(f"score_{kind}_iris_std_100"),
        ]
    out = rows.groupBy(YEAR, ZONE, CODE).agg(
        *measures,
        F.count_distinct("CODE_IRIS").alias("nb_iris_rattaches"),
        sorted_labels("CODE_IRIS").alias("codes_iris_rattaches"),
        sorted_labels("NOM_IRIS").alias("noms_iris_rattaches"),
        half_even(F.avg("dist_commissariat_km"), 4).alias("dist_commissariat_km_moyenne"),
        F.max("nb_cameras").alias("nb_cameras_arrondissement"),
    )
    return out.select(
        YEAR, ZONE, CODE, "score_surete_quartier_moyen_100", "score_risque_quartier_moyen_100",
        "score_surete_iris_min_100", "score_surete_iris_max_100", "score_surete_iris_std_100",
        "score_risque_iris_min_100", "score_risque_iris_max_100", "score_risque_iris_std_100", "nb_iris_rattaches",
        "codes_iris_rattaches", "noms_iris_rattaches", "dist_commissariat_km_moyenne", "nb_cameras_arrondissement",
    )


def safety_by_zone(iris_scores: DataFrame) -> DataFrame:
    return present(iris_scores, YEAR, ZONE).groupBy(YEAR, ZONE).agg(
        F.avg("score_surete_final_100").alias("score_surete_zone_moyen_100"),
        F.avg("score_risque_final_100").alias("score_risque_zone_moyen_100"),
        F.count_distinct("CODE_IRIS").alias("nb_iris"),
    )


# -- comfort ------------------------------------------------------------------------


def zone_counts(df: DataFrame, out: str) -> DataFrame:
    return present(df, ZONE).groupBy(ZONE).agg(F.count(F.lit(1)).alias(out))


def stations_to_zones(stations: DataFrame, quarters: DataFrame) -> DataFrame:
    """Zone of each station: the nearest mean centre of the zones' fine zones."""
    centres = (
        present(with_quarter_points(quarters).withColumn(ZONE, zone2(F.col(ZONE))), ZONE, "lat_q", "lon_q")
        .groupBy(F.col(ZONE).alias("zone_c"))
        .agg(F.avg("lat_q").alias("lat_c"), F.avg("lon_q").alias("lon_c"))
    )
    rows = stations.drop(ZONE) if ZONE in stations.columns else stations
    return nearest(
        rows, centres, lat="latitude", lon="longitude", code="zone_c", ref_lat="lat_c",
        ref_lon="lon_c", metric=squared_degrees, out_code=ZONE, out_distance="_far",
    ).drop("_far")


def zone_of_rows(df: DataFrame) -> DataFrame:
    """Rows with a normalised zone, read from the zone column or else the postal code."""
    source = first_existing(df, [ZONE, "code_postal"])
    return df.withColumn(ZONE, zone2(F.col(source)) if source else F.lit(None).cast("string"))


def comfort_scores(counts: DataFrame, quarters: DataFrame) -> DataFrame:
    """Comfort per fine zone from zone counts of incidents, works and stations."""
    fine = share_of_group(quarters, ZONE, AREA, PART)
    wide = fine.join(counts, ZONE, "left").fillna(0, subset=["incidents", "travaux", "gares"])
    wide = wide.withColumns(
        {f"{n}_estime": half_even(F.col(n) * F.col(PART), 0) for n in ("incidents", "travaux", "gares")}
    )
    scaled = minmax(wide, {"incidents_estime": "_i", "gares_estime": "_g", "travaux_estime": "_t"})
    scaled = scaled.withColumn("risque_incidents_100", F.col("_i") * 100).withColumns(
        {
            "_calm": 100 - F.col("risque_incidents_100"),
            "_stations": F.col("_g") * 100,
            "_works": F.col("_t") * 100,
        }
    )
    return scaled.withColumn("score_confort_urbain_100", weighted(COMFORT_WEIGHTS)).select(
        ZONE, CODE, "nom_quartier", AREA, PART, "incidents_estime", "travaux_estime", "gares_estime",
        "risque_incidents_100", "score_confort_urbain_100",
    )


def merge_counts(incidents: DataFrame, works: DataFrame, stations: DataFrame) -> DataFrame:
    """Three zone counts side by side; a zone any of them knows is kept, gaps are zero."""
    merged = incidents.join(works, ZONE, "outer").join(stations, ZONE, "outer")
    return merged.fillna(0, subset=["incidents", "travaux", "gares"])


def comfort_by_quarter(reports: DataFrame, stations: DataFrame, works: DataFrame, quarters: DataFrame) -> DataFrame:
    ref = quarters.withColumns(
        {
            ZONE: zone2(F.col(ZONE)),
            CODE: pad_left(F.col(CODE), 7),
            AREA: F.col(AREA).try_cast("double"),
        }
    )
    counts = merge_counts(
        zone_counts(zone_of_rows(reports), "incidents"),
        zone_counts(zone_of_rows(works), "travaux"),
        zone_counts(stations_to_zones(stations, ref), "gares"),
    )
    return comfort_scores(counts, ref)


def match_by_name(rows: DataFrame, name: str, quarters: DataFrame) -> DataFrame:
    """Rows with the code of the fine zone whose name key equals theirs; others keep null."""
    named = quarters.select(name_key(F.col("nom_quartier")).alias("_key"), CODE)
    last = named.groupBy("_key").agg(F.max(CODE).alias(CODE))
    return rows.withColumn("_key", name_key(F.col(name))).join(last, "_key", "left").drop("_key")


def match_rate(matched: DataFrame) -> DataFrame:
    hit = F.count_if(F.col(CODE).isNotNull())
    total = F.count(F.lit(1))
    return matched.agg(
        hit.alias("matched"), total.alias("total"), half_even(F.try_divide(hit * 100.0, total), 1).alias("pct")
    )


def cleanliness_axis(reports: DataFrame, quarters: DataFrame, out: str = "s1") -> DataFrame:
    dirt = reports.where(F.col("type_declaration").isin(rules.CLEANLINESS_TYPES))
    return _density_axis(dirt.groupBy(CODE).agg(F.count(F.lit(1)).cast("double").alias("_n")), quarters, out)


def incivility_axis(reports: DataFrame, quarters: DataFrame, out: str = "s2") -> DataFrame:
    bad = reports.where(F.col("type_declaration").isin(rules.INCIVILITY_TYPES))
    weight = rules.weight_all(F.col("sous_type_declaration"), rules.SEVERITY_RULES)
    return _density_axis(bad.groupBy(CODE).agg(F.sum(weight).alias("_n")), quarters, out)


def _density_axis(amounts: DataFrame, quarters: DataFrame, out: str) -> DataFrame:
    wide = quarters.join(amounts, CODE, "left").fillna(0.0, subset=["_n"])
    return density_rank_score(wide, "_n", "surface_m2", out, inverse=True).drop("_n")


def works_axis(works: DataFrame, quarters: DataFrame, out: str = "s3") -> DataFrame:
    """Weighted works of the coarse zone, split equally over its fine zones, by area."""
    weight = rules.weight_exact(F.col("categorie"), rules.WORKS_WEIGHTS, rules.WORKS_DEFAULT)
    zone = F.lpad(postal_modulo(F.col("code_postal")).cast("string"), 2, "0")
    totals = works.withColumn(ZONE, zone).where(F.col(ZONE).isNotNull()).groupBy(ZONE).agg(F.sum(weight).alias("_total"))
    wide = equal_split(totals, quarters, ZONE, "_total", "_n")
    return density_rank_score(wide, "_n", "surface_m2", out, inverse=False).drop("_n")


def rent_axis(rents: DataFrame, quarters: DataFrame, out: str = "s4") -> DataFrame:
    """Closeness to the city's median rent: latest year, unfurnished, two rooms."""
    newest = rents.agg(F.max("annee")).scalar()
    kept = (
        rents.withColumn("_newest", newest)
        .where(F.col("annee") == F.col("_newest"))
        .where(contains_folded(F.col("type_location"), "non"))
        .where(F.contains(F.col("nombre_pieces").cast("string"), F.lit("2")))
    )
    means = present(kept, CODE, "loyer").groupBy(CODE).agg(F.avg("loyer").alias("_rent"))
    wide = impute_group_median(quarters.join(means, CODE, "left"), ZONE, "_rent")
    return distance_to_median_score(wide, "_rent", out).drop("_rent")


def transport_axis(stations: DataFrame, quarters: DataFrame, out: str = "s5") -> DataFrame:
    counted = count_within(
        quarters, stations, CODE, STATION_RADIUS_KM, "lat_q", "lon_q", "latitude", "longitude", KM_PER_DEGREE_RADIUS, "_near"
    )
    return rank_score(counted, "_near", out).drop("_near")


def five_axis_index(quarters: DataFrame, axes: Mapping[str, DataFrame], exponents: Mapping[str, float] = FIVE_AXES) -> DataFrame:
    """Join the axis scores on the fine zone, fill gaps with medians, take the geometric index."""
    wide = quarters
    for name, scores in axes.items():
        wide = wide.join(scores.select(CODE, name), CODE, "left")
    filled = impute_median(stage(wide), list(axes))
    return filled.withColumn("kpi_confort_urbain", geometric_index(exponents))


def urban_comfort_from_layer(
    reports: DataFrame, works: DataFrame, rents: DataFrame, stations: DataFrame, quarters: DataFrame
) -> DataFrame | None:
    """The five-axis index from the cleaned tables; None if one of them lacks a column that an axis needs."""
    needs = (
        (reports, ("type_objet", "sous_type_objet", "conseil_de_quartier")),
        (works, ("categorie_operation", "code_postal")),
        (rents, ("annee", "code_insee_quartier", "type_location", "nombre_pieces_principales", "loyer_reference")),
        (stations, ("latitude", "longitude")),
        (quarters, (ZONE, CODE, "nom_quartier", AREA, "geometry_xy")),
    )
    if any(c not in df.columns for df, names in needs for c in names):
        return None
    named = reports.withColumnsRenamed({"type_objet": "type_declaration", "sous_type_objet": "sous_type_declaration"})
    fine = with_quarter_points(quarters).select(ZONE, CODE, "nom_quartier", F.col(AREA).alias("surface_m2"), "lat_q", "lon_q")
    return urban_comfort_five_axes(
        match_by_name(named.drop(CODE), "conseil_de_quartier", fine),
        works.select(F.col("categorie_operation").alias("categorie"), "code_postal"),
        rents.select("annee", CODE, "type_location", F.col("nombre_pieces_principales").alias("nombre_pieces"), F.col("loyer_reference").alias("loyer")),
        stations,
        fine,
    )


def urban_comfort_five_axes(
    reports: DataFrame, works: DataFrame, rents: DataFrame, stations: DataFrame, quarters: DataFrame
) -> DataFrame:
    """The five axes over one fine-zone dimension, written once because each axis reads it."""
    quarters = stage(quarters)
    return five_axis_index(
        quarters,
        {
            "s1": cleanliness_axis(reports, quarters),
            "s2": incivility_axis(reports, quarters),
            "s3": works_axis(works, quarters),
            "s4": rent_axis(rents, quarters),
            "s5": transport_axis(stations, quarters),
        },
    )


def comfort_zone_average(scores: DataFrame, score: str, area: str) -> DataFrame:
    return scores.groupBy(ZONE).agg(
        F.avg(score).alias(f"{score}_moyen"),
        F.count(F.lit(1)).alias("nb_quartiers"),
        F.sum(area).alias("surface_m2"),
    )


# -- bridges and extensions ---------------------------------------------------------


def bridge(iris: DataFrame, quarters: DataFrame) -> DataFrame:
    """Every statistical zone with every fine zone of its coarse zone; unmatched ones kept blank."""
    left = iris.select(
        F.trim("CODE_IRIS").alias("code_iris"),
        F.trim("INSEE_COM").alias("insee_com"),
        F.coalesce(F.trim("NOM_IRIS"), F.lit("")).alias("nom_iris"),
    ).where("code_iris != ''")
    left = left.withColumn(ZONE, F.coalesce(zone_of_commune(F.col("insee_com")), F.lit("")))
    right = quarters.select(
        F.trim(ZONE).alias(ZONE), F.trim(CODE).alias(CODE), F.coalesce(F.trim("nom_quartier"), F.lit("")).alias("nom_quartier")
    ).where(f"{ZONE} != '' and {CODE} != ''")
    blank = F.lit("")
    return left.join(right, ZONE, "left").select(
        "code_iris",
        F.coalesce(CODE, blank).alias(CODE),
        F.coalesce("nom_quartier", blank).alias("nom_quartier"),
        F.coalesce("insee_com", blank).alias("insee_com"),
        ZONE,
        "nom_iris",
    )


def yearly_change(df: DataFrame, keys: list[str], measure: str, out: str) -> DataFrame:
    """Percent change from the year before, by equality on the year, over a yearly table."""
    before = df.select(*keys, (F.col(YEAR) + 1).alias(YEAR), F.col(measure).alias("_before"))
    wide = df.join(before, [*keys, YEAR], "left")
    return wide.withColumn(out, percent_change(F.col("_before"), F.col(measure), None)).drop("_before")


def mix_by(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Share of each label among the rows of a key, in percent."""
    counts = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("nb"))
    totals = counts.groupBy(*keys).agg(F.sum("nb").alias("_all"))
    return counts.join(totals, keys).withColumn("part_pct", F.col("nb") * 100.0 / F.col("_all")).drop("_all")


def crime_level(df: DataFrame, keys: list[str], rate: str, count: str, population: str) -> DataFrame:
    """Mean rate per key, else events per thousand inhabitants."""
    per_head = F.try_divide(F.sum(count), F.sum(population)) * 1000
    return df.groupBy(*keys).agg(F.coalesce(F.avg(rate), per_head).alias("niveau"))


def security_housing_index(df: DataFrame, tension_column: str, crime_column: str) -> DataFrame:
    scaled = minmax(df, {tension_column: "tension_norm", crime_column: "crime_norm"})
    return scaled.withColumn("indice", weighted(SECURITY_HOUSING_WEIGHTS))


def intensity(df: DataFrame, keys: list[str], amount: str, units: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.try_divide(F.sum(amount), F.sum(units)).alias(out))


def coverage(points: DataFrame, keys: list[str], distance: str, limit_km: float) -> DataFrame:
    """Mean nearest distance and share of points within a limit, per key."""
    return points.groupBy(*keys).agg(
        F.avg(distance).alias("distance_moyenne_km"),
        F.avg(F.when(F.col(distance) <= limit_km, 1.0).otherwise(0.0)).alias("part_couverte"),
    )
