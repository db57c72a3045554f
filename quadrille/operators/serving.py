"""Queries over published tables: latest values, profiles, ranking, search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import mean_available
from ..functions.text import any_match, contains_folded, first_non_empty
from ..functions.zones import pad_left
from .scoring import INDEX_BOUNDS, bounded

CODE, ZONE, YEAR = "code_insee_quartier", "arrondissement", "annee"

# The published categories and the measure each one is read by.
CATEGORY_MEASURES = {
    "confort": "score_confort_urbain_100",
    "surete": "score_surete_quartier_moyen_100",
    "prix_m2": "prix_m2_median",
    "loyers": "loyer_reference_median",
    "logements_sociaux": "logements_finances_moyen",
    "comparaison": "kpi_comparaison_achat_location",
}
SCORED = ("confort", "surete")
LOW_IS_GOOD = ("prix_m2", "loyers")

# The series shown per category over the years.
HISTORY_MEASURES = {
    "surete": "score_surete_quartier_moyen_100",
    "prix_m2": "prix_m2_median",
    "loyers": "loyer_reference_median",
    "logements_sociaux": "logements_finances_total",
    "comparaison": "kpi_comparaison_achat_location",
}

# Address fields searched, in the record and in its properties.
ADDRESS_FIELDS = ["numero", "rue", "full", "adresse_numero", "adresse_nom_voie", "code_postal"]
ADDRESS_KEY = ["numero", "rue", "code_postal", "lat", "lon"]


def latest(df: DataFrame, keys: Sequence[str] = (CODE,), year: str = YEAR, at: int | None = None) -> DataFrame:
    """Row of the latest year per key (or of one given year).

    ``max_by`` reduces before the shuffle, so a key with a long history is no burden. A
    table without a year keeps one row per key, the smallest.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    if year in df.columns:
        rows = df if at is None else df.where(F.col(year) == at)
        best = rows.groupBy(*keys).agg(F.max_by(row, F.struct(F.col(year), row)).alias("_r"))
    else:
        best = df.groupBy(*keys).agg(F.min(row).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def choropleth(tables: Mapping[str, DataFrame], category: str) -> DataFrame:
    """Code and latest value of one category's measure."""
    if category not in CATEGORY_MEASURES:
        raise ValueError(f"unknown category: {category}")
    table = tables[category]
    return latest(table).select(CODE, F.col(CATEGORY_MEASURES[category]).alias("score"))


def latest_scores(tables: Mapping[str, DataFrame], categories: Sequence[str]) -> DataFrame:
    """One row per code with the latest measure of each known category, in one grouping.

    The tables are stacked in long form and reduced once, instead of one join per category.
    """
    known = [c for c in categories if c in tables and c in CATEGORY_MEASURES]
    stacked = None
    for category in known:
        table = tables[category]
        when = F.col(YEAR) if YEAR in table.columns else F.lit(0)
        part = table.select(
            CODE,
            F.lit(category).alias("category"),
            when.cast("int").alias("_year"),
            F.col(CATEGORY_MEASURES[category]).cast("double").alias("_value"),
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    at = F.struct(F.col("_year").alias("y"), F.col("_value").alias("v"))
    return stacked.groupBy(CODE).agg(
        *[F.max(F.when(F.col("category") == c, at)).getField("v").alias(c) for c in known]
    )


def profile(tables: Mapping[str, DataFrame], categories: Sequence[str], code: str | None = None) -> DataFrame:
    """Latest row of each category per code as one struct column per category."""
    wide = None
    for category in [c for c in categories if c in tables]:
        table = tables[category] if code is None else tables[category].where(F.col(CODE) == code)
        row = latest(table)
        packed = row.select(CODE, F.struct(*[c for c in row.columns if c != CODE]).alias(category))
        wide = packed if wide is None else wide.join(packed, CODE, "outer")
    return wide


def ranking(members: DataFrame, tables: Mapping[str, DataFrame], categories: Sequence[str]) -> DataFrame:
    """Rank the fine zones of every coarse zone by the mean of their normalised scores.

    ``members`` holds one row per fine zone. Scores out of 100 are taken as they are; the
    others are min-max scaled among the members of the coarse zone (constant: 100), turned
    round where low is good. A member without any score gets 0.
    """
    known = [c for c in categories if c in tables and c in CATEGORY_MEASURES]
    raw = members.join(latest_scores(tables, known), CODE, "left")
    scaled = [c for c in known if c not in SCORED]
    ends = [F.min(c).alias(f"_{c}_min") for c in scaled] + [F.max(c).alias(f"_{c}_max") for c in scaled]
    wide = raw.join(raw.groupBy(ZONE).agg(F.count(F.lit(1)).alias("_members"), *ends), ZONE)
    parts: list[Column] = []
    for category in known:
        value, low, high = F.col(category), F.col(f"_{category}_min"), F.col(f"_{category}_max")
        if category in SCORED:
            parts.append(value)
            continue
        span = F.try_divide(high - value if category in LOW_IS_GOOD else value - low, high - low) * 100
        parts.append(F.when(value.isNotNull() & (low == high), F.lit(100.0)).otherwise(span))
    scored = wide.withColumn("composite_score", F.coalesce(mean_available(*parts), F.lit(0.0)))
    order = Window.partitionBy(ZONE).orderBy(F.col("composite_score").desc(), CODE)
    return scored.withColumn("rank", F.row_number().over(order)).select(
        ZONE, CODE, *[c for c in members.columns if c not in (ZONE, CODE)], *known, "composite_score", "rank"
    )


def global_index(scores: Mapping[str, Column]) -> Column:
    """Mean of the selected categories after fixed-bound scaling; 0 when none is present."""
    parts = []
    for category, value in scores.items():
        if category in INDEX_BOUNDS:
            low, high, inverse = INDEX_BOUNDS[category]
            parts.append(bounded(value, low, high, inverse))
        else:
            parts.append(value)
    return F.coalesce(mean_available(*parts), F.lit(0.0))


def history(tables: Mapping[str, DataFrame], code: str | None = None) -> DataFrame:
    """Long series (code, category, year, value) of the yearly categories."""
    stacked = None
    for category, measure in HISTORY_MEASURES.items():
        if category not in tables:
            continue
        part = tables[category].select(
            CODE, F.lit(category).alias("category"), F.col(YEAR).cast("int").alias(YEAR), F.col(measure).cast("double").alias("value")
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked if code is None else stacked.where(F.col(CODE) == code)


def zone_members(members: DataFrame, zone: str, name: str) -> DataFrame:
    """Fine zones per coarse zone: count and sorted names (a zone dimension, tens of rows each)."""
    return members.groupBy(zone).agg(
        F.count(F.lit(1)).alias("nb_quartiers"), F.sort_array(F.collect_list(name)).alias("quartiers")
    )


def address_records(documents: DataFrame) -> DataFrame:
    """Address rows with fallbacks: properties first, then the record, then assembled text."""
    inner = documents.schema["properties"].dataType.fieldNames() if "properties" in documents.columns else []

    def pick(*names: str, default: str | None = "") -> Column:
        found = [F.col(f"properties.{n}") for n in names if n in inner]
        found += [F.col(n) for n in names if n in documents.columns]
        return first_non_empty(*found, default=default) if found else F.lit(default)

    number = pick("numero", "adresse_numero", "house_number")
    street = pick("rue", "adresse_nom_voie", "nom_voie", "voie")
    postal = pick("code_postal", "postal_code")
    assembled = F.trim(F.concat(number, F.lit(" "), street, F.lit(", "), postal, F.lit(" Paris")))
    return documents.select(
        number.alias("numero"),
        street.alias("rue"),
        postal.alias("code_postal"),
        pick("lat", "latitude", "y", default="0").try_cast("double").alias("lat"),
        pick("lon", "longitude", "x", default="0").try_cast("double").alias("lon"),
        F.coalesce(pick("full", "adresse_complete", default=None), assembled).alias("full"),
        pick("type", default="Adresse").alias("type"),
    )


def search_addresses(documents: DataFrame, pattern: str, fields: Sequence[str] = ADDRESS_FIELDS) -> DataFrame:
    """Distinct address records of the raw documents with the pattern in any field; every hit.

    A field is searched where it stands, in the properties and in the document, before the record is assembled from
    the first of them that has a value. Ordering and limits are the caller's.
    """
    inner = documents.schema["properties"].dataType.fieldNames() if "properties" in documents.columns else []
    places = [F.col(f"properties.{f}") for f in fields if f in inner] + [F.col(f) for f in fields if f in documents.columns]
    found = address_records(documents.where(any_match(places, pattern)))
    return found.dropDuplicates(ADDRESS_KEY)


def search_places(documents: DataFrame, quarters: DataFrame, pattern: str) -> DataFrame:
    """Matching addresses; zones by name only when no address matches."""
    found = search_addresses(documents, pattern)
    anything = found.agg(F.count(F.lit(1))).scalar()
    zones = quarters.where(any_match([F.col("nom_quartier")], pattern)).select(
        F.lit("").alias("numero"),
        F.col("nom_quartier").alias("rue"),
        postal_prefix(F.col(ZONE)).alias("code_postal"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        F.concat(F.col("nom_quartier"), F.lit(", Paris")).alias("full"),
        F.lit("Quartier").alias("type"),
    )
    fallback = zones.withColumn("_n", anything).where("_n = 0").drop("_n")
    return found.select(*zones.columns).unionByName(fallback)


def postal_prefix(zone: Column, stem: str = "75") -> Column:
    return F.concat(F.lit(stem), pad_left(zone, 2))


def addresses_of_zone(addresses: DataFrame, zone: str, stem: str = "75", postal: str = "code_postal") -> DataFrame:
    """Addresses whose postal code starts with the zone's prefix, or that carry the zone."""
    test = F.col(postal).startswith(f"{stem}{zone.zfill(2)}")
    if ZONE in addresses.columns:
        test = test | (F.col(ZONE) == zone)
    return addresses.where(F.coalesce(test, F.lit(False)))


def find_by_name(places: DataFrame, name: str, column: str, code: str) -> DataFrame:
    """One row: exact folded name first, then the first name that contains the text."""
    wanted = name.strip().lower()
    exact = F.lower(F.trim(F.col(column))) == wanted
    return (
        places.where(exact | contains_folded(F.col(column), wanted))
        .orderBy(F.when(exact, 0).otherwise(1), F.col(code))
        .limit(1)
    )
