"""Text keys, lenient numbers, zone codes, rules and search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numbers import as_number, lenient_number
from ..functions.text import first_non_empty, geo_name, text_key
from ..functions.zones import (
    digits_padded, harmonized_zone, insee_code, last_two, postal_modulo, postal_suffix, zone2, zone2_published,
)
from ..operators.hygiene import blank_to_null, drop_states, fill_text, in_zones
from ..operators.serving import (
    address_records, addresses_of_zone, find_by_name, postal_prefix, search_places,
)
from ..plans import indicators as kpi
from .registry import Tables, query
from .safety import by_kind, case_kind
from .standins import QUARTERS, code_of, q, quarters, with_sql, z, zone_of

KEY = "trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', '_', 'g'), '_')"


@query("text_key", f"select doc_id, md5({KEY.format('text')}) as cle from documents")
def text_keys(t: Tables) -> DataFrame:
    """Key of every whole text, as a digest."""
    return t.documents.select("doc_id", F.md5(text_key(F.col("text"))).alias("cle"))


@query("geo_name", """
select doc_id, md5(replace(replace(strip_accents(lower(trim(text, ' '))), '-', ' '), '_', ' ')) as nom
from documents
union all select doc_id + 1000000000, md5('inconnu') from documents""")
def geo_names(t: Tables) -> DataFrame:
    """Readable place form of every whole text; as many added rows have none, which is the unknown place."""
    added = t.documents.select((F.col("doc_id") + 1_000_000_000).alias("doc_id"), F.lit(None).cast("string").alias("text"))
    return t.documents.select("doc_id", "text").unionByName(added).select("doc_id", F.md5(geo_name(F.col("text"))).alias("nom"))


@query("lenient_number", """
select o_orderkey, case when o_orderkey % 4 < 2 then o_totalprice end as lenient,
  case when o_orderkey % 4 = 0 then o_totalprice end as plain from orders""")
def lenient_numbers(t: Tables) -> DataFrame:
    """Plain numbers, decimal commas with blanks, words, and the word for not-a-number."""
    kind, text = F.col("o_orderkey") % 4, F.col("o_totalprice").cast("string")
    spaced = F.concat(F.lit(" "), F.translate(text, ".", ","), F.lit("  "))
    written = F.when(kind == 0, text).when(kind == 1, spaced).when(kind == 2, F.concat(text, F.lit(" EUR"))).otherwise("nan")
    rows = t.orders.select("o_orderkey", written.alias("text"))
    return rows.select(
        "o_orderkey", lenient_number(F.col("text")).alias("lenient"), as_number(F.col("text")).alias("plain")
    )


@query("zone_code_parse", f"""
select c_custkey, cast(75001 + c_custkey % 20 as varchar) as postal, {z('c_custkey')} as zone,
  {q('c_custkey')} as insee, cast(c_custkey % 20 + 1 as integer) as suffix, cast(c_custkey % 20 + 1 as integer) as modulo,
  lpad(cast(c_custkey as varchar), greatest(length(cast(c_custkey as varchar)), 3)::integer, '0') as padded from customer""")
def zone_code_parse(t: Tables) -> DataFrame:
    """Codes written as numbers with decimals or inside words, read back."""
    key = F.col("c_custkey")
    postal = F.concat((key % 20 + 75001).cast("string"), F.lit(".0"))
    rows = t.customer.select(
        "c_custkey",
        postal.alias("text"),
        F.concat(F.lit("n° "), key.cast("string"), F.lit(" bis 12")).alias("label"),
        zone_of(key).alias("z"),
        F.substring(code_of(key), 6, 2).alias("n"),
    )
    code = digits_padded(F.col("text"), 5)
    return rows.select(
        "c_custkey",
        code.alias("postal"),
        last_two(code).alias("zone"),
        insee_code(F.col("z"), F.col("n")).alias("insee"),
        postal_suffix(F.col("text")).alias("suffix"),
        postal_modulo(F.col("text")).alias("modulo"),
        digits_padded(F.col("label"), 3).alias("padded"),
    )


@query("zone_normalize", f"""
select c_custkey, case when c_custkey % 5 < 3 then {z('c_custkey')} end as zone,
  case c_custkey % 5 when 0 then {z('c_custkey')} when 1 then {z('c_custkey')}
    when 2 then cast(75001 + c_custkey % 20 as varchar) when 3 then '21' else 'Paris' end as published from customer""")
def zone_normalize(t: Tables) -> DataFrame:
    number = F.col("c_custkey") % 20 + 1
    kind = F.col("c_custkey") % 5
    text = (
        F.when(kind == 0, number.cast("string"))
        .when(kind == 1, F.concat(number.cast("string"), F.lit(".0")))
        .when(kind == 2, (number + 75000).cast("string"))
        .when(kind == 3, "21")
        .otherwise("Paris")
    )
    rows = t.customer.select("c_custkey", text.alias("text"))
    return rows.select(
        "c_custkey", zone2(F.col("text")).alias("zone"), zone2_published(F.col("text")).alias("published")
    )


@query("zone_harmonize", f"""
select case when c_custkey % 3 = 0 then '99' else {z('c_custkey')} end as zone, count(*) as n from customer group by all""")
def zone_harmonize(t: Tables) -> DataFrame:
    """The zone inside the code wins; a code without one leaves the given zone."""
    key = F.col("c_custkey")
    code = F.when(key % 3 == 0, "9209934").otherwise(code_of(key))
    rows = t.customer.select(code.alias("code"), F.lit("99").alias("given"))
    zone = harmonized_zone(F.col("code"), F.col("given"))
    return rows.groupBy(zone.alias("zone")).agg(F.count(F.lit(1)).alias("n"))


@query("fill_text", """
select case when lang = 'de' then 'non_renseigne' else lang end as lang, count(*) as n, sum(n_chars)::bigint as total
from documents group by all""")
def fill_missing_text(t: Tables) -> DataFrame:
    rows = t.documents.select(F.nullif("lang", F.lit("de")).alias("lang"), "n_chars")
    return fill_text(rows).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("total"))


@query("blank_to_null", """
select source, count(case when lang <> 'fr' then 1 end) as present, count(case when lang = 'fr' then 1 end) as missing
from documents group by all""")
def blanks(t: Tables) -> DataFrame:
    rows = t.documents.select("source", F.when(F.col("lang") == "fr", "").otherwise(F.col("lang")).alias("lang"))
    return blank_to_null(rows).groupBy("source").agg(
        F.count("lang").alias("present"), F.count_if(F.col("lang").isNull()).alias("missing")
    )


def _case_rules(key: str, edge: bool) -> str:
    left, right = ("(^|_)", "(_|$)") if edge else ("", "")
    whens = " ".join(
        f"when regexp_matches({key}, '{left}({'|'.join(words)}){right}') then '{label}'"
        for label, words in rules.REPORT_RULES
    )
    return f"case {whens} else '{rules.REPORT_DEFAULT}' end"


@query("categorize_text", f"""
with k as (select doc_id, {KEY.format("text || ' ' || lang")} as cle from documents)
select doc_id, {_case_rules('cle', False)} as categorie, {_case_rules('cle', True)} as categorie_mot from k""")
def categorize_text(t: Tables) -> DataFrame:
    """Category of every whole text, by keyword anywhere and by whole word."""
    cols = [F.col("text"), F.col("lang")]
    out = rules.with_category(t.documents.select("doc_id", "text", "lang"), cols, {"categorie": False, "categorie_mot": True})
    return out.select("doc_id", "categorie", "categorie_mot")


MODES = {
    "click": "Construction neuve",
    "error": "autre",
    "purchase": "Acquisition-réhabilitation",
    "signup": "Acquisition conventionnement",
    "view": "CONSTRUCTION NEUVE ",
}


@query("encode_mode", f"""
select {case_kind(click=0, purchase=1, signup=2, view=0)} as code, count(*) as n from events group by all""")
def encode_mode(t: Tables) -> DataFrame:
    rows = t.events.select(by_kind(**MODES).alias("mode"))
    code = rules.encode_first(text_key(F.col("mode")), rules.MODE_RULES)
    return rows.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("encode_binary", f"""
select {case_kind(click=1, purchase=0, view=0)} as code, count(*) as n from events group by all""")
def encode_binary(t: Tables) -> DataFrame:
    kinds = by_kind(click="Meublé", error="?", purchase="non meublé", signup="meublés", view=" Non-Meublé ")
    rows = t.events.select(kinds.alias("type"))
    code = rules.encode_exact(text_key(F.col("type")), rules.RENTAL_CODES)
    return rows.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))


STATES = {"click": "Annulé", "error": "Non fondé", "purchase": "Traité", "signup": "nonfondé", "view": "Transmis"}


@query("filter_status", f"""
select event_type, {z('user_id')} as zone, count(*) as n from events
where event_type in ('purchase', 'view') group by all""")
def filter_status(t: Tables) -> DataFrame:
    rows = t.events.withColumn("etat", by_kind(**STATES))
    kept = drop_states(rows, F.col("etat"), rules.DROPPED_STATES)
    return kept.groupBy("event_type", zone_of(F.col("user_id")).alias("zone")).agg(F.count(F.lit(1)).alias("n"))


@query("filter_zone_prefix", f"""
select {z('c_custkey')} as arrondissement, count(*) as n from customer
where c_mktsegment not in ('AUTOMOBILE', 'BUILDING') group by all""")
def filter_zone_prefix(t: Tables) -> DataFrame:
    """Commune codes of the city, of a suburb and of a zone that does not exist."""
    key = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    city = F.concat(F.lit("751"), zone_of(key))
    commune = F.when(segment == "AUTOMOBILE", "92044").when(segment == "BUILDING", "75199").otherwise(city)
    rows = t.customer.select(commune.alias("codgeo")).where(F.col("codgeo").startswith("751"))
    return in_zones(rows.select(last_two(F.col("codgeo")).alias("arrondissement"))).groupBy("arrondissement").agg(
        F.count(F.lit(1)).alias("n")
    )


def named_rows(t: Tables) -> DataFrame:
    """Council names written in capitals with accents, one in four of no known place."""
    key = F.col("c_custkey")
    name = F.when(key % 4 == 3, "AUTRE").otherwise(F.concat(F.lit("PLACE ÉTÉ "), code_of(key)))
    return t.customer.select("c_custkey", name.alias("conseil"))


@query("name_match_join", f"""
select case when c_custkey % 4 < 3 then {q('c_custkey')} end as code_insee_quartier, count(*) as n from customer group by all""")
def name_match_join(t: Tables) -> DataFrame:
    matched = kpi.match_by_name(named_rows(t), "conseil", quarters(t))
    return matched.groupBy("code_insee_quartier").agg(F.count(F.lit(1)).alias("n"))


@query("name_match_rate", """
select count(case when c_custkey % 4 < 3 then 1 end) as matched, count(*) as total,
  round_even(count(case when c_custkey % 4 < 3 then 1 end) * 100.0::double / count(*), 1) as pct from customer""")
def name_match_rate(t: Tables) -> DataFrame:
    return kpi.match_rate(kpi.match_by_name(named_rows(t), "conseil", quarters(t)))


def address_documents(t: Tables) -> DataFrame:
    """Address documents whose fields sit in the properties, in the record, or nowhere."""
    key = F.col("c_custkey")
    number = key.cast("string")
    return t.customer.select(
        F.struct(
            F.when(key % 3 == 0, number).otherwise("").alias("numero"),
            F.when(key % 3 == 0, F.col("c_name")).alias("adresse_nom_voie"),
            postal_prefix(zone_of(key)).alias("code_postal"),
        ).alias("properties"),
        F.when(key % 3 == 1, number).alias("numero"),
        F.when(key % 3 > 0, F.col("c_name")).alias("rue"),
        (F.lit(48.8) + (key % 100) / 1000).alias("lat"),
        (F.lit(2.3) + (key % 70) / 1000).alias("lon"),
        zone_of(key).alias("arrondissement"),
    )


ADDRESSES = f"""addresses as (
  select case when c_custkey % 3 = 2 then '' else cast(c_custkey as varchar) end as numero, c_name as rue,
    '75' || {z('c_custkey')} as code_postal, 48.8::double + (c_custkey % 100) / 1000.0::double as lat,
    2.3::double + (c_custkey % 70) / 1000.0::double as lon,
    trim(case when c_custkey % 3 = 2 then '' else cast(c_custkey as varchar) end || ' ' || c_name || ', 75' || {z('c_custkey')} || ' Paris', ' ') as "full",
    'Adresse' as type, {z('c_custkey')} as arrondissement from customer)"""


@query("first_non_empty", with_sql(ADDRESSES, select="""
select numero, rue, code_postal, round_even(lat, 6) as lat, round_even(lon, 6) as lon, "full", type from addresses"""))
def address_assembly(t: Tables) -> DataFrame:
    """Address records with their fallbacks."""
    out = address_records(address_documents(t))
    return out.withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


@query("first_non_empty_text", """
select event_id, case when event_type = 'click' then props when event_type = 'view' then event_type else 'aucun' end as texte
from events""")
def first_text(t: Tables) -> DataFrame:
    first = F.when(F.col("event_type") == "click", F.col("props")).otherwise("")
    second = F.when(F.col("event_type") == "view", F.col("event_type"))
    return t.events.select("event_id", first_non_empty(first, second, default="aucun").alias("texte"))


@query("search_text", with_sql(ADDRESSES, select="""
select numero, rue, code_postal, round_even(lat, 6) as lat, round_even(lon, 6) as lon, "full", type from (
  select distinct numero, rue, code_postal, lat, lon, "full", type from addresses
  where lower(rue) like '%customer#00000%5%') x"""))
def search_text(t: Tables) -> DataFrame:
    """All addresses with the pattern in any of their twelve raw fields."""
    found = search_places(address_documents(t), placed_quarters(t), "CUSTOMER#00000.*5")
    return found.withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


@query("search_text_fallback", with_sql(QUARTERS, select="""
select '' as numero, nom_quartier as rue, '75' || arrondissement as code_postal, lat_q as lat, lon_q as lon,
  nom_quartier || ', Paris' as "full", 'Quartier' as type from quarters where nom_quartier like '%75107%'"""))
def search_text_fallback(t: Tables) -> DataFrame:
    """No address matches, so zones are searched by name."""
    found = search_places(address_documents(t), placed_quarters(t), "place-.* 75107")
    return found.select("numero", "rue", "code_postal", "lat", "lon", "full", "type")


def placed_quarters(t: Tables) -> DataFrame:
    return quarters(t).withColumnsRenamed({"lat_q": "lat", "lon_q": "lon"})


@query("search_by_prefix", with_sql(ADDRESSES, select="""
select numero, rue, code_postal from addresses where code_postal like '7507%' or arrondissement = '07'"""))
def search_by_prefix(t: Tables) -> DataFrame:
    rows = address_records(address_documents(t))
    return addresses_of_zone(rows, "7").select("numero", "rue", "code_postal")


@query("find_by_name", with_sql(QUARTERS, select="""
select 'exact' as mode, code_insee_quartier from quarters where code_insee_quartier = '7510702'
union all select 'contains', min(code_insee_quartier) from quarters where nom_quartier like '%75109%'"""))
def find_places(t: Tables) -> DataFrame:
    """Exact name first, else the first name that contains the text."""
    places = quarters(t)
    exact = find_by_name(places, " place-été 7510702 ", "nom_quartier", "code_insee_quartier")
    inside = find_by_name(places, "75109", "nom_quartier", "code_insee_quartier")
    one = exact.select(F.lit("exact").alias("mode"), "code_insee_quartier")
    return one.unionByName(inside.select(F.lit("contains").alias("mode"), "code_insee_quartier"))
