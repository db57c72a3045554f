"""Published facts with lineage, manifests and GeoJSON layers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import half_even
from ..session import staging_root
from ..sources.geojson import feature_text, read_features, to_features, write_features
from ..sources.publish import publish_manifest, with_lineage
from .quality import WHOLE, fingerprint_sql, portable
from .registry import Tables, query
from .standins import POINTS, QUARTERS, points, quarters, with_sql


@query("publish_fact_lineage", with_sql(QUARTERS, select="""
select arrondissement, code_insee_quartier, case when arrondissement = '01' then null else nom_quartier end as nom_quartier,
  'quartiers.csv' as source_file from quarters"""))
def publish_fact_lineage(t: Tables) -> DataFrame:
    name = F.when(F.col("arrondissement") == "01", "").otherwise(F.col("nom_quartier"))
    rows = quarters(t).select("arrondissement", "code_insee_quartier", name.alias("nom_quartier"))
    return with_lineage(rows, "quartiers.csv", clock=False)


@query("publish_manifest", " union all ".join(
    fingerprint_sql(n, WHOLE[n], table_name=n, source=f"{n}.parquet") for n in ("customer", "events", "orders")))
def manifest_of_tables(t: Tables) -> DataFrame:
    tables = {n: (portable(getattr(t, n), WHOLE[n]), f"{n}.parquet") for n in ("customer", "events", "orders")}
    return publish_manifest(tables).withColumn("content_sum", F.col("content_sum").cast("string"))


def placed(t: Tables) -> DataFrame:
    """Points as a layer: one in five without position, one property missing now and then."""
    kind = F.col("id") % 5
    return points(t).select(
        F.col("id"),
        F.when(kind != 1, F.col("zone")).alias("zone"),
        F.when(kind != 4, F.col("lat")).alias("latitude"),
        F.col("lon").alias("longitude"),
    )


FEATURES = """features as (
  select '{"type":"Point","coordinates":[' || cast(lon as varchar) || ',' || cast(lat as varchar) || ']}' as geometry,
    '{"id":' || cast(id as varchar) || ',"zone":' || case when id % 5 = 1 then 'null' else '"' || zone || '"' end || '}' as properties
  from points where id % 5 <> 4)"""


@query("geojson_features", with_sql(POINTS, FEATURES, select="select geometry, properties from features"))
def geojson_features(t: Tables) -> DataFrame:
    return to_features(placed(t))


@query("geojson_documents", with_sql(POINTS, FEATURES, select="""
select '{"type":"Feature","geometry":' || geometry || ',"properties":' || properties || '}' as value from features"""))
def geojson_documents(t: Tables) -> DataFrame:
    return feature_text(to_features(placed(t)))


@query("geojson_roundtrip", with_sql(POINTS, FEATURES, select="select geometry, properties from features"))
def geojson_roundtrip(t: Tables) -> DataFrame:
    """Features written to a collection and read back."""
    path = f"{staging_root(t.spark)}/features/{uuid.uuid4().hex}"
    write_features(to_features(placed(t)), path)
    return read_features(t.spark, path)


@query("geojson_polygons", with_sql(QUARTERS, select="""
select code_insee_quartier, case when arrondissement = '03' then 'Point' else 'Polygon' end as kind,
  round_even(case when arrondissement = '03' then lon_q else lon_q - 0.005 end, 6) as x from quarters"""))
def geojson_polygons(t: Tables) -> DataFrame:
    """Polygon layer: a zone whose polygon is broken falls back to its centre point."""
    from .spatial import areas

    shape = F.when(F.substring("code", 4, 2) == "03", "{broken").otherwise(F.col("shape"))
    rows = areas(t).select(
        F.col("code").alias("code_insee_quartier"),
        shape.alias("geo_shape"),
        F.concat_ws(",", F.col("lat_c").cast("string"), F.col("lon_c").cast("string")).alias("geometry_xy"),
    )
    out = to_features(rows, "polygon")
    kind = F.get_json_object("geometry", "$.type")
    x = F.coalesce(
        F.get_json_object("geometry", "$.coordinates[0][0][0]"), F.get_json_object("geometry", "$.coordinates[0]")
    )
    return out.select(
        F.get_json_object("properties", "$.code_insee_quartier").alias("code_insee_quartier"),
        kind.alias("kind"),
        half_even(x.cast("double"), 6).alias("x"),
    )
