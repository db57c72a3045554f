"""GeoJSON features: one JSON text per row, written and read as JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import GEOMETRY_COLUMNS, POLYGON_TEXTS, first_polygon_text, point_from_any

# The exported layers and their geometry.
LAYERS = {
    "quartiers": "polygon",
    "arrondissements": "polygon",
    "iris": "polygon",
    "commissariats": "point",
    "cameras": "point",
    "gares": "point",
}
EMPTY_POINT = '{"type":"Point","coordinates":[0,0]}'


def json_safe(df: DataFrame, name: str) -> Column:
    """A value JSON can hold: NaN as null, timestamps as ISO text."""
    kind = df.schema[name].dataType.simpleString()
    col = F.col(f"`{name}`")
    if kind in ("double", "float"):
        return F.when(~F.isnan(col), col).alias(name)
    if kind.startswith("timestamp"):
        return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss").alias(name)
    return col.alias(name)


def point_json(lon: Column, lat: Column) -> Column:
    return F.concat(
        F.lit('{"type":"Point","coordinates":['), lon.cast("string"), F.lit(","), lat.cast("string"), F.lit("]}")
    )


def to_features(df: DataFrame, mode: str = "point") -> DataFrame:
    """Feature rows (geometry text, properties text); rows without geometry are dropped.

    Polygon mode falls back to a point. Geometry columns are left out of the properties.
    """
    point = point_from_any(df.columns)
    geometry = F.when(point.isNotNull(), point_json(point["lon"], point["lat"]))
    if mode == "polygon":
        geometry = F.coalesce(first_polygon_text(POLYGON_TEXTS, df.columns), geometry)
    kept = [c for c in df.columns if c not in GEOMETRY_COLUMNS]
    properties = F.to_json(F.struct(*[json_safe(df, c) for c in kept]), {"ignoreNullFields": "false"})
    return df.select(geometry.alias("geometry"), properties.alias("properties")).where("geometry is not null")


def feature_text(features: DataFrame) -> DataFrame:
    """One GeoJSON feature per row; a missing geometry becomes the empty point."""
    return features.select(
        F.concat(
            F.lit('{"type":"Feature","geometry":'),
            F.coalesce("geometry", F.lit(EMPTY_POINT)),
            F.lit(',"properties":'),
            F.coalesce("properties", F.lit("{}")),
            F.lit("}"),
        ).alias("value")
    )


def write_features(features: DataFrame, path: str) -> None:
    """Replace a collection; JSON lines, so no task ever holds a whole collection."""
    feature_text(features).write.mode("overwrite").text(path)


def _feature(text: Column) -> list[Column]:
    return [
        F.get_json_object(text, "$.geometry").alias("geometry"),
        F.get_json_object(text, "$.properties").alias("properties"),
    ]


def read_features(spark: SparkSession, path: str, whole_document: bool = False) -> DataFrame:
    """Features from JSON lines, or from documents holding a collection or a bare array.

    Lines are split across tasks. ``whole_document`` files are one JSON value each and are
    parsed one file per task, as such a file cannot be split.
    """
    if not whole_document:
        return spark.read.text(path).select(*_feature(F.col("value")))
    body = spark.read.option("wholetext", "true").text(path)
    listed = F.coalesce(F.get_json_object("value", "$.features"), F.col("value"))
    found = F.from_json(listed, "array<struct<geometry:string,properties:string>>")
    return body.select(F.explode(found).alias("f")).select("f.geometry", "f.properties")
