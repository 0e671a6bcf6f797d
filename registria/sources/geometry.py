"""State outlines from a GeoJSON FeatureCollection."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Label point for a state without a usable outline (lon, lat).
FALLBACK_LON, FALLBACK_LAT = -53.1, -14.2
POLYGONS = ["Polygon", "MultiPolygon"]

_NUMBER = r"(-?[0-9][0-9.eE+-]*)"
VERTEX = rf"\[\s*{_NUMBER}\s*,\s*{_NUMBER}"
# Nested coordinate lists of any depth arrive as their JSON text.
SCHEMA = (
    "type string, features array<struct<properties:struct<sigla:string>,"
    "geometry:struct<type:string,coordinates:string>>>"
)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: ``uf, kind, coordinates``. Raises if it is no FeatureCollection."""
    collection = spark.read.schema(SCHEMA).json(path, multiLine=True)
    sound = (F.col("type") == "FeatureCollection") & F.col("features").isNotNull()
    bad = F.count_if(~F.coalesce(sound, F.lit(False)))
    wrong, found = collection.agg((bad > 0) | (F.count(F.lit(1)) == 0), F.sum(F.size("features"))).first()
    if wrong:
        raise ValueError(f"{path}: not a FeatureCollection with features")
    if not found:
        warnings.warn(f"{path} has no features", stacklevel=2)
    return collection.select(F.explode("features").alias("f")).select(
        F.col("f.properties.sigla").alias("uf"),
        F.col("f.geometry.type").alias("kind"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )


def _mean(group: int) -> Column:
    numbers = F.regexp_extract_all("coordinates", F.lit(VERTEX), group).cast("array<double>")
    total = F.aggregate(numbers, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.col("kind").isin(POLYGONS) & (F.size(numbers) > 0), total / F.size(numbers))


def centroids(features: DataFrame) -> DataFrame:
    """``uf, lon, lat``: plain mean of a state's vertices, or the fallback point."""
    return features.where(F.col("uf") != "").select(
        "uf",
        F.coalesce(_mean(1), F.lit(FALLBACK_LON)).alias("lon"),
        F.coalesce(_mean(2), F.lit(FALLBACK_LAT)).alias("lat"),
    )
