"""GeoJSON in and out, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE = "struct<type: string, geometry: struct<type: string, coordinates: string>, properties: map<string, string>>"
COLLECTION = f"struct<type: string, features: array<{FEATURE}>>"


def geometry(geom: Column) -> Column:
    """A GeoJSON polygon of array<ring>, rings closed."""
    close = lambda ring: F.concat(ring, F.slice(ring, 1, 1))
    points = F.transform(geom, lambda ring: F.transform(close(ring), lambda p: F.array(p.x, p.y)))
    return F.struct(F.lit("Polygon").alias("type"), points.alias("coordinates"))


def feature(geom: Column, properties: Column) -> Column:
    return F.struct(F.lit("Feature").alias("type"), geometry(geom).alias("geometry"), properties.alias("properties"))


def collection(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, geojson): a feature collection of each group of (geom, properties); groups are files of bounded size."""
    own = df.withColumn("__f", feature(F.col("geom"), F.col("properties")))
    return own.groupBy(*keys).agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list("__f").alias("features"))).alias("geojson"))


def features(df: DataFrame, column: str = "value") -> DataFrame:
    """One row for each feature of the collections in a text column: type, properties, ring0 (exterior of a polygon, else null)."""
    parsed = df.withColumn("__c", F.from_json(column, COLLECTION)).withColumn("__f", F.explode("__c.features"))
    kind = F.col("__f.geometry.type")
    rings = F.from_json(F.col("__f.geometry.coordinates"), "array<array<array<double>>>")
    ring = F.when(kind == "Polygon", F.transform(rings[0], lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return parsed.select("*", F.col("__c.type").alias("type"), F.col("__f.properties").alias("properties"), kind.alias("geometry_type"), ring.alias("ring")).drop("__c", "__f", column)


def read(spark: SparkSession, path: str) -> DataFrame:
    return features(spark.read.text(path, wholetext=True))
