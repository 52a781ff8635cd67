"""Places and regions from GeoJSON features."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.geometry import oriented, rings_centroid

log = logging.getLogger(__name__)

POINT = T.ArrayType(T.DoubleType())
POLYGON = T.ArrayType(T.ArrayType(POINT))


def _feature_schema(fields: list[str]) -> T.StructType:
    properties = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    # coordinates nest differently per geometry type, so they stay text at first
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    feature = T.StructType([T.StructField("properties", properties), T.StructField("geometry", geometry)])
    return T.StructType([*feature.fields, T.StructField("features", T.ArrayType(feature))])


def read_features(spark: SparkSession, path: str, fields: list[str], multi_line: bool = False) -> DataFrame:
    """``(loc_id, <fields>, lon, lat, rings)`` from GeoJSON: a feature per line, or feature collections.

    ``multi_line`` is for files that hold one JSON document over several lines; a
    document is read by one task. Points fill ``lon``/``lat``; polygons and
    multi-polygons give all their rings, holes included, and their centroid; other
    geometries have neither. Name fields that no feature has are reported and left
    out. The result feeds ``match_place_names`` and ``match_regions``.
    """
    rows = spark.read.schema(_feature_schema(fields)).option("multiLine", multi_line).json(path)
    alone = F.array(F.struct("properties", "geometry"))
    features = rows.select(F.explode(F.coalesce("features", alone)).alias("f")).select("f.*")
    present = features.agg(*[F.count(f"properties.`{f}`").alias(f) for f in fields]).first().asDict()
    kept = [f for f in fields if present[f]]
    for name in set(fields) - set(kept):
        log.warning("no feature of %s has a property %s", path, name)
    return features_to_places(features, kept)


def features_to_places(features: DataFrame, fields: list[str]) -> DataFrame:
    text, kind = F.col("geometry.coordinates"), F.col("geometry.type")
    point = F.from_json(F.when(kind == "Point", text), POINT)
    single = F.from_json(F.when(kind == "Polygon", text), POLYGON)
    parts = F.coalesce(F.from_json(F.when(kind == "MultiPolygon", text), T.ArrayType(POLYGON)),
                       F.when(single.isNotNull(), F.array(single)))

    def ring(points: Column, index: Column) -> Column:
        # GeoJSON repeats the first point at the end; rings here close themselves
        open_ring = F.slice(points, F.lit(1), F.greatest(F.size(points) - 1, F.lit(0)))
        plain = F.transform(open_ring, lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))
        return oriented(plain, index > 0)

    rings = F.flatten(F.transform(parts, lambda polygon: F.transform(polygon, ring)))
    # an id that depends on the feature alone, not on the order of reading
    loc_id = F.xxhash64("properties", "geometry")
    placed = features.select(
        loc_id.alias("loc_id"),
        *[F.lower(F.col(f"properties.`{f}`")).alias(f) for f in fields],
        point.alias("_point"),
        rings.alias("rings"),
    )
    middle = F.when(F.size("rings") > 0, rings_centroid(F.col("rings")))
    return placed.select(
        "loc_id",
        *fields,
        F.coalesce(F.get("_point", 0), middle["x"]).alias("lon"),
        F.coalesce(F.get("_point", 1), middle["y"]).alias("lat"),
        "rings",
    )
