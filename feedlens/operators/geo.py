"""Locations of a message: by name in its text, or by its coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.geometry import bounding_box, in_box, in_rings, rings_centroid
from feedlens.functions.nested import add_locations
from feedlens.functions.text import fold
from feedlens.operators.cells import INSIDE, OUTSIDE, cell_of, code_at, region_cells, with_level
from feedlens.operators.contains import contains_join
from feedlens.operators.dedupe import first_per_key
from feedlens.operators.joins import TEXT_KEY, with_text_key
from feedlens.operators.sizing import constant, rows_if_small
from feedlens.operators.tokens import MESSAGE_KEY

MAX_INLINE_NAMES = 200
MAX_INLINE_REGIONS = 50
MAX_INLINE_POINTS = 2_000

HIT = "field_ix:int,loc_id:bigint,name:string,lon:double,lat:double"
HITS = f"array<struct<{HIT}>>"
NAMES = "array<struct<field_ix:int,name:string>>"
SHAPES = f"array<struct<loc_id:bigint,names:{NAMES},rings:array<array<struct<x:double,y:double>>>,box:struct<x0:double,y0:double,x1:double,y1:double>>>"


def place_names(gazetteer: DataFrame, fields: list[str]) -> DataFrame:
    """``(field_ix, loc_id, name, lon, lat)``: one row per place and name field.

    Names are folded; null and empty ones are dropped, since an empty name is
    part of every text. A place given as a ring stands at its centroid.
    """
    absent = [f for f in fields if f not in gazetteer.columns]
    fields = [f for f in fields if f not in absent]
    if not fields:
        raise ValueError(f"no name field in the gazetteer: {', '.join(absent)}")
    lon, lat = F.col("lon"), F.col("lat")
    if "lon" not in gazetteer.columns:
        middle = rings_centroid(_rings(gazetteer))
        lon, lat = middle["x"], middle["y"]
    names = F.array(
        *[F.struct(F.lit(i).alias("field_ix"), fold(F.col(f)).alias("name")) for i, f in enumerate(fields)]
    )
    return (
        gazetteer.select(F.col("loc_id").cast("bigint").alias("loc_id"), lon.alias("lon"), lat.alias("lat"), F.explode(names).alias("_n"))
        .select("_n.field_ix", "loc_id", "_n.name", "lon", "lat")
        .where("name is not null and name <> ''")
    )


def _inline_names(names: DataFrame) -> Column | None:
    rows = rows_if_small(names, MAX_INLINE_NAMES)
    if rows is None:
        return None
    ordered = sorted((r.asDict() for r in rows), key=lambda r: (r["field_ix"], r["loc_id"], r["name"]))
    return constant(ordered, HITS)


def match_place_names(
    messages: DataFrame,
    gazetteer: DataFrame,
    fields: list[str],
    key: list[str] | None = None,
    force_shuffle: bool = False,
) -> DataFrame:
    """``(key…, field_ix, loc_id, name, lon, lat)``: every place whose name is in the text.

    A few names are tested in place. More go through the anchored containment
    join, whose keys-only form ``force_shuffle`` asks for.
    """
    key = list(key or MESSAGE_KEY)
    names = place_names(gazetteer, fields)
    # names have no white space at their ends, so the text need not be stripped
    texts = messages.select(*key, F.lower("text").alias("_text"))
    few = None if force_shuffle else _inline_names(names)
    if few is not None:
        hits = F.filter(few, lambda n: F.contains(F.col("_text"), n["name"]))
        return texts.select(*key, F.inline(hits))
    found = contains_join(texts, "_text", names, "name", force_shuffle)
    return found.select(*key, "field_ix", "loc_id", "name", "lon", "lat")


def _rings(regions: DataFrame) -> Column:
    """The rings of a region; one given as a single ring has no parts or holes."""
    return F.col("rings") if "rings" in regions.columns else F.array("ring")


def _shapes(regions: DataFrame, fields: list[str]) -> DataFrame:
    """``loc_id, names, rings, box`` of every region with a shape; one name per field that is not null."""
    identity = "loc_id" if "loc_id" in regions.columns else "region_id"
    known = [f for f in fields if f in regions.columns]
    if not known:
        raise ValueError(f"the regions have none of the name fields {', '.join(fields)}")
    names = F.array(*[F.struct(F.lit(i).alias("field_ix"), F.col(f).alias("name")) for i, f in enumerate(known)])
    shaped = regions.select(
        F.col(identity).cast("bigint").alias("loc_id"),
        F.filter(names, lambda n: n["name"].isNotNull()).alias("names"),
        _rings(regions).alias("rings"),
    )
    return shaped.where(F.size(F.flatten("rings")) > 0).withColumn("box", bounding_box(F.flatten("rings")))


def _few_shapes(shapes: DataFrame) -> list[dict] | None:
    """The regions as plain rows, when there are few and their rings are short."""
    points = shapes.limit(MAX_INLINE_REGIONS + 1).agg(F.count("*"), F.sum(F.size(F.flatten("rings")))).first()
    if points[0] > MAX_INLINE_REGIONS or (points[1] or 0) > MAX_INLINE_POINTS:
        return None
    rows = [r.asDict(recursive=True) for r in shapes.limit(MAX_INLINE_REGIONS).collect()]
    return sorted(rows, key=lambda r: r["loc_id"])


def _region_hits(shapes: list[dict], lon: Column, lat: Column) -> Column:
    """Locations at the point itself, one per name of each region around it."""
    inside = F.filter(
        constant(shapes, SHAPES),
        lambda r: in_box(lon, lat, r["box"]) & in_rings(lon, lat, r["rings"]),
    )

    def locations(r: Column) -> Column:
        return F.transform(r["names"], lambda n: F.struct(
            n["field_ix"].alias("field_ix"), r["loc_id"].alias("loc_id"), n["name"].alias("name"),
            lon.alias("lon"), lat.alias("lat"),
        ))

    return F.flatten(F.transform(inside, locations))


def region_candidates(points: DataFrame, shapes: DataFrame, key: list[str]) -> DataFrame:
    """``(key…, lon, lat, _shape, _sure)``: points and the regions they may be in, or surely are in.

    Each point is listed once for every grid in use and meets the cells of regions
    there: an equi-join on small rows.
    """
    cells = region_cells(shapes).distinct()
    levels = [row["_level"] for row in shapes.select("_level").distinct().collect()]  # a score at most: powers of two
    placed = points.withColumn("_level", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")))
    lon, lat = F.col("lon"), F.col("lat")
    placed = placed.withColumn("_cx", cell_of(lon)).withColumn("_cy", cell_of(lat))
    met = placed.join(cells, ["_level", "_cx", "_cy"]).where(in_box(lon, lat, F.col("box")))
    known = met.withColumn("_code", code_at(lon, lat)).where(F.col("_code") != OUTSIDE)
    return known.select(*key, "lon", "lat", "_shape", (F.col("_code") == INSIDE).alias("_sure"))


def match_regions(
    messages: DataFrame,
    regions: DataFrame,
    key: list[str] | None = None,
    force_grid: bool = False,
    fields: list[str] | None = None,
) -> DataFrame:
    """``(key…, field_ix, loc_id, name, lon, lat)``: every region around the message's point, once per name field.

    ``regions`` has ``loc_id`` (or ``region_id``), the name ``fields`` (default
    ``name``) and ``rings`` (or one ``ring``), as ``read_features`` gives them. A
    few short regions are tested in place. Otherwise points meet the cells of
    regions (``cells``), which tell for most of them whether they are inside; the
    others, near a border, are verified by ray casting. Pairs cannot repeat, so
    nothing is de-duplicated.
    """
    key = list(key or MESSAGE_KEY)
    shapes = _shapes(regions, fields or ["name"])
    points = messages.where(F.col("info.coordinates").isNotNull()).select(
        *key, F.col("info.coordinates.lon").alias("lon"), F.col("info.coordinates.lat").alias("lat")
    )
    few = None if force_grid else _few_shapes(shapes)
    if few is not None:
        return points.select(*key, F.inline(_region_hits(few, F.col("lon"), F.col("lat"))))

    shapes = with_level(shapes.withColumn("_shape", F.xxhash64("loc_id", "rings")))
    candidates = region_candidates(points, shapes, key)
    lon, lat = F.col("lon"), F.col("lat")
    inside = candidates.join(shapes.select("_shape", "loc_id", "names", "rings"), "_shape").where(
        F.col("_sure") | in_rings(lon, lat, F.col("rings"))
    )
    named = inside.select(*key, F.explode("names").alias("n"), "loc_id", "lon", "lat")
    return named.select(*key, "n.field_ix", "loc_id", "n.name", "lon", "lat")


def geolocate(
    messages: DataFrame,
    gazetteer: DataFrame,
    fields: list[str],
    regions: DataFrame | None = None,
    force_shuffle: bool = False,
    region_fields: list[str] | None = None,
) -> DataFrame:
    """Append locations to ``info``: by coordinates where a message has them, else by name.

    With a small gazetteer and few regions this is a projection. Otherwise the
    hits of a text or point, at most one per place and field, are gathered once
    for all messages that share it and joined back.
    """
    has_point = F.col("info.coordinates").isNotNull()
    names = _inline_names(place_names(gazetteer, fields))
    rings = [] if regions is None else _few_shapes(_shapes(regions, region_fields or ["name"]))

    def as_locations(hits: Column) -> Column:
        return F.transform(
            hits,
            lambda h: F.struct(
                h["name"].alias("name"), h["lon"].alias("longitude"), h["lat"].alias("latitude")
            ),
        )

    if names is not None and rings is not None and not force_shuffle:
        by_name = F.filter(
            names, lambda n: F.coalesce(F.contains(F.col("_lower"), n["name"]), F.lit(False))
        )
        by_point = _region_hits(rings, F.col("info.coordinates.lon"), F.col("info.coordinates.lat"))
        found = F.when(has_point, as_locations(by_point)).otherwise(as_locations(by_name))
        lowered = messages.withColumn("_lower", F.lower("text"))
        return lowered.withColumn("info", add_locations(F.col("info"), found)).drop("_lower")

    # hits depend on the text and the point alone: found once for each, joined back by their hash
    point = F.col("info.coordinates")
    keyed = with_text_key(messages, F.col("text"), point["lon"], point["lat"])
    unique = first_per_key(keyed.select(*TEXT_KEY, "text", "info"), TEXT_KEY, [F.col(TEXT_KEY[0])])
    hits = match_place_names(unique.where(~has_point), gazetteer, fields, TEXT_KEY, force_shuffle)
    if regions is not None:
        hits = hits.unionByName(match_regions(unique, regions, TEXT_KEY, force_shuffle, region_fields))
    gathered = hits.groupBy(*TEXT_KEY).agg(
        F.sort_array(F.collect_list(F.struct("field_ix", "loc_id", "name", "lon", "lat"))).alias("_hits")
    )
    joined = keyed.join(gathered, TEXT_KEY, "left")
    found = as_locations(F.coalesce("_hits", F.array().cast(HITS)))
    return joined.withColumn("info", add_locations(F.col("info"), found)).drop("_hits", *TEXT_KEY)
