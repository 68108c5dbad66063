"""Tile attributes: flat tags, labels and sources of a feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapsheaf.functions.mercator import extent_pixels, pixel_size
from mapsheaf.functions.text import json_text

# Fixed value: a feature this many pixels long keeps all its tags.
TAG_PIXELS = 16

# Columns of the engine that place a feature rather than describe it; none is an attribute.
PLACING = (
    "theme", "type", "bbox", "geometry", "geom_type", "z", "x", "y", "min_zoom", "max_zoom",
    "tags_zoom", "min_pixel", "layer", "layer_kind", "tags", "filename", "feature_id", "extent",
)

# Tags shown at every zoom, whatever the feature's size.
ALWAYS_SHOWN = ("@height_source", "@geometry_source")

# The type is an attribute of the files as well.
_NOT_TAGS = tuple(c for c in PLACING if c not in ("theme", "type"))
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _has_member(df: DataFrame, column: str, member: str) -> bool:
    if column not in df.columns:
        return False
    type_ = df.schema[column].dataType
    return isinstance(type_, T.StructType) and member in type_.fieldNames()


def feature_label(df: DataFrame) -> Column:
    """The primary name, or null if a name rule covers only part of the feature."""
    if "@name" in df.columns:
        return F.col("`@name`")
    if not _has_member(df, "names", "primary"):
        return F.lit(None).cast("string")
    if not _has_member(df, "names", "rules"):
        return F.col("names.primary")
    partial = F.exists(
        F.coalesce(F.col("names.rules"), F.array()), lambda rule: rule["between"].isNotNull()
    )
    return F.when(~partial, F.col("names.primary"))


def primary_label(df: DataFrame) -> DataFrame:
    """Add ``@name``."""
    return df.withColumn("@name", feature_label(df))


def primary_category(df: DataFrame) -> Column:
    """The primary category out of a struct or its JSON text; empty when there is none."""
    if _has_member(df, "categories", "primary"):
        return F.coalesce(F.col("categories.primary"), F.lit(""))
    if "categories" in df.columns:
        return json_text(F.col("categories"), "primary")
    return F.lit("")


def _first_dataset(property_: str) -> Column:
    found = F.filter(F.col("sources"), lambda source: source["property"] == property_)
    return F.try_element_at(F.transform(found, lambda source: source["dataset"]), F.lit(1))


def _has_source(property_: str) -> Column:
    return F.coalesce(
        F.exists(F.col("sources"), lambda source: source["property"] == property_), F.lit(False)
    )


def height_source(df: DataFrame) -> DataFrame:
    """Add ``@height_source``: who gave the height; the whole feature's source only if it has one."""
    return df.withColumn(
        "@height_source",
        F.when(_has_source("properties/height"), _first_dataset("properties/height"))
        .when(F.col("height").isNotNull(), _first_dataset("")),
    )


def geometry_source(df: DataFrame) -> DataFrame:
    """Add ``@geometry_source``: who gave the geometry, else the whole feature's source."""
    return df.withColumn(
        "@geometry_source",
        F.when(_has_source("properties/geometry"), _first_dataset("properties/geometry"))
        .otherwise(_first_dataset("")),
    )


def geometry_layer_kind(df: DataFrame) -> DataFrame:
    """Add the tile layer and its kind: point, else polygon if closed, else line."""
    kind = (
        F.when(F.col("geom_type").isin("Point", "MultiPoint"), "point")
        .when(F.col("geom_type").isin("Polygon", "MultiPolygon"), "polygon")
        .otherwise("line")
    )
    return df.withColumns({"layer": F.col("type"), "layer_kind": kind})


def stable_feature_id(df: DataFrame) -> DataFrame:
    """Add a 64-bit id that depends on the text id alone."""
    return df.withColumn("feature_id", F.xxhash64("id"))


def _tag_columns(df: DataFrame, skip: tuple[str, ...]) -> dict[str, Column]:
    tags = {}
    for field in df.schema.fields:
        if field.name in _NOT_TAGS or field.name in skip:
            continue
        column = F.col(f"`{field.name}`")
        tags[field.name] = F.to_json(column) if isinstance(field.dataType, _NESTED) else column
    if "names" in df.columns and "@name" not in (*tags, *skip):
        tags["@name"] = feature_label(df)
    return tags


def flatten_tags(df: DataFrame) -> DataFrame:
    """All attributes as flat columns, nested ones as JSON text; box and geometry left out."""
    return df.select(*(column.alias(name) for name, column in _tag_columns(df, ()).items()))


def tag_map(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """Add ``tags``: the same attributes as one map of texts, missing ones dropped."""
    tags = _tag_columns(df, skip)
    if not tags:
        return df.withColumn("tags", F.create_map().cast("map<string,string>"))
    names = F.array(*(F.lit(name) for name in tags))
    values = F.array(*(column.cast("string") for column in tags.values()))
    return df.withColumn(
        "tags", F.map_filter(F.map_from_arrays(names, values), lambda _, value: value.isNotNull())
    )


def _pixels(df: DataFrame, zoom) -> Column:
    """Size at ``zoom``: of the shape if its ``extent`` is known, else of the box."""
    if "extent" not in df.columns:
        return pixel_size(zoom)
    return F.coalesce(extent_pixels(zoom), pixel_size(zoom))


def attribute_visibility(df: DataFrame, zoom, pixels: float = TAG_PIXELS) -> DataFrame:
    """Empty ``tags`` of features too small at ``zoom`` to show them yet, but for those always shown.

    Size is that of the shape where ``extent`` is stored, else of the box.
    """
    zoom = zoom if isinstance(zoom, Column) else F.lit(zoom)
    shown = (_pixels(df, zoom) >= pixels) | (zoom >= F.col("tags_zoom"))
    none = F.map_filter(F.col("tags"), lambda key, value: key.isin(*ALWAYS_SHOWN))
    return df.withColumn("tags", F.when(F.coalesce(shown, F.lit(False)), F.col("tags")).otherwise(none))


def min_pixel_filter(df: DataFrame, zoom, limit: float = 1.0) -> DataFrame:
    """Drop lines and areas shorter than ``min_pixel``, or ``limit`` where that is null.

    Points have no size and stay. Size is that of the shape where ``extent`` is stored, else of the box.
    """
    needed = F.coalesce(F.col("min_pixel").cast("double"), F.lit(float(limit)))
    return df.where((F.col("geom_type") == "Point") | (_pixels(df, zoom) >= needed))
