"""Filters on features, each a plain ``where`` that reaches the scan if it can."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapsheaf.functions import predicates as p
from mapsheaf.model import SHARED_PROPERTIES
from mapsheaf.operators.tags import feature_label, primary_category
from mapsheaf.plans.rules import CATEGORY_WORDS, PLACE_CATEGORIES


def bbox_clip(df: DataFrame, bbox) -> DataFrame:
    """Features whose box meets ``bbox``; touching is enough."""
    return df.where(p.meets_box(bbox))


def bbox_overlap(df: DataFrame, bbox) -> DataFrame:
    """Features whose box overlaps ``bbox``; touching is not enough."""
    return df.where(p.overlaps_box(bbox))


def geometry_kind_filter(df: DataFrame, kind: str) -> DataFrame:
    """Point, LineString or Polygon features."""
    return df.where(F.col("geom_type") == kind)


def class_match_filter(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Features whose attribute is one of ``values``."""
    return df.where(F.col(column).isin(*values))


def class_exclude_filter(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Features whose attribute is none of ``values``; a missing one passes."""
    return df.where(p.none_of(column, values))


def has_field_filter(df: DataFrame, present: Iterable[str] = (), absent: Iterable[str] = ()) -> DataFrame:
    """Features that carry all attributes ``present`` and none of ``absent``."""
    for column in present:
        df = df.where(F.col(column).isNotNull())
    for column in absent:
        df = df.where(F.col(column).isNull())
    return df


def confidence_filter(df: DataFrame, zoom) -> DataFrame:
    """Places sure enough to be shown at ``zoom``."""
    return df.where(p.confident(zoom))


def population_filter(df: DataFrame, zoom) -> DataFrame:
    """Localities large enough to be labelled at ``zoom``."""
    return df.where((F.col("subtype") == "locality") & p.populous(zoom))


def label_length_filter(df: DataFrame, kind: str, zoom) -> DataFrame:
    """Divisions whose name is short enough for ``kind`` labels at ``zoom``."""
    return df.where(p.label_fits(kind, zoom, feature_label(df)))


def stepped_class_filter(df: DataFrame, name: str, zoom) -> DataFrame:
    """One of the class predicates that change with zoom; see ``predicates.STEPPED``."""
    return df.where(p.STEPPED[name](zoom))


def zoom_window_filter(df: DataFrame, zoom, low: str = "minzoom", high: str = "maxzoom") -> DataFrame:
    """Rows whose zoom window is open at ``zoom``."""
    return df.where(p.in_zoom_window(zoom, F.col(low), F.col(high)))


def category_match_filter(df: DataFrame, group: str | Column) -> DataFrame:
    """Places whose primary category is listed for ``group``, a name or a column of names."""
    category = primary_category(df)
    if not isinstance(group, Column):
        return df.where(category.isin(*PLACE_CATEGORIES[group]))
    listed = F.lit(False)
    for name, categories in PLACE_CATEGORIES.items():
        listed = listed | ((group == name) & category.isin(*categories))
    return df.where(listed)


def category_contains_filter(df: DataFrame, word: str) -> DataFrame:
    """Places whose primary category contains ``word``, as for restaurants and shops."""
    if word not in CATEGORY_WORDS:
        raise ValueError(f"no place group is found by the word: {word}")
    return df.where(primary_category(df).contains(word))


def whole_building_filter(df: DataFrame) -> DataFrame:
    """Buildings that are not drawn by their parts."""
    return df.where(~F.col("has_parts").eqNullSafe(True))


def low_zoom_base_filter(df: DataFrame, zoom, inspect: bool | Column = False) -> DataFrame:
    """Drop base features below zoom 10 unless inspecting."""
    zoom = zoom if isinstance(zoom, Column) else F.lit(zoom)
    inspect = inspect if isinstance(inspect, Column) else F.lit(inspect)
    return df.where(~((zoom < 10) & ~inspect & (F.col("theme") == "base")))


def visible_property_filter(df: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Rows of exploded properties that belong in the property table."""
    return df.where(
        ~F.col(key).startswith("@")
        & ~F.col(key).isin(*SHARED_PROPERTIES)
        & F.col(value).isNotNull()
        & (F.col(value) != "null")
    )
