"""Per-theme profiles: the zooms at which a feature and its tags appear on tiles.

Each ``zoom_<theme>`` adds

- ``min_zoom``, ``max_zoom``: where the feature appears; null ``min_zoom`` leaves
  the start to the tile build,
- ``tags_zoom``: from here on every tag is kept whatever the feature's size,
- ``min_pixel``: 0 keeps the feature however small, null leaves the limit to the
  tile build.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapsheaf.functions.predicates import holds, is_kind, one_of
from mapsheaf.operators.tags import geometry_source, height_source

Profile = Callable[[DataFrame], DataFrame]

# Last zoom of each theme's tiles.
THEME_MAX_ZOOM = {
    "addresses": 14, "base": 13, "buildings": 14, "divisions": 12, "places": 14,
    "transportation": 14,
}

# First zoom by road class and by division subtype.
ROAD_ZOOMS = {
    "motorway": 4, "trunk": 5, "primary": 7, "secondary": 9, "tertiary": 11,
    "residential": 12, "living_street": 13,
}
DIVISION_ZOOMS = {"country": 0, "dependency": 0, "region": 4, "county": 8}


def _pick(column: str, table: Mapping[str, int], default: int) -> Column:
    """The table's number for the column's value; others and null get the default."""
    chosen = F
    for value, number in table.items():
        chosen = chosen.when(F.col(column) == value, number)
    return chosen.otherwise(default)


def _zooms(df: DataFrame, theme: str, first, tags=None, last=None, any_size: Column | None = None) -> DataFrame:
    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    top = THEME_MAX_ZOOM[theme]
    return df.withColumns({
        "min_zoom": column(first).cast("int"),
        "max_zoom": F.lit(top) if last is None else F.least(column(last), F.lit(top)).cast("int"),
        "tags_zoom": column(first if tags is None else tags).cast("int"),
        "min_pixel": F.lit(None).cast("int") if any_size is None else F.when(any_size, 0),
    })


def zoom_addresses(df: DataFrame) -> DataFrame:
    return _zooms(df, "addresses", 14)


def zoom_places(df: DataFrame) -> DataFrame:
    return _zooms(df, "places", 14)


def zoom_buildings(df: DataFrame) -> DataFrame:
    return _zooms(df, "buildings", None, tags=14)


def zoom_divisions(df: DataFrame) -> DataFrame:
    shape = one_of("type", ("division_area", "division_boundary"))
    return _zooms(df, "divisions", _pick("subtype", DIVISION_ZOOMS, 10),
                  any_size=shape)


def zoom_transportation(df: DataFrame) -> DataFrame:
    segment = (
        F.when(F.col("subtype") == "road", _pick("class", ROAD_ZOOMS, 14))
        .when(F.col("subtype") == "rail", 8)
        .otherwise(10)
    )
    is_segment = F.col("type") == "segment"
    return _zooms(df, "transportation", F.when(is_segment, segment).otherwise(13), tags=14,
                  any_size=is_segment)


def zoom_base(df: DataFrame) -> DataFrame:
    type_, subtype = F.col("type"), F.col("subtype")
    point, area = is_kind("Point"), is_kind("Polygon")
    cartography = "cartography" in df.columns
    drawn_from = F.col("cartography.min_zoom") if cartography else F.lit(None).cast("int")
    drawn_to = F.col("cartography.max_zoom") if cartography else F.lit(None).cast("int")

    land = F.when(point, 13).when(subtype.isin("land", "glacier"), 0).otherwise(7)
    land_use = F.when(point, 13).when(subtype == "residential", 6).otherwise(9)
    water = (
        F.when(subtype == "ocean", 0).when(point, 8).when(area, 4)
        .when(subtype == "river", 9).otherwise(13)
    )
    first = (
        F.when(type_ == "infrastructure", 13)
        .when(type_ == "land", land)
        .when(type_ == "bathymetry", 0)
        .when(type_ == "land_use", land_use)
        .when(type_ == "land_cover", drawn_from)
        .when(type_ == "water", water)
    )
    any_size = (
        (type_ == "bathymetry")
        | ((type_ == "land") & holds(land == 0))
        | ((type_ == "water") & ~point & (holds(subtype == "ocean") | area))
    )
    return _zooms(
        df, "base", first,
        tags=F.when(type_.isin("land_cover", "water"), first).otherwise(13),
        last=F.when(type_ == "land_cover", drawn_to).otherwise(13),
        any_size=any_size,
    )


def buildings(df: DataFrame) -> DataFrame:
    return zoom_buildings(df.transform(height_source).transform(geometry_source))


PROFILES: dict[str, Profile] = {
    "addresses": zoom_addresses,
    "base": zoom_base,
    "buildings": buildings,
    "divisions": zoom_divisions,
    "places": zoom_places,
    "transportation": zoom_transportation,
}


def theme_profile(df: DataFrame, theme: str, registry: Mapping[str, Profile] = PROFILES) -> DataFrame:
    """Apply the profile registered for ``theme`` to that theme's features."""
    if theme not in registry:
        raise ValueError(f"no profile for theme: {theme}")
    return df.where(F.col("theme") == theme).transform(registry[theme])
