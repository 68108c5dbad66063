"""Vocabulary of a feature release: themes, types, boxes and fixed names."""

from __future__ import annotations

import math
from typing import NamedTuple

# The themes of a release and the types in each.
THEME_TYPES = {
    "addresses": ("address",),
    "base": ("bathymetry", "infrastructure", "land", "land_cover", "land_use", "water"),
    "buildings": ("building", "building_part"),
    "divisions": ("division", "division_area", "division_boundary"),
    "places": ("place",),
    "transportation": ("connector", "segment"),
}

# The order in which types are tried when an id is looked up.
LOOKUP_TYPE_ORDER = (
    "land_cover", "land_use", "water", "land", "infrastructure", "bathymetry",
    "building", "building_part",
    "place",
    "division", "division_area", "division_boundary",
    "segment", "connector",
    "address",
)

# Properties every feature shows outside its property table.
SHARED_PROPERTIES = (
    "theme", "type", "update_time", "id", "sources", "names", "categories",
    "subtype", "class", "subclass", "version",
)

TYPE_THEME = {type_: theme for theme, types in THEME_TYPES.items() for type_ in types}


class Box(NamedTuple):
    """A longitude/latitude box in degrees."""

    west: float
    south: float
    east: float
    north: float

    @classmethod
    def of(cls, values) -> "Box":
        """Check and convert four numbers, or a ``w,s,e,n`` text, to a box."""
        if isinstance(values, str):
            values = values.split(",")
        try:
            numbers = [float(v) for v in values]
        except (TypeError, ValueError) as err:
            raise ValueError("a box needs four finite numbers: west, south, east, north") from err
        if len(numbers) != 4 or not all(math.isfinite(v) for v in numbers):
            raise ValueError("a box needs four finite numbers: west, south, east, north")
        return cls(*numbers)


def theme_types(theme: str) -> tuple[str, ...]:
    if theme not in THEME_TYPES:
        raise ValueError(f"unknown theme: {theme}")
    return THEME_TYPES[theme]
