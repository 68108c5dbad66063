"""Predicates on features.

Missing attributes: a comparison with one is false, its negation true. Rows a
filter keeps are the same with or without ``holds``; it matters below a ``~``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapsheaf.model import Box

# Lowest confidence shown, and the zooms at which it falls.
CONFIDENCE_STEPS = (0.99, (15, 0.97), (16, 0.95), (17, 0.9))

# Longest name shown, and the zooms at which it grows.
LABEL_LENGTH_STEPS = {
    "country": (15, (3, 25), (5, 50), (7, 999)),
    "region": (15, (6, 30), (8, 999)),
}

# Subtypes of small divisions that are labelled from each zoom.
LOCAL_SUBTYPES = ("localadmin", "borough", "macrohood", "neighborhood", "microhood")
LOCAL_SUBTYPE_STEPS = (
    ("borough",),
    (10, ("borough", "localadmin")),
    (11, ("borough", "localadmin", "macrohood")),
    (13, ("borough", "localadmin", "macrohood", "neighborhood")),
    (14, LOCAL_SUBTYPES),
)


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _named(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def holds(predicate: Column) -> Column:
    """The predicate, with unknown taken as false."""
    return F.coalesce(predicate, F.lit(False))


def fails(predicate: Column) -> Column:
    """The negation, with unknown taken as not met."""
    return ~holds(predicate)


def by_zoom(zoom, first, *stops) -> Column:
    """The value in force at ``zoom``: ``first``, then each ``(from_zoom, value)``.

    A numeric zoom is settled here, so the plan carries one value only.
    """
    if not isinstance(zoom, Column):
        for start, value in stops:
            if zoom >= start:
                first = value
        return _column(first)
    chosen = _column(first)
    for start, value in stops:
        chosen = F.when(zoom >= start, _column(value)).otherwise(chosen)
    return chosen


def meets_box(box, bbox: str = "bbox") -> Column:
    """Closed test: boxes that only touch do meet."""
    box = Box.of(box)
    return (
        (F.col(f"{bbox}.xmin") <= box.east) & (F.col(f"{bbox}.xmax") >= box.west)
        & (F.col(f"{bbox}.ymin") <= box.north) & (F.col(f"{bbox}.ymax") >= box.south)
    )


def overlaps_box(box, bbox: str = "bbox") -> Column:
    """Open test: boxes that only touch do not overlap."""
    box = Box.of(box)
    return (
        (F.col(f"{bbox}.xmin") < box.east) & (F.col(f"{bbox}.xmax") > box.west)
        & (F.col(f"{bbox}.ymin") < box.north) & (F.col(f"{bbox}.ymax") > box.south)
    )


def is_kind(kind: str, column="geom_type") -> Column:
    return holds(_named(column) == kind)


def one_of(column, values: Iterable) -> Column:
    return holds(_named(column).isin(*values))


def none_of(column, values: Iterable) -> Column:
    return fails(_named(column).isin(*values))


def confident(zoom, column="confidence") -> Column:
    return holds(_named(column) >= by_zoom(zoom, *CONFIDENCE_STEPS))


def populous(zoom, column="population") -> Column:
    people = _named(column)
    return by_zoom(
        zoom,
        holds(people >= 1_000_000),
        (11, holds(people >= 50_000)),
        (12, holds(people >= 10_000)),
        (13, True),
    )


def label_fits(kind: str, zoom, column="label") -> Column:
    return holds(F.length(_named(column)) <= by_zoom(zoom, *LABEL_LENGTH_STEPS[kind]))


def in_zoom_window(zoom, low, high) -> Column:
    """From ``low`` up to but not including ``high``; null leaves that end open."""
    zoom, low, high = _column(zoom), _column(low), _column(high)
    return F.coalesce(zoom >= low, F.lit(True)) & F.coalesce(zoom < high, F.lit(True))


# Predicates that change with zoom. ``col`` maps an attribute name to its Column.

def base_land(zoom, col=F.col) -> Column:
    untyped = col("subtype").isNull()
    return by_zoom(zoom, untyped, (5, holds(col("class") == "land") | untyped))


def ocean(zoom, col=F.col) -> Column:
    return by_zoom(zoom, col("subtype").isNull(), (5, holds(col("subtype") == "ocean")))


def lake_or_river(zoom, col=F.col) -> Column:
    return by_zoom(zoom, col("subtype").isNotNull(), (5, fails(col("subtype") == "ocean")))


def land_boundary(zoom, col=F.col) -> Column:
    return by_zoom(zoom, True, (8, fails(col("class") == "maritime")))


def local_area(zoom, col=F.col) -> Column:
    first, *later = LOCAL_SUBTYPE_STEPS
    return by_zoom(
        zoom,
        one_of(col("subtype"), first),
        *((start, one_of(col("subtype"), values)) for start, values in later),
    )


STEPPED = {
    "land": base_land,
    "ocean": ocean,
    "lake_or_river": lake_or_river,
    "boundary": land_boundary,
    "local_area": local_area,
}

# What these predicates name, as attribute, operator and values.
STEPPED_MENTIONS = {
    "land": (("subtype", "absent", ()), ("class", "in", ("land",))),
    "ocean": (("subtype", "absent", ()), ("subtype", "in", ("ocean",))),
    "lake_or_river": (("subtype", "present", ()), ("subtype", "not in", ("ocean",))),
    "boundary": (("class", "not in", ("maritime",)),),
    "local_area": (
        ("subtype", "in", tuple(LOCAL_SUBTYPE_STEPS[0])),
        *(("subtype", "in", tuple(values)) for _, values in LOCAL_SUBTYPE_STEPS[1:])),
}
