"""Values that vary piecewise-linearly with zoom or an attribute."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def interpolate(position: Column, *stops) -> Column:
    """Linear between ``(position, value)`` stops and flat beyond the ends.

    Stops come in rising order; a value may be a number or a Column.
    """
    (first, value), *rest = stops
    result = F.when(position <= first, _column(value))
    left, left_value = first, _column(value)
    for right, right_value in rest:
        right_value = _column(right_value)
        share = (position - left) / float(right - left)
        result = result.when(position <= right, left_value + (right_value - left_value) * share)
        left, left_value = right, right_value
    return result.when(position > left, left_value)


def by_value(column: Column, table: dict[tuple[str, ...], float], default: float) -> Column:
    """A number picked by the value of ``column``."""
    chosen = None
    for values, number in table.items():
        match = column.isin(*values)
        chosen = F.when(match, float(number)) if chosen is None else chosen.when(match, float(number))
    return F.lit(float(default)) if chosen is None else chosen.otherwise(float(default))


# Icon size of a place by confidence.
PLACE_ICON_STOPS = ((0, 0.2), (0.5, 0.2), (0.7, 0.3), (0.9, 0.4), (1, 0.5))

# Intensity and radius of the place density map by zoom.
DENSITY_INTENSITY_STOPS = ((0, 1), (9, 3))
DENSITY_RADIUS_STOPS = ((0, 2), (9, 6))

# Opacity of raised buildings by zoom.
EXTRUSION_OPACITY_STOPS = ((15, 0.4), (16, 0.63))

# Width of division boundaries by zoom, for country, region and
# county levels, and for all other subtypes.
BOUNDARY_LEVELS = (("country", "dependency"), ("region", "macroregion"), ("county", "macrocounty"))
BOUNDARY_WIDTHS = (
    (3, (1, 0.7, 0.5), 0.1),
    (8, (1.25, 0.85, 0.65), 0.15),
    (12, (1.75, 1.25, 0.9), 0.2),
    (16, (2, 1.5, 1), 0.2),
)


def boundary_width_stops(subtype: Column) -> tuple:
    """Zoom stops of the boundary width for each row's subtype."""
    return tuple(
        (zoom, by_value(subtype, dict(zip(BOUNDARY_LEVELS, widths)), other))
        for zoom, widths, other in BOUNDARY_WIDTHS
    )
