"""A space-filling curve as a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEPTH = 16


def hilbert(x: Column, y: Column, depth: int = DEPTH) -> Column:
    """Number along the Hilbert curve of a place in the unit square, cut into ``2 ** depth`` by as many cells.

    Places outside are moved to the edge; null where a coordinate is null or no number.
    """
    size = 1 << depth
    levels = F.array(*(F.lit(1 << level).cast("long") for level in range(depth - 1, -1, -1)))

    def cell(value: Column) -> Column:
        inside = F.greatest(F.lit(0.0), F.least(F.lit(float(size - 1)), F.floor(value * size).cast("double")))
        return F.when(value.isNotNull() & ~F.isnan(value), inside.cast("long"))

    def step(state: Column, level: Column) -> Column:
        right, up = (state[c].bitwiseAND(level) > 0 for c in "xy")
        quarter = F.when(right & up, 2).when(right, 3).when(up, 1).otherwise(0)
        # Lower quarters are mirrored along a diagonal.
        turned = right & ~up
        new_x = F.when(up, state["x"]).when(turned, size - 1 - state["y"]).otherwise(state["y"])
        new_y = F.when(up, state["y"]).when(turned, size - 1 - state["x"]).otherwise(state["x"])
        return F.struct(new_x.alias("x"), new_y.alias("y"), (state["d"] + quarter * level * level).alias("d"))

    start = F.struct(cell(x).alias("x"), cell(y).alias("y"), F.lit(0).cast("long").alias("d"))
    along = F.aggregate(levels, start, step, lambda state: state["d"])
    return F.when(cell(x).isNotNull() & cell(y).isNotNull(), along)


def place_on_curve(bbox: str = "bbox", depth: int = DEPTH) -> Column:
    """``hilbert`` of the middle of a box in degrees; one with west beyond east crosses 180 degrees."""
    middle = (F.col(f"{bbox}.xmin") + F.col(f"{bbox}.xmax")) / 2
    west_first = F.col(f"{bbox}.xmin") <= F.col(f"{bbox}.xmax")
    x = F.when(west_first, middle).when(middle > 0, middle - 180).otherwise(middle + 180)
    return hilbert((x + 180) / 360, ((F.col(f"{bbox}.ymin") + F.col(f"{bbox}.ymax")) / 2 + 90) / 180, depth)
