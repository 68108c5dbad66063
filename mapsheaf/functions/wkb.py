"""Well-known binary to GeoJSON, a batch at a time."""

from __future__ import annotations

import math
import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString",
          6: "MultiPolygon", 7: "GeometryCollection"}


def _number(value: float) -> str:
    return str(int(value)) if value.is_integer() else repr(value)


def _positions(numbers: tuple[float, ...], size: int) -> str:
    """Texts of positions of ``size`` numbers each, joined by commas."""
    texts = list(map(_number, numbers))
    return ",".join("[" + ",".join(texts[n:n + size]) + "]" for n in range(0, len(texts), size))


def _shape(data: bytes, at: int) -> tuple[str, str, int]:
    """Kind, coordinates text and end position of the geometry at ``at``."""
    order = "<" if data[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    if code & 0x20000000:  # a coordinate system number precedes the content
        at += 4
    size = 2 + (1 if code & 0x80000000 or code % 10000 // 1000 in (1, 3) else 0)
    size += 1 if code & 0x40000000 or code % 10000 // 1000 in (2, 3) else 0
    kind = _KINDS[code % 1000 if code < 0x10000000 else code & 0xFF]

    def count() -> int:
        nonlocal at
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        return n

    def numbers(positions: int) -> tuple[float, ...]:
        nonlocal at
        found = struct.unpack_from(f"{order}{positions * size}d", data, at)
        at += 8 * size * positions
        return found

    def run() -> str:
        return "[" + _positions(numbers(count()), size) + "]"

    if kind == "Point":
        place = numbers(1)
        # An empty point is written with sides that are no numbers.
        return kind, "[]" if all(map(math.isnan, place)) else _positions(place, size), at
    if kind == "LineString":
        return kind, run(), at
    if kind == "Polygon":
        return kind, "[" + ",".join(run() for _ in range(count())) + "]", at
    parts = []
    for _ in range(count()):
        part, coordinates, at = _shape(data, at)
        if kind == "GeometryCollection":
            coordinates = _text(part, coordinates)
        parts.append(coordinates)
    return kind, "[" + ",".join(parts) + "]", at


def _text(kind: str, coordinates: str) -> str:
    member = "geometries" if kind == "GeometryCollection" else "coordinates"
    return f'{{"type":"{kind}","{member}":{coordinates}}}'


def _read(data: bytes | None) -> str | None:
    try:
        return None if data is None else _text(*_shape(bytes(data), 0)[:2])
    except (struct.error, IndexError, KeyError, ValueError, OverflowError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def wkb_to_geojson(geometry: pd.Series) -> pd.Series:
    """GeoJSON text of each geometry; null where it is null or cannot be read."""
    return geometry.map(_read)
