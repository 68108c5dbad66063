import math
import random
import struct

import numpy as np
import pyarrow as pa
import pytest

from mapsheaf.functions.shapes import AREA, LINE, POINT, decode, extents, to_world
from mapsheaf.operators import cover, tags

BOX = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"


def wkb(kind, parts, order="<", flags=0, extra=()):
    """Binary of a shape: kind 1 to 3 with positions, 4 to 7 with binaries."""
    head = struct.pack(order + "BI", 1 if order == "<" else 0, kind | flags)
    if flags & 0x20000000:
        head += struct.pack(order + "I", 4326)

    def run(places):
        return b"".join(struct.pack(order + f"{2 + len(extra)}d", *p, *extra) for p in places)

    if kind == 1:
        return head + run(parts)
    head += struct.pack(order + "I", len(parts))
    if kind == 2:
        return head + run(parts)
    if kind == 3:
        return head + b"".join(struct.pack(order + "I", len(ring)) + run(ring) for ring in parts)
    return head + b"".join(parts)


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]


def test_decode_all_forms():
    shapes = [
        wkb(1, [(1, 2)]), wkb(2, [(0, 0), (1, 1), (2, 0)], ">"), wkb(3, [SQUARE, HOLE]), None, b"",
        wkb(6, [wkb(3, [SQUARE]), wkb(3, [SQUARE, HOLE], ">")]), wkb(1, [(math.nan, math.nan)]),
        wkb(7, [wkb(1, [(5, 6)]), wkb(7, [wkb(5, [wkb(2, [(0, 0), (3, 4)])])]), wkb(4, [wkb(1, [(7, 8)])])], ">"),
        wkb(3, [SQUARE, HOLE])[:-3], wkb(2, [(0, 0), (1, 1)], flags=0x80000000, extra=(9,)),
        wkb(2, [(0, 0), (1, 1)], flags=0x20000000), wkb(3002, [])[:9], wkb(9, []), wkb(2, []),
        struct.pack("<BII4d", 1, 1002, 1, 1, 2, 3, 4), wkb(6, [wkb(3, [SQUARE])])[:9],
    ]
    paths = decode(pa.array(shapes, pa.binary()))
    found = [(int(o), int(k), bool(h), list(zip(paths.x[a:b], paths.y[a:b], strict=True))) for o, k, h, a, b in zip(
        paths.owner, paths.kind, paths.hole, paths.first, paths.first[1:], strict=False)]
    assert found == [
        (0, POINT, False, [(1, 2)]), (1, LINE, False, [(0, 0), (1, 1), (2, 0)]),
        (2, AREA, False, SQUARE), (2, AREA, True, HOLE),
        (5, AREA, False, SQUARE), (5, AREA, False, SQUARE), (5, AREA, True, HOLE),
        (7, POINT, False, [(5, 6)]), (7, LINE, False, [(0, 0), (3, 4)]), (7, POINT, False, [(7, 8)]),
        (9, LINE, False, [(0, 0), (1, 1)]), (10, LINE, False, [(0, 0), (1, 1)]), (14, LINE, False, [(1, 2)])]
    sliced = decode(pa.array(shapes, pa.binary())[2:6])
    assert sliced.owner.tolist() == [0, 0, 3, 3, 3]
    size = extents(paths, len(shapes))
    assert size[[0, 2, 5, 7]] == pytest.approx([0, math.sqrt(15), math.sqrt(31), 5])
    assert len(decode(pa.array([], pa.binary())).owner) == len(decode(pa.array([None, b""], pa.binary())).owner) == 0


def meets(square, shape, kind):
    """Whether a tile meets a shape of world paths: an edge enters it, or its middle is inside."""
    a, b, size = *square, 1.0
    inside = False
    for path in shape:
        for (x0, y0), (x1, y1) in zip(path, path[1:] if len(path) > 1 else path, strict=False):
            low, high = 0.0, 1.0
            for d, p, edge in ((x1 - x0, x0, a), (y1 - y0, y0, b)):
                if d == 0:
                    if not edge <= p <= edge + size:
                        low = 2.0
                else:
                    t = sorted(((edge - p) / d, (edge + size - p) / d))
                    low, high = max(low, t[0]), min(high, t[1])
            if low <= high:
                return True
            mx, my = a + 0.5, b + 0.5
            if kind == 3 and (y0 <= my) != (y1 <= my) and x0 + (my - y0) / (y1 - y0) * (x1 - x0) > mx:
                inside = not inside
    return inside


def star(rng, x, y, size, corners):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    ring = [(x + size * rng.uniform(0.3, 1) * math.cos(t), y + size * rng.uniform(0.3, 1) * math.sin(t)) for t in turns]
    return [*ring, ring[0]]


def test_cover_equals_tile_by_tile():
    rng = random.Random(5)
    for _ in range(60):
        zoom = rng.choice([0, 3, 5])
        x, y = rng.uniform(-150, 150), rng.uniform(-60, 60)
        if rng.random() < 0.4:
            kind, rings = 2, [[(x + rng.uniform(-20, 20), y + rng.uniform(-20, 20)) for _ in range(rng.randrange(2, 6))]]
        else:
            kind, rings = 3, [star(rng, x, y, 25, rng.randrange(3, 9))]
            if rng.random() < 0.5:
                rings.append(star(rng, x, y, 7, 5))
        paths = to_world(decode(pa.array([wkb(kind, rings[0] if kind == 2 else rings)], pa.binary())))
        owner, rows, first, last = cover.cover(paths, zoom, np.zeros(1, bool))
        got = [(c, r) for r, a, b in zip(rows, first, last, strict=True) for c in range(a, b + 1)]
        n = 1 << zoom
        shape = [list(zip(paths.x[a:b] * n, paths.y[a:b] * n, strict=True)) for a, b in zip(paths.first, paths.first[1:], strict=False)]
        want = {(c, r) for c in range(n) for r in range(n) if meets((c, r), shape, kind)}
        assert len(got) == len(set(got)) and set(got) == want and set(owner) <= {0}


def frame(spark, rows):
    return spark.createDataFrame(rows, f"id string, geometry binary, bbox {BOX}, min_zoom int, max_zoom int, geom_type string, min_pixel int")


def test_tiles_of_shapes_not_of_boxes(spark):
    ring = wkb(3, [[(-170, -80), (170, -80), (170, 80), (-170, 80), (-170, -80)],
                   [(-160, -75), (160, -75), (160, 75), (-160, 75), (-160, -75)]])
    rows = [("ring", ring, (-170.0, 170.0, -80.0, 80.0), 4, 4, "Polygon", 0),
            ("line", wkb(2, [(-179, 84), (179, -84)]), (-179.0, 179.0, -84.0, 84.0), 6, 6, "LineString", 0),
            ("point", wkb(1, [(10, 10)]), (10.0, 10.0, 10.0, 10.0), 0, 14, "Point", 0),
            ("lost", b"\x01", (10.0, 10.0, 10.0, 10.0), 0, 14, "Point", 0), ("none", None, None, 0, 2, "Point", 0)]
    tiles = cover.tile_cover(frame(spark, rows), 0, 8)
    assert "geometry" not in tiles.columns and not any(c.startswith("_") for c in tiles.columns)
    found = {}
    for r in tiles.collect():
        found.setdefault((r.id, r.z), []).append((r.x, r.y))
    assert len(found["line", 6]) < 200 and len(found["line", 6]) == len(set(found["line", 6]))
    assert (8, 8) not in found["ring", 4] and (0, 8) in found["ring", 4]
    assert all(len(found["point", z]) == 1 for z in range(9)) and ("lost", 0) not in found and ("none", 0) not in found


def test_shape_across_180_degrees(spark):
    line = wkb(2, [(179, 10), (-179, 10)])
    rows = [("far", line, (179.0, -179.0, 10.0, 10.0), 7, 7, "LineString", 0),
            ("near", line, (-179.0, 179.0, 10.0, 10.0), 7, 7, "LineString", 0)]
    columns = {}
    for r in cover.tile_cover(frame(spark, rows), 0, 8).collect():
        columns.setdefault(r.id, set()).add(r.x)
    assert columns == {"far": {127, 0}, "near": set(range(128))}
    area = wkb(3, [[(170, 0), (-170, 0), (-170, 20), (170, 20), (170, 0)]])
    tiles = cover.tile_cover(frame(spark, [("fiji", area, (170.0, -170.0, 0.0, 20.0), 5, 5, "Polygon", 0)])).collect()
    assert {r.x for r in tiles} == {31, 0} and len(tiles) == len({(r.x, r.y) for r in tiles}) == 6


def test_thin_areas_are_judged_by_their_area(spark):
    thin = wkb(3, [[(0, 0), (10, 10), (10.001, 10), (0, 0)]])
    holed = wkb(3, [SQUARE, [(0.001, 0.001), (3.999, 0.001), (3.999, 3.999), (0.001, 3.999), (0.001, 0.001)]])
    rows = [("thin", thin, (0.0, 10.001, 0.0, 10.0), 0, 14, "Polygon", None), ("holed", holed, (0.0, 4.0, 0.0, 4.0), 0, 14, "Polygon", None),
            ("line", wkb(2, [(0, 0), (10, 10)]), (0.0, 10.0, 0.0, 10.0), 0, 14, "LineString", None),
            ("lost", None, (0.0, 10.0, 0.0, 10.0), 0, 14, "LineString", None)]
    sized = cover.with_extent(frame(spark, rows))
    assert {r.id for r in tags.min_pixel_filter(sized, 1).collect()} == {"line", "lost"}
    assert {r.id for r in tags.min_pixel_filter(sized.drop("extent"), 1).collect()} == {"thin", "holed", "line", "lost"}
    assert {r.id for r in tags.min_pixel_filter(sized, 9).collect()} == {"thin", "holed", "line", "lost"}


def test_few_tiles_are_not_shuffled(spark, capsys):
    ring = wkb(3, [[(-170, -80), (170, -80), (170, 80), (-170, 80), (-170, -80)]])
    rows = [("ring", ring, (-170.0, 170.0, -80.0, 80.0), 8, 8, "Polygon", 0),
            (None, wkb(2, [(0, 0), (3, 2)]), (0.0, 3.0, 0.0, 2.0), 0, 8, "LineString", 0),
            ("twice", wkb(1, [(10, 10)]), None, 0, 8, "Point", 0), ("twice", wkb(1, [(10, 10)]), None, 0, 8, "Point", 0)]
    tiles = cover.tile_cover(frame(spark, rows), 0, 8)
    tiles.explain()
    # Plans are printed from the top: runs of most features are expanded where they are made.
    top = capsys.readouterr().out.split("MapInArrow")[0]
    assert "inline" in top and "Exchange" not in top
    found = [(r.id, r.z, r.x, r.y) for r in tiles.collect()]
    assert sum(f[0] == "twice" for f in found) == 18 and len(set(found)) == len(found) - 9
    assert sum(f[0] == "ring" for f in found) > cover.ROW_TILES


def test_runs_of_all_zooms_equal_each_zooms_cover(monkeypatch):
    rng = random.Random(5)
    shapes = [None, wkb(1, [(180, 10)]), wkb(2, [(179, 10), (-179, 10)])]
    for size in (1e-4, 0.3, 20):
        for _ in range(20):
            x, y = rng.uniform(-150, 150), rng.uniform(-60, 60)
            shapes += [wkb(3, [star(rng, x, y, size, 6)]), wkb(2, star(rng, x, y, size, 5)), wkb(1, [(x, y)])]
    paths = to_world(decode(pa.array(shapes, pa.binary())))
    first = np.array([rng.randrange(4) for _ in shapes])
    last = first + np.array([rng.randrange(8) for _ in shapes])
    wrapped = np.array([n == 2 for n in range(len(shapes))])
    want = set()
    for zoom in range(12):
        for owner, y, x0, x1 in zip(*cover.cover(paths, zoom, wrapped), strict=True):
            if first[owner] <= zoom <= last[owner]:
                want.add((owner, zoom, y, x0, x1))
    for batch in (1, 500, 1 << 17):
        monkeypatch.setattr(cover, "BATCH_ROWS", batch)
        parts = list(cover._tile_runs(paths, first, last, wrapped))
        got = [row for part in parts for row in zip(*part, strict=True)]
        assert len(got) == len(set(got)) and set(got) == want
        # All runs of a feature are in one part.
        assert sum(len(set(part[0])) for part in parts) == len({row[0] for row in want})
