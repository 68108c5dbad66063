"""Every layer rule takes one row made for it and leaves one made against it."""

from collections import Counter

import pytest

from mapsheaf.operators.classify import classify_features, feature_items, item_rollup, threshold_bands
from mapsheaf.plans.rules import (
    EXPLORE, INSPECT, LAND_COVER_SUBTYPES, RULES, rule_references, rule_table, tree_table,
)

SCHEMA = (
    "id string, theme string, type string, geom_type string, subtype string, class string, "
    "depth int, is_intermittent boolean, has_parts boolean, population bigint, confidence double, "
    "names struct<primary:string>, categories struct<primary:string>"
)
SHAPES = {"P": "Point", "L": "LineString", "A": "Polygon"}


def row(id_, type_, shape="A", subtype=None, class_=None, depth=None, intermittent=None, parts=None,
        population=None, confidence=None, name=None, category=None):
    return (id_, None, type_, SHAPES[shape], subtype, class_, depth, intermittent, parts, population,
            confidence, (name,) if name else None, (category,) if category else None)


def road(class_, shape="L", subtype="road"):
    return dict(shape=shape, subtype=subtype, class_=class_)


# rule id -> type, zoom, attributes that pass, attributes that do not
EXPLORE_CASES = {
    "base-water-ocean-fill": ("water", 5, dict(subtype="ocean"), dict(subtype="lake")),
    "base-bathymetry-depth-0-fill": ("bathymetry", 0, dict(depth=90), dict(depth=95)),
    "base-land-fill": ("land", 5, dict(subtype="forest", class_="land"), dict(subtype="forest", class_="cliff")),
    "base-infrastructure-airport-fill": ("infrastructure", 13, dict(subtype="airport"), dict(subtype="pier")),
    "base-infrastructure-pier-fill": ("infrastructure", 13, dict(subtype="pier"), dict(shape="L", subtype="pier")),
    "base-infrastructure-pier-line": ("infrastructure", 13, dict(shape="L", subtype="pier"), dict(subtype="pier")),
    "base-infrastructure-aerialway-fill": (
        "infrastructure", 13, dict(subtype="airport", class_="runway"), dict(subtype="airport", class_="gate")),
    "base-infrastructure-aerialway-line": (
        "infrastructure", 13, dict(shape="L", subtype="airport", class_="taxiway"), dict(subtype="pier", class_="taxiway")),
    "base-water-lake-river-fill": ("water", 4, dict(subtype="ocean"), dict()),
    "base-water-lake-river-intermittent-fill": (
        "water", 5, dict(subtype="lake", intermittent=False), dict(subtype="lake")),
    "base-water-lake-river-line": (
        "water", 5, dict(shape="L", subtype="river"), dict(shape="L", subtype="river", intermittent=True)),
    "base-water-lake-river-intermittent-line": (
        "water", 5, dict(shape="L", subtype="river", intermittent=True), dict(shape="L", subtype="river")),
    "base-water-lake-river-label": (
        "water", 5, dict(shape="L", subtype="river"), dict(shape="A", subtype="river")),
    "transportation-segment-overview-casing": ("segment", 13, dict(shape="L"), None),
    "transportation-segment-overview": ("segment", 13, dict(shape="L"), None),
    "transportation-segment-road-steps-line": ("segment", 15, road("steps"), road("path")),
    "divisions-division-boundary-boundary": (
        "division_boundary", 8, dict(shape="L"), dict(shape="L", class_="maritime")),
    "divisions-division-boundary-maritime": (
        "division_boundary", 8, dict(shape="L", class_="maritime"), dict(shape="L")),
    "buildings-building-fill": ("building", 14, dict(), dict(parts=True)),
    "buildings-building-part-fill": ("building_part", 14, dict(), dict(shape="P")),
    "buildings-building-extrusion": ("building", 14, dict(parts=False), dict(shape="P")),
    "buildings-building-part-extrusion": ("building_part", 14, dict(parts=True), dict(shape="L")),
    "transportation-segment-rail-line": ("segment", 12, road(None, subtype="rail"), road(None)),
    "transportation-segment-rail-ticks": ("segment", 14, road(None, subtype="rail"), road(None)),
    "transportation-segment-water-line": ("segment", 12, road(None, subtype="water"), road(None)),
    "transportation-segment-water-label": ("segment", 13, road(None, subtype="water"), road(None)),
    "transportation-segment-rail-label": ("segment", 13, road(None, subtype="rail"), road(None)),
    "places-place-all-density-circle": ("place", 8, dict(shape="P"), dict()),
    "places-place-all-circle": ("place", 13, dict(shape="P"), dict()),
    "addresses-address-label": ("address", 16, dict(shape="P"), None),
    "divisions-division-county-label": ("division", 12, dict(subtype="macrocounty"), dict(subtype="region")),
    "divisions-division-localadmin-local-label": (
        "division", 10, dict(subtype="localadmin"), dict(subtype="macrohood")),
    "divisions-division-region-label": (
        "division", 5, dict(subtype="region", name="x" * 15), dict(subtype="region", name="x" * 16)),
    "divisions-division-locality-label": (
        "division", 11, dict(subtype="locality", population=50_000), dict(subtype="locality", population=49_999)),
    "divisions-division-country-label": (
        "division", 3, dict(subtype="dependency", name="x" * 25), dict(subtype="country", name="x" * 26)),
}
for _depth in (3000, 2500, 2000, 1500, 1000, 500, 100):
    EXPLORE_CASES[f"base-bathymetry-depth-{_depth}-fill"] = (
        "bathymetry", 3, dict(depth=_depth), dict(shape="L", depth=_depth))
for _item, _class in {"park": "golf_course", "recreation": "rough", "college-university": "university",
                      "medical": "hospital", "military": "naval_base", "cemetery": "grave_yard"}.items():
    EXPLORE_CASES[f"base-land-use-{_item}-fill"] = (
        "land_use", 12, dict(class_=_class), dict(class_="farmland"))
for _subtype in LAND_COVER_SUBTYPES:
    EXPLORE_CASES[f"base-land-cover-{_subtype}-fill"] = (
        "land_cover", 12, dict(subtype=_subtype), dict(subtype="urban"))
for _part, _zoom in (("casing", 15), ("line", 15)):
    EXPLORE_CASES[f"transportation-segment-road-pedestrian-{_part}"] = (
        "segment", _zoom, road("bridleway"), road("steps"))
    EXPLORE_CASES[f"transportation-segment-road-other-{_part}"] = ("segment", 12, road(None), road("steps"))
EXPLORE_CASES["transportation-segment-road-other-label"] = ("segment", 16, road("steps"), road("trunk"))
for _class, _label in {"living_street": 16, "residential": 15, "tertiary": 14, "secondary": 13, "primary": 13,
                       "trunk": 13, "motorway": 13}.items():
    for _part, _zoom in (("casing", 12), ("line", 12), ("label", _label)):
        EXPLORE_CASES[f"transportation-segment-road-{_class.replace('_', '-')}-{_part}"] = (
            "segment", _zoom, road(_class, subtype="rail" if _class == "motorway" else "road"), road("service"))
for _group, _category in {
        "park": "dog_park", "airport": "major_airport", "bar": "speakeasy", "grocery": "ethical_grocery",
        "hospital": "childrens_hospital", "fuel": "truck_gas_station", "golf": "golf_club",
        "convenience": "convenience_store", "lodging": "inn", "parking": "parking", "rail-station": "trains",
        "restaurant": "thai_restaurant", "shop": "coffee_shop", "college": "law_schools",
        "stadium": "hockey_arena"}.items():
    EXPLORE_CASES[f"places-place-categories-{_group}-symbol"] = (
        "place", 15, dict(shape="P", confidence=0.97, category=_category),
        dict(shape="P", confidence=0.96, category=_category))

INSPECT_CASES = {}
for _rule in INSPECT:
    _parts = _rule.rule_id.split("-")
    _shape = {"fill": "A", "line": "L", "circle": "P", "label": "P"}[_parts[-1]]
    _subtype = _parts[1] if _rule.type == "segment" and _parts[1] != "segment" else None
    _open = _rule.test is None
    INSPECT_CASES[_rule.rule_id] = (
        _rule.type, 15, dict(shape=_shape, subtype=_subtype),
        None if _open else dict(shape="L" if _shape != "L" else "P", subtype="other"))


@pytest.mark.parametrize("mode", ["explore", "inspect"])
def test_each_rule_takes_and_leaves(spark, mode):
    cases = EXPLORE_CASES if mode == "explore" else INSPECT_CASES
    assert set(cases) == {rule.rule_id for rule in RULES[mode] if rule.type}
    for zoom in sorted({case[1] for case in cases.values()}):
        rows = []
        for rule_id, (type_, at, good, bad) in cases.items():
            if at == zoom:
                rows.append(row(f"+{rule_id}", type_, **good))
                if bad is not None:
                    rows.append(row(f"-{rule_id}", type_, **bad))
        hits = classify_features(spark.createDataFrame(rows, SCHEMA), zoom, mode).collect()
        found = {(hit.id, hit.rule_id) for hit in hits}
        for rule_id, (_, at, _, _) in cases.items():
            if at == zoom:
                assert (f"+{rule_id}", rule_id) in found, rule_id
                assert (f"-{rule_id}", rule_id) not in found, rule_id


def test_zoom_window_includes_start_and_not_end(spark):
    rows = spark.createDataFrame([row("a", "place", "P"), row("b", "land_cover", subtype="snow")], SCHEMA)

    def hits(zoom):
        return {h.rule_id for h in classify_features(rows, zoom).collect()}

    assert "places-place-all-density-circle" in hits(8.9)
    assert "places-place-all-density-circle" not in hits(9)
    assert "places-place-all-circle" not in hits(12.9)
    assert "places-place-all-circle" in hits(13)
    assert "base-land-cover-snow-fill" not in hits(13)


def test_zoom_as_column_agrees_with_zoom_as_number(spark):
    from pyspark.sql import functions as F
    rows = [row(f"{n}-{rule_id}", type_, **good)
            for n, (rule_id, (type_, _, good, _)) in enumerate(EXPLORE_CASES.items())]
    frame = spark.createDataFrame(rows, SCHEMA)
    for zoom in (2, 8, 11, 16):
        fixed = classify_features(frame, zoom).select("id", "rule_id", "first_of_item").collect()
        moving = classify_features(frame.withColumn("zoom", F.lit(zoom)), F.col("zoom"))
        assert Counter(fixed) == Counter(moving.select("id", "rule_id", "first_of_item").collect())


def test_missing_columns_count_as_missing_values(spark):
    frame = spark.createDataFrame([("a", "building", "Polygon")], "id string, type string, geom_type string")
    assert {h.item for h in classify_features(frame, 14).collect()} == {"building-footprint", "building-3d"}


def test_items_once_per_feature_and_counts_in_tree_order(spark):
    rows = [row("a", "segment", **road("trunk")), row("b", "segment", **road("trunk")),
            row("c", "segment", **road("tertiary")), row("d", "address", "P")]
    frame = spark.createDataFrame(rows, SCHEMA)
    items = feature_items(frame, 16)
    assert Counter(r.item for r in items.collect()) == {"road-trunk": 2, "road-tertiary": 1, "address": 1}
    first = classify_features(frame, 16).where("first_of_item and item is not null")
    assert Counter(r.item for r in first.collect()) == {"road-trunk": 2, "road-tertiary": 1, "address": 1}
    listed = [(r.theme, r.item_group, r.item, r.features) for r in item_rollup(items).collect()]
    assert listed == [
        ("addresses", "addresses", "address", 1), ("addresses", "addresses", None, 1),
        ("addresses", None, None, 1),
        ("transportation", "transportation-roads", "road-trunk", 2),
        ("transportation", "transportation-roads", "road-tertiary", 1),
        ("transportation", "transportation-roads", None, 3), ("transportation", None, None, 3),
        (None, None, None, 4),
    ]


def test_rule_and_tree_tables(spark):
    rules = rule_table(spark).collect()
    assert Counter(r.mode for r in rules) == {"explore": 99, "inspect": 30}
    assert len({(r.mode, r.rule_id) for r in rules}) == 129
    assert [r.draw_order for r in EXPLORE] == list(range(99))
    # Each rule that takes features knows its theme and type and how it is drawn.
    assert all(r.rule_theme and r.rule_type and r.kind for r in rules if r.rule_id != "background")
    tree = {r.item for r in tree_table(spark).collect()}
    with_rules = {r.item for r in rules if r.mode == "explore"}
    assert tree - with_rules == {"division-area"}


def test_threshold_bands_cover_the_zooms(spark):
    frame = spark.createDataFrame([(0.99,), (0.96,), (0.9,), (None,)], "confidence double")
    bands = [(b.zooms, b.features) for b in threshold_bands(frame).collect()]
    assert bands == [("z<15", 1), ("z15–15", 1), ("z16–16", 2), ("z17+", 3)]


def test_rules_as_data(spark):
    rows = rule_references(spark).collect()
    assert {r.mode for r in rows} == {"explore", "inspect"}
    by_rule = {}
    for r in rows:
        by_rule.setdefault((r.mode, r.rule_id), set()).add((r.attribute, r.value))
    trunk = next(v for (mode, name), v in by_rule.items() if mode == "explore" and "road-trunk" in name)
    assert {("subtype", "road"), ("class", "trunk")} <= trunk
    assert ("geom_type", "Polygon") in by_rule["explore", "base-land-fill"]
    assert ("class", "land") in by_rule["explore", "base-land-fill"]
    assert ("category", "hotel") in {v for values in by_rule.values() for v in values}
