"""The layer rules that sort features into map items, and the item trees.

A rule takes the features of one type that meet its test while the zoom is in
its window. Rules are listed bottom to top; their position is the draw order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapsheaf.functions import predicates as p
from mapsheaf.model import TYPE_THEME

Attributes = Callable[[str], Column]


@dataclass(frozen=True)
class Test:
    """A condition on a feature's attributes and the zoom, and what it mentions.

    ``mentions`` lists attribute, operator and literal values, so that audits can read
    the rules as data. ``fact`` is the one mention that says all a test asks, if there is
    one; ``parts`` are the tests that all must hold.
    """

    build: Callable[[Attributes, object], Column]
    mentions: tuple[tuple[str, str, tuple], ...] = ()
    fact: tuple[str, str, tuple] | None = None
    parts: tuple[Test, ...] = ()

    def __call__(self, col: Attributes, zoom) -> Column:
        return self.build(col, zoom)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    type: str | None
    kind: str
    item: str | None
    group: str | None
    test: Test | None = None
    minzoom: int | None = None
    maxzoom: int | None = None
    selectable: bool = True
    icon: str | None = None
    confidence: str | None = None
    draw_order: int = -1

    @property
    def theme(self) -> str | None:
        return TYPE_THEME.get(self.type)

    def open_at(self, zoom) -> bool:
        """Whether the zoom window can be open; a Column zoom is tested per row."""
        if isinstance(zoom, Column):
            return True
        return (self.minzoom or 0) <= zoom and (self.maxzoom is None or zoom < self.maxzoom)

    def accepts(self, col: Attributes, zoom) -> Column:
        """Whether a row of the rule's type is taken at ``zoom``."""
        test = self.test(col, zoom) if self.test else F.lit(True)
        if isinstance(zoom, Column):
            return p.in_zoom_window(zoom, self.minzoom, self.maxzoom) & test
        return test


# -- tests ---------------------------------------------------------------

def _factual(build, *fact) -> Test:
    return Test(build, (fact,), fact)


def kind(geometry: str) -> Test:
    return _factual(lambda col, zoom: p.is_kind(geometry, col("geom_type")), "geom_type", "is", (geometry,))


def among(attribute: str, *values) -> Test:
    return _factual(lambda col, zoom: p.one_of(col(attribute), values), attribute, "in", values)


def outside(attribute: str, *values) -> Test:
    return _factual(lambda col, zoom: p.none_of(col(attribute), values), attribute, "not in", values)


def present(attribute: str) -> Test:
    return _factual(lambda col, zoom: col(attribute).isNotNull(), attribute, "present", ())


def absent(attribute: str) -> Test:
    return _factual(lambda col, zoom: col(attribute).isNull(), attribute, "absent", ())


def stepped(name: str) -> Test:
    return Test(lambda col, zoom: p.STEPPED[name](zoom, col), p.STEPPED_MENTIONS[name])


def every(*tests: Test) -> Test:
    def test(col, zoom):
        result = tests[0](col, zoom)
        for other in tests[1:]:
            result = result & other(col, zoom)
        return result
    return Test(test, tuple(mention for one in tests for mention in one.mentions),
                parts=tuple(part for one in tests for part in one.parts or (one,)))


POINT, LINE, AREA = kind("Point"), kind("LineString"), kind("Polygon")


# -- word lists ------------------------------------------------------------
# Depths, classes, subtypes and place categories by map item.

DEPTHS = (3000, 2500, 2000, 1500, 1000, 500, 100)
SHALLOW_DEPTHS = (0, 10, 20, 30, 40, 50, 60, 70, 80, 90)

LAND_USE_CLASSES = {
    "park": ("village_green", "state_park", "park", "national_park", "golf_course", "dog_park"),
    "recreation": ("camp_site", "fairway", "garden", "pitch", "playground", "recreation_ground", "rough"),
    "college-university": ("college", "university"),
    "medical": ("hospital",),
    "military": ("base", "military", "naval_base"),
    "cemetery": ("cemetery", "grave_yard"),
}

LAND_COVER_SUBTYPES = (
    "forest", "barren", "shrub", "grass", "crop", "wetland", "mangrove", "moss", "snow",
)

PEDESTRIAN_CLASSES = ("pedestrian", "footway", "path", "track", "cycleway", "bridleway")
LABELLED_ROAD_CLASSES = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "residential", "living_street",
)
NAMED_ROAD_CLASSES = LABELLED_ROAD_CLASSES + (
    "pedestrian", "footway", "steps", "path", "track", "cycleway", "bridleway",
)

PLACE_CATEGORIES = {
    "park": ("park", "dog_park", "memorial_park", "national_park", "state_park"),
    "airport": ("airport", "domestic_airport", "major_airport", "ultralight_airport"),
    "bar": (
        "beach_bar", "beer_bar", "champagne_bar", "cocktail_bar", "dive_bar", "drive_thru_bar",
        "hotel_bar", "pub", "sake_bar", "lounge", "speakeasy", "sports_bar", "tiki_bar",
        "vermouth_bar", "whiskey_bar", "wine_bar",
    ),
    "grocery": (
        "grocery_store", "specialty_grocery_store", "asian_grocery_store", "ethical_grocery",
        "indian_grocery_store", "japanese_grocery_store", "korean_grocery_store",
        "kosher_grocery_store", "mexican_grocery_store", "organic_grocery_store",
        "russian_grocery_store",
    ),
    "hospital": ("childrens_hospital", "hospital"),
    "fuel": ("gas_station", "truck_gas_station"),
    "golf": ("golf_course", "golf_club", "indoor_golf_center"),
    "convenience": ("convenience_store",),
    "lodging": ("hostel", "hotel", "inn", "lodge", "motel"),
    "parking": ("parking",),
    "rail-station": ("light_rail_and_subway_stations", "metro_station", "trains", "train_station"),
    "college": (
        "college_university", "architecture_schools", "business_schools", "engineering_schools",
        "law_schools", "medical_sciences_schools", "dentistry_schools", "pharmacy_schools",
        "veterinary_schools", "science_schools", "educational_research_institute",
    ),
    "stadium": (
        "stadium_arena", "baseball_stadium", "basketball_stadium", "cricket_ground",
        "football_stadium", "hockey_arena", "rugby_stadium", "soccer_stadium", "tennis_stadium",
        "track_stadium",
    ),
}
CATEGORY_WORDS = ("restaurant", "shop")

# Place groups as drawn, with the map item and icon of each.
PLACE_GROUPS = (
    ("park", "place-park", "park"),
    ("airport", "airport", "airport"),
    ("bar", "bar", "beer"),
    ("grocery", "grocery", "grocery"),
    ("hospital", "hospital", "doctor"),
    ("fuel", "fuel", "fuel"),
    ("golf", "place-golf", "golf"),
    ("convenience", "convenience", "convenience"),
    ("lodging", "lodging", "lodging"),
    ("parking", "parking", "parking"),
    ("rail-station", "rail-station", "rail"),
    ("restaurant", "restaurant", "restaurant"),
    ("shop", "shop", "shop"),
    ("college", "college", "ranger-station"),
    ("stadium", "stadium", "stadium"),
)

# Zoom from which each road class is labelled, as drawn.
ROAD_LABEL_ZOOMS = {
    "living_street": 16, "residential": 15, "tertiary": 14, "secondary": 13,
    "primary": 13, "trunk": 13, "motorway": 13,
}


# -- rule families -------------------------------------------------------

def _bathymetry(depths: tuple, name: int) -> Rule:
    return Rule(f"base-bathymetry-depth-{name}-fill", "bathymetry", "fill",
                f"bathymetry-depth-{name}", "base-bathymetry", every(AREA, among("depth", *depths)))


def _land_use(item: str) -> Rule:
    return Rule(f"base-land-use-{item}-fill", "land_use", "fill", item, "base-land-use",
                every(AREA, among("class", *LAND_USE_CLASSES[item])), 12)


def _land_cover(subtype: str) -> Rule:
    return Rule(f"base-land-cover-{subtype}-fill", "land_cover", "fill", subtype,
                "base-land-cover", among("subtype", subtype), None, 13)


def _infrastructure(name: str, shape: str, item: str, test: Test) -> Rule:
    return Rule(f"base-infrastructure-{name}-{shape}", "infrastructure", shape, item,
                "base-infrastructure", test, 13)


def _water(name: str, style: str, test: Test, selectable: bool = True) -> Rule:
    return Rule(f"base-water-lake-river-{name}", "water", style, "lakes-rivers", "base-land",
                test, selectable=selectable)


def _road(name: str, part: str, test: Test, low: int = 12, item: str | None = None) -> Rule:
    item = item or f"road-{name}"
    group = "transportation-pedestrian" if item == "road-pedestrian" else "transportation-roads"
    return Rule(f"transportation-segment-road-{name}-{part}", "segment",
                "symbol" if part == "label" else "line", item, group, test, low,
                selectable=part != "casing")


def _road_class(class_: str, part: str, low: int = 12) -> Rule:
    # Motorways are recognised by class alone, whatever the subtype.
    test = among("class", class_)
    if class_ != "motorway":
        test = every(among("subtype", "road"), test)
    return _road(class_.replace("_", "-"), part, test, low)


def _way(subtype: str, part: str, low: int, selectable: bool = True) -> Rule:
    item = "waterway" if subtype == "water" else subtype
    return Rule(f"transportation-segment-{subtype}-{part}", "segment",
                "symbol" if part == "label" else "line", item, f"transportation-{subtype}",
                among("subtype", subtype), low, selectable=selectable)


def _building(type_: str, part: str, test: Test) -> Rule:
    name = type_.replace("_", "-")
    style, item, group = {
        "fill": ("fill", f"{name}-footprint", "buildings-footprints"),
        "extrusion": ("fill-extrusion", f"{name}-3d", "buildings-3d"),
    }[part]
    return Rule(f"buildings-{name}-{part}", type_, style, item, group, test, 14)


def _confidence_text() -> str:
    first, *later = p.CONFIDENCE_STEPS
    return "|".join([str(first)] + [f"{zoom}:{value}" for zoom, value in later])


_CONFIDENT = Test(lambda col, zoom: p.confident(zoom, col("confidence")), (("confidence", "at least", ()),))


def _place_group(name: str, item: str, icon: str) -> Rule:
    if name in CATEGORY_WORDS:
        in_group = Test(
            lambda col, zoom: p.holds(col("category").contains(name)), (("category", "contains", (name,)),))
    else:
        in_group = among("category", *PLACE_CATEGORIES[name])
    return Rule(f"places-place-categories-{name}-symbol", "place", "symbol", item,
                "places-categories", every(POINT, _CONFIDENT, in_group), 14,
                icon=icon, confidence=_confidence_text())


def _division(name: str, test: Test, low: int | None, high: int | None) -> Rule:
    return Rule(f"divisions-division-{name}", "division", "symbol", name, "divisions-division",
                test, low, high)


def _fits(size: str) -> Test:
    return Test(lambda col, zoom: p.label_fits(size, zoom, col("label")), (("names", "length", ()),))


_PEDESTRIAN = every(among("subtype", "road"), among("class", *PEDESTRIAN_CLASSES))
_OTHER_ROAD = every(among("subtype", "road"), outside("class", *NAMED_ROAD_CLASSES))
_RUNWAY = every(among("subtype", "airport"), among("class", "runway", "taxiway"))
# A part of a building that is drawn by its parts is left to those.
_WHOLE = every(AREA, outside("has_parts", True))
_SLOW_TO_FAST = ("living_street", "residential", "tertiary", "secondary", "primary")


def _numbered(rules: list[Rule]) -> tuple[Rule, ...]:
    return tuple(Rule(**{**vars(rule), "draw_order": n}) for n, rule in enumerate(rules))


EXPLORE = _numbered([
    Rule("background", None, "background", None, None),
    Rule("base-water-ocean-fill", "water", "fill", "oceans", "base-land", every(AREA, stepped("ocean"))),
    *(_bathymetry((depth,), depth) for depth in DEPTHS),
    _bathymetry(SHALLOW_DEPTHS, 0),
    Rule("base-land-fill", "land", "fill", "land", "base-land", every(AREA, stepped("land"))),
    *(_land_use(item) for item in LAND_USE_CLASSES),
    _infrastructure("airport", "fill", "airport-area", every(AREA, among("subtype", "airport"))),
    _infrastructure("pier", "fill", "pier", every(AREA, among("subtype", "pier"))),
    _infrastructure("pier", "line", "pier", every(LINE, among("subtype", "pier"))),
    _infrastructure("aerialway", "fill", "aerialway", every(AREA, _RUNWAY)),
    _infrastructure("aerialway", "line", "aerialway", _RUNWAY),
    # The released rule also compares the flag with a text, which never matches a Boolean.
    _water("fill", "fill", every(AREA, stepped("lake_or_river"))),
    _water("intermittent-fill", "fill", every(AREA, present("subtype"), present("is_intermittent"))),
    _water("line", "line", every(LINE, present("subtype"), absent("is_intermittent"))),
    _water("intermittent-line", "line", every(LINE, present("subtype"), present("is_intermittent"))),
    _water("label", "symbol", every(LINE, present("subtype"), absent("is_intermittent")), False),
    *(_land_cover(subtype) for subtype in LAND_COVER_SUBTYPES),
    Rule("transportation-segment-overview-casing", "segment", "line", None, "transportation-roads",
         None, None, 14, selectable=False),
    Rule("transportation-segment-overview", "segment", "line", None, "transportation-roads",
         None, None, 14),
    _road("pedestrian", "casing", _PEDESTRIAN, 15),
    _road("other", "casing", _OTHER_ROAD),
    *(_road_class(class_, "casing") for class_ in _SLOW_TO_FAST),
    _road("steps", "line", every(among("subtype", "road"), among("class", "steps")), 15, "road-pedestrian"),
    _road("pedestrian", "line", _PEDESTRIAN, 15),
    _road("other", "line", _OTHER_ROAD),
    *(_road_class(class_, "line") for class_ in _SLOW_TO_FAST),
    _road_class("trunk", "casing"),
    _road_class("motorway", "casing"),
    _road_class("trunk", "line"),
    _road_class("motorway", "line"),
    Rule("divisions-division-boundary-boundary", "division_boundary", "line", "division-boundary",
         "divisions-boundary", stepped("boundary")),
    Rule("divisions-division-boundary-maritime", "division_boundary", "line",
         "division-boundary-maritime", "divisions-boundary", among("class", "maritime"), 8),
    _building("building", "fill", _WHOLE),
    _building("building_part", "fill", AREA),
    _building("building", "extrusion", _WHOLE),
    _building("building_part", "extrusion", AREA),
    _way("rail", "line", 12),
    _way("rail", "ticks", 14, selectable=False),
    _way("water", "line", 12),
    Rule("places-place-all-density-circle", "place", "heatmap", "place-all-density-circle",
         "places-all", POINT, None, 9),
    Rule("places-place-all-circle", "place", "symbol", "place-all-circle", "places-all", POINT, 13,
         icon="circle"),
    Rule("addresses-address-label", "address", "symbol", "address", "addresses", None, 16,
         icon="circle-opt"),
    *(_place_group(*group) for group in PLACE_GROUPS),
    _way("water", "label", 13),
    _road("other", "label", every(among("subtype", "road"), outside("class", *LABELLED_ROAD_CLASSES)), 16),
    *(_road_class(class_, "label", low) for class_, low in ROAD_LABEL_ZOOMS.items()),
    _way("rail", "label", 13),
    _division("county-label", among("subtype", "macrocounty", "county"), None, 13),
    _division("localadmin-local-label",
              every(among("subtype", *p.LOCAL_SUBTYPES), stepped("local_area")), 9, None),
    _division("region-label", every(among("subtype", "region", "macroregion"), _fits("region")), None, 11),
    _division("locality-label",
              every(among("subtype", "locality"), Test(
                  lambda col, zoom: p.populous(zoom, col("population")), (("population", "at least", ()),))),
              None, 14),
    _division("country-label", every(among("subtype", "country", "dependency"), _fits("country")), None, 9),
])


def _plain(path: str, type_: str, style: str, group: str, test: Test | None = None,
           low: int | None = None, item: str | None = None) -> Rule:
    return Rule(path, type_, style, item or path.split("-", 1)[1], group, test, low)


INSPECT = _numbered([
    _plain("base-bathymetry-fill", "bathymetry", "fill", "base-bathymetry"),
    _plain("base-water-fill", "water", "fill", "base-water", AREA),
    _plain("base-water-line", "water", "line", "base-water", LINE),
    _plain("base-land-fill", "land", "fill", "base-land", AREA),
    _plain("base-land-line", "land", "line", "base-land", LINE),
    _plain("base-land-cover-fill", "land_cover", "fill", "base-land-cover"),
    _plain("base-land-use-fill", "land_use", "fill", "base-land-use", AREA),
    _plain("base-land-use-line", "land_use", "line", "base-land-use", LINE),
    _plain("divisions-division-area-fill", "division_area", "fill", "divisions-division",
           item="division-area-fill"),
    _plain("buildings-building-fill", "building", "fill", "buildings-building", low=13),
    _plain("buildings-building-part-fill", "building_part", "fill", "buildings-building-part", low=13),
    _plain("transportation-road-line", "segment", "line", "transportation-road",
           among("subtype", "road"), 4),
    _plain("transportation-rail-line", "segment", "line", "transportation-rail",
           among("subtype", "rail"), 4),
    _plain("transportation-water-line", "segment", "line", "transportation-water",
           among("subtype", "water"), 4, "waterway-line"),
    _plain("divisions-division-boundary-line", "division_boundary", "line", "divisions-boundary",
           item="division-boundary-line"),
    _plain("transportation-connector-circle", "connector", "circle", "transportation-connector",
           POINT, 13),
    _plain("addresses-address-circle", "address", "circle", "addresses-address", POINT, 14),
    _plain("places-place-circle", "place", "circle", "places-place", POINT, 13),
    _plain("divisions-division-circle", "division", "circle", "divisions-division", POINT),
    _plain("base-water-label", "water", "symbol", "base-water", low=10),
    _plain("base-land-label", "land", "symbol", "base-land", low=10),
    _plain("base-land-use-label", "land_use", "symbol", "base-land-use", low=12),
    _plain("transportation-segment-label", "segment", "symbol", "transportation-segment", low=13),
    _plain("transportation-road-label", "segment", "symbol", "transportation-road",
           among("subtype", "road"), 13),
    _plain("transportation-rail-label", "segment", "symbol", "transportation-rail",
           among("subtype", "rail"), 13),
    _plain("transportation-water-label", "segment", "symbol", "transportation-water",
           among("subtype", "water"), 13, "waterway-label"),
    _plain("transportation-connector-label", "connector", "symbol", "transportation-connector", low=14),
    _plain("addresses-address-label", "address", "symbol", "addresses-address", POINT, 15),
    _plain("places-place-label", "place", "symbol", "places-place", POINT, 14),
    _plain("divisions-division-label", "division", "symbol", "divisions-division", POINT),
])

RULES = {"explore": EXPLORE, "inspect": INSPECT}

RULE_SCHEMA = (
    "mode string, draw_order int, rule_id string, rule_theme string, rule_type string, "
    "kind string, item string, item_group string, minzoom int, maxzoom int, "
    "selectable boolean, icon string, confidence_rule string"
)


# Items that are off until chosen.
DEFAULT_OFF = ("place-all-circle", "place-all-density-circle", "building-footprint", "building-part-footprint", "address")


def default_items(mode: str) -> list[str]:
    """Items shown when a view does not choose any, in draw order."""
    items = dict.fromkeys(rule.item for rule in RULES[mode] if rule.item)
    return [item for item in items if mode != "explore" or item not in DEFAULT_OFF]


def rule_references(spark: SparkSession, *modes: str) -> DataFrame:
    """What each rule mentions: a row per attribute and literal text value, null without one.

    A table of fixed size, as the rules are.
    """
    rows = []
    for mode in modes or RULES:
        for rule in RULES[mode]:
            for attribute, operator, values in rule.test.mentions if rule.test else ():
                texts = [v for v in values if isinstance(v, str)] or [None]
                rows += [(mode, rule.rule_id, rule.theme, rule.type, attribute, operator, text) for text in texts]
    return spark.createDataFrame(
        rows, "mode string, rule_id string, theme string, type string, attribute string, operator string, value string")


def rule_table(spark: SparkSession, *modes: str) -> DataFrame:
    """The rules as a table of fixed size, small enough to ship to every task."""
    rows = [
        (mode, r.draw_order, r.rule_id, r.theme, r.type, r.kind, r.item, r.group,
         r.minzoom, r.maxzoom, r.selectable, r.icon, r.confidence)
        for mode in (modes or RULES) for r in RULES[mode]
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA)


# -- item trees -------------------------------------------------------------
# Groups and items of each theme, as the tree shows them.

EXPLORE_TREE = {
    "addresses": {"addresses": ("address",)},
    "base": {
        "base-land": ("land", "oceans", "lakes-rivers"),
        "base-bathymetry": tuple(
            f"bathymetry-depth-{depth}" for depth in (0, 100, 500, 1000, 1500, 2000, 2500, 3000)),
        "base-land-cover": (
            "wetland", "mangrove", "moss", "forest", "grass", "shrub", "crop", "barren", "snow"),
        "base-land-use": (
            "park", "recreation", "cemetery", "college-university", "military", "medical"),
        "base-infrastructure": ("airport-area", "aerialway", "pier"),
    },
    "buildings": {
        "buildings-3d": ("building-3d", "building-part-3d"),
        "buildings-footprints": ("building-footprint", "building-part-footprint"),
    },
    "divisions": {
        "divisions-division": (
            "country-label", "region-label", "county-label", "locality-label",
            "localadmin-local-label", "division-area"),
        "divisions-boundary": ("division-boundary", "division-boundary-maritime"),
    },
    "places": {
        "places-categories": (
            "airport", "bar", "college", "convenience", "fuel", "place-golf", "grocery",
            "hospital", "lodging", "parking", "place-park", "rail-station", "restaurant",
            "shop", "stadium"),
        "places-all": ("place-all-density-circle", "place-all-circle"),
    },
    "transportation": {
        "transportation-roads": (
            "road-motorway", "road-trunk", "road-primary", "road-secondary", "road-tertiary",
            "road-residential", "road-living-street", "road-other"),
        "transportation-rail": ("rail",),
        "transportation-pedestrian": ("road-pedestrian",),
        "transportation-water": ("waterway",),
    },
}

INSPECT_TREE = {
    "base": {
        "base-land": ("land-fill", "land-line", "land-label"),
        "base-water": ("water-fill", "water-line", "water-label"),
        "base-bathymetry": ("bathymetry-fill",),
        "base-land-cover": ("land-cover-fill",),
        "base-land-use": ("land-use-fill", "land-use-line", "land-use-label"),
    },
    "buildings": {
        "buildings-building": ("building-fill",),
        "buildings-building-part": ("building-part-fill",),
    },
    "transportation": {
        "transportation-segment": ("segment-line", "segment-label"),
        "transportation-road": ("road-line", "road-label"),
        "transportation-rail": ("rail-line", "rail-label"),
        "transportation-water": ("waterway-line", "waterway-label"),
        "transportation-connector": ("connector-circle", "connector-label"),
    },
    "divisions": {
        "divisions-division": ("division-area-fill", "division-circle", "division-label"),
        "divisions-boundary": ("division-boundary-line",),
    },
    "places": {"places-place": ("place-circle", "place-label")},
    "addresses": {"addresses-address": ("address-circle", "address-label")},
}

# Order numbers of tree groups that are not simply 1, 2, 3.
GROUP_ORDERS = {("explore", "base-land-use"): 5, ("explore", "base-infrastructure"): 6}

TREES = {"explore": EXPLORE_TREE, "inspect": INSPECT_TREE}


def tree_table(spark: SparkSession, mode: str = "explore") -> DataFrame:
    """One row per tree item with the order of its theme, group and item."""
    rows = []
    for theme_order, (theme, groups) in enumerate(TREES[mode].items(), 1):
        for place, (group, items) in enumerate(groups.items(), 1):
            group_order = GROUP_ORDERS.get((mode, group), place)
            for item_order, item in enumerate(items, 1):
                rows.append((theme, theme_order, group, group_order, item, item_order))
    return spark.createDataFrame(
        rows,
        "theme string, theme_order int, item_group string, group_order int, "
        "item string, item_order int",
    )
