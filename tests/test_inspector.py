"""Inspector, lookups, clicks and audits."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mapsheaf.functions.style import boundary_width_stops
from mapsheaf.operators import audit, filters, inspector, lookup
from mapsheaf.operators.views import click_dedupe

BOX = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"
ENTRIES = "array<struct<key:string,value:string>>"


def test_entity_takes_place_then_properties(spark):
    frame = spark.createDataFrame(
        [("buildings", "building", [("id", "123"), ("height", "50")]),
         ("buildings", "building", [("theme", "weather"), ("type", None)]), ("x", "y", [])],
        f"source string, source_layer string, properties {ENTRIES}")
    rows = inspector.feature_entity(frame).collect()
    assert [(e.key, e.value) for e in rows[0].entity] == [
        ("theme", "buildings"), ("type", "building"), ("id", "123"), ("height", "50")]
    assert [(r.theme, r.type, r.known_theme) for r in rows] == [
        ("buildings", "building", True), ("weather", None, False), ("x", "y", False)]


def test_panel_title(spark):
    texts = ['{"primary":"Central Park"}', "not json", '{"primary":""}', "{}", None]
    frame = spark.createDataFrame([(t,) for t in texts], "names string")
    assert [r.title for r in inspector.panel_title(frame).collect()] == ["Central Park"] + ["Inspector Panel"] * 4


def test_feature_title(spark):
    frame = spark.createDataFrame([
        ("addresses", "address", "12", "", "Main St", None, "ignored", None),
        ("places", "place", None, None, None, None, "Name", '{"primary":"Other"}'),
        ("places", "place", None, None, None, None, "", '{"primary":"Other"}'),
        ("base", "water", None, None, None, "lake", None, None), ("base", "land", None, None, None, "land", None, "{}"),
        ("base", "land", None, None, None, None, None, None),
    ], "theme string, type string, number string, unit string, street string, subtype string, `@name` string, names string")
    assert [r.title for r in inspector.feature_title(frame).collect()] == [
        "12 Main St", "Name", "Other", "water (lake)", "land", "land"]


def test_subclass_follows_class(spark):
    frame = spark.createDataFrame([
        ("a", [("subclass", "s"), ("@name", "n"), ("class", "c"), ("id", "1")]),
        ("b", [("subclass", "s"), ("id", "1")]), ("c", [("class", "c"), ("id", "1")]), ("d", [("@x", "1")]),
    ], f"fid string, properties {ENTRIES}")
    rows = inspector.property_rows(frame, "properties", ("fid",)).collect()
    listed = {}
    for r in sorted(rows, key=lambda r: (r.fid, r.position)):
        listed.setdefault(r.fid, []).append((r.position, r.key, r.indented))
    assert listed == {
        "a": [(0, "class", False), (1, "subclass", True), (2, "id", False)],
        "b": [(0, "id", False), (1, "subclass", False)],
        "c": [(0, "class", False), (1, "id", False)],
    }


def test_property_values(spark):
    texts = [
        ("names", '{"primary":"A","common":null,"x":[1,2,3],"y":[1,2,3,4],"alternate":["p","q","r","s"]}'),
        ("list", '["a",{"b":1},null]'), ("plain", "text"), ("broken", "[1,"), ("empty", None)]
    frame = spark.createDataFrame(texts, "key string, value string")
    found = {}
    for r in inspector.property_values(frame).collect():
        found.setdefault(r.key, set()).add((r.member, r.text))
    assert found["names"] == {
        ("primary", "A"), ("x", "[1, 2, 3]"), ("y", "[1,2,3,4]"), ("alternate", "p, q, r, s")}
    assert (None, "a") in found["list"] and (None, '{"b":1}') in found["list"]
    assert found["plain"] == {(None, "text")} and found["broken"] == {(None, "[1,")} and found["empty"] == {(None, None)}


def test_property_members_in_order(spark):
    texts = [
        ("names", '{"rules":[],"zeta":"z","common":{"en":"A"},"alpha":"null","primary":"A"}'),
        ("categories", '{"alternate":["p"],"primary":"q"}'),
        ("other", '{"b":1,"a":2,"links":["https://example.org/a","https://example.org/b"]}')]
    frame = spark.createDataFrame(texts, "key string, value string")
    found = {}
    for r in sorted(inspector.property_values(frame).collect(), key=lambda r: r.position):
        found.setdefault(r.key, []).append((r.member, r.text))
    assert found["names"] == [("primary", "A"), ("common", '{"en":"A"}'), ("rules", "[]"), ("zeta", "z")]
    assert [m for m, _ in found["categories"]] == ["primary", "alternate"]
    # Members in the order of the text; web addresses are never in line.
    assert found["other"] == [
        ("b", "1"), ("a", "2"), ("links", '["https://example.org/a","https://example.org/b"]')]


def test_visible_properties(spark):
    frame = spark.createDataFrame(
        [("@name", "x"), ("theme", "x"), ("version", "1"), ("level", None), ("surface", "null"), ("height", "5")],
        "key string, value string")
    assert [r.key for r in filters.visible_property_filter(frame).collect()] == ["height"]


@pytest.mark.parametrize("text,expected", [
    ("https://example.org", True), ("http://example.org:80/a?b#c", True), ("HTTPS://EXAMPLE.ORG", True),
    ("https:example.org", True), ("ftp://example.org", False), ("example.org", False), ("https://", False),
    ("http://a b", False), ("", False), (None, False)])
def test_urls(spark, text, expected):
    frame = spark.createDataFrame([(text, [text, text])], "value string, links array<string>")
    row = inspector.url_flags(frame, "value", "links").first()
    assert (row.is_url, row.all_urls) == (expected, expected)


def test_titles_of_types(spark):
    words = ["snake_case", "land", "building_part", "ATM_machine", "a__b", ""]
    frame = spark.createDataFrame([(w,) for w in words], "type string")
    assert [r.title for r in inspector.type_titles(frame).collect()] == [
        "Snake Case", "Land", "Building Part", "ATM Machine", "A  B", ""]


def test_source_links(spark):
    records = [("OpenStreetMap", "w123@4"), ("OpenStreetMap", "N9"), ("OpenStreetMap", "r7@x"), ("OpenStreetMap", None),
               ("meta", "55"), ("Esri", "w1")]
    frame = spark.createDataFrame([("a", records)], "id string, sources array<struct<dataset:string,record_id:string>>")
    assert [r.url for r in inspector.source_links(frame).orderBy("position").collect()] == [
        "https://www.openstreetmap.org/way/123", "https://www.openstreetmap.org/node/9", None, None,
        "https://facebook.com/55", None]


def test_json_key_and_language(spark):
    frame = spark.createDataFrame(
        [('{"primary":"A","common":{"en":"B"}}', "A"), ('{"primary" : "A"}', "A"), ('{"primary":5}', None), (None, "D")],
        "names string, `@name` string")
    assert [r.primary for r in inspector.json_key(frame, "names", "primary").collect()] == ["A", "A", "", ""]
    named = spark.createDataFrame(
        [("A", ("A", {"en": "B"})), ("A", ("A", None)), ("A", None)],
        "`@name` string, names struct<primary:string,common:map<string,string>>")
    assert [r.label for r in inspector.localized_label(named, "en").collect()] == ["B", "A", "A"]
    assert [r.label for r in inspector.localized_label(named, "mul").collect()] == ["A", "A", "A"]


def test_extrusion_and_widths(spark):
    frame = spark.createDataFrame([(3.0, 9.0), (-1.0, None), (None, 4.0)], "min_height double, height double")
    assert [(r.base, r.top) for r in inspector.building_extrusion(frame).collect()] == [(3.0, 9.0), (0.0, 0.0), (0.0, 4.0)]
    zooms = spark.createDataFrame(
        [("country", 1.0), ("country", 5.5), ("region", 8.0), ("locality", 20.0), (None, 3.0)], "subtype string, z double")
    widths = inspector.style_interpolate(zooms, "z", boundary_width_stops(F.col("subtype"))).collect()
    assert [r.styled for r in widths] == pytest.approx([1.0, 1.125, 0.85, 0.2, 0.1])


def test_viewports(spark):
    frame = spark.createDataFrame(
        [("wide", (0.0, 1.0, 0.0, 2.0), 5.0, 6.0), ("thin", (0.0, 0.001, 0.0, 2.0), 5.0, 6.0),
         ("no box", None, 5.0, 6.0), ("nothing", None, None, None)], f"id string, box {BOX}, lon double, lat double")

    def views(mode):
        return {r.id: (r.action, r.center_lon, r.center_lat, r.view_zoom)
                for r in lookup.lookup_viewport(frame, mode).collect()}

    fit, none = ("fit", None, None, 14.5), (None, None, None, None)
    assert views("id") == {"wide": fit, "thin": ("center", 0.0005, 1.0, 16.0), "no box": ("center", 5.0, 6.0, 14.5),
                           "nothing": none}
    assert views("country")["wide"] == ("center", 5.0, 6.0, 4.0)
    assert views("locality") == {"wide": fit, "thin": ("center", 5.0, 6.0, 14.5), "no box": ("center", 5.0, 6.0, 14.5),
                                 "nothing": none}


def test_links(spark):
    urls = {
        "full": "https://m.org/?mode=inspect&layers=land%2Crail&feature=base.water.a.b.c#12.5/31/-35.5",
        "bare": "https://m.org/", "short": "https://m.org/?feature=base.water&mode=x#5//",
        "bad": "https://m.org/?feature=base.water.zzz#a/1/2", "broken": "http://[bad",
    }
    features = spark.createDataFrame(
        [("base", "water", "a.b.c", "lake", (0.0, 0.0, 0.0, 0.0))],
        f"theme string, type string, id string, subtype string, bbox {BOX}")
    links = spark.createDataFrame(list(urls.items()), "link_id string, url string")
    rows = {r.link_id: r for r in lookup.view_link_restore(links, features).collect()}
    full = rows["full"]
    assert (full.mode, full.layers, full.zoom, full.latitude, full.longitude) == ("inspect", ["land", "rail"], 12.5, 31.0, -35.5)
    assert (full.theme, full.type, full.id, full.feature.subtype) == ("base", "water", "a.b.c", "lake")
    assert (rows["short"].mode, rows["short"].zoom, rows["short"].latitude, rows["short"].id) == ("explore", 5.0, 0.0, None)
    assert (rows["bad"].zoom, rows["bad"].id, rows["bad"].feature) == (None, "zzz", None)
    assert (rows["bare"].mode, rows["bare"].layers, rows["broken"].zoom) == ("explore", None, None)


def test_lookup_takes_the_first_type(spark):
    box = (0.0, 0.0, 0.0, 0.0)
    features = spark.createDataFrame(
        [("a", "address", box), ("a", "water", box), ("a", "land", box), ("b", "place", box)],
        f"id string, type string, bbox {BOX}")
    ids = spark.createDataFrame([("a",), ("a",), ("c",)], "id string")
    assert [(r.id, r.type) for r in lookup.feature_lookup(features, ids).collect()] == [("a", "water")]


def test_name_search_equals_sorting_everything(spark):
    rng = random.Random(3)
    names = [f"{rng.choice(['Road', 'road', 'Rope', 'Lake'])} {rng.randint(0, 30)}" for _ in range(300)]
    # A third of the names are one and the same.
    names += ["Road 7"] * 150
    rows = [(f"f{n}", None, "division", rng.choice(["country", "county"]), (name,)) for n, name in enumerate(names)]
    features = spark.createDataFrame(rows, "id string, theme string, type string, subtype string, names struct<primary:string>")
    texts = ["ro", "ROAD 7", "rope 1", "l", "zzz", "ro", "a name longer than any other name"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")
    for mode in ("locality", "country"):
        expected = []
        for n, text in enumerate(texts):
            if len(text) >= 2:
                hits = sorted((r[4][0].lower(), r[4][0], r[0], r[3]) for r in rows if r[4][0].lower().startswith(text.lower()))[:6]
                expected += [(n, h[2]) for h in hits if mode != "country" or h[3] == "country"]
        found = lookup.name_search(features, queries, mode).collect()
        assert sorted((r.query_id, r.id) for r in found) == sorted(expected)


def test_name_search_limits_before_the_shuffle(spark, capsys):
    features = spark.createDataFrame([("a", "t", "p", "s", ("Road",))], "id string, theme string, type string, subtype string, names struct<primary:string>")
    queries = spark.createDataFrame([(1, "ro")], "query_id int, text string")
    lookup.name_search(features, queries).explain()
    assert "Partial" in [line for line in capsys.readouterr().out.splitlines() if "WindowGroupLimit" in line][-1]


def test_click_keeps_the_topmost_hit_of_each_feature(spark):
    hits = spark.createDataFrame(
        [(1, "a", 5, "r5"), (1, "a", 9, "r9"), (1, "b", 7, "r7"), (2, "b", 7, "r7"), (2, "c", 7, "r7")],
        "click_id int, id string, draw_order int, rule_id string")
    rows = {(r.click_id, r.id): (r.rule_id, r.active) for r in click_dedupe(hits).collect()}
    assert rows == {(1, "a"): ("r9", True), (1, "b"): ("r7", False), (2, "b"): ("r7", True), (2, "c"): ("r7", False)}


def test_low_zoom_base_features(spark):
    frame = spark.createDataFrame([("base",), ("places",)], "theme string")
    assert filters.low_zoom_base_filter(frame, 9.9).count() == 1
    assert filters.low_zoom_base_filter(frame, 10).count() == 2
    assert filters.low_zoom_base_filter(frame, 5, inspect=True).count() == 2


def test_audit(spark):
    spec = spark.createDataFrame(
        [("base", "water", "id", 4), ("base", "water", "subtype", 4)], "theme string, layer string, field string, minzoom int")
    types = spark.createDataFrame([("base", "water", 3), ("base", "land", 2)], "theme string, type string, features long")
    assert [r.subject for r in audit.audit_missing_layers(types, spec).collect()] == ["land"]
    fields = spark.createDataFrame(
        [("base", "water", f, 1) for f in ("id", "$x", "geometry-type", "@name", "depth", "known")] + [("base", "land", "id", 1)],
        "theme string, type string, field string, features long")
    allowed = spark.createDataFrame([("base", "water", "known")], "theme string, type string, field string")
    assert {r.subject for r in audit.audit_missing_fields(fields, spec).collect()} == {"@name", "depth", "known"}
    assert [r.subject for r in audit.audit_missing_fields(fields, spec, allowed, True).collect()] == ["depth"]
    zooms = spark.createDataFrame([("base", "water", 3, 1), ("base", "water", 4, 1)], "theme string, type string, min_zoom int, features long")
    assert [r.subject for r in audit.audit_zoom_range(zooms, spec).collect()] == ["3"]
    placed = spark.createDataFrame(
        [("base", "water", "base", "water"), ("base", "water", "places", "lake"), ("base", "water", None, "")],
        "theme string, type string, declared_theme string, declared_type string")
    assert {r.subject for r in audit.audit_metadata(placed).collect()} == {"theme:places", "type:lake"}


def test_coverage(spark):
    enums = spark.createDataFrame(
        [("base", "water", "subtypes", v) for v in ("lake", "ocean", "river")]
        + [("base", "water", "classes", "lake"), ("t", "segment", "rail_classes", "tram")],
        "theme string, type string, kind string, value string")
    used = spark.createDataFrame(
        [("base", "water", "lake"), ("base", "water", "ocean"), ("base", "water", "pond"), ("base", "land", "river")],
        "theme string, type string, value string")
    rows = {r.kind: (r.total, r.styled, r.percent, r.styled_values, r.unstyled_values)
            for r in audit.style_coverage(enums, used).collect()}
    assert rows == {"subtypes": (3, 2, 67, "lake,ocean", "river"), "classes": (1, 1, 100, "lake", ""),
                    "rail_classes": (1, 0, 0, "", "tram")}
    total = audit.style_coverage_total(enums, used).first()
    assert (total.total, total.styled, total.percent) == (5, 3, 60)
    assert audit.style_coverage_total(enums.limit(0), used).first().percent == 0
    observed = used.withColumn("features", F.lit(1))
    assert {r.subject for r in audit.audit_bad_values(observed, enums).collect()} == {"pond"}
    assert Counter(r.styled for r in audit.styled_values(enums, used).collect()) == {True: 2, False: 2}
    issues = spark.createDataFrame([("error", "a"), ("error", "b"), ("warn", "c")], "severity string, check string")
    counts = {(r.severity, r.check): r.issues for r in audit.audit_counts(issues).collect()}
    assert counts[None, None] == 3 and counts["error", None] == 2


def leaves(value, path=()):
    """Plain values of parsed JSON with the way to them, in order."""
    if isinstance(value, dict):
        for name, below in value.items():
            yield from leaves(below, (*path, name))
    elif isinstance(value, list):
        for n, below in enumerate(value):
            yield from leaves(below, (*path, str(n)))
    elif value is not None:
        yield ".".join(path) or None, value if isinstance(value, str) else json.dumps(value)


def test_property_walk_goes_to_the_end(spark):
    deep = "x"
    for n in range(25):
        deep = {"k": deep, "n": n} if n % 2 else [n, deep]
    values = [deep, {"z": 1, "a": {"c": [], "b": [None, 2.5], "e": {}}, "m": True}, {"z": 1, "a": [[["y"]]]}, [], "plain"]
    rows = [(n, "key", v if isinstance(v, str) else json.dumps(v)) for n, v in enumerate([*values, values[1]])]
    frame = spark.createDataFrame([*rows, (9, "key", None)], "id int, key string, value string")
    found = {}
    for r in sorted(inspector.property_walk(frame).collect(), key=lambda r: (r.id, r.position)):
        found.setdefault(r.id, []).append((r.path, r.text))
    assert found == {n: listed for n, v in enumerate([*values, values[1]]) if (listed := list(leaves(v)))}


def test_feature_lookup_shuffles_only_the_columns_asked_for(spark):
    box = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"
    features = spark.createDataFrame(
        [("a", "division_area", "s", "long text", (2.0, 3.0, 1.0, 2.0)), ("a", "division_area", "t", "long text", (1.0, 3.0, 1.0, 2.0)),
         ("b", "place", None, "long text", (1.0, 1.0, 1.0, 1.0))], f"id string, type string, subtype string, names string, bbox {box}")
    ids = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "id string")
    found = lookup.feature_lookup(features, ids, ["type", "subtype"])
    assert {tuple(r) for r in found.collect()} == {("a", "division_area", "t"), ("b", "place", None)}
    assert found.columns == ["id", "type", "subtype"]
    assert lookup.feature_lookup(features, ids).columns == features.columns
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "names" not in plan.split("LogicalRDD")[0]


def test_property_walk_opens_nested_texts_without_a_shuffle_of_its_own(spark):
    frame = spark.createDataFrame([(1, "k", ' \n{"a": [1, {"b": "[x"}], "c": null}'), (2, "k", "plain"), (3, "k", "{no"), (4, "k", "[]"),
                                   (5, "k", None), (2, "k", "plain")], "id int, key string, value string")
    wanted = [(1, "k", 0, "a.0", "1"), (1, "k", 1, "a.1.b", "[x"), (2, "k", 0, None, "plain"), (2, "k", 0, None, "plain"), (3, "k", 0, None, "{no")]
    for run in (inspector.property_tree, inspector.property_walk):
        found = run(frame)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Join" not in plan
