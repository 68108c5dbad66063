"""What the inspector shows of a feature: entity, titles, properties and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapsheaf.functions import text as t
from mapsheaf.functions.style import interpolate
from mapsheaf.model import THEME_TYPES
from mapsheaf.operators.tags import _tag_columns

# Title without a name, longest list shown in line, record pages.
DEFAULT_TITLE = "Inspector Panel"
INLINE_ITEMS = 3
META_RECORD_URL = "https://facebook.com/"
OSM_RECORD_URL = "https://www.openstreetmap.org/"
OSM_RECORD_PATTERN = r"(?i)^([nwr])(\d+)(@\d+)?$"
OSM_RECORD_KINDS = {"n": "node", "w": "way", "r": "relation"}


def json_key(df: DataFrame, column: str, key: str, name: str | None = None) -> DataFrame:
    """Add the text stored under ``key`` in a JSON column, empty when it has none."""
    return df.withColumn(name or key, t.json_text(F.col(column), key))


def localized_label(df: DataFrame, language: str, name: str = "label") -> DataFrame:
    """Add the name in a language, else ``@name``; ``mul`` asks for ``@name`` itself."""
    plain = F.col("`@name`")
    if language == "mul":
        return df.withColumn(name, plain)
    return df.withColumn(name, F.coalesce(F.try_element_at("names.common", F.lit(language)), plain))


def feature_title(df: DataFrame, name: str = "title") -> DataFrame:
    """Add the title: an address line, or a name, or the type with its subtype.

    ``names`` is JSON text here, as it comes on tiles.
    """
    address = F.concat_ws(" ", *(t.blank_as_null(F.col(c)) for c in ("number", "unit", "street")))
    subtype = t.blank_as_null(F.col("subtype"))
    named = F.when(subtype != F.col("type"), F.concat("type", F.lit(" ("), subtype, F.lit(")")))
    other = F.coalesce(
        t.blank_as_null(F.col("`@name`")),
        t.blank_as_null(F.get_json_object("names", "$.primary")),
        named,
        F.col("type"),
    )
    return df.withColumn(name, F.when(F.col("theme") == "addresses", address).otherwise(other))


def panel_title(df: DataFrame, column: str = "names", name: str = "title") -> DataFrame:
    """Add the primary name out of JSON text; a default if it is missing or not JSON."""
    primary = t.blank_as_null(F.get_json_object(column, "$.primary"))
    return df.withColumn(name, F.coalesce(primary, F.lit(DEFAULT_TITLE)))


def record_url(dataset: Column, record_id: Column) -> Column:
    """The page of a source record, where its dataset has one."""
    kind = F.lower(F.regexp_extract(record_id, OSM_RECORD_PATTERN, 1))
    page = F
    for letter, word in OSM_RECORD_KINDS.items():
        page = page.when(kind == letter, word)
    number = F.regexp_extract(record_id, OSM_RECORD_PATTERN, 2)
    return (
        F.when(dataset == "meta", F.concat(F.lit(META_RECORD_URL), record_id))
        .when(dataset == "OpenStreetMap", F.concat(F.lit(OSM_RECORD_URL), page, F.lit("/"), number))
    )


def source_links(df: DataFrame) -> DataFrame:
    """One row per feature and source, with the page of the record."""
    return (
        df.select("id", F.posexplode("sources").alias("position", "source"))
        .select("id", "position", "source.*")
        .withColumn("url", record_url(F.col("dataset"), F.col("record_id")))
    )


def properties_of(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """Add ``properties``: the attributes a feature carries, as texts in column order."""
    entries = F.array(*(
        F.struct(F.lit(name).alias("key"), column.cast("string").alias("value"))
        for name, column in _tag_columns(df, skip).items()
    ))
    return df.withColumn("properties", F.filter(entries, lambda entry: entry["value"].isNotNull()))


def feature_entity(df: DataFrame) -> DataFrame:
    """Add ``entity``: source and layer as theme and type, then the properties.

    ``df`` has ``source``, ``source_layer`` and ``properties``. Properties of the
    same name win. ``known_theme`` tells whether the theme is one of the release's.
    """
    properties = F.col("properties")

    def settled(key: str, given: Column) -> Column:
        own = F.filter(properties, lambda entry: entry["key"] == key)
        return F.when(F.size(own) > 0, F.get(own, 0)["value"]).otherwise(given)

    theme, type_ = settled("theme", F.col("source")), settled("type", F.col("source_layer"))
    head = F.array(
        F.struct(F.lit("theme").alias("key"), theme.alias("value")),
        F.struct(F.lit("type").alias("key"), type_.alias("value")),
    )
    rest = F.filter(properties, lambda entry: ~entry["key"].isin("theme", "type"))
    return df.withColumns({
        "theme": theme, "type": type_, "entity": F.concat(head, rest),
        "known_theme": F.coalesce(theme.isin(*THEME_TYPES), F.lit(False)),
    })


def property_rows(df: DataFrame, column: str = "entity", keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row per property in order; ``subclass`` follows ``class``, indented.

    Properties that start with ``@`` are helpers and left out.
    """
    def line(entry: Column, indented: bool) -> Column:
        return F.struct(
            entry["key"].alias("key"), entry["value"].alias("value"), F.lit(indented).alias("indented"))

    def entries(where) -> Column:
        return F.filter("_own", where)

    own = df.select(
        *keys, F.filter(column, lambda entry: ~entry["key"].startswith("@")).alias("_own"))
    parts = own.select(
        *keys,
        entries(lambda entry: entry["key"] != "subclass").alias("_others"),
        F.get(entries(lambda entry: entry["key"] == "subclass"), 0).alias("_sub"),
    )
    split = parts.select(
        "*", F.array_position(F.transform("_others", lambda entry: entry["key"]), F.lit("class")).alias("_class"))
    lines = F.transform("_others", lambda entry: line(entry, False))
    below = (
        F.when(F.col("_class") > 0, F.array_insert(lines, (F.col("_class") + 1).cast("int"), line(F.col("_sub"), True)))
        .otherwise(F.array_append(lines, line(F.col("_sub"), False)))
    )
    ordered = F.when(F.col("_sub").isNull(), lines).otherwise(below)
    return (
        split.select(*keys, F.posexplode(ordered).alias("position", "line"))
        .select(*keys, "position", "line.*")
    )


# Members that come first, in this order.
FIRST_MEMBERS = {"names": ("primary", "common", "rules"), "categories": ("primary", "alternate")}


def property_values(df: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Nested property texts member by member.

    A JSON object gives one row per member that is neither null nor the text "null": the
    known members of names and categories first, the others in the order of the text. A
    JSON list gives one row per item, anything else one row as it is. Short lists of plain
    values other than web addresses are shown in line, with brackets but for
    ``alternate``, which always shows plain lists so.
    """
    keep = [c for c in df.columns if c != value]
    # Parsed once, in a step of its own, and then split up.
    parsed = df.withColumn("_parsed", F.when(F.col(value).rlike(r"^\s*[\[{]"), F.try_parse_json(value)))
    split = parsed.withColumns({
        "_map": F.try_variant_get("_parsed", "$", "map<string,variant>"),
        "_keys": F.json_object_keys(value),
        "_items": F.try_variant_get("_parsed", "$", "array<variant>"),
    })
    known = F.array().cast("array<string>")
    for name, listed in FIRST_MEMBERS.items():
        known = F.when(F.col(key) == name, F.array(*map(F.lit, listed))).otherwise(known)
    split = split.withColumn("_known", known).withColumn("_members", F.transform(
        F.concat(F.array_intersect("_known", "_keys"), F.array_except("_keys", "_known")),
        lambda member: F.struct(member.alias("key"), F.try_element_at("_map", member).alias("value"))))

    def text(item: Column) -> Column:
        return F.coalesce(F.try_variant_get(item, "$", "string"), F.to_json(item))

    def listing(member: Column, items: Column) -> Column:
        kind = r"^(STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
        plain = F.forall(items, lambda item: F.coalesce(F.schema_of_variant(item).rlike(kind), F.lit(False)))
        joined = F.array_join(F.transform(items, text), ", ")
        addresses = F.forall(items, lambda item: t.is_url(text(item))) & (F.size(items) > 0)
        return F.when(
            plain & ~F.coalesce(addresses, F.lit(False)),
            F.when(F.coalesce(member == "alternate", F.lit(False)), joined)
            .when(F.size(items) <= INLINE_ITEMS, F.concat(F.lit("["), joined, F.lit("]"))))

    def shown(member: Column, item: Column) -> Column:
        items = F.array(F.try_variant_get(item, "$", "array<variant>"))
        listed = F.get(F.transform(items, lambda values: listing(member, values)), 0)
        return F.coalesce(
            F.when(F.schema_of_variant(item).startswith("ARRAY"), listed), text(item))

    members, items = F.col("_members"), F.col("_items")
    nothing = F.lit(None).cast("string")
    rows = (
        F.when(members.isNotNull(), F.transform(
            F.filter(members, lambda m: F.coalesce(
                ~F.is_variant_null(m["value"]) & (text(m["value"]) != "null"), F.lit(False))),
            lambda m: F.struct(m["key"].alias("member"), shown(m["key"], m["value"]).alias("text"))))
        .when(items.isNotNull(), F.transform(
            items, lambda item: F.struct(nothing.alias("member"), shown(nothing, item).alias("text"))))
        .otherwise(F.array(F.struct(nothing.alias("member"), F.col(value).alias("text"))))
    )
    return split.select(*keep, F.posexplode(rows).alias("position", "row")).select(
        *keep, "position", "row.*")


# Rounds of a recursive query: nested deeper is an error, not a cut.
WALK_ROUNDS = 1_000

# Objects in objects are followed this deep; what lies below stays JSON text.
TREE_DEPTH = 8


# An entry of a nested text: where it stands, what it is, and whether it may hold entries of its own.
_ENTRIES = "array<struct<path:array<string>,text:string,open:boolean>>"


def _opens(text: str) -> str:
    """Whether a text may be an object or a list, by its first character."""
    return rf"coalesce(left(trim(LEADING ' \t\n\u000B\u000C\r' FROM {text}), 1) IN ('\u007B', '['), false)"


def _entry(name: str, text: str) -> str:
    return f"named_struct('path', concat(p.path, array({name})), 'text', {text}, 'open', {_opens(text)})"


# A level of entries opened; each is parsed once. What cannot be opened is closed.
_BELOW = f"""CAST(flatten(transform(_rows, p -> CASE WHEN p.open THEN coalesce(
  CASE WHEN p.text RLIKE '^\\\\s*\\\\x7B' THEN transform(array(from_json(p.text, 'map<string,string>')), m ->
    CASE WHEN size(m) > 0 THEN transform(map_entries(m), e -> {_entry("e.key", "e.value")}) END)[0]
  ELSE transform(array(from_json(p.text, 'array<string>')), m ->
    CASE WHEN size(m) > 0 THEN transform(m, (item, n) -> {_entry("CAST(n AS string)", "item")}) END)[0] END,
  array(named_struct('path', p.path, 'text', p.text, 'open', false))) ELSE array(p) END)) AS {_ENTRIES})"""
_SOME_OPEN = "exists(_rows, p -> p.open)"


def _entries(df: DataFrame, value: str) -> DataFrame:
    """``df`` with ``_rows`` in place of a text: the text itself as the only entry."""
    first = f"CAST(array(named_struct('path', array(), 'text', `{value}`, 'open', {_opens(f'`{value}`')})) AS {_ENTRIES})"
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c != value), F.expr(first).alias("_rows"))


def _opened(rows: DataFrame, depth: int) -> DataFrame:
    """Entries opened level by level, ``depth`` deep."""
    for _ in range(depth):
        # Most are done after a few levels and only looked at from then on.
        rows = rows.withColumn("_rows", F.expr(f"CASE WHEN {_SOME_OPEN} THEN {_BELOW} ELSE _rows END"))
    return rows


def _listed(rows: DataFrame) -> DataFrame:
    """A row for each entry that is neither null, the text "null" nor empty."""
    shown = F.filter("_rows", lambda row: row["text"].isNotNull() & ~row["text"].rlike(
        r"^\s*(null|\[\s*\]|\{\s*\})\s*$"))
    keep = [F.col(f"`{c}`") for c in rows.columns if c != "_rows"]
    return rows.select(*keep, F.posexplode(shown).alias("position", "row")).select(
        *keep, "position", F.when(F.size("row.path") > 0, F.array_join("row.path", ".")).alias("path"), "row.text")


def property_tree(df: DataFrame, key: str = "key", value: str = "value", depth: int = TREE_DEPTH) -> DataFrame:
    """Nested property texts down to their plain values, one row each in the order of the text.

    ``path`` joins the members and list positions that lead to ``text`` by dots; it is null
    for a text that is not nested. Members that are null, the text "null" or empty are left out.
    """
    return _listed(_opened(_entries(df, value), depth))


def property_walk(df: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """``property_tree`` by a recursive query, which goes on until no nested value is left.

    A row of the recursion is a whole text with its entries so far, so these need no numbers to be put
    together again. Spark keeps the rows of all rounds, so the first ``TREE_DEPTH`` levels are opened before
    the recursion and only texts with more than those take part in it. Text nested more than ``WALK_ROUNDS`` deep is an error. Spark's limit of a
    recursion's rows, a million, is lifted for the session.
    """
    df.sparkSession.conf.set("spark.sql.cteRecursionRowLimit", -1)

    def opened(rows: DataFrame) -> DataFrame:
        # Out of a generator, as the filters below would repeat all levels otherwise.
        rows = _opened(_entries(rows, value), TREE_DEPTH)
        return rows.select(*(F.col(f"`{c}`") for c in rows.columns if c != "_rows"), F.explode(F.array("_rows")).alias("_rows"))

    # Each level has a bracket of its own in the text, as it is or escaped.
    start = opened(df.where(F.regexp_count(F.col(f"`{value}`"), F.lit(r"[\[{]|\\u")) > TREE_DEPTH))
    keep = ", ".join(f"`{c}`" for c in start.columns if c != "_rows")
    walked = df.sparkSession.sql(f"""
      WITH RECURSIVE walk({keep}, _rows) MAX RECURSION LEVEL {WALK_ROUNDS} AS (
        SELECT {keep}, _rows FROM {{start}} WHERE {_SOME_OPEN}
        UNION ALL
        SELECT {keep}, {_BELOW} FROM walk WHERE {_SOME_OPEN})
      SELECT {keep}, _rows FROM walk WHERE NOT {_SOME_OPEN}""", start=start)
    # Texts that are open no more take no part in the recursion.
    return _listed(walked).union(_listed(opened(df).where(f"NOT {_SOME_OPEN}")))


def url_flags(df: DataFrame, value: str = "value", values: str | None = None) -> DataFrame:
    """Add whether ``value`` is a web address, and whether all of a list ``values`` are."""
    df = df.withColumn("is_url", t.is_url(F.col(value)))
    if values is None:
        return df
    every = F.forall(values, lambda item: t.is_url(item)) & (F.size(values) > 0)
    return df.withColumn("all_urls", F.coalesce(every, F.lit(False)))


def type_titles(df: DataFrame, column: str = "type", name: str = "title") -> DataFrame:
    """Add the spelled-out form of a snake_case name."""
    return df.withColumn(name, t.title_case(F.col(column)))


def building_extrusion(df: DataFrame) -> DataFrame:
    """Add the heights between which a building is raised."""
    floor = F.col("min_height")
    return df.withColumns({
        "base": F.when(floor >= 0, floor).otherwise(0.0),
        "top": F.coalesce("height", F.lit(0.0)),
    })


def style_interpolate(df: DataFrame, position, stops, name: str = "styled") -> DataFrame:
    """Add a value that changes linearly with zoom or an attribute; see ``functions.style``."""
    position = F.col(position) if isinstance(position, str) else position
    return df.withColumn(name, interpolate(position, *stops))
