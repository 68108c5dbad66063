"""Finding features by id, by shared link and by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapsheaf.model import LOOKUP_TYPE_ORDER
from mapsheaf.operators.tags import feature_label
from mapsheaf.plans.rules import default_items

# Most results of a name search, and the shortest query.
SEARCH_RESULTS = 6
SHORTEST_QUERY = 2

# A box wider and higher than this is shown whole; zooms of the views.
SMALLEST_BOX = 0.001
FIT_MAX_ZOOM = 14.5
CENTER_ZOOM = 16.0
COUNTRY_ZOOM = 4.0


def _type_rank() -> Column:
    order = F.array(*(F.lit(type_) for type_ in LOOKUP_TYPE_ORDER))
    place = F.array_position(order, F.col("type"))
    return F.when(place > 0, place).otherwise(len(LOOKUP_TYPE_ORDER) + 1)


def feature_lookup(features: DataFrame, ids: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The feature of each id; where types share an id, the first in the fixed type order.

    Ids are made distinct before the join and hits reduced per id by a minimum, so
    neither repeated requests nor repeated features pile up in one task. Only the id, ``columns``
    (all, if not given) and what ranks the hits are shuffled.
    """
    wanted = ids.select("id").distinct()
    columns = [c for c in columns or features.columns if c != "id"]
    rank = F.struct("_rank", "_west", "_south")
    ranked = features.select("id", *columns, _type_rank().cast("tinyint").alias("_rank"),
                             F.col("bbox.xmin").alias("_west"), F.col("bbox.ymin").alias("_south"))
    return (
        ranked.join(wanted, "id")
        .groupBy("id").agg(F.min_by(F.struct(*columns), rank).alias("_found"))
        .select("id", "_found.*")
    )


def _number(text: Column) -> Column:
    """A number out of a link; blank text is 0, anything else unreadable is null."""
    trimmed = F.trim(text)
    value = F.when(trimmed == "", F.lit(0.0)).otherwise(trimmed.try_cast("double"))
    return F.when(~F.isnan(value), value)


def parse_links(links: DataFrame, url: str = "url") -> DataFrame:
    """Add mode, layers, map position and feature parts of shared links.

    ``items`` are the layers, or the mode's default items for a link without any.
    """
    def parameter(name: str) -> Column:
        return F.try_url_decode(F.try_parse_url(F.col(url), F.lit("QUERY"), F.lit(name)))

    # Each part of the address is taken out once, in a step of its own, and then read.
    parts = links.withColumns({
        "_mode": parameter("mode"), "_layers": parameter("layers"),
        "_feature": F.split(parameter("feature"), r"\.", 3),
        "_position": F.split(F.try_parse_url(F.col(url), F.lit("REF")), "/"),
    })
    spots = parts.withColumns({f"_spot{n}": _number(F.get("_position", n)) for n in range(3)})
    spot = [F.col(f"_spot{n}") for n in range(3)]
    placed = (F.size("_position") >= 3) & spot[0].isNotNull() & spot[1].isNotNull() & spot[2].isNotNull()
    whole = F.size("_feature") >= 3
    return spots.withColumns({
        "mode": F.when(F.col("_mode") == "inspect", "inspect").otherwise("explore"),
        "layers": F.when(F.col("_layers") != "", F.split("_layers", ",")),
        "zoom": F.when(placed, spot[0]),
        "latitude": F.when(placed, spot[1]),
        "longitude": F.when(placed, spot[2]),
        "theme": F.when(whole, F.get("_feature", 0)),
        "type": F.when(whole, F.get("_feature", 1)),
        "id": F.when(whole, F.get("_feature", 2)),
    }).withColumn("items", F.coalesce("layers", F.when(
        F.col("mode") == "inspect", F.array(*map(F.lit, default_items("inspect")))).otherwise(
        F.array(*map(F.lit, default_items("explore")))),
    )).drop("_mode", "_layers", "_feature", "_position", "_spot0", "_spot1", "_spot2")


def view_link_restore(links: DataFrame, features: DataFrame) -> DataFrame:
    """Shared links with the state they carry and the feature they point at, if it exists.

    ``links`` has ``link_id`` and ``url``. Features are looked up once per distinct
    target; a target many links share is split by the adaptive skew join.
    """
    keys = ["theme", "type", "id"]
    parsed = parse_links(links)
    pointing = parsed.where(F.col("id").isNotNull())
    columns = [c for c in features.columns if c not in keys]
    found = (
        features.join(pointing.select(*keys).distinct(), keys)
        .groupBy(*keys).agg(F.min_by(
            F.struct(*columns), F.struct("bbox.xmin", "bbox.ymin")).alias("feature"))
    )
    # Links without a target need no join; their equal, empty keys would meet in one task.
    aimed = pointing.join(found, keys, "left")
    return aimed.unionByName(parsed.where(F.col("id").isNull()), allowMissingColumns=True)


def _prefix_results(features: DataFrame, queries: DataFrame, results: int) -> DataFrame:
    named = features.withColumn("name", feature_label(features)).where(F.col("name").isNotNull())
    texts = (
        queries.where(F.length("text") >= SHORTEST_QUERY)
        .select(F.lower("text").alias("prefix")).distinct()
    )
    # Only prefixes as long as some query; there are no more lengths than the longest query has letters.
    lengths = F.coalesce(texts.agg(F.collect_set(F.length("prefix"))).scalar(), F.array().cast("array<int>"))
    folded = F.lower("name")
    prefixes = named.withColumn("_lengths", lengths).withColumn("prefix", F.explode(F.transform(
        F.filter("_lengths", lambda n: n <= F.length(folded)), lambda n: F.left(folded, n)))).drop("_lengths")
    asked = prefixes.join(texts, "prefix", "left_semi")
    # Spark keeps the best rows of a prefix in every task before it shuffles them,
    # so a prefix shared by most names costs no more than any other.
    best = Window.partitionBy("prefix").orderBy(folded, "name", "id")
    return (
        asked.withColumn("position", F.row_number().over(best))
        .where(F.col("position") <= results)
        .select("prefix", "position", "id", "theme", "type", "subtype", "name")
    )


def name_search(features: DataFrame, queries: DataFrame, mode: str = "locality",
                results: int = SEARCH_RESULTS) -> DataFrame:
    """The first names that start with each query, whatever the case.

    ``queries`` has ``query_id`` and ``text``. Country mode drops other results
    after the limit, so it may return fewer.
    """
    found = _prefix_results(features, queries, results)
    if mode == "country":
        found = found.where(F.col("subtype") == "country")
    asked = queries.withColumn("prefix", F.lower("text"))
    return asked.join(found, "prefix").drop("prefix")


def lookup_viewport(hits: DataFrame, mode: str = "id") -> DataFrame:
    """Where the map goes for each search result.

    ``hits`` has a ``box`` and ``lon``, ``lat``, any of them null. A result either
    fits its box, up to a zoom, or centres on a point at a zoom. An id lookup always
    has a box; a country with a point goes there; others prefer a box that has some size.
    """
    box = F.col("box")
    sized = F.coalesce(
        (F.abs(box["xmax"] - box["xmin"]) > SMALLEST_BOX)
        & (F.abs(box["ymax"] - box["ymin"]) > SMALLEST_BOX), F.lit(False))
    boxed = box["xmin"].isNotNull()
    point = F.col("lon").isNotNull() & F.col("lat").isNotNull()

    def go(action: str, x: Column, y: Column, zoom: float) -> Column:
        return F.struct(
            F.lit(action).alias("action"), x.alias("center_lon"), y.alias("center_lat"),
            F.lit(zoom).alias("view_zoom"))

    none = F.lit(None).cast("double")
    fit = go("fit", none, none, FIT_MAX_ZOOM)
    middle = go("center", (box["xmin"] + box["xmax"]) / 2, (box["ymin"] + box["ymax"]) / 2, CENTER_ZOOM)
    if mode == "id":
        chosen = F.when(boxed & sized, fit).when(boxed, middle)
        chosen = chosen.when(point, go("center", F.col("lon"), F.col("lat"), FIT_MAX_ZOOM))
    else:
        chosen = F.when(sized, fit).when(point, go("center", F.col("lon"), F.col("lat"), FIT_MAX_ZOOM))
        if mode == "country":
            chosen = F.when(point, go("center", F.col("lon"), F.col("lat"), COUNTRY_ZOOM)).otherwise(chosen)
    return hits.withColumn("_view", chosen).select("*", "_view.*").drop("_view")
