"""Extracts: GeoJSON text and its description."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapsheaf.functions.predicates import meets_box
from mapsheaf.functions.text import fixed3, number_text
from mapsheaf.functions.wkb import wkb_to_geojson
from mapsheaf.model import Box

_SIDES = ("xmin", "ymin", "xmax", "ymax")


def box_geometry(geom_type: Column, bbox: Column) -> Column:
    """GeoJSON text of the shape a box stands for: point, diagonal or outline."""
    def at(x: str, y: str) -> Column:
        return F.concat(F.lit("["), number_text(bbox[x]), F.lit(","), number_text(bbox[y]), F.lit("]"))

    def shape(kind: str, *coordinates) -> Column:
        return F.concat(
            F.lit(f'{{"type":"{kind}","coordinates":'), *coordinates, F.lit("}"))

    low, high = at("xmin", "ymin"), at("xmax", "ymax")
    ring = F.concat_ws(",", low, at("xmax", "ymin"), high, at("xmin", "ymax"), low)
    return (
        F.when(geom_type == "Point", shape("Point", low))
        .when(geom_type == "LineString",
              shape("LineString", F.lit("["), low, F.lit(","), high, F.lit("]")))
        .otherwise(shape("Polygon", F.lit("[["), ring, F.lit("]]")))
    )


def geojson_lines(df: DataFrame) -> DataFrame:
    """One GeoJSON feature text per row beside its ``type``.

    A ``geometry`` in well-known binary is written out; without one the box stands in.
    """
    if "geometry" in df.columns:
        geometry = wkb_to_geojson(F.col("geometry"))
    else:
        geometry = box_geometry(F.col("geom_type"), F.col("bbox"))
    skip = ("theme", "type", "geometry", "geom_type", "filename")
    properties = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns if c not in skip)))
    return df.select("type", F.concat(
        F.lit('{"type":"Feature","geometry":'), F.coalesce(geometry, F.lit("null")),
        F.lit(',"properties":'), properties, F.lit("}"),
    ).alias("value"))


def export_geojson(df: DataFrame, bbox, types: Iterable[str], out: str) -> None:
    """Write the features of ``types`` that meet ``bbox``, one feature per line.

    Each type gets its own folder; a type without features gets none.
    """
    wanted = df.where(F.col("type").isin(*types) & meets_box(bbox))
    geojson_lines(wanted).write.mode("overwrite").partitionBy("type").text(out)


def box_text(box: str = "box") -> Column:
    """``west,south,east,north`` in full precision."""
    return F.concat_ws(",", *(number_text(F.col(f"{box}.{side}")) for side in _SIDES))


def valid_box(box: str = "box") -> Column:
    """Whether all four sides are finite numbers."""
    ok = F.lit(True)
    for side in _SIDES:
        value = F.col(f"{box}.{side}")
        ok = ok & value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.coalesce(ok, F.lit(False))


def export_summary(df: DataFrame, bbox, release: str, now: datetime | None = None,
                   view_url: str | None = None) -> DataFrame:
    """One row about the extract of ``bbox``: box, release, sorted layers, counts and view.

    ``view_url`` is where the map shows the same view; null if it is empty or not given.
    """
    box = Box.of(bbox)
    if not isinstance(release, str) or not release:
        raise ValueError("release must be a non-empty text")
    made = F.lit(now) if now is not None else F.current_timestamp()
    return (
        df.where(meets_box(box))
        .groupBy("type").agg(F.count("*").alias("n"))
        # At most one row per type from here on.
        .agg(
            F.array_join(F.sort_array(F.collect_list("type")), ",").alias("layers"),
            F.count("*").alias("layer_count"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("features"),
        )
        .select(
            F.concat_ws(",", *(number_text(F.lit(side)) for side in box)).alias("bbox_text"),
            *(F.lit(side).alias(name) for name, side in box._asdict().items()),
            F.lit(release).alias("release"), "layers", "layer_count", "features",
            made.alias("generated_at"), F.lit(view_url or None).cast("string").alias("view_url"))
    )


def export_summaries(extract: DataFrame, release: str, now: datetime | None = None) -> DataFrame:
    """The same for many exports at once: one row per ``view_id`` of a view extract."""
    made = F.lit(now) if now is not None else F.current_timestamp()
    return (
        extract.where(valid_box())
        .groupBy("view_id", "box", "type").agg(F.count("*").alias("n"))
        .groupBy("view_id", "box").agg(
            F.array_join(F.sort_array(F.collect_list("type")), ",").alias("layers"),
            F.count("*").alias("layer_count"), F.sum("n").alias("features"))
        .withColumns({
            "bbox_text": box_text(), "release": F.lit(release), "generated_at": made})
    )


def bbox_label(df: DataFrame, release: str, prefix: str = "features", box: str = "box",
               type: str = "type") -> DataFrame:
    """Add the box at three decimals and the file and archive names made from it."""
    label = F.concat_ws(",", *(fixed3(F.col(f"{box}.{side}")) for side in _SIDES))
    return df.withColumn("label", label).withColumns({
        "file_name": F.concat(
            F.concat_ws("-", F.lit(prefix), F.lit(release), F.col(type), "label"), F.lit(".geojson")),
        "archive_name": F.concat(
            F.concat_ws("-", F.lit(prefix), F.lit(release), "label"), F.lit(".zip")),
    })
