"""Audit of observed data against tile and schema specs.

Observations are distinct types, fields, values and zooms, counted per task
before they are shuffled; specs are small tables with one row per entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KINDS = ("subtypes", "classes", "road_classes", "rail_classes")
ISSUE_COLUMNS = ("severity", "check", "theme", "type", "subject", "features")


# What the audits look at besides the fields.
_OBSERVED = ("theme", "type", "subtype", "class", "min_zoom", "declared_theme", "declared_type")


def observations(df: DataFrame, fields: tuple[str, ...] = ()) -> DataFrame:
    """Features counted once by all that audits look at, and how many carry each field.

    As many rows as there are such combinations; every ``observed_`` function and
    ``audit_metadata`` takes them in place of the features, so one pass serves all.
    """
    keys = [c for c in _OBSERVED if c in df.columns]
    return df.groupBy(*keys).agg(
        F.count("*").alias("features"), *(F.count(F.col(f"`{name}`")).alias(f"n:{name}") for name in fields))


def _counted(df: DataFrame):
    return (F.sum("features") if "features" in df.columns else F.count("*")).alias("features")


def observed_types(df: DataFrame) -> DataFrame:
    return df.groupBy("theme", "type").agg(_counted(df))


def observed_fields(summary: DataFrame) -> DataFrame:
    """Fields that occur in each theme and type, out of ``observations``."""
    fields = [c.removeprefix("n:") for c in summary.columns if c.startswith("n:")]
    sums = summary.groupBy("theme", "type").agg(
        *(F.sum(F.col(f"`n:{name}`")).alias(f"n{i}") for i, name in enumerate(fields)))
    rows = F.array(*(
        F.struct(F.lit(name).alias("field"), F.col(f"n{i}").alias("features")) for i, name in enumerate(fields)))
    return sums.select("theme", "type", F.inline(rows)).where(F.col("features") > 0)


def observed_values(df: DataFrame, columns: tuple[str, ...] = ("subtype", "class")) -> DataFrame:
    """Values of the enumerated attributes per type, with their number of features."""
    values = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns))
    kept = [c for c in df.columns if c == "features"]
    return (
        df.select("theme", "type", *kept, F.inline(values)).where(F.col("value").isNotNull())
        .groupBy("theme", "type", "field", "value").agg(_counted(df))
    )


def observed_zooms(df: DataFrame) -> DataFrame:
    return df.where(F.col("min_zoom").isNotNull()).groupBy("theme", "type", "min_zoom").agg(_counted(df))


def _issues(df: DataFrame, severity: str, check: str, subject) -> DataFrame:
    return df.select(
        F.lit(severity).alias("severity"), F.lit(check).alias("check"), "theme", "type",
        subject.cast("string").alias("subject"), "features")


def _layers(tilespec: DataFrame) -> DataFrame:
    return tilespec.select("theme", F.col("layer").alias("type")).distinct()


def audit_missing_layers(observed: DataFrame, tilespec: DataFrame) -> DataFrame:
    """Types that have no layer in the tile spec."""
    missing = observed.join(_layers(tilespec), ["theme", "type"], "left_anti")
    return _issues(missing, "error", "tile-layer", F.col("type"))


def audit_missing_fields(observed_fields: DataFrame, tilespec: DataFrame, allowed: DataFrame | None = None,
                         skip_helpers: bool = False) -> DataFrame:
    """Fields that their layer does not list; types without a layer are another check's.

    ``$`` names and the geometry type are never fields; ``skip_helpers`` also passes
    ``@`` names, and ``allowed`` lists (theme, type, field) known to be missing.
    """
    fields = observed_fields.where(
        ~F.col("field").startswith("$") & ~F.col("field").isin("geometry-type", "geom_type"))
    if skip_helpers:
        fields = fields.where(~F.col("field").startswith("@"))
    listed = tilespec.select("theme", F.col("layer").alias("type"), "field").distinct()
    missing = (
        fields.join(_layers(tilespec), ["theme", "type"], "left_semi")
        .join(listed, ["theme", "type", "field"], "left_anti")
    )
    if allowed is not None:
        missing = missing.join(allowed, ["theme", "type", "field"], "left_anti")
    return _issues(missing, "error", "tile-field", F.col("field"))


def enum_values(enums: DataFrame) -> DataFrame:
    """All values a type may take, over subtypes, classes, road and rail classes."""
    return enums.where(F.col("kind").isin(*_KINDS)).select("theme", "type", "value").distinct()


def audit_bad_values(observed_values: DataFrame, enums: DataFrame) -> DataFrame:
    """Subtypes and classes outside the enums, for types that have enums.

    A value is named once per type, whichever of the attributes it came from.
    """
    allowed = enum_values(enums)
    bad = (
        observed_values.groupBy("theme", "type", "value").agg(F.sum("features").alias("features"))
        .join(allowed.select("theme", "type").distinct(), ["theme", "type"], "left_semi")
        .join(allowed, ["theme", "type", "value"], "left_anti")
    )
    return _issues(bad, "warn", "schema-value", F.col("value"))


def audit_zoom_range(zooms: DataFrame, tilespec: DataFrame) -> DataFrame:
    """First zooms below that of their layer."""
    layers = tilespec.groupBy("theme", F.col("layer").alias("type")).agg(
        F.min("minzoom").alias("layer_minzoom"))
    low = zooms.join(layers, ["theme", "type"]).where(F.col("min_zoom") < F.col("layer_minzoom"))
    return _issues(low, "warn", "zoom-range", F.col("min_zoom"))


def audit_metadata(df: DataFrame) -> DataFrame:
    """Declared themes and types that differ from the ones the rows sit in.

    ``df`` has ``declared_theme`` and ``declared_type`` beside ``theme`` and ``type``.
    """
    found = F.array(
        F.struct(F.lit("theme").alias("part"), F.col("declared_theme").alias("declared"),
                 F.col("theme").alias("placed")),
        F.struct(F.lit("type").alias("part"), F.col("declared_type").alias("declared"),
                 F.col("type").alias("placed")),
    )
    kept = [c for c in df.columns if c == "features"]
    wrong = (
        df.select("theme", "type", *kept, F.inline(found))
        .where((F.col("declared") != "") & (F.col("declared") != F.col("placed")))
        .groupBy("theme", "type", "part", "declared").agg(_counted(df))
    )
    return _issues(wrong, "warn", "metadata", F.concat_ws(":", "part", "declared"))


def audit_counts(issues: DataFrame) -> DataFrame:
    """Issues by severity and check, with totals."""
    return issues.rollup("severity", "check").agg(F.count("*").alias("issues"))


def used_values(references: DataFrame) -> DataFrame:
    """Subtypes and classes that some rule names, by theme and type; see ``rule_references``."""
    named = references.where(F.col("attribute").isin("subtype", "class") & F.col("value").isNotNull())
    return named.select("theme", "type", "value").distinct()


def _marked(values: DataFrame, used: DataFrame) -> DataFrame:
    taken = used.select("theme", "type", "value").distinct().withColumn("styled", F.lit(True))
    return values.join(taken, ["theme", "type", "value"], "left").withColumn(
        "styled", F.coalesce("styled", F.lit(False)))


def styled_values(enums: DataFrame, used: DataFrame) -> DataFrame:
    """Every enum value of a type and whether a rule names it."""
    return _marked(enum_values(enums), used)


def _percent(styled, total):
    # Positive numbers, so adding a half and cutting off rounds halves up.
    return F.floor(styled * 100 / total + 0.5)


def style_coverage(enums: DataFrame, used: DataFrame) -> DataFrame:
    """Per type and kind: how many enum values are used, and which.

    The lists hold at most the enum's own values.
    """
    styled, value = F.col("styled"), F.col("value")
    return (
        _marked(enums, used).groupBy("theme", "type", "kind")
        .agg(
            F.count("*").alias("total"),
            F.count_if(styled).alias("styled"),
            F.array_join(F.sort_array(F.collect_list(F.when(styled, value))), ",").alias("styled_values"),
            F.array_join(F.sort_array(F.collect_list(F.when(~styled, value))), ",").alias("unstyled_values"),
        )
        .withColumn("percent", _percent(F.col("styled"), F.col("total")))
    )


def style_coverage_total(enums: DataFrame, used: DataFrame) -> DataFrame:
    """Overall share of used enum values; 0 percent when there are none."""
    return (
        _marked(enums, used)
        .agg(F.count("*").alias("total"), F.count_if("styled").alias("styled"))
        .withColumn("percent", F.when(F.col("total") > 0, _percent(F.col("styled"), F.col("total"))).otherwise(0))
    )
