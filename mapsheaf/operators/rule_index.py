"""Classification through an index of the rules by type and attribute values.

What a rule asks of single values (a class among some, no subtype, an area) is settled when the
index is made: for each type and each combination of the values its rules name, the index lists
the rules that such a feature meets. A feature finds its list by one hash lookup; only what is
left of a rule (thresholds by zoom, lengths, parts of texts) is tested on it, and only for the
rules on its list. Values that no rule of the type names count as one, missing ones as another.

The index follows from the rules alone, some hundred rows whatever the features are, so it is
broadcast.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapsheaf.functions import predicates as p
from mapsheaf.operators.classify import rule_attributes
from mapsheaf.plans.rules import RULES, Rule, Test, rule_table

_SEPARATOR, _OTHER, _MISSING = "\x1f", "\x01", "\x02"
_HITS = "array<struct<draw_order:int,item:string,minzoom:int,maxzoom:int,residual:int>>"


def _atoms(rule: Rule) -> tuple[Test, ...]:
    return (rule.test.parts or (rule.test,)) if rule.test else ()


def _residual(rule: Rule) -> tuple[Test, ...]:
    """The tests of a rule that values alone do not settle."""
    return tuple(atom for atom in _atoms(rule) if not atom.fact)


def _settled(rule: Rule, values: dict[str, object]) -> bool:
    """Whether a feature of these values meets all a rule asks of values."""
    for attribute, operator, named in (atom.fact for atom in _atoms(rule) if atom.fact):
        value = values[attribute]
        met = {
            "is": value in named, "in": value in named, "not in": value not in named,
            "present": value is not _MISSING, "absent": value is _MISSING,
        }
        if not met[operator]:
            return False
    return True


def _text(value) -> str:
    """A named value as Spark casts it to text."""
    return str(value).lower() if isinstance(value, bool) else str(value)


class RuleIndex:
    """The rules of a mode that can be open at ``zoom``, by type and attribute values."""

    def __init__(self, zoom, mode: str = "explore") -> None:
        self.zoom = zoom
        self.rules: dict[str, list[Rule]] = {}
        for rule in RULES[mode]:
            if rule.type and rule.open_at(zoom):
                self.rules.setdefault(rule.type, []).append(rule)
        self.named: dict[str, dict[str, tuple]] = {}
        self.residuals: list[tuple[Test, ...]] = []
        for type_, rules in self.rules.items():
            named: dict[str, dict] = {}
            for rule in rules:
                for attribute, _, values in (atom.fact for atom in _atoms(rule) if atom.fact):
                    named.setdefault(attribute, {}).update(dict.fromkeys(values))
                if (left := _residual(rule)) and left not in self.residuals:
                    self.residuals.append(left)
            self.named[type_] = {attribute: tuple(values) for attribute, values in named.items()}
        self.attributes = sorted({attribute for named in self.named.values() for attribute in named})

    def _entry(self, rule: Rule) -> tuple:
        left = _residual(rule)
        return (rule.draw_order, rule.item, rule.minzoom, rule.maxzoom,
                self.residuals.index(left) if left else None)

    def table(self, spark: SparkSession) -> DataFrame:
        """``@rule_key, @candidates``: the rules that a feature of each key meets, bottom to top."""
        rows = []
        for type_, rules in self.rules.items():
            named = self.named[type_]
            for values in product(*((*v, _OTHER, _MISSING) for v in named.values())):
                met = [self._entry(rule) for rule in rules if _settled(rule, dict(zip(named, values, strict=True)))]
                if met:
                    texts = dict(zip(named, map(_text, values), strict=True))
                    rows.append((_SEPARATOR.join([type_, *(texts.get(a, "") for a in self.attributes)]), met))
        return spark.createDataFrame(rows, f"`@rule_key` string, `@candidates` {_HITS}")

    def _part(self, attribute: str, value: Column) -> Column:
        """What the key holds of one attribute: nothing for types whose rules do not ask for it."""
        type_, value = F.col("type"), value.cast("string")
        asking = {t: named[attribute] for t, named in self.named.items() if attribute in named}
        known = [t + _SEPARATOR + _text(v) for t, values in asking.items() for v in values]
        part = F.when(~type_.isin(*asking), "").when(value.isNull(), _MISSING)
        if known:
            part = part.when(F.concat(type_, F.lit(_SEPARATOR), value).isin(*known), value)
        return part.otherwise(_OTHER)

    def key(self, attributes) -> Column:
        """The key of a feature; null for types without open rules."""
        parts = [self._part(attribute, attributes(attribute)) for attribute in self.attributes]
        return F.when(F.col("type").isin(*self.rules), F.concat_ws(_SEPARATOR, F.col("type"), *parts))

    def open(self, entry: Column) -> Column:
        """Whether the window of a listed rule is open; numeric zooms are settled in the index."""
        if not isinstance(self.zoom, Column):
            return F.lit(True)
        return p.in_zoom_window(self.zoom, entry["minzoom"], entry["maxzoom"])

    def holds(self, entry: Column, attributes) -> Column:
        """Whether what is left of a listed rule holds. Only its own tests are evaluated."""
        met = F.when(entry["residual"].isNull(), True)
        for number, tests in enumerate(self.residuals):
            met = met.when(entry["residual"] == number, reduce(
                lambda a, b: a & b, [test(attributes, self.zoom) for test in tests]))
        return self.open(entry) & met

    def candidates(self, features: DataFrame) -> DataFrame:
        """Features with their lists; those that meet no rule are left out."""
        return features.withColumn("@rule_key", self.key(rule_attributes(features))).join(
            F.broadcast(self.table(features.sparkSession)), "@rule_key")


def classify_indexed(features: DataFrame, zoom, mode: str = "explore") -> DataFrame:
    """The rows of ``classify_features``, through the index of the rules."""
    index = RuleIndex(zoom, mode)
    attributes = rule_attributes(features)
    # The hits are a column of their own, so that they are found once.
    found = index.candidates(features).withColumn(
        "@hits", F.filter("@candidates", lambda entry: index.holds(entry, attributes)))
    hits = F.transform("@hits", lambda hit, n: F.struct(
        hit["draw_order"].alias("draw_order"),
        (~F.exists(F.slice("@hits", 1, n), lambda other: other["item"].eqNullSafe(hit["item"]))).alias("first_of_item")))
    rules = rule_table(features.sparkSession, mode).drop("mode")
    return (
        found.select(*(F.col(f"`{name}`") for name in features.columns), F.inline(hits))
        .join(F.broadcast(rules), "draw_order")
    )


def rule_index_counts(features: DataFrame, zoom, mode: str = "explore") -> DataFrame:
    """Per type: features, tests without the index, rules that the lists hold, and tests left on them.

    Types without open rules are left out.
    """
    index = RuleIndex(zoom, mode)
    attributes = rule_attributes(features)
    numbers = F.create_map(*(part for type_, rules in index.rules.items() for part in (F.lit(type_), F.lit(len(rules)))))
    keyed = features.select("type", index.key(attributes).alias("@rule_key")).where(F.col("@rule_key").isNotNull())
    # Features are counted by key first; then a few rows meet the index.
    return (
        keyed.groupBy("type", "@rule_key").agg(F.count("*").alias("n"))
        .join(F.broadcast(index.table(features.sparkSession)), "@rule_key", "left")
        .groupBy("type")
        .agg(
            F.sum("n").alias("features"),
            F.sum(F.col("n") * numbers[F.col("type")]).alias("tests_without_index"),
            F.sum(F.col("n") * F.coalesce(F.size("@candidates"), F.lit(0))).alias("rules_met"),
            F.sum(F.col("n") * F.coalesce(F.size(F.filter(
                "@candidates", lambda entry: entry["residual"].isNotNull())), F.lit(0))).alias("tests_left"),
        )
    )
