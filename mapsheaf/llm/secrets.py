"""Secret scans: fixed patterns, and Markov models of characters.

Three patterns give the base spans. Further tokens are taken as secrets when a Markov
chain trained on random strings explains their characters better than one trained on
ordinary identifiers: the sum of log-likelihood ratios of neighbouring characters must
reach ``LOG_ODDS``. Both chains are learned from labelled samples. Tokens have 12 characters
or more; those of digits only are scored from ``NUMBER`` characters on.

All of it is built-in functions: matches come from extracting, their places from the
lengths of what splitting leaves between them. A null text is an empty one. Places count
code points, ends exclusive. Null ids, repeated rows and extra columns do no harm. With
nothing to learn from, both chains are uniform and add no span.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of the base kinds, in the order of the kinds; the group that is
# the value, and the least length of the value or match.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8)
ACCESS = (r"AKIA[A-Z0-9]{12,}", 0, 16)
HEX = (r"[0-9a-f]{32,}", 0, 32)
TOKEN = (r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}", 0, 12)
# Plain numbers of fewer characters are not scored: order, card and telephone numbers look random.
NUMBER = 20
IDENTIFIER = r"(?<![A-Za-z0-9_])[A-Za-z_][A-Za-z0-9_]{7,}"
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_.=-"

LOG_ODDS = 12.0
SMOOTHING = 0.5
SAMPLE_DOCS = 20_000


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _prefix_sums(steps: Column) -> Column:
    """The sum of all steps before each one; blocks keep long arrays from quadratic time.

    Steps and block sums are bound: an expression named in a lambda would be evaluated
    anew for each element.
    """
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def sums(steps: Column) -> Column:
        size = F.size(steps)
        block = F.ceil(F.sqrt(size)).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((size - 1) / block).cast("int")),
            lambda b: total(F.slice(steps, b * block + 1, block)))
        return _bound(blocks, lambda blocks: F.transform(
            F.sequence(F.lit(0), size - 1),
            lambda i: total(F.slice(blocks, F.lit(1), F.floor(i / block).cast("int")))
            + total(F.slice(steps, F.floor(i / block).cast("int") * block + 1, i % block))))

    return _bound(steps, sums)


def _found(text: Column, kind: tuple[str, int, int], number: int) -> Column:
    """Spans of one pattern: ``start, kind, end, value``; leftmost first, not overlapping."""
    pattern, group, least = kind
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(gaps, matches, lambda gap, match: F.length(gap) + F.length(match))
    size = F.size(matches)
    spans = F.transform(
        F.arrays_zip(
            _prefix_sums(F.slice(steps, F.lit(1), size)).alias("before"), F.slice(gaps, F.lit(1), size).alias("gap"),
            matches.alias("match"), values.alias("value")),
        lambda m: F.struct(
            (m["before"] + F.length(m["gap"])).alias("start"), F.lit(number).alias("kind"),
            (m["before"] + F.length(m["gap"]) + F.length(m["match"])).alias("end"), m["value"].alias("value")))
    kept = F.filter(spans, lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(pattern), kept).otherwise(
        F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))


def sample_values(docs: DataFrame) -> DataFrame:
    """``value, random``: distinct secrets and identifiers of about ``SAMPLE_DOCS`` documents.

    The sample is the fit's documented bound; documents are drawn by a hash of their id.
    What a base pattern finds is labelled random, words outside are labelled ordinary.
    """
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("secrets")), F.lit(1 << 20))
    text = F.col("text").cast("string")
    few = docs.where(drawn < share * (1 << 20)).select(F.coalesce(text, F.lit("")).alias("text"))
    secrets = [F.filter(F.regexp_extract_all("text", F.lit(pattern), F.lit(group)),
                        lambda v, least=least: F.length(v) >= least) for pattern, group, least in (ASSIGN, ACCESS, HEX)]
    rest = F.regexp_replace(F.regexp_replace("text", ASSIGN[0], " "), f"{ACCESS[0]}|{HEX[0]}", " ")
    rows = few.select(F.array_distinct(F.concat(*secrets)).alias("random"),
                      F.array_distinct(F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))).alias("plain"))
    labelled = F.concat(
        F.transform("random", lambda v: F.struct(v.alias("value"), F.lit(True).alias("random"))),
        F.transform("plain", lambda v: F.struct(v.alias("value"), F.lit(False).alias("random"))))
    return rows.select(F.explode(labelled).alias("s")).select("s.value", "s.random").distinct()


def _code(character: Column) -> Column:
    """Number of a character in the alphabet; 0 for all others."""
    return F.instr(F.lit(ALPHABET), character)


def _codes(value: Column) -> Column:
    return F.transform(F.split(value, ""), _code)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio, random over ordinary, of each two neighbouring characters.

    Entry ``a * n + b`` is for character ``b`` after ``a``; the driver gets at most two
    rows for each such pair, whatever the sample.
    """
    size = len(ALPHABET) + 1
    codes = samples.select("random", _codes(F.col("value")).alias("codes"))
    pairs = codes.select("random", F.explode(F.zip_with(
        F.slice("codes", F.lit(1), F.size("codes") - 1), F.slice("codes", F.lit(2), F.size("codes")),
        lambda a, b: a * size + b)).alias("pair"))
    counts = {(r.random, r.pair): r["count"] for r in pairs.groupBy("random", "pair").count().collect()}
    ratios = []
    for a in range(size):
        totals = {label: sum(counts.get((label, a * size + b), 0) for b in range(size)) for label in (True, False)}
        for b in range(size):
            likely = {label: (counts.get((label, a * size + b), 0) + SMOOTHING) / (totals[label] + SMOOTHING * size)
                      for label in (True, False)}
            ratios.append(math.log(likely[True] / likely[False]))
    return ratios


def log_odds(value: Column, ratios: list[float]) -> Column:
    """The sum of the ratios of a value's neighbouring characters."""
    size = len(ALPHABET) + 1
    model = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded to one literal
    codes = _codes(value)
    steps = F.zip_with(
        F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes)),
        lambda a, b: F.get(model, a * size + b))
    return F.aggregate(steps, F.lit(0.0), lambda total, x: total + x)


def with_spans(docs: DataFrame, ratios: list[float], prefix: str = "__") -> DataFrame:
    """``docs`` with ``<prefix>base`` and ``<prefix>spans``: arrays of start, kind and end, sorted."""
    text, base, spans = f"{prefix}text", f"{prefix}base", f"{prefix}spans"
    found = docs.withColumn(text, F.coalesce(F.col("text").cast("string"), F.lit("")))
    for n, kind in enumerate((ASSIGN, ACCESS, HEX, TOKEN)):
        found = found.withColumn(f"{prefix}{n}", _found(F.col(text), kind, n))
    found = found.withColumn(base, F.array_sort(F.concat(*(_plain(F.col(f"{prefix}{n}")) for n in range(3)))))
    random = F.filter(f"{prefix}3", lambda s: (
        (F.length(s["value"]) >= NUMBER) | s["value"].rlike("[^0-9]")) & ~F.exists(
        base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])) & (log_odds(s["value"], ratios) >= LOG_ODDS))
    found = found.withColumn(spans, F.array_sort(F.concat(F.col(base), _plain(random))))
    return found.drop(text, *(f"{prefix}{n}" for n in range(4)))


def written(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` for every row."""
    ratios = train(sample_values(docs))
    found = with_spans(docs.select("doc_id", "text"), ratios)

    def number(spans: str, kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(number("__base", n).alias(f"n_{KINDS[n]}") for n in range(3)),
        number("__spans", 3).alias("n_random"),
        F.sha2(written(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
        written(F.col("__spans")).alias("spans"))


def keep_clean(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text holds no secret."""
    found = with_spans(docs, train(sample_values(docs)), "__secret_")
    # The number comes out of a generator: a filter is not moved below that, where Spark would put
    # the expressions of all spans in its place, to be worked out anew wherever they are named.
    counted = found.select(*(F.col(f"`{c}`") for c in docs.columns), F.explode(F.array(F.size("__secret_spans"))).alias("__secret_n"))
    return counted.where("__secret_n = 0").select(docs.columns)
