"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters or digits, lower-cased. Fixed masks lie on eight or nine
neighbouring tokens and hash six of them, so a changed token under a gap of the mask does
not matter. Texts and benchmark items meet on equal hashes; each meeting gives a diagonal,
the distance between the two places. Along it the whole text is compared with the whole
item: an overlap is a run of ``WINDOW`` aligned tokens of which at least ``MATCHES`` are
equal. Every such run contains a hit of one of the masks, so none is lost.

Only built-in functions are used. Equal texts are compared once. Null texts and texts
with fewer than ``WINDOW`` tokens overlap nothing, and shorter items are no evidence, but
that ``keep_clean`` also matches items of ``least`` tokens and more, exactly and whole.
Rows without ``doc_id`` are judged by ``keep_clean`` but do not appear in ``overlaps``.
Repeated rows and items, null items and extra columns do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapsheaf.llm.common import materialize, without

# Together the masks hit every window of 13 tokens with up to 2 changed.
MASKS = ("11101011", "110100111")
WINDOW = 13
MATCHES = 11
TOKEN = r"[\p{L}\p{N}]+"
# Seeds of the items are broadcast up to this many; each is a few dozen bytes.
BROADCAST_SEEDS = 1_000_000
BROADCAST_TOKENS = 2_000_000
# Hits too, some sixty bytes each: then texts without one are not shuffled.
BROADCAST_HITS = 500_000


def token_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))


def _seeds(hashes: Column) -> Column:
    """Mask, position from 0 and hash of each place."""
    def of(mask: str, number: int) -> Column:
        read = [n for n, bit in enumerate(mask) if bit == "1"]
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - len(mask)),
            lambda i: F.xxhash64(F.lit(number), *(F.get(hashes, i + n) for n in read)))

    longest = max(map(len, MASKS))
    return F.when(F.size(hashes) >= max(longest, WINDOW), F.array(*(of(m, n) for n, m in enumerate(MASKS))))


def _exploded(frame: DataFrame, keep: list[str], position: str) -> DataFrame:
    by_mask = frame.select(*keep, F.explode(_seeds(F.col("hashes"))).alias("places"))
    return by_mask.select(*keep, F.posexplode("places").alias(position, "seed"))


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``key, item_id, matched, aligned, doc_start``: overlaps of texts, by the text's key."""
    items = items.select(
        F.col("item_id").cast("long").alias("item_id"),
        token_hashes(F.col("text").cast("string")).alias("item")).where(f"size(item) >= {WINDOW}")
    items = materialize(items.distinct(), "items")
    seeds = materialize(
        _exploded(items.select("item_id", F.col("item").alias("hashes"), F.size("item").alias("length")),
                  ["item_id", "length"], "at"), "seeds")
    text = F.col("text").cast("string")
    texts = docs.where("text is not null").select(_text_key(text).alias("key"), text.alias("text"))
    places = _exploded(texts.select("key", token_hashes(F.col("text")).alias("hashes")), ["key"], "position")
    small = seeds.count() <= BROADCAST_SEEDS
    hits = places.join(F.broadcast(seeds) if small else seeds, "seed").select(
        "key", "item_id", "length", (F.col("position") - F.col("at")).alias("diagonal")).distinct()
    hits = materialize(hits, "hits")
    by_text = hits.groupBy("key").agg(
        F.collect_list(F.struct("item_id", "length", "diagonal")).alias("hits"))
    if hits.count() <= BROADCAST_HITS:
        by_text = F.broadcast(by_text)
    aligned = (
        texts.join(by_text, "key").select("key", "hits", token_hashes(F.col("text")).alias("hashes"))
        .select("key", "hashes", F.explode("hits").alias("hit"))
        .select("key", "hit.item_id", "hit.diagonal", F.slice(
            "hashes", F.greatest(F.col("hit.diagonal"), F.lit(0)) + 1,
            F.col("hit.length") + F.least(F.col("hit.diagonal"), F.lit(0))).alias("part")))
    # Slots of the item before the text's first token are cut off on both sides.
    total = items.agg(F.sum(F.size("item"))).first()[0] or 0
    compared = aligned.join(F.broadcast(items) if total <= BROADCAST_TOKENS else items, "item_id").select(
        "key", "item_id", F.greatest(F.col("diagonal"), F.lit(0)).alias("doc_start"),
        F.zip_with("part", F.slice("item", F.greatest(-F.col("diagonal"), F.lit(0)) + 1, F.size("part")),
                   lambda a, b: (a == b).cast("int")).alias("equal"))
    equal = F.col("equal")
    overlap = F.when(F.size(equal) >= WINDOW, F.exists(
        F.sequence(F.lit(1), F.size(equal) - WINDOW + 1),
        lambda i: F.aggregate(F.slice(equal, i, F.lit(WINDOW)), F.lit(0), lambda a, x: a + x) >= MATCHES))
    return (
        compared.where(overlap)
        .select("key", "item_id", "doc_start", F.size(equal).alias("aligned"),
                F.aggregate(equal, F.lit(0), lambda a, x: a + x).alias("matched")))


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, matched, aligned, doc_start``: the best overlap of each two.

    ``matched`` tokens of the ``aligned`` ones are equal; the alignment starts at the
    text's token ``doc_start``. Most matches first, then the earliest place.
    """
    found = materialize(_matches(docs, items), "overlaps")
    best = found.groupBy("key", "item_id").agg(F.max(F.struct(
        "matched", "aligned", (-F.col("doc_start")).alias("from"))).alias("best"))
    ids = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), _text_key(F.col("text").cast("string")).alias("key")).distinct()
    return ids.join(best, "key").groupBy("doc_id", "item_id").agg(F.max("best").alias("best")).select(
        "doc_id", "item_id", F.col("best.matched").cast("long").alias("matched"),
        F.col("best.aligned").cast("long").alias("aligned"), (-F.col("best.from")).cast("long").alias("doc_start"))


def _whole(docs: DataFrame, items: DataFrame, least: int) -> DataFrame | None:
    """``key`` of texts that hold an item of ``least`` to ``WINDOW`` - 1 tokens word for word."""
    short = materialize(
        items.select(token_hashes(F.col("text").cast("string")).alias("part"))
        .where(f"size(part) >= {least} and size(part) < {WINDOW}").distinct(), "short")
    lengths = sorted(r[0] for r in short.select(F.size("part")).distinct().collect())
    if not lengths:
        return None
    text, hashes = F.col("text").cast("string"), F.col("hashes")

    def parts(n: int) -> Column:
        return F.when(F.size(hashes) >= n, F.transform(
            F.sequence(F.lit(1), F.size(hashes) - n + 1), lambda i: F.slice(hashes, i, F.lit(n)))).otherwise(
            F.array().cast("array<array<bigint>>"))

    found = docs.where("text is not null").select(_text_key(text).alias("key"), token_hashes(text).alias("hashes")).select(
        "key", F.explode(F.concat(*map(parts, lengths))).alias("part"))
    return found.join(F.broadcast(short) if short.count() <= BROADCAST_SEEDS else short, "part", "left_semi").select("key")


def keep_clean(docs: DataFrame, items: DataFrame, least: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text overlaps no item."""
    keys = _matches(docs, items).select("key")
    whole = _whole(docs, items, least)
    keys = materialize((keys if whole is None else keys.union(whole)).distinct(), "overlapping")
    own = F.coalesce(_text_key(F.col("text").cast("string")), F.lit(b""))
    return without(docs, own, keys, "key")
