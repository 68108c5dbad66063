"""SimHash near-duplicates, found by a pigeonring filter.

Of two 64-bit fingerprints at most ``max_bits`` apart, cut into ``max_bits + 1``
segments on a ring, some chain of consecutive segments keeps within its share of the
distance at every length: its first ``l`` segments differ in at most
``l * max_bits / segments`` bits. So the first segment is equal and the first two differ
in one bit at most. That pair of segments is the join key; longer chains and then the
whole distance are checked on the pairs that meet.

Nulls and texts without a word have fingerprint zero and link like any other; rows
without ``doc_id`` get a fingerprint, and a component if their class has an id. Repeated
rows and equal texts are one class. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapsheaf.llm.common import components, give_back, keep_only, materialize, without

BITS = 64


def text_fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[n:] for n in range(shingle)), strict=False))
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, max(1, len(hashes) >> 15)):
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """The columns of ``docs`` but ``text``, and the ``fingerprint`` (a long) of every whole text."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for part in parts:
            prints = [text_fingerprint(text.as_py(), shingle) for text in part.column(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(prints, pa.int64())], [*part.schema.names[:-1], "fingerprint"])
        give_back()

    rest = [c for c in docs.columns if c != "text"]
    schema = docs.select(*rest, F.lit(0).cast("long").alias("fingerprint")).schema
    return docs.select(*rest, F.col("text").cast("string")).mapInArrow(batches, schema)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """Start and width of each segment."""
    count = max_bits + 1
    ends = [BITS * n // count for n in range(count + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _segment(value: Column, start: int, width: int) -> Column:
    shifted = F.shiftrightunsigned(value, start)
    return shifted if width == BITS else shifted.bitwiseAND(F.lit((1 << width) - 1))


def links(classes: DataFrame, max_bits: int) -> DataFrame:
    """``low, high``: the ``doc_id`` of every two of ``classes`` that are near.

    ``classes`` holds distinct fingerprints, each with its smallest id. One side goes to
    each segment once, the other also with one bit of the next segment turned.
    """
    parts = _segments(max_bits)

    def key(n: int, value: Column, turned: int | None = None) -> Column:
        (a, wide), (b, next_wide) = parts[n], parts[(n + 1) % len(parts)]
        following = _segment(value, b, next_wide)
        if turned is not None:
            following = following.bitwiseXOR(F.lit(1 << turned))
        return F.struct(
            F.lit(n).cast("byte").alias("n"),
            F.shiftleft(_segment(value, a, wide), next_wide).bitwiseOR(following).alias("at"))

    value = F.col("fingerprint")
    stored = classes.select(
        F.explode(F.array(*(key(n, value) for n in range(len(parts))))).alias("key"),
        value.alias("there"), F.col("doc_id").alias("low"))
    asked = classes.select(
        F.explode(F.array(*(
            key(n, value, turned) for n in range(len(parts))
            for turned in (None, *range(parts[(n + 1) % len(parts)][1]))))).alias("key"),
        value.alias("here"), F.col("doc_id").alias("high"))
    stored = stored.select("key.n", "key.at", "there", "low")
    asked = asked.select("key.n", "key.at", "here", "high")
    differing = F.col("here").bitwiseXOR(F.col("there"))
    near = F.bit_count(differing) <= max_bits
    for n in range(len(parts)):
        within = F.lit(True)
        for length in range(1, len(parts)):
            chain = [_segment(differing, *parts[(n + k) % len(parts)]) for k in range(length)]
            total = sum((F.bit_count(part) for part in chain[1:]), F.bit_count(chain[0]))
            within &= total <= length * max_bits // len(parts)
        near &= (F.col("n") != n) | within
    return (asked.join(stored, ["n", "at"]).where((F.col("low") < F.col("high")) & near)
            .select("low", "high"))


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """``doc_id, row_key, fingerprint, component_id, keeper`` for each row of ``docs`` (``doc_id, row_key, text``).

    Classes are linked by their fingerprints, so one whose rows all lack an id joins its
    neighbours too. ``keeper`` is the key of the component's first row by id (nulls last) and key.
    """
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row_key")
    classes = materialize(prints.groupBy("fingerprint").agg(F.min(first).alias("first")), "classes")
    if max_bits:
        nodes = classes.select("fingerprint", F.col("fingerprint").alias("doc_id"))
        found = components(links(nodes, max_bits), "low", "high")
        joined = found.join(classes, F.col("node") == F.col("fingerprint")).select("fingerprint", "component", "first")
        least = joined.groupBy("component").agg(F.min("first").alias("least"))
        linked = joined.join(least, "component").select("fingerprint", "least")
        classes = classes.join(linked, "fingerprint", "left").select(
            "fingerprint", F.coalesce("least", "first").alias("first"))
    return prints.join(classes, "fingerprint").select(
        "doc_id", "row_key", "fingerprint", F.col("first.doc_id").alias("component_id"),
        F.col("first.row_key").alias("keeper"))


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id``: the smallest ``doc_id`` reachable by links.

    ``fingerprint`` is 16 hexadecimal digits. One row for each row of ``docs``.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).alias("row_key"), "text")
    return _grouped(narrow, shingle, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each component: the first by id (nulls last), then by the digest of its text.

    Rows are told apart by id and text, so rows that share an id but not a text are judged
    apart; of rows with the same id and text one stays. A null text is an empty one.
    """
    row_key = F.unhex(F.md5(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
        F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("binary")))
    grouped = _grouped(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key.alias("row_key"), "text"), shingle, max_bits)
    counted = grouped.groupBy("row_key", "keeper").agg(F.count("*").alias("rows"))
    gone = F.col("row_key") != F.col("keeper")
    marked = materialize(counted.where(gone | (F.col("rows") > 1)).withColumn("gone", gone), "marked")
    single = without(docs, row_key, marked, "row_key")
    repeated = marked.where("not gone").select(F.col("row_key").alias("__row_key"))
    again = docs.withColumn("__row_key", row_key).join(repeated, "__row_key", "left_semi")
    return single.union(again.dropDuplicates(["__row_key"]).select(docs.columns))
