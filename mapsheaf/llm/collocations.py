"""Phrases whose words stand together more often than chance, for each language.

Pairs of words are counted by the hashes of both words. Every longer run opens a window: a row
of columns for a word and the words after it in its piece, as many as the longest phrase has,
padded at the end of the piece. Only these longest windows are counted, summed within a task
first; ``ROLLUP`` over their columns sums them to all shorter prefixes of three words or more,
which are the counts of all longer phrases at once. Should a frequent word share its hash with
another word, which is looked up in the counts of all words, pairs open windows as well.

A window need not reach further than a phrase can. Passes before the windows count words, pairs, and
runs of ``PRUNED`` words at most by hash, and mark those that reach the least count in
bitmaps of fixed size; a window is padded where its words, or a run of them, are rare.
Bitmaps have no false negatives: two runs in one bit leave a window longer than needed,
nothing else, as its counts are taken by the words themselves. So what is sent to the tasks
is bounded whatever the corpus holds, and no phrase is lost.

A null text is empty, a null language is ``und``. Repeated rows count each time; ids and further
columns are ignored. Words are whole byte strings of any length. No rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapsheaf.llm.common import BROADCAST_KEYS, materialize
from mapsheaf.llm.words import hashes, mix, runs

# Text bytes taken at once; longer texts are cut where a piece ends.
CHUNK = 4 << 20
# Bits of the bitmaps of words and of each length of runs, as a power of two: 2 MB and 8 MB.
WORD_BITS, RUN_BITS = 24, 26
# Runs are marked up to this many words.
PRUNED = 4
# Bytes of windows that a task sums up at once.
SUMMED = 16 << 20
# Word totals of languages are broadcast up to this many values of ``lang``.
LANGUAGES = 100_000
PAD = ""

# What parts words, and what parts pieces.
_BLANK, _STOP = b" \t", b".,;:!?\n\x0b\x0c\r"
_STOPS = re.compile(b"[" + re.escape(_STOP) + b"]")
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANK)] = 1
_KIND[list(_STOP)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


class _Words:
    """Words of some texts: the distinct ones of each language, and which stands where."""

    def __init__(self, parts: list[tuple[str, bytes]]):
        data = _LOWER[np.frombuffer(b"\n".join(text for _, text in parts) + b"\n", np.uint8)]
        kind = _KIND[data]
        starts, held = runs(data, kind == 0)
        held = held.dictionary_encode()
        langs = sorted({lang for lang, _ in parts})
        number = {lang: n for n, lang in enumerate(langs)}
        first = np.cumsum([0, *(len(text) + 1 for _, text in parts[:-1])])
        of_part = np.array([number[lang] for lang, _ in parts])
        lang = of_part[np.searchsorted(first, starts, "right") - 1]
        size = max(1, len(held.dictionary))
        keys, at, counts = np.unique(
            lang * size + held.indices.to_numpy(), return_inverse=True, return_counts=True)
        self.at, self.counts = at, counts
        self.lang = pa.array(langs, pa.string()).take(pa.array(keys // size))
        self.seeds = _seeds(langs)[keys // size]
        self.word = held.dictionary.take(pa.array(keys % size)).cast(pa.string())
        piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        # Whether the next word is in the same piece.
        self.followed = np.append(piece[1:] == piece[:-1], False)[:len(starts)]

    def hashes(self) -> np.ndarray:
        """A hash of language and word at each place."""
        return _word_hashes(self.word, self.seeds)[self.at]

    def runs(self, bitmaps: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of runs of 1, 2, ... words: their hashes, and whether each may be frequent.

        A run may be so if both runs within it, of a word less, may be, and its bit is set. For the
        run after the last bitmap no bit is known yet.
        """
        words = self.hashes()
        hashes, often = words, np.ones(len(words), bool)
        for size, bitmap in enumerate([*bitmaps, None], 1):
            if size > 1:
                hashes = _joined(hashes, _shifted(words, size - 1))
                often = often & _shifted(often, 1) & (self.followed if size == 2 else True)
            if bitmap is not None:
                often = often & _marked(bitmap, hashes)
            yield hashes, often


def _shifted(values: np.ndarray, places: int) -> np.ndarray:
    """The value so many places on; nothing follows the last."""
    return np.append(values[places:], np.zeros(min(places, len(values)), values.dtype))


def _seeds(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(lang) for lang in langs], np.uint64)


def _word_hashes(words: pa.Array, seeds: np.ndarray) -> np.ndarray:
    words = words.cast(pa.binary())
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    return mix(hashes(data, ends[:-1], ends[1:]) ^ seeds)


def _joined(run: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of runs that go on with a word."""
    return mix(run * np.uint64(0x9E3779B97F4A7C15) + word)


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit for each ``hash``; the driver gets at most ``2 ** bits / 64`` numbers."""
    at = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    slots = hashes.groupBy(F.shiftright(at, 6).alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, int(hash & 63)))").alias("bits")).toArrow()
    bitmap = np.zeros((1 << bits) // 64, np.uint64)
    bitmap[slots.column("slot").to_numpy()] = slots.column("bits").to_numpy().view(np.uint64)
    return bitmap


def _each_chunk(docs: DataFrame, run: Callable[[_Words], pa.RecordBatch], schema: str,
                passed: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter) -> DataFrame:
    """``run`` of the words of all texts, some megabytes of them at a time; ``passed`` takes what a task gives."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in parts:
            for lang, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                data = memoryview(text.as_buffer() or b"")
                while len(data):
                    stop = _STOPS.search(data, CHUNK) if len(data) > CHUNK else None
                    end = stop.end() if stop else len(data)
                    held.append((lang, bytes(data[:end])))
                    data, size = data[end:], size + end
                    if size >= CHUNK:
                        yield run(_Words(held))
                        held, size = [], 0
        if held:
            yield run(_Words(held))

    narrow = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return narrow.mapInArrow(lambda parts: passed(batches(parts)), schema)


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with ``n`` summed by their other columns, passed on when sums no longer bring much."""
    held: list[pa.RecordBatch] = []

    def summed() -> list[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        keys = [name for name in table.column_names if name != "n"]
        sums = table.group_by(keys, use_threads=False).aggregate([("n", "sum")])
        return sums.rename_columns({"n_sum": "n"}).select(table.column_names).to_batches()

    for batch in batches:
        held.append(batch)
        if sum(part.nbytes for part in held) >= SUMMED:
            held = summed()
            if sum(part.nbytes for part in held) >= SUMMED // 2:
                yield from held
                held = []
    if held:
        yield from summed()


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, n`` of all words."""
    def count(words: _Words) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([words.lang, words.word, pa.array(words.counts)], ["lang", "word", "n"])

    return _each_chunk(docs, count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def with_hashes(counts: DataFrame) -> DataFrame:
    """``counts`` with the ``hash`` of each language's word."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            hashed = _word_hashes(part.column(1), _seeds(part.column(0).to_pylist()))
            yield part.append_column("hash", pa.array(hashed.view(np.int64)))

    return counts.select("lang", "word", "n").mapInArrow(batches, "lang string, word string, n long, hash long")


def share_hashes(counts: DataFrame, frequent: DataFrame) -> bool:
    """Whether one of the ``frequent`` words has the hash of another one of ``counts``."""
    words, keys = frequent.count(), frequent.select("hash")
    return counts.join(F.broadcast(keys) if words <= BROADCAST_KEYS else keys, "hash").count() != words


def frequent_pairs(docs: DataFrame, bitmaps: Broadcast, least: int) -> DataFrame:
    """``left, right, f, hash`` of pairs that occur ``least`` times: their words' hashes, and the run's own."""
    def count(found: _Words) -> pa.RecordBatch:
        *_, (_, often) = found.runs(bitmaps.value[:1])
        at, size = np.flatnonzero(often), len(found.word)
        pairs, counts = np.unique(found.at[at] * size + found.at[np.minimum(at + 1, len(found.at) - 1)], return_counts=True)
        hashes = _word_hashes(found.word, found.seeds).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes[pairs // max(1, size)]), pa.array(hashes[pairs % max(1, size)]), pa.array(counts)],
            ["left", "right", "n"])

    def run_hashes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            left, right = (part.column(n).to_numpy().view(np.uint64) for n in (0, 1))
            yield part.append_column("hash", pa.array(_joined(left, right).view(np.int64)))

    counted = _each_chunk(docs, count, "left long, right long, n long").groupBy("left", "right").agg(F.sum("n").alias("f"))
    return counted.where(F.col("f") >= least).mapInArrow(run_hashes, "left long, right long, f long, hash long")


def pair_phrases(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, words, f`` of the ``pairs``, whose words are all in ``words``, one of a hash."""
    return pairs.join(words.select("lang", F.col("hash").alias("left"), F.col("word").alias("first")), "left").join(
        words.select(F.col("hash").alias("right"), F.col("word").alias("second")), "right").select(
        "lang", F.array("first", "second").alias("words"), "f")


def frequent_runs(docs: DataFrame, bitmaps: Broadcast, least: int) -> DataFrame:
    """``hash`` of the runs, one word longer than the last bitmap's, that may occur ``least`` times."""
    def count(found: _Words) -> pa.RecordBatch:
        *_, (hashes, often) = found.runs(bitmaps.value)
        runs, counts = np.unique(hashes[often], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64)), pa.array(counts)], ["hash", "n"])

    counted = _each_chunk(docs, count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least).select("hash")


def _columns(longest: int) -> list[str]:
    return [f"w{n}" for n in range(1, longest + 1)]


def windows(docs: DataFrame, bitmaps: Broadcast, longest: int, shortest: int = 2) -> DataFrame:
    """``lang, w1, ..., n``: how often each padded window of ``longest`` words, ``shortest`` of them at least, occurs."""
    names = _columns(longest)

    def count(found: _Words) -> pa.RecordBatch:
        marks = [often for _, often in found.runs(bitmaps.value)][:len(bitmaps.value)]
        size, last = len(found.word) + 1, len(found.at) - 1
        # Shorter runs are counted already.
        opening = np.flatnonzero(marks[shortest - 1])
        # Lead columns: numbers of words, 0 as padding; windows get numbers column by column.
        columns = [found.at[opening] + 1]
        reach, window = np.ones(len(opening), bool), columns[0]
        for lead in range(1, longest):
            run = min(lead + 1, len(marks))  # the longest known run that ends with this word
            reach = reach & marks[run - 1][np.minimum(opening + lead + 1 - run, last)]
            following = np.where(reach, found.at[np.minimum(opening + lead, last)] + 1, 0)
            columns.append(following)
            window = np.unique(window * size + following, return_inverse=True)[1]
        _, first, counts = np.unique(window, return_index=True, return_counts=True)
        padded = pa.concat_arrays([pa.array([PAD]), found.word])
        return pa.RecordBatch.from_arrays(
            [found.lang.take(pa.array(columns[0][first] - 1)),
             *(padded.take(pa.array(column[first])) for column in columns), pa.array(counts)], ["lang", *names, "n"])

    counted = _each_chunk(docs, count, ", ".join(["lang string", *(f"{w} string" for w in names), "n long"]), _summed)
    return counted.groupBy("lang", *names).agg(F.sum("n").alias("n"))


def phrase_counts(counted: DataFrame, longest: int, least: int, shortest: int = 2) -> DataFrame:
    """``lang, words, f`` of all phrases of ``shortest`` words or more that occur ``least`` times.

    The windows are summed to all their prefixes.
    """
    names = _columns(longest)
    rolled = counted.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("summed"))
    # Prefix of k words: the last longest - k columns are summed, and its last word is no padding.
    length = reduce(
        lambda rest, k: F.when((F.col("summed") == (1 << (longest - k)) - 1) & (F.col(f"w{k}") != PAD), k).otherwise(rest),
        range(shortest, longest + 1), F.lit(0))
    return rolled.withColumn("k", length).where((F.col("k") > 0) & (F.col("f") >= least)).select(
        "lang", F.slice(F.array(*names), F.lit(1), F.col("k")).alias("words"), "f")


def _exact(value: str) -> Column:
    return F.col(value).cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases.

    ``score`` is the least of ``floor(1000 * a * n / (l * r))`` over the cuts of a phrase. Dropped
    is a phrase inside a longer one that occurs as often.
    """
    context = docs.sparkSession.sparkContext
    counts = materialize(with_hashes(word_counts(docs)), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = counts.where(F.col("n") >= least)
    bitmaps = [_bitmap(words, WORD_BITS)]
    pairs = materialize(frequent_pairs(docs, context.broadcast(bitmaps), least), "pairs")
    bitmaps.append(_bitmap(pairs, RUN_BITS))
    for _ in range(2, min(PRUNED, longest)):
        bitmaps.append(_bitmap(frequent_runs(docs, context.broadcast(bitmaps), least), RUN_BITS))
    found, shortest = words.select("lang", F.array("word").alias("words"), F.col("n").alias("f")), 2
    if not share_hashes(counts, words):
        found, shortest = found.union(pair_phrases(pairs, words)), 3
    if shortest <= longest:
        found = found.union(phrase_counts(
            windows(docs, context.broadcast(bitmaps), longest, shortest), longest, least, shortest))
    phrases = materialize(found.withColumn("phrase", F.array_join("words", " ")), "phrases")
    candidates = phrases.where(F.size("words") > 1)

    def part(start: Column, size: Column) -> Column:
        return F.array_join(F.slice("words", start, size), " ")

    size = F.size("words")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(
        F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
        part(F.col("k") + 1, size - F.col("k")).alias("rest"))
    known = phrases.select("lang", "phrase", "f")
    scored = (
        cuts.join(known.toDF("lang", "first", "l"), ["lang", "first"])
        .join(known.toDF("lang", "rest", "r"), ["lang", "rest"])
        .join(F.broadcast(totals) if totals.count() <= LANGUAGES else totals, "lang"))
    scored = scored.withColumn("over", _exact("l") * _exact("r")).withColumn(
        "under", (F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(16,0)")).cast("decimal(19,0)") * _exact("n"))
    best = scored.withColumn("score", F.expr("under div over")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")).select("lang", "phrase", "cut.*")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(
        F.sequence(F.lit(1), size - k + 1), lambda start: F.array_join(F.slice("words", start, k), " "))))
    around = candidates.where(size > 2).select("lang", F.col("f").alias("longer"), F.explode(inner).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(around, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
