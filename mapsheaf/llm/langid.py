"""Language identification by the nearest of several centroids per language.

A text is a vector of byte n-gram weights (one to three bytes of lower-cased letters,
hashed to ``DIMENSIONS``): logarithm of the count times inverse document frequency, length
one. The documents of a language in the sample are clustered; a text takes the language
of the centroid with the highest cosine. It is rejected when that cosine is lower than
nearly all (see ``QUANTILE``) that the language's own texts of about its length reach.
Length is the number of distinct n-grams. What own texts reach is measured on sampled
documents, and windows of their words, that the centroids were not made of.

The classifier knows every value of ``lang``. Document frequencies are those of all rows to
learn from. Centroids and floors are fitted language by language, each in a task, on a
bounded sample: up to ``SAMPLE`` documents, taken by a hash of their id. Every whole text
is then classified.

Null texts and texts without a letter get ``und``, score 0 and are rejected; so does every
text if there is nothing to learn from. Rows without ``doc_id`` are classified but never
learned from. Repeated rows are classified one by one. Extra columns are ignored, or
passed on by ``keep_recognised``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapsheaf.llm.common import give_back, hash_fold, keep_only

SAMPLE = 256
CLUSTERS = 4
ROUNDS = 8
DIMENSIONS = 1 << 13
NGRAMS = (1, 2, 3)
# A text must reach this quantile of its language's cosines at its length. Floors are kept for
# these lengths (logarithms of distinct n-grams) and lie between them on straight lines.
QUANTILE = 0.002
LENGTHS = np.arange(1.0, 14.0)
NEAR = 0.75
WINDOWS = 2
# A length with fewer cosines has no floor of its own. A language with fewer documents, or no
# length with a floor, takes a share of the least floors of the others.
LEAST_COSINES = 20
LEAST_DOCS = 8
SHARE = 0.5
PIECE = 1 << 20
BATCH = 256
UNKNOWN = "und"

_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


@dataclass
class Model:
    languages: list[str]  # of each centroid
    rarity: np.ndarray
    centroids: np.ndarray
    floors: np.ndarray  # least cosine that each centroid accepts, for each of LENGTHS


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of the whole text, a piece at a time."""
    data = b" ".join(text.lower().encode().translate(_LETTERS).split())
    codes = np.frombuffer(b" " + data + b" ", np.uint8)
    total = np.zeros(DIMENSIONS, np.int64)
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    for start in range(0, len(codes), PIECE):
        for n in NGRAMS:
            part = codes[start:start + PIECE + n - 1].astype(np.uint32)
            if len(part) < n:
                continue
            grams = np.full(len(part) - n + 1, n, np.uint32)
            for k in range(n):
                grams = (grams << np.uint32(8)) | part[k:len(part) - n + 1 + k]
            total += np.bincount((grams * np.uint32(2654435761)) >> shift, minlength=DIMENSIONS)
    return total


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(length == 0, 1, length)


def windows(text: str) -> list[str]:
    """Parts of a text: 1, 2, 4, ... of its words, ``WINDOWS`` of each size at fixed random places."""
    units, space = text.split(), " "
    if len(text) > 32 * len(units):  # a script without spaces
        units, space = list(text), ""
    places = np.random.default_rng(crc32(text.encode()))
    found, size = [], 1
    while size < len(units):
        for start in places.integers(0, len(units) - size + 1, WINDOWS):
            found.append(space.join(units[start:start + size]))
        size *= 2
    return [part for part in found if has_letter(part)]


def sparse(text: str) -> tuple[bytes, bytes]:
    """Places and weights of the n-grams that a text has."""
    found = counts(text)
    at = np.flatnonzero(found)
    return at.astype("<u2").tobytes(), np.log1p(found[at]).astype("<f4").tobytes()


def _dense(places: list[bytes], weights: list[bytes]) -> np.ndarray:
    rows = np.zeros((len(places), DIMENSIONS), np.float32)
    for n, (at, weight) in enumerate(zip(places, weights, strict=True)):
        rows[n, np.frombuffer(at, "<u2")] = np.frombuffer(weight, "<f4")
    return rows


def _cluster(vectors: np.ndarray) -> np.ndarray:
    """Centroids by spherical k-means.

    Starts from vectors evenly spread by closeness to the mean, so that no centroid is
    spent on an outlier.
    """
    order = np.argsort(vectors @ _unit(vectors.mean(axis=0)), kind="stable")
    count = min(CLUSTERS, len(vectors))
    centres = vectors[order[(np.arange(count) * 2 + 1) * len(order) // (2 * count)]]
    for _ in range(ROUNDS):
        owner = (vectors @ centres.T).argmax(axis=1)
        centres = np.stack([
            _unit(vectors[owner == k].mean(axis=0)) if (owner == k).any() else centres[k]
            for k in range(len(centres))])
    return centres


def language(places: list[list[bytes]], weights: list[list[bytes]], rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and floors from the sampled documents of a language, each followed by its windows.

    The centroids of one half of the documents measure the other half. Floors are NaN where
    there is too little to measure.
    """
    vectors = _unit(_dense([p[0] for p in places], [w[0] for w in weights]) * rarity)
    centres = _cluster(vectors)
    floors = np.full(len(LENGTHS), np.nan)
    if len(vectors) < LEAST_DOCS:
        return centres, floors
    lengths, cosines = [], []
    for half in (0, 1):
        others = _cluster(vectors[half::2])
        parts = [(at, weight) for p, w in zip(places[1 - half::2], weights[1 - half::2], strict=True)
                 for at, weight in zip(p, w, strict=True)]
        for start in range(0, len(parts), BATCH):
            at, weight = zip(*parts[start:start + BATCH], strict=True)
            cosines.append((_unit(_dense(at, weight) * rarity) @ others.T).max(axis=1))
            lengths.append(np.log2([len(a) // 2 for a in at]))
    lengths, cosines = np.concatenate(lengths), np.concatenate(cosines)
    for n, length in enumerate(LENGTHS):
        near = cosines[abs(lengths - length) <= NEAR]
        if len(near) >= LEAST_COSINES:
            floors[n] = np.quantile(near, QUANTILE)
    measured = np.flatnonzero(~np.isnan(floors))
    return centres, np.interp(LENGTHS, LENGTHS[measured], floors[measured]) if len(measured) else floors


def assembled(parts: list[tuple[str, np.ndarray, np.ndarray]], rarity: np.ndarray) -> Model:
    """The model of all languages: name, centroids and floors of each."""
    measured = [floors for _, _, floors in parts if not np.isnan(floors[0])]
    least = SHARE * np.min(measured, axis=0) if measured else np.zeros(len(LENGTHS))
    return Model(
        [name for name, centres, _ in parts for _ in centres], rarity,
        np.vstack([centres for _, centres, _ in parts]).astype(np.float32),
        np.vstack([np.tile(least if np.isnan(floors[0]) else floors, (len(centres), 1)) for _, centres, floors in parts]))


def fit(docs: DataFrame, learn: object) -> Model | None:
    """A model from the rows of ``docs`` for which the column ``learn`` holds."""
    known = docs.where(learn).where("lang is not null and text is not null and doc_id is not null").select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    # Thin out by hash first, so that the exact cut sorts a few times SAMPLE rows at most.
    frequent = known.groupBy("lang").count().select("lang", F.least(
        F.lit(1.0), 3.0 * SAMPLE / F.col("count")).alias("share"))
    dealt = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    thin = known.join(F.broadcast(frequent), "lang").withColumn("dealt", dealt).where(
        F.pmod("dealt", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    order = Window.partitionBy("lang").orderBy("dealt", "doc_id")
    sample = thin.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE).select("lang", "text")

    def features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for part in parts:
            rows = [(lang, list(zip(*map(sparse, [text, *windows(text)]), strict=True))) for lang, text in zip(
                part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) if has_letter(text)]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1][0] for r in rows], pa.list_(pa.binary())),
                pa.array([r[1][1] for r in rows], pa.list_(pa.binary()))],
                ["lang", "at", "weight"])

    def occurrences(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last counter is the number of texts.
        keep_only()
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for part in parts:
            for text in part.column(0).to_pylist():
                if has_letter(text):
                    total[:-1] += counts(text) > 0
                    total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])

    total = np.zeros(DIMENSIONS + 1, np.int64)
    for row in known.select("text").mapInArrow(occurrences, "at int, n long").groupBy("at").agg(
            F.sum("n").alias("n")).collect():
        total[row["at"]] = row.n
    if not total[-1]:
        return None
    rarity = (np.log((1 + total[-1]) / (1 + total[:-1])) + 1).astype(np.float32)

    def fitted(rows: pa.Table) -> pa.Table:
        own = sorted(zip(rows["at"].to_pylist(), rows["weight"].to_pylist(), strict=True))
        centres, floors = language([r[0] for r in own], [r[1] for r in own], rarity)
        return pa.table({"lang": [rows["lang"][0].as_py()], "centres": [centres.astype("<f4").tobytes()],
                         "floors": [floors.astype("<f8").tobytes()]})

    rows = sample.mapInArrow(features, "lang string, at array<binary>, weight array<binary>").groupBy(
        "lang").applyInArrow(fitted, "lang string, centres binary, floors binary").collect()
    return assembled([
        (r.lang, np.frombuffer(r.centres, "<f4").reshape(-1, DIMENSIONS), np.frombuffer(r.floors, "<f8"))
        for r in sorted(rows, key=lambda r: r.lang)], rarity) if rows else None


def predict(model: Model | None, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    """Language, cosine to the nearest centroid, and whether the text is rejected."""
    languages, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
    usable = [n for n, text in enumerate(texts) if has_letter(text)] if model else []
    for start in range(0, len(usable), BATCH):
        part = usable[start:start + BATCH]
        vectors = _dense(*zip(*(sparse(texts[n]) for n in part), strict=True))
        lengths = np.log2((vectors > 0).sum(axis=1))
        cosine = _unit(vectors * model.rarity) @ model.centroids.T
        nearest = cosine.argmax(axis=1)
        for row, n in enumerate(part):
            best = nearest[row]
            score = float(cosine[row, best])
            languages[n] = model.languages[best]
            scores[n] = min(1.0, max(0.0, score))
            rejected[n] = bool(score < np.interp(lengths[row], LENGTHS, model.floors[best]))
    return languages, scores, rejected


def identify(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``; learns from the other folds only."""
    fold = hash_fold(F.col("doc_id"), folds)
    model = fit(docs, fold != held_out)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for part in parts:
            languages, scores, rejected = predict(model, part.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1), pa.array(languages, pa.string()),
                pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"])
        give_back()

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(
        batches, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_recognised(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is recognised."""
    model = fit(docs, hash_fold(F.col("doc_id"), folds) != held_out)
    at = docs.columns.index("text")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for part in parts:
            rejected = predict(model, part.column(at).to_pylist())[2]
            yield part.filter(pa.array([not x for x in rejected], pa.bool_()))
        give_back()

    return docs.mapInArrow(batches, docs.schema)
