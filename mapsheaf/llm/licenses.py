"""Licence notices in texts, found through an index of rare words and their places.

Templates are licence notices and short phrases. Their words form a positional index:
each word has postings, the templates and places where it stands. How rare a licence
word is comes from its document frequency in the whole corpus. A file's licence words
are looked up; for each template whose words the file holds in sufficient weight, the file's
``ANCHORS`` rarest words of that template propose where the template starts: place in the
file less place in the template. Proposals that several of them agree on are verified:
the weight of the template's words that stand there, each at most ``slack`` words out of
place, must reach ``least``, and every key phrase must stand word by word.

Phrases have no slack and must be whole, so exactly their places are found. The only cut
before the proposals is an upper bound: no place can match more weight than the file
holds, nor a key phrase of which a word is missing. Counts of words cover all documents.

A null text is empty. Texts are taken whole, long ones in parts of ``CHUNK`` bytes cut between
words; what is kept of them is the licence words. Null ids and repeated rows are judged like
others, further columns are ignored, no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapsheaf.llm.words import runs

CHUNK = 4 << 20
ANCHORS = 4
SUPPORT = 2


@dataclass(frozen=True)
class Template:
    """A notice: its text, phrases in it that must stand, and how much of it is enough."""

    label: str
    text: str
    required: tuple[str, ...]
    least: float = 0.7
    slack: int = 3
    base: bool = False


def _phrase(label: str, text: str, base: bool = False) -> Template:
    return Template(label, text, (text,), 1.0, 0, base)


# Notices as licensors ask to have them written, and the base phrases.
TEMPLATES = (
    _phrase("cc-by", "cc by", True),
    _phrase("gpl", "general public license", True),
    _phrase("reserved", "all rights reserved", True),
    _phrase("mit", "the mit license"),
    _phrase("lgpl", "lesser general public license"),
    _phrase("agpl", "affero general public license"),
    _phrase("cc0", "cc0 1 0 universal"),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the"
             " license at http www apache org licenses license 2 0", ("apache org licenses license 2 0",)),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2",
             ("gnu general public license", "version 2")),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3",
             ("gnu general public license", "version 3")),
    Template("gpl-or-later", "you can redistribute it and or modify it under the terms of the gnu general public license as"
             " published by the free software foundation either version 3 of the license or at your option any later version",
             ("gnu general public license", "any later version")),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license",
             ("creative commons attribution 4 0",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
             " associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "without restriction")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is"
             " hereby granted", ("with or without fee is hereby granted",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided"
             " that the following conditions are met", ("source and binary forms", "conditions are met")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license v 2 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("unencumbered software", "public domain")),
)

# Bytes of words, after A-Z are made lower-case.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")

MATCHES = ("doc_id long, n_words long, base array<struct<label:string,start:long>>,"
           " found array<struct<label:string,start:long,score:double>>")


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of the ranges in turn, and the range that each is of."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes), owner


class Index:
    """Postings of the templates' words."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        texts = [t.text.split() for t in templates]
        self.words = sorted({w for text in texts for w in text})
        number = {w: n for n, w in enumerate(self.words)}
        self.lookup = pa.array([w.encode() for w in self.words], pa.binary())
        rows, phrases = [], []
        for t, (template, text) in enumerate(zip(templates, texts, strict=True)):
            of_place = [-1] * len(text)
            for phrase in map(str.split, template.required):
                at = next(n for n in range(len(text)) if text[n:n + len(phrase)] == phrase)
                of_place[at:at + len(phrase)] = [len(phrases)] * len(phrase)
                phrases.append(len(phrase))
            rows += [(number[w], t, place, of_place[place]) for place, w in enumerate(text)]
        self.word, self.template, self.place, self.phrase = np.array(sorted(rows)).T
        self.first = np.searchsorted(self.word, np.arange(len(self.words) + 1))
        self.phrase_size = np.array(phrases)
        self.required = np.array([len(t.required) for t in templates])
        self.least = np.array([t.least for t in templates])
        self.slack = np.array([t.slack for t in templates])
        self.longest = max(map(len, texts))

    def weigh(self, documents: int, holding: np.ndarray) -> None:
        """Rarity of each word, ``log(1 + documents / (1 + holding))``, and what depends on it."""
        self.idf = np.log(1 + documents / (1 + holding))
        self.rank = np.argsort(np.argsort(-self.idf, kind="stable"))
        self.total = np.bincount(self.template, self.idf[self.word], len(self.templates))
        self.needed = np.bincount(self.template, self.phrase >= 0, len(self.templates))

    def postings(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the index for each of ``words``, and which of them each row is for."""
        return _ranges(self.first[words], self.first[words + 1])

    def places(self, docs: np.ndarray, at: np.ndarray, words: np.ndarray, count: int) -> list[np.ndarray]:
        """``doc, template, start, score`` of all notices, from the licence words of ``count`` files.

        ``docs, at, words``: file, place and number of each licence word, in this order.
        """
        kinds, size = len(self.templates), len(self.words)
        # What a file holds in all bounds what can stand anywhere in it.
        held = np.unique(docs * size + words)
        row, owner = self.postings(held % size)
        pair = held[owner] // size * kinds + self.template[row]
        weight = np.bincount(pair, self.idf[self.word[row]], count * kinds).reshape(count, kinds)
        needed = np.bincount(pair, self.phrase[row] >= 0, count * kinds).reshape(count, kinds)
        possible = ((weight >= self.least * self.total - 1e-9) & (needed >= self.needed - 1e-9)).ravel()
        own = possible.reshape(count, kinds).any(axis=1)[docs]
        docs, at, words = docs[own], at[own], words[own]

        row, owner = self.postings(words)
        pair = docs[owner] * kinds + self.template[row]
        keep = possible[pair]
        row, owner, pair = row[keep], owner[keep], pair[keep]
        width = (int(at.max()) if len(at) else 0) + 4 * self.longest
        start = pair * width + at[owner] - self.place[row] + 2 * self.longest
        order = np.argsort(start, kind="stable")
        row, start, pair = row[order], start[order], pair[order]

        # The file's rarest words of the template propose starts.
        rank = pair * size + self.rank[self.word[row]]
        ranks, inverse = np.unique(rank, return_inverse=True)
        begin = np.searchsorted(ranks, ranks // size * size)
        anchor = (np.arange(len(ranks)) - begin < ANCHORS)[inverse]
        starts, support = np.unique(start[anchor], return_counts=True)
        starts = starts[support >= SUPPORT]
        template = starts // width % kinds

        # Hits near each proposal: every place of the template counts once.
        slack = self.slack[template]
        hit, owner = _ranges(np.searchsorted(start, starts - slack), np.searchsorted(start, starts + slack, "right"))
        matched = np.unique(owner * (self.longest + 1) + self.place[row[hit]], return_index=True)[1]
        score = np.bincount(owner[matched], self.idf[self.word[row[hit[matched]]]], len(starts)) / self.total[template]
        phrase = self.phrase[row[hit]]
        of_phrase = phrase >= 0
        key = (owner * len(self.phrase_size) + phrase)[of_phrase]
        lines, size_of = np.unique(np.stack([key, start[hit][of_phrase]]), axis=1, return_counts=True)
        whole = np.unique(lines[0][size_of == self.phrase_size[lines[0] % len(self.phrase_size)]])
        standing = np.bincount(whole // len(self.phrase_size), minlength=len(starts))
        good = (score >= self.least[template] - 1e-9) & (standing == self.required[template])
        starts, template = starts[good], template[good]
        return [starts // width // kinds, template, starts % width - 2 * self.longest, np.minimum(score[good], 1.0)]


@lru_cache(maxsize=2)
def _index(templates: tuple[Template, ...]) -> Index:
    return Index(templates)


def _licence_words(index: Index, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each text how many words it has, and place and number of its licence words."""
    held, ends = [], []

    def chunk() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        data = _LOWER[np.frombuffer(b" ".join(held) + b" ", np.uint8)]
        begins, words = runs(data, _INSIDE[data])
        numbers = pc.fill_null(pc.index_in(words, value_set=index.lookup), -1).to_numpy()
        edges = np.searchsorted(begins, np.cumsum([0, *(len(part) + 1 for part in held)]))
        for a, b in zip(edges, edges[1:], strict=False):
            at = np.flatnonzero(numbers[a:b] >= 0)
            yield int(b - a), at, numbers[a:b][at].astype(np.int64)

    def whole() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        parts, before = [], 0
        for (count, at, words), end in zip(chunk(), ends, strict=True):
            parts.append((at + before, words))
            before += count
            if end:
                yield before, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                parts, before = [], 0

    size = 0
    for text in texts:
        data = text.as_buffer() or b""
        start = 0
        while True:
            gap = _GAP.search(data, start + CHUNK) if len(data) - start > CHUNK else None
            end = gap.end() if gap else len(data)
            held.append(bytes(memoryview(data)[start:end]))
            ends.append(end == len(data))
            size, start = size + end - start, end
            if ends[-1]:
                break
        if size >= CHUNK:
            yield from whole()
            held, ends, size = [], [], 0
    if held:
        yield from whole()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[int, np.ndarray]:
    """How many documents there are, and how many hold each licence word.

    The driver gets one number for each word of the templates.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(templates)
        holding, documents = np.zeros(len(index.words) + 1, np.int64), 0
        for part in parts:
            for _, _, words in _licence_words(index, part.column(1)):
                holding[np.unique(words)] += 1
                documents += 1
        holding[-1] = documents
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(holding))), pa.array(holding)], ["word", "n"])

    counted = _texts(docs).mapInArrow(batches, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    holding = np.zeros(len(_index(templates).words) + 1, np.int64)
    for word, n in counted.collect():
        holding[word] = n
    return int(holding[-1]), holding[:-1]


def find_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``doc_id, n_words, base, found`` for every row of ``docs``.

    ``base``: label and start of every place of a base phrase. ``found``: label, start
    and score of every notice or phrase of the others. Both by start, then label.
    """
    documents, holding = document_frequencies(docs, templates)

    def listed(kept: np.ndarray, docs: np.ndarray, fields: dict[str, pa.Array], count: int) -> pa.Array:
        ends = np.searchsorted(docs[kept], np.arange(count + 1)).astype(np.int32)
        rows = pa.StructArray.from_arrays([v.filter(pa.array(kept)) for v in fields.values()], list(fields))
        return pa.ListArray.from_arrays(pa.array(ends), rows)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        index.weigh(documents, holding)
        labels, base = [t.label for t in templates], np.array([t.base for t in templates])
        for part in parts:
            found = list(_licence_words(index, part.column(1)))
            count = len(found)
            owner = np.repeat(np.arange(count), [len(at) for _, at, _ in found])
            at = np.concatenate([np.empty(0, np.int64), *(at for _, at, _ in found)])
            words = np.concatenate([np.empty(0, np.int64), *(w for _, _, w in found)])
            doc, template, start, score = index.places(owner, at, words, count)
            names = np.array(labels, object)[template]
            order = np.lexsort((template, start, doc))
            doc, template, start, score, names = (x[order] for x in (doc, template, start, score, names))
            fields = {"label": pa.array(names, pa.string()), "start": pa.array(start)}
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([n for n, _, _ in found], pa.int64()),
                 listed(base[template], doc, fields, count),
                 listed(~base[template], doc, fields | {"score": pa.array(score)}, count)],
                ["doc_id", "n_words", "base", "found"])

    return _texts(docs).mapInArrow(batches, MATCHES)


def summary(found: DataFrame) -> DataFrame:
    """One row for each document: counts, first and last base place, labels and best score.

    A base phrase scores 1, a document without any licence 0.
    """
    def starts(spans: str) -> Column:
        return F.transform(spans, lambda s: s["start"])

    def labels(*spans: str) -> Column:
        each = [F.transform(s, lambda x: x["label"]) for s in spans]
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*each))), ",")

    best = F.coalesce(F.array_max(F.transform("found", lambda s: s["score"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts("base")).alias("first_word"), F.array_max(starts("base")).alias("last_word"),
        labels("base").alias("base_labels"), labels("base", "found").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(best).alias("score"))
