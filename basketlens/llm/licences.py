"""Licence notices in documents, by a positional index of rare words.

A template is a notice with key phrases that must stand in it.  Each phrase
is indexed by the one of its words that fewest documents of the corpus have.
A file looks up those of its words, keeps the alignments at which the
postings of all phrases of a template agree on where it begins, and only
there are phrases compared word by word.  A phrase cannot stand in a file
without its rarest word, so nothing is lost.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.audit import SpanTable
from basketlens.llm.rolling import grouped, slices

#: Words by which a key phrase may stand nearer or farther than in the template.
SLACK = 5
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# The base phrases and their labels.
BASE = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# Published licence notices with the phrases that tell them
# from other notices.
NOTICES = (
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0",
        ("apache license version 2 0",),
    ),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        ("apache license", "except in compliance with the license"),
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms", "provided that the following conditions are met"),
    ),
    (
        "bsd-3-clause",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        ("endorse or promote products derived from this software", "specific prior written permission"),
    ),
    (
        "bsl-1.0",
        "Distributed under the Boost Software License, Version 1.0",
        ("boost software license",),
    ),
    (
        "cc-by-nc",
        "Licensed under CC BY-NC 4.0",
        ("cc by nc",),
    ),
    (
        "cc-by-sa",
        "Licensed under CC BY-SA 4.0",
        ("cc by sa",),
    ),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution",),
    ),
    (
        "cc0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        ("waived all copyright and related or neighboring rights",),
    ),
    (
        "epl-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        ("accompanying materials are made available under the terms", "eclipse public license"),
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        ("free software you can redistribute it and or modify it", "gnu general public license"),
    ),
    (
        "gpl",
        "This work is licensed under the GNU General Public License, version 3",
        ("licensed under the gnu general public license",),
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    (
        "lgpl",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        ("gnu lesser general public license",),
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    (
        "mit",
        "Released under the MIT License",
        ("under the mit license",),
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("this source code form is subject to the terms", "mozilla public license"),
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("free and unencumbered software", "public domain"),
    ),
    (
        "zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software",
        ("without any express or implied warranty", "will the authors be held liable"),
    ),
)


def words_of(text: str) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


@dataclass(frozen=True)
class Template:
    """Words of a notice, and its key phrases as (start, length) in them."""

    label: str
    words: tuple[str, ...]
    phrases: tuple[tuple[int, int], ...]
    base: bool = False

    @classmethod
    def of(cls, label: str, notice: str, phrases: Iterable[str], base: bool = False) -> "Template":
        words, found = words_of(notice), []
        for phrase in map(words_of, phrases):
            places = [k for k in range(len(words)) if words[k : k + len(phrase)] == phrase]
            if not places:
                raise ValueError(f"not in the notice: {' '.join(phrase)}")
            found.append((places[0], len(phrase)))
        if not found:
            raise ValueError(f"no key phrase: {notice}")
        return cls(label, tuple(words), tuple(found), base)


def default_templates() -> list[Template]:
    return [Template.of(label, phrase, [phrase], True) for label, phrase in BASE] + [Template.of(*notice) for notice in NOTICES]


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IN_WORD = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])


class Vocabulary:
    """Numbers of given words, looked up in many texts at once."""

    def __init__(self, words: list[str]):
        self.words = words
        self.tail = "\n".join(words).encode()

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text, number) of every word of the texts, -1 for other words."""
        n = len(texts)
        raw = b"\n".join(texts).translate(_LOWER) + b"\n"
        data = np.frombuffer(raw + self.tail + b"\n" * 9, np.uint8)
        edges = np.flatnonzero(np.diff(_IN_WORD[data], prepend=False))
        starts, ends = edges[0::2], edges[1::2]
        spans = SpanTable(data, starts, ends, np.zeros(len(starts), np.int64))
        hashes, own = spans.hashes(), len(starts) - len(self.words)
        order = np.argsort(hashes[own:])
        known = hashes[own:][order]
        # Few words pass by the first 16 bits of their hash.
        maybe = np.zeros(1 << 16, bool)
        maybe[known >> np.uint64(48)] = True
        some = np.flatnonzero(maybe[hashes[:own] >> np.uint64(48)])
        at = np.minimum(np.searchsorted(known, hashes[some]), len(known) - 1)
        numbers = np.full(own, -1, np.int64)
        same = spans.same(some, own + order[at])
        numbers[some[same]] = order[at][same]
        sizes = np.fromiter(map(len, texts), np.int64, n) + 1
        return np.searchsorted(np.cumsum(sizes), starts[:own], side="right"), numbers


def document_counts(docs: DataFrame, words: list[str]) -> tuple[dict[str, int], int]:
    """In how many documents each of the given words stands, and how many
    documents there are; one row per word and task meets."""
    vocabulary = Vocabulary(words)

    def count(batches):
        counts = np.zeros(len(words) + 1, np.int64)
        for batch in slices(batches):
            counts[-1] += batch.num_rows
            for texts in grouped(batch.column(0).to_pylist()):
                text, number = vocabulary.read(texts)
                pairs = np.unique((text * len(words) + number)[number >= 0])
                counts[:-1] += np.bincount(pairs % len(words), minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], names=["word", "n"])

    found = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r["word"]: r["n"] for r in found.collect()}
    return {w: counts.get(k, 0) for k, w in enumerate(words)}, counts.get(len(words), 0)


class RareWordIndex:
    """Postings of the rarest word of every key phrase."""

    def __init__(self, templates: list[Template], counts: dict[str, int], documents: int):
        self.templates = templates
        self.vocabulary = Vocabulary(sorted({w for t in templates for w in t.words}))
        number = {w: k for k, w in enumerate(self.vocabulary.words)}
        self.idf = {w: math.log((documents + 1) / (counts.get(w, 0) + 1)) for w in number}
        self.numbers = [np.array([number[w] for w in t.words]) for t in templates]
        #: By template, for each phrase: the rarest word's number, its place
        #: in the template, and the phrase's place and length.
        self.postings = []
        for t in templates:
            rows = []
            for start, length in t.phrases:
                place = max(range(start, start + length), key=lambda k: (self.idf[t.words[k]], -k))
                rows.append((number[t.words[place]], place, start, length))
            self.postings.append(rows)
        #: More words than any template and the slack: between two texts.
        self.gap = max(len(t.words) for t in templates) + SLACK + 1

    def scan(self, texts: list[bytes]) -> list[list]:
        """n_words, n_base, first_word, last_word, base_labels, labels, score
        of each text, as columns."""
        n = len(texts)
        text, numbers = self.vocabulary.read(texts)
        counts = np.bincount(text, minlength=n)[:n]
        firsts = np.cumsum(counts) - counts
        #: Words with gaps between texts, so that nothing reaches into the next one.
        line = np.full(len(numbers) + (n + 1) * self.gap, -1, np.int64)
        at = np.arange(len(numbers)) + (text + 1) * self.gap
        line[at] = numbers
        begin = firsts + (np.arange(n) + 1) * self.gap
        owner = lambda places: np.searchsorted(begin, places, side="right") - 1

        rare = np.unique([row[0] for rows in self.postings for row in rows])
        held = np.flatnonzero(np.isin(line, rare))
        held_words = line[held]
        places = {int(w): held[held_words == w] for w in rare}
        n_base, score = np.zeros(n, np.int64), np.zeros(n)
        first_word, last_word = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        base_labels, labels = [set() for _ in range(n)], [set() for _ in range(n)]
        for template, numbers, rows in zip(self.templates, self.numbers, self.postings):
            hits = [places[word] - place for word, place, _, _ in rows]
            if not len(aligned(hits)):
                continue
            for k, (_, _, start, length) in enumerate(rows):
                for j in range(start, start + length):
                    hits[k] = hits[k][line[hits[k] + j] == numbers[j]]
            found = aligned(hits)
            if not len(found):
                continue
            # A notice may begin before its file does; its first phrase may not.
            first = found + rows[0][2]
            own = owner(first)
            in_place = sum((line[np.clip(found + j, 0, len(line) - 1)] == numbers[j]).astype(np.int64) for j in range(len(numbers)))
            np.maximum.at(score, own, in_place / len(numbers))
            for k in np.unique(own).tolist():
                labels[k].add(template.label)
                if template.base:
                    base_labels[k].add(template.label)
            if template.base:
                n_base += np.bincount(own, minlength=n)
                np.minimum.at(first_word, own, first - begin[own])
                np.maximum.at(last_word, own, first - begin[own])
        none = n_base == 0
        joined = [[",".join(sorted(s)) for s in each] for each in (base_labels, labels)]
        return [pa.array(counts), pa.array(n_base), pa.array(first_word, mask=none), pa.array(last_word, mask=none), *map(pa.array, joined), pa.array(score)]


def aligned(hits: list[np.ndarray]) -> np.ndarray:
    """Of the first list of ascending places those with a place of every
    other list within the slack."""
    found = hits[0]
    for other in hits[1:]:
        if len(found):
            found = found[np.searchsorted(other, found - SLACK) < np.searchsorted(other, found + SLACK, side="right")]
    return found


FOUND = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def scan(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """The licence notices of each document.

    A template is found where its first key phrase stands and every other
    one stands at most ``SLACK`` words from where the first puts it.
    ``labels`` are those of the templates found, ``base_labels`` of the base
    phrases among them, of which ``n_base`` counts all places and
    ``first_word`` and ``last_word`` tell the outermost.  ``score`` is the
    largest share of a found template's words that stand in place (1 for a
    base phrase), 0 if none is found.

    Null texts are empty: no words, no labels, score 0.  Rows are judged one
    by one, repeated ones alike; other columns are not read.  An empty table
    gives an empty result.
    """
    templates = default_templates() if templates is None else templates
    words = sorted({w for t in templates for w in t.words})
    index = RareWordIndex(templates, *document_counts(docs, words))
    names = [f.split()[0] for f in FOUND.split(", ")]

    def judge(batches):
        for batch in slices(batches):
            at = 0
            for texts in grouped(batch.column(1).to_pylist()):
                columns = [batch.column(0).slice(at, len(texts)), *index.scan(texts)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(judge, FOUND)


def scan_sql(templates: list[Template] | None = None) -> str:
    """The same in SQL, phrase by phrase over all words."""
    templates = default_templates() if templates is None else templates
    heads, parts, words = [], [], []
    for t, template in enumerate(templates):
        heads.append(f"({t}, '{template.label}', {str(template.base).lower()}, {len(template.words)}, {len(template.phrases)}, {template.phrases[0][0]})")
        words += [f"({t}, {k}, '{w}')" for k, w in enumerate(template.words)]
        parts += [f"({t}, {j}, {length}, {k}, '{template.words[k]}')" for j, (start, length) in enumerate(template.phrases) for k in range(start, start + length)]
    return rf"""
WITH heads(t, label, base, size, phrases, first_at) AS (VALUES {", ".join(heads)}),
notice(t, place, word) AS (VALUES {", ".join(words)}),
parts(t, j, length, place, word) AS (VALUES {", ".join(parts)}),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS MATERIALIZED (SELECT rid, pos - 1 AS pos, word FROM (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM d)
    WHERE word IN (SELECT word FROM notice)),
phrase AS MATERIALIZED (SELECT rid, t, j, pos - place AS o FROM w JOIN parts USING (word) GROUP BY rid, t, j, pos - place HAVING count(*) = any_value(length)),
found AS MATERIALIZED (SELECT a.rid, a.t, a.o FROM phrase a JOIN heads h ON h.t = a.t
    JOIN phrase b ON b.rid = a.rid AND b.t = a.t AND b.o BETWEEN a.o - CASE WHEN b.j = 0 THEN 0 ELSE {SLACK} END AND a.o + CASE WHEN b.j = 0 THEN 0 ELSE {SLACK} END
    WHERE a.j = 0 GROUP BY a.rid, a.t, a.o HAVING count(DISTINCT b.j) = any_value(h.phrases)),
share AS (SELECT f.rid, max(f.n / h.size) AS score FROM
    (SELECT f.rid, f.t, f.o, count(*) AS n FROM found f JOIN notice x ON x.t = f.t JOIN w ON w.rid = f.rid AND w.pos = f.o + x.place AND w.word = x.word
    GROUP BY f.rid, f.t, f.o) f JOIN heads h ON h.t = f.t GROUP BY f.rid),
told AS (SELECT rid, count(*) FILTER (base) AS n_base, min(o + first_at) FILTER (base) AS first_word, max(o + first_at) FILTER (base) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM found JOIN heads USING (t) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
    CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN told USING (rid) LEFT JOIN share USING (rid)
"""
