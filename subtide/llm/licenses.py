"""Licence scan by a positional index of rare words.

Words are runs of ASCII letters, digits and characters above ASCII, A-Z lower-cased.

1. Each template's words are ranked by how rare they are among all documents. The rarest of each
   are its anchors; the index holds (template, position) for every anchor.
2. Every anchor found in a file votes for the place where its template would begin: file position less
   template position. Places where enough different anchors agree are candidates.
3. A candidate counts if the template's mandatory phrases stand in the text it spans, and a
   sufficient share of its words, weighted by rarity, stands in its relative position.

Apart from templates, places of fixed phrases ("mit license") give base labels.

Null and empty texts have no words and no labels. Repeated rows are scanned each for itself, other
columns are ignored. Document counts of the template words are all that tasks exchange, so no key
can be hot; the index is as large as the templates.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm import batch
from subtide.llm.decontamination import WORD_BYTES
from subtide.llm.shared import bounded, text_column

# Phrases of the base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Label, wording, phrases that must occur in it.
TEMPLATES: list[tuple[str, str, tuple[str, ...]]] = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction", ("permission is hereby granted", "free of charge")),
    ("mit", "Released under the MIT License.", ("mit license",)),
    ("mit", "Licensed under the MIT License.", ("mit license",)),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "2 0")),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at", ("apache license", "in compliance with the license")),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.", ("general public license", "version 3")),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2.", ("general public license", "version 2")),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ("free software", "general public license", "version 3")),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", ("free software", "general public license", "version 2")),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("lesser general public license",)),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ("affero general public license",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use", "source and binary forms")),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ("permission to use", "with or without fee")),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla public license",)),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ("cc by nc 4 0",)),
    ("cc-by-4.0", "Licensed under CC BY 4.0.", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("creative commons attribution noncommercial",)),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    ("unlicense", "This is free and unencumbered software released into the public domain.", ("public domain", "unencumbered")),
    ("proprietary", "Copyright. All rights reserved.", ("all rights reserved",)),
    ("proprietary", "All rights reserved.", ("all rights reserved",)),
]

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)


def hashed(text: str) -> np.ndarray:
    """Hashes of the words of one text."""
    for _, data, offsets in batch.runs(pa.array([text], pa.string())):
        return batch.words(data, offsets, inside=WORD_BYTES).hashes()
    return np.zeros(0, np.uint64)


def places_of(words: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts of all places where the phrase stands."""
    if not len(phrase) or len(words) < len(phrase):
        return np.zeros(0, np.int64)
    at = np.flatnonzero(words[: len(words) - len(phrase) + 1] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[words[at + k] == phrase[k]]
    return at


class Index:
    """Anchors of the templates, chosen by the documents that have each word."""

    def __init__(self, templates: list[tuple[str, str, tuple[str, ...]]], document_counts: dict[int, int], n_docs: int, anchors: int) -> None:
        self.labels = [t[0] for t in templates]
        self.words = [hashed(t[1]) for t in templates]
        self.mandatory = [[hashed(p) for p in t[2]] for t in templates]
        rarity = {int(w): math.log((n_docs + 1) / (document_counts.get(int(w), 0) + 1)) + 1e-6 for ws in self.words for w in ws}
        self.weights = [np.array([rarity[int(w)] for w in ws]) for ws in self.words]
        self.needed = []
        postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, ws in enumerate(self.words):
            rare = sorted(set(ws.tolist()), key=lambda w: (-rarity[w], w))[:anchors]
            self.needed.append(max(1, len(rare) // 2))
            for at, w in enumerate(ws.tolist()):
                if w in rare:
                    postings[w].append((t, at))
        self.anchors = batch.HashSet(np.array(sorted(postings), np.uint64))
        self.postings = [postings[int(k)] for k in self.anchors.keys]
        self.phrases = [(hashed(p), label) for p, label in PHRASES.items()]

    def candidates(self, hits: np.ndarray, known: np.ndarray) -> list[tuple[int, int]]:
        """(template, place where it would begin) on which enough different anchors agree."""
        votes: dict[tuple[int, int], set[int]] = defaultdict(set)
        for p, k in zip(hits.tolist(), known.tolist(), strict=True):
            for t, at in self.postings[k]:
                votes[t, p - at].add(k)
        return sorted(x for x, agreeing in votes.items() if len(agreeing) >= self.needed[x[0]])

    def share(self, words: np.ndarray, template: int, begin: int) -> float:
        """Weighted share of a template's words in place, 0 if a mandatory phrase is missing."""
        ws, weights = self.words[template], self.weights[template]
        span = words[max(0, begin) : begin + len(ws)]
        if any(not len(places_of(span, phrase)) for phrase in self.mandatory[template]):
            return 0.0
        at = np.arange(max(0, -begin), min(len(ws), len(words) - begin))
        return float(weights[at][words[begin + at] == ws[at]].sum() / weights.sum())

    def scan(self, words: np.ndarray, hits: np.ndarray, known: np.ndarray, least: float) -> tuple[list[int], set[str], set[str], float]:
        places, base, labels, score = [], set(), set(), 0.0
        for phrase, label in self.phrases:
            if len(own := places_of(words, phrase)):
                places += own.tolist()
                base.add(label)
        for template, begin in self.candidates(hits, known):
            share = self.share(words, template, begin)
            if share >= least:
                labels.add(self.labels[template])
                score = max(score, share)
        return places, base, labels | base, max(score, 0.5 * bool(base))


def _template_word_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[dict[int, int], int]:
    """Documents that have each word of the vocabulary, and documents."""
    known = batch.HashSet(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, n = np.zeros(len(vocabulary), np.int64), 0
        for rows in batches:
            n += rows.num_rows
            for _, data, offsets in batch.runs(rows.column(0)):
                found = batch.words(data, offsets, inside=WORD_BYTES)
                place = known.places(found.hashes())
                hit = place >= 0
                pairs = np.unique(found.rows()[hit] * len(vocabulary) + place[hit])
                totals += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int64()), pa.array([n, *totals[at].tolist()], pa.int64())], names=["place", "n"])

    sums = docs.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()  # one row per template word
    by_place = {r["place"]: r["n"] for r in sums}
    return {int(vocabulary[k]): n for k, n in by_place.items() if k >= 0}, by_place.get(-1, 0)


def license_scan(docs: DataFrame, templates: list[tuple[str, str, tuple[str, ...]]] | None = None, anchors: int = 6, least: float = 0.8) -> DataFrame:
    """Per document: n_words, places of base phrases, labels and the best template's weighted share.

    ``score`` is the highest share among the templates found; 0.5 where only a base phrase was, else 0.
    """
    templates = TEMPLATES if templates is None else templates
    texts = bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_column("text").alias("text"))
    vocabulary = np.unique(np.concatenate([hashed(t[1]) for t in templates]))
    index = Index(templates, *_template_word_counts(texts.select("text"), vocabulary), anchors)
    first_words = batch.HashSet(np.unique(np.array([p[0] for p, _ in index.phrases], np.uint64)))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            n_words, found = np.zeros(rows.num_rows, np.int64), {}
            for first, data, offsets in batch.runs(rows.column(1)):
                words = batch.words(data, offsets, inside=WORD_BYTES)
                hashes = words.hashes()
                n_words[first : first + len(offsets) - 1] = np.diff(words.first)
                known = index.anchors.places(hashes)
                hits = np.flatnonzero(known >= 0)
                begins = np.flatnonzero(first_words.places(hashes) >= 0)
                for row in np.unique(np.searchsorted(words.first, np.concatenate([hits, begins]), "right") - 1).tolist():
                    a, b = words.first[row], words.first[row + 1]
                    mine = hits[np.searchsorted(hits, a) : np.searchsorted(hits, b)]
                    found[first + row] = index.scan(hashes[a:b], mine - a, known[mine], least)
            none = ([], set(), set(), 0.0)
            every = [found.get(k, none) for k in range(rows.num_rows)]
            columns = [
                rows.column(0),
                n_words,
                [len(x[0]) for x in every],
                [min(x[0], default=None) for x in every],
                [max(x[0], default=None) for x in every],
                [",".join(sorted(x[1])) for x in every],
                [",".join(sorted(x[2])) for x in every],
                [round(x[3], 9) for x in every],
            ]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    return texts.mapInArrow(scanned, SCHEMA)
