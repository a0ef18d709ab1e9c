"""Licence scan by a trained paragraph classifier.

A paragraph is a line; long ones are read in pieces of ``PIECE`` words that overlap by half.  Features are
hashed word unigrams and bigrams.  A softmax regression over the licence families, an
``unknown`` class (licence-like, of no family here) and ``none`` is trained on notices made from templates, whole and
short forms, and on a bounded sample of paragraphs of the documents.  A part of both is held out: it sets the temperature of the
probabilities and the least probability of a family at which at most ``WRONG`` of the family
predictions are wrong; less certain licence-like pieces are ``unknown``.  A family is confirmed if the piece
agrees with one of its templates in word shingles; a prediction that no template confirms becomes ``unknown``.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolattice.llm.common import keyed, map_texts
from echolattice.llm.prefix_decontam import LOWER, BETWEEN
from echolattice.llm.textarrays import Spans, mix, text_bytes, word_bounds, word_units

#: Notices by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "bsd-3-clause": (
        "Distributed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "cc-by-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0-1.0": ("Released into the public domain under CC0 1.0.",),
    "gpl-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License, version 2.",
    ),
    "lgpl-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ),
    "agpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU Affero General Public License, version 3.",
    ),
    "bsd-2-clause": ("Distributed under the BSD 2-Clause License.", "This project is licensed under the terms of the BSD 2-Clause Simplified License."),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "bsl-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software.",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
}
#: Identifiers that short forms name a family by, where they differ from its name here.
IDENTIFIERS = {"gpl-2.0": ("GPL-2.0-only", "GPL-2.0-or-later"), "gpl-3.0": ("GPL-3.0-only", "GPL-3.0-or-later"), "lgpl-2.1": ("LGPL-2.1-only", "LGPL-2.1-or-later"), "agpl-3.0": ("AGPL-3.0-only", "AGPL-3.0-or-later")}
TEMPLATES = {family: (*own, *(f"SPDX-License-Identifier: {name}" for name in IDENTIFIERS.get(family, (family,)))) for family, own in TEMPLATES.items()}
#: Licence-like notices of no family.
OTHERS = (
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "This software is provided as is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "This package may be used, distributed and modified under the terms of the Artistic License 2.0.",
    "SPDX-License-Identifier: LicenseRef-Proprietary",
    "Licensed under the European Union Public Licence, version 1.2.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, subject to the restrictions below.",
    "All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher.",
    "This software is proprietary and confidential; unauthorized copying is strictly prohibited.",
    "Use of this material is subject to the terms of the license agreement that came with it.",
    "Licensed under the terms found in the license file.",
    "Copyright by the authors. Licensed for personal use only.",
    "Distributed under a custom license; ask the owner for permission.",
)
FAMILIES = tuple(TEMPLATES)
UNKNOWN, NONE = len(FAMILIES), len(FAMILIES) + 1
#: Places of hashed features, words of a piece, words of a shingle, and share of shingles that confirms a family.
FEATURES, PIECE, SHINGLE, AGREE = 1 << 14, 64, 5, 0.8
#: Bounds of the training sample: documents and paragraphs of the corpus, notices made of each template.
SAMPLE_DOCUMENTS, SAMPLE_PARAGRAPHS, MADE = 300, 2500, 60
#: Share of wrong family predictions at the threshold, on held-out notices and paragraphs.
WRONG, STEPS = 0.01, 120


def _pieces(column: pa.Array):
    """Words of texts and their pieces: units, first and end word, paragraph (numbered over all texts), and text of each piece."""
    data, offsets = text_bytes(column)
    line = np.cumsum(data == 10)
    starts, ends, firsts = word_bounds(LOWER[data], offsets, BETWEEN)
    units = word_units(LOWER[data], starts, ends)
    text = np.repeat(np.arange(len(column)), np.diff(firsts))
    where = line[starts] if len(starts) else starts
    begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(starts)), dtype=bool), (where[1:] != where[:-1]) | (text[1:] != text[:-1])]))
    end = np.append(begin[1:], len(starts))[: len(begin)]
    parts = np.maximum(1, -(-(end - begin - PIECE) // (PIECE // 2)) + 1)
    paragraph = np.repeat(np.arange(len(begin)), parts)
    first = begin[paragraph] + (np.arange(len(paragraph)) - np.repeat(np.cumsum(parts) - parts, parts)) * (PIECE // 2)
    return units, first, np.minimum(first + PIECE, end[paragraph]), paragraph, text[begin][paragraph]


def _features(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of each word and of each pair of neighbours."""
    pairs = mix(units[:-1] * np.uint64(0x9E3779B97F4A7C15) + units[1:], 9)
    return (mix(units, 10) % np.uint64(FEATURES)).astype(np.int64), (pairs % np.uint64(FEATURES)).astype(np.int64)


def _logits(weights: np.ndarray, bias: np.ndarray, units: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    ones, twos = _features(units)
    sums = lambda at: np.concatenate([np.zeros((1, weights.shape[1])), np.cumsum(weights[at], axis=0, dtype=np.float64)])
    one, two = sums(ones), sums(twos)
    n = 2 * (end - first) - 1
    return (one[end] - one[first] + two[end - 1] - two[first]) / np.sqrt(n)[:, None] + bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _shingles(units: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    size = min(size, len(units))
    at = np.arange(len(units) - size + 1)
    return np.unique(mix(Spans(units).of(at, at + size), size))


class Classifier:
    """Trained on the driver, on a sample of bounded size."""

    def __init__(self, paragraphs: list[str]):
        words = [[_pieces(pa.array([t]))[0] for t in own] for own in TEMPLATES.values()]
        self.templates = [[(min(SHINGLE, len(w)), _shingles(w)) for w in own] for own in words]
        r = random.Random(8)
        filler = [w for p in paragraphs[:200] for w in p.split()] or ["word"]
        texts, classes = [], []
        for c, own in enumerate([*TEMPLATES.values(), OTHERS]):
            for template in own:
                for k in range(MADE):
                    words = template.split()
                    for _ in range(r.randint(0, 1 + len(words) // 8) if k else 0):
                        at = r.randrange(len(words))
                        words[at : at + r.randint(0, 1)] = r.choices(filler, k=r.randint(0, 1))
                    if k % 3 == 1:
                        words = r.choices(filler, k=r.randint(1, 12)) + words
                    if k % 3 == 2:
                        words += r.choices(filler, k=r.randint(1, 12))
                    texts.append(" ".join(words) or template)
                    classes.append(c)
        known = np.unique(np.concatenate([s for own in self.templates for _, s in own]))
        for p in paragraphs:
            units = _pieces(pa.array([p]))[0]
            if len(units) and not np.isin(_shingles(units), known).any():
                texts.append(p)
                classes.append(NONE)
        units, first, end, _, text = _pieces(pa.array(texts))
        label = np.array(classes)[text]
        held = np.array([r.random() < 0.3 for _ in texts])[text]
        self._train(units, first[~held], end[~held], label[~held])
        self._calibrate(_logits(self.weights, self.bias, units, first[held], end[held]), label[held])

    def _train(self, units, first, end, label) -> None:
        ones, twos = _features(units)
        count = end - first
        unroll = lambda n: (np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), np.repeat(np.arange(len(n)), n))
        (at1, row1), (at2, row2) = unroll(count), unroll(count - 1)
        place, row = np.concatenate([ones[at1], twos[at2]]), np.concatenate([row1, row2])
        scale = 1 / np.sqrt(2 * count - 1)
        k = NONE + 1
        weights, bias = np.zeros((FEATURES, k)), np.zeros(k)
        seen, seen_bias = np.full((FEATURES, k), 1e-6), np.full(k, 1e-6)
        # Every class has the same weight as a whole.
        share = np.bincount(label, minlength=k)[label]
        target = np.eye(k)[label]
        for _ in range(STEPS):
            logits = np.stack([np.bincount(row, weights=weights[place, c], minlength=len(label)) for c in range(k)], axis=1) * scale[:, None] + bias
            error = (_softmax(logits) - target) / (share * k)[:, None]
            scaled = error * scale[:, None]
            gradient = np.stack([np.bincount(place, weights=scaled[row, c], minlength=FEATURES) for c in range(k)], axis=1) + 1e-6 * weights
            seen += gradient**2
            seen_bias += error.sum(axis=0) ** 2
            weights -= 0.3 * gradient / np.sqrt(seen)
            bias -= 0.3 * error.sum(axis=0) / np.sqrt(seen_bias)
        self.weights, self.bias = weights.astype(np.float32), bias

    def _calibrate(self, logits: np.ndarray, label: np.ndarray) -> None:
        def loss(t: float) -> float:
            return -np.log(np.maximum(_softmax(logits / t)[np.arange(len(label)), label], 1e-300)).mean() if len(label) else 0.0

        self.temperature = min((2 ** (x / 4) for x in range(-16, 17)), key=loss)
        p = _softmax(logits / self.temperature)
        best, sure = p.argmax(axis=1), p.max(axis=1)
        family = best < UNKNOWN
        order = np.argsort(-sure[family])
        wrong = np.cumsum((best != label)[family][order]) / (1 + np.arange(len(order)))
        allowed = np.flatnonzero(wrong <= WRONG)
        self.threshold = float(sure[family][order][allowed[-1]]) if len(allowed) else 1.0

    def classify(self, column: pa.Array):
        """Paragraph and text of every piece, its class (a family, ``UNKNOWN`` or ``NONE``) and its probability of a licence."""
        units, first, end, paragraph, text = _pieces(column)
        if not len(first):
            return paragraph, text, paragraph, paragraph.astype(float)
        p = _softmax(_logits(self.weights, self.bias, units, first, end) / self.temperature)
        best = p.argmax(axis=1)
        for i in np.flatnonzero(best < UNKNOWN):
            if p[i, best[i]] < self.threshold or not self.confirmed(units[first[i] : end[i]], best[i]):
                best[i] = UNKNOWN
        return paragraph, text, best, 1 - p[:, NONE]

    def confirmed(self, units: np.ndarray, family: int) -> bool:
        """A template of the family lies in the piece, or the piece in a template, to ``AGREE`` of the shingles."""
        for size, t in self.templates[family]:
            own = _shingles(units, size)  # short templates have short shingles
            if np.isin(t, own).sum() >= AGREE * min(len(t), len(own)):
                return True
        return False


def scan(docs: DataFrame) -> DataFrame:
    """Per input row: doc_id, n_paragraphs (lines with a word), n_licensed, n_unknown, families (sorted array), licence_probability.

    ``docs``: doc_id, text (null: empty).  ``n_licensed`` counts paragraphs with a confirmed family, ``n_unknown`` others
    with a licence-like piece; ``licence_probability`` is the greatest of any piece, null without words.  Repeated rows
    get the same result.  Other columns are ignored; an empty table gives no rows.
    """
    ids = [r[0] for r in docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS).collect()]
    lines = docs.where(F.col("doc_id").isin(ids)).select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line")).where("trim(line) <> ''")
    sample = [r[0] for r in lines.distinct().orderBy(F.xxhash64("line"), "line").limit(SAMPLE_PARAGRAPHS).collect()]
    given = docs.sparkSession.sparkContext.broadcast(Classifier(sample))

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        paragraph, text, best, sure = given.value.classify(batch.column("text"))
        n = len(batch)
        _, first = np.unique(paragraph, return_index=True)
        paragraphs = np.bincount(text[first], minlength=n)
        licensed, unknown, families = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), [set() for _ in range(n)]
        done: dict[int, bool] = {}
        for i in np.flatnonzero(best != NONE):
            families[text[i]] |= {FAMILIES[best[i]]} if best[i] < UNKNOWN else set()
            done[int(paragraph[i])] = done.get(int(paragraph[i]), False) | bool(best[i] < UNKNOWN)
        for p, named in done.items():
            (licensed if named else unknown)[text[first[p]]] += 1
        top = np.full(n, -1.0)
        np.maximum.at(top, text, sure)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(paragraphs.astype(np.int64)), pa.array(licensed), pa.array(unknown),
             pa.array([sorted(f) for f in families], pa.list_(pa.string())), pa.array(top, mask=top < 0)],
            names=["doc_id", "n_paragraphs", "n_licensed", "n_unknown", "families", "licence_probability"],
        )

    return map_texts(keyed(docs), rows, "doc_id long, n_paragraphs long, n_licensed long, n_unknown long, families array<string>, licence_probability double")
