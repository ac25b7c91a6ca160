"""Licence scans: a trained classifier of text units, confirmed against notices.

A unit is a sentence or line of a document, as lower-case words. Its hashed word
n-grams (one to three words) go through a multinomial logistic regression whose
classes are licence families and ``unknown``. Positive examples are pieces and
variants of the families' notices below; the unknown class is learned from units
of the corpus itself and from the notices' words in disorder. A temperature
fitted on examples kept aside calibrates the probabilities.

A unit whose likeliest class is a family, with probability of at least
``min_probability``, is reported; it is confirmed if enough of its word pairs
stand in the family's notices.

Training reads whole texts of about ``background_documents`` documents, chosen
by a hash of the id, and takes every unit of them up to ``background_units``
(the smallest by hash); both bounds concern training only.

Defined results: null and empty texts have no units; every row is scanned as it
is; the same unit gets the same answer in every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.words import ALNUM, LOWER, Words, slices, window_hashes

UNKNOWN = "unknown"
GRAMS = 3
BUCKET_BITS = 18
MIN_PROBABILITY = 0.5
MIN_OVERLAP = 0.4
BACKGROUND_DOCUMENTS = 1500
BACKGROUND_UNITS = 20_000
VARIANTS = 250
EPOCHS = 60

# The wording of licence notices, by family.
NOTICES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "This project is released under the Apache License 2.0. SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License. SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY-NC-SA 4.0. Creative Commons Attribution NonCommercial ShareAlike",
        "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",
        "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/",
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU Lesser General Public License, version 2.1. SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GNU Affero General Public License, version 3.",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction.",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.",
        "Released under the MIT License. SPDX-License-Identifier: MIT",
        "Licensed under the MIT License.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
        "Released under the Mozilla Public License, version 2.0. SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright (c) 2020 The Company. All rights reserved.",
        "This document is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
    ),
    "public_domain": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, for any purpose, commercial or non-commercial, and by any means.",
        "This work has been released into the public domain. The Unlicense",
    ),
}

# Sentences that use the words of notices for something else.
OTHER_USES = (
    "She renewed her driving license at the public office.",
    "The software update was released on Monday.",
    "You may copy the recipe from the book.",
    "All rooms are reserved for tonight.",
    "The general public was invited to the free concert.",
    "He gave permission to use the garden.",
    "Version 3 of the report is under review.",
    "The work was distributed among all members.",
    "They reserved the right to refuse service.",
    "Creative writing and common sense are required.",
)


class Units:
    """Sentences and lines of texts: unit ``u`` has the words ``begin[u]`` to ``begin[u + 1]`` of ``words``; ``first[r]`` stand before row ``r``."""

    def __init__(self, texts: pa.Array):
        self.words = w = Words(texts, ALNUM, LOWER)
        blank = np.zeros(256, dtype=bool)
        blank[[0x20, *range(0x09, 0x0E)]] = True
        stop = np.zeros(len(w.data), dtype=bool)
        stop[:-1] = np.isin(w.data[:-1], np.frombuffer(b".!?", dtype=np.uint8)) & blank[w.data[1:]]
        stop |= w.data == 0x0A
        before = np.concatenate([[0], np.cumsum(stop)])
        new = np.ones(len(w), dtype=bool)
        new[1:] = (before[w.end[:-1]] != before[w.start[1:]]) | (w.row[1:] != w.row[:-1])
        self.begin = np.append(np.flatnonzero(new), len(w))
        self.row = w.row[self.begin[:-1]]
        self.first = np.searchsorted(self.row, np.arange(len(w.first)))

    def __len__(self) -> int:
        return len(self.begin) - 1

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(unit, bucket) of every n-gram, by unit."""
        hashes = self.words.hashes()
        size = np.diff(self.begin)
        unit = np.repeat(np.arange(len(self)), size)
        left = np.repeat(self.begin[1:], size) - np.arange(len(hashes))
        units, buckets = [], []
        for n in range(1, GRAMS + 1):
            at = np.flatnonzero(left >= n)
            units.append(unit[at])
            buckets.append((window_hashes(hashes, at, n, n) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        units, buckets = np.concatenate(units), np.concatenate(buckets)
        order = np.argsort(units, kind="stable")
        return units[order], buckets[order]

    def text(self, unit: int) -> str:
        return self.words.text(self.begin[unit], self.begin[unit + 1]).decode()


def pairs(words: str) -> set[tuple[str, ...]]:
    """Word pairs of a unit (or its one word)."""
    split = words.split()
    return {tuple(split[i : i + 2]) for i in range(max(1, len(split) - 1))} if split else set()


def plain(text: str) -> str:
    return " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower()))


FAMILIES = sorted(NOTICES)
CLASSES = [*FAMILIES, UNKNOWN]
_PAIRS = {f: set().union(*(pairs(plain(n)) for n in NOTICES[f])) for f in FAMILIES}


def overlap(unit: str, family: str) -> float:
    """Share of the unit's word pairs that the family's notices have."""
    own = pairs(unit)
    return len(own & _PAIRS[family]) / len(own) if own else 0.0


@dataclass
class Model:
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, unit: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        """Class scores of ``n`` units, each of which has an n-gram."""
        at = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]])) if len(unit) else np.zeros(0, dtype=np.int64)
        size = np.diff(np.append(at, len(unit)))
        out = np.tile(self.bias, (n, 1))
        if len(at):
            out[unit[at]] += np.add.reduceat(self.weights[bucket], at, axis=0) / np.sqrt(size)[:, None]
        return out / self.temperature

    def probabilities(self, unit: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        z = self.logits(unit, bucket, n)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def examples(seed: int = 7) -> tuple[list[str], np.ndarray]:
    """Pieces and variants of notices with their class numbers, and notices' words in disorder as unknown."""
    rng = np.random.default_rng(seed)
    filler = "the of project file author see www com 2019 2023 inc team code data text".split()
    texts, classes = [], []
    for number, family in enumerate(FAMILIES):
        units = [u for n in NOTICES[family] for u in re.split(r"(?<=[.!?;:])\s+", n)]
        for u in units:
            texts.append(plain(u))
            classes.append(number)
        for _ in range(VARIANTS):
            words = plain(units[rng.integers(len(units))]).split()
            if len(words) > 8 and rng.random() < 0.5:  # as in wrapped lines
                a = int(rng.integers(0, len(words) - 6))
                words = words[a : a + int(rng.integers(6, 14))]
            keep = rng.random(len(words)) > 0.05
            words = [w for w, k in zip(words, keep) if k]
            for _ in range(int(rng.integers(0, 3))):
                words.insert(int(rng.choice([0, len(words)])), filler[rng.integers(len(filler))])
            texts.append(" ".join(words))
            classes.append(number)
            if rng.random() < 0.4:
                mixed = list(words)
                rng.shuffle(mixed)
                texts.append(" ".join(mixed[: int(rng.integers(3, 8))]))
                classes.append(len(FAMILIES))
    texts += [plain(s) for s in OTHER_USES] * 3
    classes += [len(FAMILIES)] * 3 * len(OTHER_USES)
    return texts, np.array(classes)


def train(background: list[str], seed: int = 7) -> Model:
    """Fit on notices and on units of the corpus (as plain words) that do not resemble them."""
    texts, classes = examples(seed)
    other = [u for u in background if u and max(overlap(u, f) for f in FAMILIES) < MIN_OVERLAP / 2]
    texts, classes = [*texts, *other], np.concatenate([classes, np.full(len(other), len(FAMILIES))])
    some = np.array([bool(t) for t in texts])
    texts, classes = [t for t, s in zip(texts, some) if s], classes[some]
    u = Units(pa.array(texts, pa.large_string()))
    unit, bucket = u.features()
    apart = np.random.default_rng(seed + 1).random(len(texts)) < 0.2
    k = len(CLASSES)
    target = np.eye(k)[classes]
    weight = np.where(apart, 0.0, 1.0 / np.sqrt(np.bincount(classes, minlength=k)[classes]))
    weight /= weight.sum()
    model = Model(np.zeros((1 << BUCKET_BITS, k)), np.zeros(k), 1.0)
    used, compact = np.unique(bucket, return_inverse=True)
    scale = 1 / np.sqrt(np.bincount(unit, minlength=len(texts)))
    by_feature = np.argsort(compact, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], compact[by_feature][1:] != compact[by_feature][:-1]]))
    speed = np.full((len(used), k), 1e-8)
    speed_bias = np.full(k, 1e-8)
    for _ in range(EPOCHS):
        error = (model.probabilities(unit, bucket, len(texts)) - target) * weight[:, None]
        slope = np.add.reduceat((error * scale[:, None])[unit[by_feature]], edges, axis=0) + 1e-6 * model.weights[used]
        speed += slope**2
        model.weights[used] -= 0.5 * slope / np.sqrt(speed)
        speed_bias += error.sum(axis=0) ** 2
        model.bias -= 0.1 * error.sum(axis=0) / np.sqrt(speed_bias)
    z = model.logits(unit, bucket, len(texts))[apart]
    if len(z):
        def loss(t: float) -> float:
            s = z / t
            s = s - s.max(axis=1, keepdims=True)
            return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), classes[apart]]).mean())

        model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=loss)
    model.weights = model.weights.astype(np.float32)
    return model


def background(docs: DataFrame, *, key: str = "doc_id", text: str = "text", documents: int = BACKGROUND_DOCUMENTS, units: int = BACKGROUND_UNITS) -> list[str]:
    """Distinct units of about so many documents, as plain words."""
    total = max(1, docs.count())
    dice = F.coalesce(F.pmod(F.xxhash64(key), F.lit(1 << 30)) / float(1 << 30), F.lit(1.0))
    share = documents / total

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                u = Units(part.column("text"))
                yield pa.record_batch({"unit": pa.array(sorted({u.text(i) for i in range(len(u))}), pa.string())})

    rows = docs.filter(dice < share).select(F.col(text).alias("text")).mapInArrow(cut, "unit string").distinct()
    return [r["unit"] for r in rows.orderBy(F.xxhash64("unit"), "unit").limit(units).collect()]


FOUND = pa.struct([("unit", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("overlap", pa.float64()), ("confirmed", pa.bool_())])


def scan(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", min_probability: float = MIN_PROBABILITY, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``key, n_units, found``: in every document, the units taken for a licence notice."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                u = Units(part.column("text"))
                found: list[list[dict]] = [[] for _ in range(part.num_rows)]
                if len(u):
                    p = shared.value.probabilities(*u.features(), len(u))
                    best = p.argmax(axis=1)
                    for i in np.flatnonzero((best < len(FAMILIES)) & (p.max(axis=1) >= min_probability)):
                        family = CLASSES[best[i]]
                        shares = overlap(u.text(i), family)
                        row = int(u.row[i])
                        found[row].append(
                            {
                                "unit": int(i - u.first[row]),
                                "family": family,
                                "probability": round(float(p[i, best[i]]), 6),
                                "overlap": shares,
                                "confirmed": shares >= min_overlap,
                            }
                        )
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(np.diff(u.first).astype(np.int64)), pa.array(found, pa.list_(FOUND))],
                    names=["key", "n_units", "found"],
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_units long, found array<struct<unit:long,family:string,probability:double,overlap:double,confirmed:boolean>>"
    return rows.mapInArrow(look, schema).withColumnRenamed("key", key)


def train_and_scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    return scan(docs, train(background(docs, key=key, text=text)), key=key, text=text)
