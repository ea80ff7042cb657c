"""Licence scan by a trained paragraph classifier.

1. The templates below, cut to windows and thinned at random, and about
   ``SAMPLE`` paragraphs, drawn by a hash over the paragraphs of all documents
   wherever they stand, are the training set.  A drawn paragraph is used whole;
   of one longer than ``LONGEST`` characters a window of that length at a
   hashed place is, so that the driver holds a bounded sample.  This is the
   only sampled step.
2. Features are the word 1- to 3-grams of the templates; a multinomial
   logistic regression over these sparse rows, with one class for everything
   that is no licence, is trained by gradient descent.
3. On held-out rows a temperature calibrates the probabilities, and the
   threshold below which a paragraph is unknown is set so that no more than
   one in a thousand held-out ordinary paragraphs passes.
4. Every paragraph (line) of every document is classified where it is: the
   model is a few megabytes and documents are independent, so nothing is
   shuffled.  A prediction counts as confirmed if the paragraph holds a large
   part of a template of that family, word pair by word pair.

Defined cases: null or empty text has no paragraphs; a paragraph of any length
is read whole; repeated rows are answered each; other columns are not read;
with an empty table only the templates are learnt from.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.llm.common import about, map_batches, register, table, text_column

SAMPLE, LONGEST = 4800, 20_000
PASSES, RATE, DECAY = 60, 0.5, 1e-5
CONFIRM = 0.6
UNKNOWN = "unknown"

# Usual short notices by SPDX family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the 2-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: redistributions of source code must retain the above copyright notice.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
}
FAMILIES = tuple(TEMPLATES) + (UNKNOWN,)
#: letters and digits of a paragraph, lower-cased; all else separates words
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(paragraph: str) -> list[bytes]:
    return paragraph.encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Scanner:
    """Vocabulary, n-gram features, weights, temperature and threshold."""

    def __init__(self):
        self.vocab: dict[bytes, int] = {}
        for texts in TEMPLATES.values():
            for t in texts:
                for w in words(t):
                    self.vocab.setdefault(w, len(self.vocab) + 1)
        self.base = len(self.vocab) + 1
        grams = [self._grams(self.numbers(words(t)))[1] for texts in TEMPLATES.values() for t in texts]
        self.grams = np.unique(np.concatenate(grams))
        self.weights = np.zeros((len(self.grams) + 1, len(FAMILIES)))
        self.temperature, self.threshold = 1.0, 0.5
        pairs = lambda t: {tuple(p) for p in zip(words(t), words(t)[1:])}
        self.pairs = {f: [pairs(t) for t in texts] for f, texts in TEMPLATES.items()}

    @classmethod
    def of(cls, state: dict) -> Scanner:
        s = cls.__new__(cls)
        s.__dict__.update(state)
        return s

    def numbers(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocab.get, ws, repeat(0)), dtype=np.int64, count=len(ws))

    def _grams(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and codes of the 1- to 3-grams of known words; a 0 in
        ``x`` (unknown word, end of paragraph) is in none."""
        at, code = [np.flatnonzero(x)], [x[x > 0]]
        for k in (1, 2):
            if len(x) > k:
                parts = [x[i:len(x) - k + i] for i in range(k + 1)]
                ok = np.flatnonzero(np.all([p > 0 for p in parts], axis=0))
                value = np.zeros(len(ok), dtype=np.int64)
                for p in parts:
                    value = value * self.base + p[ok]
                at.append(ok)
                code.append(value)
        return np.concatenate(at), np.concatenate(code)

    def rows(self, paragraphs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sparse rows: paragraph, feature (the last one is the constant)
        and value; values of a row have length one beside the constant."""
        size = np.array([len(p) + 1 for p in paragraphs], dtype=np.int64)
        x = self.numbers([w for p in paragraphs for w in (*p, b"")])
        owner = np.repeat(np.arange(len(paragraphs)), size)
        at, code = self._grams(x)
        f = np.minimum(np.searchsorted(self.grams, code), len(self.grams) - 1)
        ok = self.grams[f] == code
        cell = np.unique(owner[at[ok]] * len(self.grams) + f[ok])
        row, feature = cell // len(self.grams), cell % len(self.grams)
        known = np.bincount(row, minlength=len(paragraphs))
        # a row's weight is spread over its n-grams and all its words, known or not
        scale = 1 / np.sqrt(np.maximum(known + 2.0 * (size - 1 - np.bincount(owner[x > 0], minlength=len(paragraphs))), 1))
        n = len(paragraphs)
        return (np.concatenate([row, np.arange(n)]), np.concatenate([feature, np.full(n, len(self.grams))]),
                np.concatenate([3 * scale[row], np.ones(n)]))

    def logits(self, rows, n: int) -> np.ndarray:
        r, f, v = rows
        return np.stack([np.bincount(r, weights=v * self.weights[f, k], minlength=n) for k in range(len(FAMILIES))], axis=1)

    def probabilities(self, paragraphs: list[list[bytes]]) -> np.ndarray:
        z = self.logits(self.rows(paragraphs), len(paragraphs)) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def similarity(self, family: str, ws: list[bytes]) -> float:
        """The largest part of a template's word pairs, or of the
        paragraph's, that both have."""
        mine, best = set(zip(ws, ws[1:])), 0.0
        for t in self.pairs.get(family, ()):
            common = len(mine & t)
            best = max(best, common / len(t), common / max(len(mine), 4))
        return best

    def train(self, ordinary: list[list[bytes]], seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        examples: list[tuple[list[bytes], int]] = []
        for k, f in enumerate(FAMILIES[:-1]):
            for t in TEMPLATES[f]:
                ws = words(t)
                for turn in range(24):
                    # whole, or a long window of a long template; some words changed
                    cut, part = 0, len(ws)
                    if turn % 2 and len(ws) > 16:
                        part = int(rng.integers(12, len(ws)))
                        cut = int(rng.integers(0, len(ws) - part + 1))
                    kept = [w if rng.random() > 0.04 * (turn > 0) else b"*" for w in ws[cut:cut + part]]
                    around = [[b"*"] * int(rng.integers(0, 6)) if turn > 3 else [] for _ in range(2)]
                    examples.append((around[0] + kept + around[1], k))
        known = [w for w in self.vocab]
        for _ in range(600):  # the same words without their order, and in passing
            n = int(rng.integers(3, 30))
            examples.append(([known[int(i)] if rng.random() < 0.4 else b"*" for i in rng.integers(0, len(known), n)], len(FAMILIES) - 1))
        ordinary = [p for p in ordinary if p and max(self.similarity(f, p) for f in FAMILIES[:-1]) < 0.3]
        examples += [(p, len(FAMILIES) - 1) for p in ordinary] + [([b"*"] * n, len(FAMILIES) - 1) for n in (1, 5, 50)] * 10
        order = rng.permutation(len(examples))
        held, used = [examples[i] for i in order[::5]], [examples[i] for i in order if i not in set(order[::5].tolist())]
        rows, y = self.rows([p for p, _ in used]), np.array([k for _, k in used])
        r, f, v = rows
        target = np.eye(len(FAMILIES))[y]
        squares = np.full_like(self.weights, 1e-6)
        for _ in range(PASSES):
            z = self.logits(rows, len(used))
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = z / z.sum(axis=1, keepdims=True) - target
            grad = DECAY * self.weights
            for k in range(len(FAMILIES)):
                grad[:, k] += np.bincount(f, weights=v * error[r, k], minlength=len(self.weights)) / len(used)
            squares += grad * grad
            self.weights -= RATE * grad / np.sqrt(squares)
        z, t = self.logits(self.rows([p for p, _ in held]), len(held)), np.array([k for _, k in held])

        def loss(temperature):
            u = z / temperature
            u -= u.max(axis=1, keepdims=True)
            return (np.log(np.exp(u).sum(axis=1)) - u[np.arange(len(t)), t]).mean()

        self.temperature = min(np.geomspace(0.2, 5, 40), key=loss)
        p = np.exp(z / self.temperature - (z / self.temperature).max(axis=1, keepdims=True))
        best = (p / p.sum(axis=1, keepdims=True))[:, :-1].max(axis=1)[t == len(FAMILIES) - 1]
        self.threshold = float(np.clip(np.quantile(best, 0.999) if len(best) else 0.5, 0.5, 0.95))


def paragraphs(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` paragraphs (at most twice as many) of all of ``docs``."""
    lines = docs.select("doc_id", F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("at", "line")).where(F.trim("line") != "")
    drawn = about(lines, sample, F.col("doc_id").cast("string"), "at", "line")
    place = F.pmod(F.xxhash64("line"), F.greatest(F.length("line") - LONGEST, F.lit(1))).cast("int") + 1
    return drawn.select(F.when(F.length("line") > LONGEST, F.substr("line", place, F.lit(LONGEST))).otherwise(F.col("line")).alias("line"))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Scanner:
    """A scanner trained on the templates and a bounded sample of ``docs``."""
    scanner = Scanner()
    scanner.train([words(r.line) for r in paragraphs(docs, sample).orderBy("line").collect()])
    return scanner


def find_licences(docs: DataFrame, scanner: Scanner, confirm: float = CONFIRM) -> DataFrame:
    """``doc_id``, ``n_paragraphs`` and ``found``: paragraph number, family,
    probability, similarity and confirmed of every predicted paragraph."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(scanner))

    def fn(batch: pa.RecordBatch):
        s = Scanner.of(shared.value)
        count, found = [], []
        paragraphs, place = [], []

        def flush():
            if not paragraphs:
                return
            p = s.probabilities(paragraphs)
            best = p[:, :-1].argmax(axis=1)
            for i in np.flatnonzero(p[np.arange(len(p)), best] >= s.threshold).tolist():
                family = FAMILIES[best[i]]
                like = s.similarity(family, paragraphs[i])
                found[place[i][0]].append({"paragraph": place[i][1], "family": family, "probability": float(p[i, best[i]]),
                                           "similarity": like, "confirmed": like >= confirm})
            paragraphs.clear()
            place.clear()

        held = 0
        for d, t in enumerate(text_column(batch, "text")):
            lines = t.split("\n") if t else []
            count.append(sum(1 for x in lines if x.strip()))
            found.append([])
            for k, x in enumerate(lines):
                ws = words(x)
                if ws:
                    paragraphs.append(ws)
                    place.append((d, k))
                    held += len(ws)
                if held > 500_000:
                    flush()
                    held = 0
        flush()
        yield {"doc_id": batch.column(0), "n_paragraphs": count, "found": found}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), fn,
                       "doc_id long, n_paragraphs long, found array<struct<paragraph:long,family:string,probability:double,"
                       "similarity:double,confirmed:boolean>>")


@register("op5_licences")
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.filter("found", lambda x: x["confirmed"])
    name = lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"])
    return find_licences(docs, fit(docs)).select(
        "doc_id", "n_paragraphs", F.size(found).cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform(found, name), ",").alias("paragraphs"),
        F.size(F.filter("found", lambda x: ~x["confirmed"])).cast("long").alias("n_unconfirmed"))
