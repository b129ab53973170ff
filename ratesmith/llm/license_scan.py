"""Licence scan: a trained paragraph classifier names licence families, templates confirm them.

A multinomial logistic regression over hashed word n-grams is fitted on varied templates and on plain paragraphs of the corpus.
Lines and word windows of every paragraph of a text are its units, so that a notice inside long prose isn't diluted. A unit that the
calibrated classifier takes for a licence is compared with the family's templates; what they don't confirm is an unknown licence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, small_batches, table
from .shingles import NOT_LOWER_ALNUM, Words, mix, text_slices, windows, words

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
#: Words of a unit's windows; each window begins half a window after the one before.
WIDTHS = (16, 64)
#: Documents and units that the plain class is fitted on, at most.
SAMPLE_DOCUMENTS, SAMPLE_UNITS = 2_000, 4_000
#: Of each such document one unit and this share of the others; a unit of more characters is no example, all are scanned.
UNIT_SHARE, UNIT_CHARS = 0.02, 4_096
#: Varied copies of each template.
VARIANTS = 40
#: The share of plain units in the calibration part that may be taken for a licence.
FALSE_ALARMS = 0.001
#: The share of a family's right predictions in the calibration part that sets its least probability.
PRECISION = 0.99
#: The share of word pairs that a unit and a template must have in common.
CONFIRM = 0.6
#: The share of any template's word pairs, at least, in what is taken for an unknown licence: long runs of one word have none.
RESEMBLE = 0.2
SEED = 29
PLAIN, UNKNOWN = "plain", "unknown"

#: Notices and leading paragraphs of public licences.
TEMPLATES = {
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ],
    "CC-BY": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0": ["Released under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal"],
    "EPL": ["Licensed under the Eclipse Public License 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0"],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "Released under the GPL version 2 or later",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    ],
    "ISC": ["Released under the ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version",
    ],
    "MIT": [
        "Released under the MIT License",
        "This project is licensed under the terms of the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ],
    "MPL": ["Licensed under the Mozilla Public License 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"],
    "Unlicense": ["This is free and unencumbered software released into the public domain", "Released under the Unlicense"],
}
#: Plain sentences that share words with notices.
NEAR_MISSES = [
    "She renewed her driver's license before the long trip to the coast",
    "He studied at MIT and later worked on general public health policy",
    "The version of the story that was released last year is under review",
    "Permission to build the house was granted by the council on Monday",
    "The work was distributed among the members of the public library",
    "The Apache helicopter is subject to the terms of the treaty",
    "A fishing license is free of charge for any person under twelve",
    "The following conditions were met at the border in the winter",
]
FAMILIES = [PLAIN, *sorted(TEMPLATES)]


def cut_units(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and text of each unit: lines of up to the largest width, and windows of each width over each paragraph.

    A paragraph is a run of lines that aren't blank."""
    n = len(w.start)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    text = np.repeat(np.arange(len(w.first) - 1), w.counts())
    line = np.cumsum(w.data == 0x0A)[w.start]
    jump, other = np.diff(line), np.diff(text) > 0
    edges = lambda new: np.r_[0, np.flatnonzero(new) + 1, n]
    lines, paragraphs = edges(other | (jump > 0)), edges(other | (jump > 1))
    low, high = [lines[:-1]], [lines[1:]]
    for width in WIDTHS:
        size, step = np.diff(paragraphs), width // 2
        count = np.maximum(-(-(size - width) // step), 0) + 1
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        first = np.repeat(paragraphs[:-1], count) + at * step
        low.append(first)
        high.append(np.minimum(first + width, np.repeat(paragraphs[1:], count)))
    low, high = np.concatenate(low), np.concatenate(high)
    keep = high - low <= max(WIDTHS)
    pairs = np.unique(low[keep] * (n + 1) + high[keep])
    low, high = pairs // (n + 1), pairs % (n + 1)
    return low, high, text[low]


def _grams(w: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Order, bucket and first word of the n-grams of each order."""
    plain = w.hashes()
    for k in ORDERS:
        fps, _, at = windows(plain, w.first, k, seed=k)
        yield k, (fps % np.uint64(BUCKETS)).astype(np.int64), at


def _sums(w: Words, low: np.ndarray, high: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of each unit: the weights of its n-grams over the root of their number. Running sums serve all units that overlap."""
    out, total = np.zeros((len(low), weights.shape[1])), np.zeros(len(low))
    for k, bucket, at in _grams(w):
        running = np.zeros((len(w.start) + 1, weights.shape[1]))
        running[at + 1] = weights[bucket]
        np.cumsum(running, axis=0, out=running)
        end = np.maximum(high - k + 1, low)
        out += running[end] - running[low]
        total += end - low
    return out / np.sqrt(np.maximum(total, 1))[:, None]


def unit_words(w: Words, low: int, high: int) -> list[str]:
    """The unit's words, numbers as #."""
    found = (w.data[w.start[i] : w.end[i]].tobytes().decode(errors="replace") for i in range(low, high))
    return ["#" if x.isdigit() else x for x in found]


def _pairs_of(found: list[str]) -> frozenset[tuple[str, str]]:
    return frozenset(zip(found, found[1:], strict=False))


def _words_of(texts: list[str]) -> Words:
    return words(pa.array(texts, pa.string()), NOT_LOWER_ALNUM, lower=True)


_PAIRS: dict[str, list[frozenset]] = {}


def matches(found: list[str]) -> dict[str, tuple[int, float]]:
    """Of each family's best template: word pairs in common, and their share of the template's or, if it's a part of that, the unit's."""
    if not _PAIRS:
        for family, texts in TEMPLATES.items():
            w = _words_of(texts)
            _PAIRS[family] = [_pairs_of(unit_words(w, w.first[i], w.first[i + 1])) for i in range(len(texts))]
    mine, out = _pairs_of(found), {}
    for family, templates in _PAIRS.items():
        each = [(len(mine & t), max(len(mine & t) / len(t), len(mine & t) / len(mine) if len(mine) >= 6 else 0)) for t in templates] if mine else [(0, 0.0)]
        out[family] = max((x for x in each if x[1] >= CONFIRM), default=max(each, key=lambda x: x[1]))
    return out


@dataclass
class Model:
    """Weights of each n-gram bucket and family, and what calibration has found."""

    weights: np.ndarray
    bias: np.ndarray
    scale: float
    plain_below: float
    least: np.ndarray

    def chances(self, w: Words, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return softmax((_sums(w, low, high, self.weights) + self.bias) * self.scale)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _varied(plain: list[str], rng: np.random.Generator) -> Iterator[tuple[str, int]]:
    """Templates with words left out, other version numbers, parts of long ones, and plain words around them."""
    for family, texts in TEMPLATES.items():
        for template in texts:
            parts = template.split()
            for i in range(VARIANTS):
                own = [x if not x.strip("v.,").replace(".", "").isdigit() else f"{rng.integers(1, 5)}.{rng.integers(0, 2)}" for x in parts]
                if len(own) > 12:
                    size = int(rng.integers(10, len(own) + 1))
                    at = int(rng.integers(0, len(own) - size + 1))
                    own = own[at : at + size]
                    own = [x for x in own if rng.random() > 0.05]
                around = (plain[int(rng.integers(len(plain)))] if plain else "").split()
                left, right = (int(x) for x in rng.integers(0, 6, 2) * (i % 2))
                yield " ".join([*around[:left], *own, *around[len(around) - right :]]), FAMILIES.index(family)


def _sampled_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a few units of each document, chosen by a hash of their words, so that it doesn't matter how rows are dealt; those
    of a licence's words, and those of over UNIT_CHARS characters, are left out."""
    for batch in batches:
        for a, b in text_slices(batch):
            w = words(batch.column("text").slice(a, b - a), NOT_LOWER_ALNUM, lower=True)
            low, high, text = cut_units(w)
            h = w.hashes(SEED)
            draw = mix(h[low] ^ mix(h[high - 1] + (high - low).astype(np.uint64)) ^ mix(low.astype(np.uint64) - w.first[text].astype(np.uint64)))
            order = np.lexsort((low, draw, text))
            _, first = np.unique(text[order], return_index=True)
            chosen = np.unique(np.concatenate([order[first], np.flatnonzero(draw < np.uint64(int(UNIT_SHARE * 2**64)))]))
            found = [unit_words(w, low[i], high[i]) for i in chosen]
            found = [" ".join(x) for x in found if max(share for _, share in matches(x).values()) < CONFIRM / 2]
            yield pa.RecordBatch.from_arrays([pa.array([x for x in found if len(x) < UNIT_CHARS], pa.string())], ["unit"])


def _calibrated(logits: np.ndarray, label: np.ndarray) -> tuple[float, float, np.ndarray]:
    """The scale with the least log loss; the plain chance under which a unit is a licence; each family's least chance."""
    scales = np.geomspace(0.25, 16, 49)
    loss = [-np.log(np.maximum(softmax(logits * s)[np.arange(len(label)), label], 1e-12)).mean() for s in scales]
    scale = float(scales[int(np.argmin(loss))])
    chance = softmax(logits * scale)
    plain = np.sort(chance[label == 0, 0])
    below = min(0.5, float(plain[int(FALSE_ALARMS * len(plain))])) if len(plain) else 0.5
    best, least = chance[:, 1:].argmax(axis=1) + 1, np.full(len(FAMILIES), 0.5)
    for f in range(1, len(FAMILIES)):
        mine = np.flatnonzero((best == f) & (chance[:, 0] < below))
        order = mine[np.argsort(-chance[mine, f])]
        right = np.cumsum(label[order] == f) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(right >= PRECISION)
        least[f] = min(0.5, float(chance[order[good[-1]], f])) if len(good) else 0.5
    return scale, below, least


def fit(docs: DataFrame) -> Model:
    """Fit on varied templates, near misses and a bounded sample of the documents' units; three quarters train, a quarter calibrates.

    The sample is at most SAMPLE_UNITS units of SAMPLE_DOCUMENTS documents, both the least by a hash of their own.
    """
    spark = docs.sparkSession
    ids = saved(docs.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(SAMPLE_DOCUMENTS), "license_sample")
    # at most SAMPLE_DOCUMENTS ids are sent to all tasks
    some = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text").mapInArrow(_sampled_units, "unit string")
    plain = [r["unit"] for r in some.distinct().orderBy(F.xxhash64("unit"), "unit").limit(SAMPLE_UNITS).collect()]
    rng = np.random.default_rng(SEED)
    rows = [*((x, 0) for x in plain), *((x, 0) for x in NEAR_MISSES for _ in range(8)), *_varied(plain, rng)]
    w, label = _words_of([x for x, _ in rows]), np.array([y for _, y in rows])
    counted = [(np.searchsorted(w.first, at, "right") - 1, bucket) for _, bucket, at in _grams(w)]
    row, bucket = (np.concatenate(x) for x in zip(*counted, strict=True))
    pairs, n = np.unique(row * BUCKETS + bucket, return_counts=True)
    row, bucket = pairs // BUCKETS, pairs % BUCKETS
    value = n / np.sqrt(np.bincount(row, weights=n, minlength=len(rows)))[row]
    edge, held = np.searchsorted(row, np.arange(len(rows) + 1)), rng.random(len(rows)) < 0.25
    held[np.unique(label, return_index=True)[1]] = False  # each family has a row to train on
    vector = lambda i: Vectors.sparse(BUCKETS, bucket[edge[i] : edge[i + 1]].tolist(), value[edge[i] : edge[i + 1]].tolist())
    train = spark.createDataFrame([(float(label[i]), vector(i)) for i in np.flatnonzero(~held)], ["label", "features"])
    found = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=30, standardization=False).fit(train.coalesce(2))
    coefficients = found.coefficientMatrix.toArray()
    weights, bias = np.zeros((BUCKETS, len(FAMILIES))), np.full(len(FAMILIES), -30.0)
    weights[:, : coefficients.shape[0]], bias[: coefficients.shape[0]] = coefficients.T, found.interceptVector.toArray()
    out = _sums(w, w.first[:-1], w.first[1:], weights) + bias
    return Model(weights.astype(np.float32), bias, *_calibrated(out[held], label[held]))


def _merged(hits: list[tuple[int, int, str, float, float]]) -> list[tuple[int, int, str, float, float]]:
    """Spans of one family that overlap as one; unknown ones where no family was confirmed."""
    out: list[list] = []
    for low, high, family, chance, share in sorted(hits, key=lambda x: (x[2] == UNKNOWN, x[2], x[0], x[1])):
        if out and out[-1][2] == family and low < out[-1][1]:
            out[-1] = [out[-1][0], max(high, out[-1][1]), family, max(chance, out[-1][3]), max(share, out[-1][4])]
        elif family != UNKNOWN or not any(low < x[1] and x[0] < high for x in out):
            out.append([low, high, family, chance, share])
    return sorted(map(tuple, out))


_SPAN = pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("family", pa.string()), ("chance", pa.float64()), ("template_share", pa.float64())])


def _scan(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            for a, b in text_slices(batch):
                w = words(batch.column("text").slice(a, b - a), NOT_LOWER_ALNUM, lower=True)
                low, high, text = cut_units(w)
                chance = m.chances(w, low, high) if len(low) else np.zeros((0, len(FAMILIES)))
                hits: list[list] = [[] for _ in range(b - a)]
                for i in np.flatnonzero(chance[:, 0] < m.plain_below):
                    f = int(chance[i, 1:].argmax()) + 1
                    found = matches(unit_words(w, low[i], high[i]))
                    common, share = found[FAMILIES[f]]
                    sure = chance[i, f] >= m.least[f] and share >= CONFIRM and common == max(n for n, s in found.values() if s >= CONFIRM)
                    if not sure and max(s for _, s in found.values()) < RESEMBLE:
                        continue
                    at = w.first[text[i]]
                    hits[text[i]].append((int(low[i] - at), int(high[i] - at), FAMILIES[f] if sure else UNKNOWN, float(chance[i, f]), float(share)))
                spans = [[dict(zip([x.name for x in _SPAN], s, strict=True)) for s in _merged(h)] for h in hits]
                units = np.bincount(text, minlength=b - a)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(w.counts()), pa.array(units, pa.int64()), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "n_words", "n_units", "spans"])

    return run


def scan_licenses(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Licence notices in whole texts.

    Words are runs of letters and digits, A-Z as a-z. Returns doc_id, n_words, n_units and spans, one row for each input row; a
    span has its first word, the word after its last, the family or `unknown`, the classifier's chance and the template's share.
    A null or empty text has no units. Rows without doc_id and repeated ids count each by its own text; other columns are left
    out. An empty table trains on the templates alone.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model or fit(docs))  # BUCKETS by families, whatever the input
    span = "struct<first_word: long, end_word: long, family: string, chance: double, template_share: double>"
    return docs.select("doc_id", "text").mapInArrow(_scan(sent), f"doc_id long, n_words long, n_units long, spans array<{span}>")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.filter("spans", lambda s: s["family"] != UNKNOWN)
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(known).cast("long").alias("n_notices"), F.size(F.filter("spans", lambda s: s["family"] == UNKNOWN)).cast("long").alias("n_unknown"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(known, lambda s: s["family"]))), ",").alias("families"),
    )
