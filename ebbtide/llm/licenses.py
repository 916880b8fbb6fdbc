"""Licence statements in documents: a trained paragraph classifier, confirmed against templates.

A paragraph is a line, read in overlapping windows of ``WINDOW`` words, so that other text in a long line never dilutes a statement; a shorter line is one window. A
window's features are word pairs and single words (lower case, punctuation at the ends off), looked up among the n-grams of the training
paragraphs of licences: the classifier is sparse, everything else has weight zero. It is a logistic regression over licence families and a class
"unknown", trained by gradient descent in numpy on the driver from variations of the templates and the windows of a sample of paragraphs of the corpus
(``BACKGROUND`` in expectation). Probabilities are calibrated by a temperature fitted on windows not trained on; a family is predicted only above the
probability that all but ``FALSE_SHARE`` of the sampled background windows stay below. A prediction is confirmed where the window, or the run of touching predicted
windows around it, and one of the family's templates share enough word pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import coded, mixed, ranges, raw, string_hashes, words

# Well-known statements of licences.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "LGPL": ["Licensed under the GNU Lesser General Public License.", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "BSD": ["Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
FAMILIES = ["unknown", *TEMPLATES]
#: Paragraphs of the corpus that the unknown class is learned and calibrated from, in expectation.
BACKGROUND = 4000
#: Words of a window, and from one window's start to the next; a statement of up to ``WINDOW - STRIDE + 1`` words lies whole in one.
WINDOW, STRIDE = 24, 8
#: Background windows that may be taken for a licence before the templates are asked.
FALSE_SHARE = 0.001
#: Shared word pairs, as a share of the shorter of paragraph and template, that confirm.
CONFIRM = 0.7
#: Such a share from which a background window isn't learned from: it may hold the edge of a statement.
PARTIAL = 0.35
#: Word pairs a paragraph must have to be confirmed as a piece of a longer template.
LEAST_PAIRS = 3
TRIM = ".,;:!?()[]{}\"'“”«»"


def _line_words(lines: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, each word's place, where each line begins plus the end), trimmed and lower-cased."""
    flat, ends = words(lines, lower=True)
    distinct, ids = coded(flat)
    return pc.utf8_trim(distinct, TRIM), ids, ends


def _grams(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of each line's words and word pairs, where each line begins plus the end); a line of n words has 2n: its first pair is with nothing."""
    distinct, ids, ends = _line_words(lines)
    h = string_hashes(*raw(distinct))[ids] if len(ids) else np.zeros(0, np.uint64)
    before = np.concatenate([np.zeros(1, np.uint64), h[:-1]]) if len(h) else h
    before[ends[:-1][ends[:-1] < len(h)]] = 0
    out = np.empty(2 * len(h), np.uint64)
    out[::2], out[1::2] = h, mixed(before * np.uint64(3) + h)
    return out, 2 * ends


@dataclass
class LicenseModel:
    grams: np.ndarray  # sorted
    weights: np.ndarray  # grams x families
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(logits of each window, its line, its first word in the line and the word after its last)."""
        g, ends = _grams(lines)
        line, first, last = windows(np.diff(ends) // 2)
        at = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
        hit = np.flatnonzero(self.grams[at] == g)
        lo, hi = np.searchsorted(hit, ends[line] + 2 * first), np.searchsorted(hit, ends[line] + 2 * last)
        out, some = np.zeros((len(line), len(FAMILIES))), np.flatnonzero(hi > lo)
        for k in range(0, len(some), 100_000):
            own = some[k:k + 100_000]
            sizes = hi[own] - lo[own]
            out[own] = np.add.reduceat(self.weights[at[hit[ranges(lo[own], sizes)]]], np.cumsum(sizes) - sizes, axis=0)
        return out / np.sqrt(np.maximum(2 * (last - first), 1))[:, None] + self.bias, line, first, last

    def predict(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(family, its calibrated probability, line, first word, word after the last) of each window taken for a licence."""
        z, line, first, last = self.logits(lines)
        p = _softmax(z / self.temperature)
        best = p[:, 1:].argmax(1) + 1
        top = p[np.arange(len(p)), best]
        hit = np.flatnonzero(top > self.threshold)
        return best[hit], top[hit], line[hit], first[hit], last[hit]


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, first word, word after the last) of each window of lines with so many words; the last window ends with its line."""
    each = 1 + -(-np.maximum(counts - WINDOW, 0) // STRIDE)
    line = np.repeat(np.arange(len(counts)), each)
    first = np.minimum((np.arange(len(line)) - np.repeat(np.cumsum(each) - each, each)) * STRIDE, np.maximum(counts - WINDOW, 0)[line])
    return line, first, np.minimum(first + WINDOW, counts[line])


def _split(text: str) -> list[str]:
    w = text.split()
    _, first, last = windows(np.array([len(w)]))
    return [" ".join(w[a:b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _pairs(text: str) -> set[tuple[str, str]]:
    w = [x.strip(TRIM) for x in text.lower().split()]
    return set(zip(["", *w], w, strict=False))


_template_pairs = {f: [_pairs(t) for t in ts] for f, ts in TEMPLATES.items()}


def similarity(line: str, family: str) -> tuple[float, int]:
    """(largest share of word pairs of the shorter that the line and a template of the family share, that template's number)."""
    own, best = _pairs(line), (0.0, 0)
    for k, t in enumerate(_template_pairs[family]):
        shorter = min(len(own), len(t))
        if shorter >= min(LEAST_PAIRS, len(t)):
            best = max(best, (len(own & t) / shorter, -k))
    return best[0], -best[1]


def _variations(rng: np.random.Generator, background: list[str], each: int) -> tuple[list[str], list[int]]:
    """Templates whole, cut, with words dropped, and inside other text."""
    lines, labels = [], []
    for k, family in enumerate(FAMILIES[1:], 1):
        for t in TEMPLATES[family]:
            w = t.split()
            for i in range(each):
                x = list(w)
                if i % 4 == 1:
                    x = [y for y in x if rng.random() > 0.1] or x
                if i % 4 == 2 and len(x) > 14:
                    n = int(rng.integers(10, len(x)))
                    s = int(rng.integers(0, len(x) - n + 1))
                    x = x[s:s + n]
                if i % 4 == 3 and background:
                    around = background[int(rng.integers(len(background)))].split()[:max(12, WINDOW - len(x))]
                    cut = int(rng.integers(len(around) + 1))
                    x = around[:cut] + x + around[cut:]
                for piece in _split(" ".join(x)) if i % 4 != 3 else [" ".join(x)]:
                    lines.append(piece)
                    labels.append(k)
    return lines, labels


def fit(background: list[str], seed: int = 3, steps: int = 400) -> LicenseModel:
    """A model from the templates and these paragraphs of the corpus (their windows that may hold a part of a statement left out); without any, unknown is learned from nothing but the bias."""
    rng = np.random.default_rng(seed)
    clean = [x for x in sorted({w for x in background for w in _split(x)}) if not any(similarity(x, f)[0] >= PARTIAL for f in TEMPLATES)]
    rng.shuffle(clean)
    learn, judge = clean[::2], clean[1::2]
    lines, labels = _variations(rng, learn, 24)
    check, check_labels = _variations(rng, judge, 8)
    grams, ends = _grams(pa.array(lines, pa.string()))
    known, counts = np.unique(grams, return_counts=True)
    model = LicenseModel(known[counts > 1], np.zeros((int((counts > 1).sum()), len(FAMILIES))), np.zeros(len(FAMILIES)), 1.0, 0.5)
    data, target = [*lines, *learn], np.array([*labels, *[0] * len(learn)])
    x = _dense(model.grams, pa.array(data, pa.string()))
    share = np.bincount(target, minlength=len(FAMILIES)).clip(1)
    weight = (1 / share)[target][:, None]
    weight /= weight.mean()
    speed_w, speed_b, goal = np.zeros_like(model.weights), np.zeros_like(model.bias), np.eye(len(FAMILIES))[target]
    for _ in range(steps):
        error = weight * (_softmax(x @ model.weights + model.bias) - goal) / len(x)
        speed_w = 0.9 * speed_w - 2.0 * (x.T @ error + 1e-5 * model.weights)
        speed_b = 0.9 * speed_b - 2.0 * error.sum(0)
        model.weights += speed_w
        model.bias += speed_b
    z, line, _, _ = model.logits(pa.array([*check, *judge], pa.string()))
    truth = np.array([*check_labels, *[0] * len(judge)])[line]
    model.temperature = min(np.geomspace(0.2, 5, 40).tolist(), key=lambda t: -np.log(_softmax(z / t)[np.arange(len(z)), truth] + 1e-12).mean()) if len(z) else 1.0
    if judge:
        top = _softmax(z[line >= len(check)] / model.temperature)[:, 1:].max(1)
        model.threshold = float(max(0.3, np.quantile(top, 1 - FALSE_SHARE)))
    return model


def _dense(known: np.ndarray, lines: pa.Array) -> np.ndarray:
    g, ends = _grams(lines)
    out = np.zeros((len(ends) - 1, len(known)), np.float32)
    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
    hit = np.flatnonzero(known[at] == g)
    np.add.at(out, (np.searchsorted(ends, hit, "right") - 1, at[hit]), 1)
    return out / np.sqrt(np.maximum(np.diff(ends), 1))[:, None]


def train(docs: DataFrame, text: str = "text", sample: int = BACKGROUND) -> LicenseModel:
    """A model whose unknown class knows this corpus: the windows of about ``sample`` of its paragraphs, chosen by a hash of their words; of those windows at most as many, by their hash."""
    lines = docs.select(F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line")).where("trim(line) <> ''")
    n = lines.count()
    share = min(1.0, sample / max(1, n))
    some = lines.where(F.pmod(F.xxhash64("line"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()
    # For training only, words are cut to 100 characters; no template has such long ones.
    cut = some.select(F.transform(F.split(F.trim("line"), "[ \\t\\x0B\\f\\r]+"), lambda w: F.substring(w, 1, 100)).alias("w"))
    last = F.greatest(F.size("w") - WINDOW, F.lit(0))
    firsts = F.array_union(F.sequence(F.lit(0), last, F.lit(STRIDE)), F.array(last))
    pieces = cut.select(F.explode(F.transform(firsts, lambda i: F.array_join(F.slice("w", i + 1, WINDOW), " "))).alias("piece")).distinct()
    return fit([r["piece"] for r in pieces.orderBy(F.xxhash64("piece"), "piece").limit(sample).collect()])


def _statements(lines: pa.Array, family: np.ndarray, p: np.ndarray, line: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[tuple[int, int, float, int, float]]:
    """(line, family, probability, template, similarity): of each run of touching windows the one most probable, among the confirmed ones if any is."""
    if not len(line):
        return []
    out, new = [], np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (first[1:] > last[:-1])
    bounds = np.append(np.flatnonzero(new), len(line)).tolist()
    spelled: tuple[int, list[str]] = (-1, [])
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        if spelled[0] != line[lo]:
            flat, _ = words(lines.slice(int(line[lo]), 1))
            spelled = int(line[lo]), flat.to_pylist()
        w = spelled[1]
        whole = " ".join(w[first[lo]:last[hi - 1]])
        of_run = {k: similarity(whole, FAMILIES[k]) for k in set(family[lo:hi].tolist())}
        found = []
        for i in range(lo, hi):
            k = int(family[i])
            s, t = max(of_run[k], similarity(" ".join(w[first[i]:last[i]]), FAMILIES[k]), key=lambda x: x[0])
            found.append((s >= CONFIRM, float(p[i]), k, t, s))
        _, top, k, t, s = max(found, key=lambda x: x[:2])
        out.append((int(line[lo]), k, top, t, s))
    return out


def scan(docs: DataFrame, model: LicenseModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per statement of a licence predicted in a paragraph (a long one may have several, apart from one another): (key, paragraph, family, probability, template, similarity, confirmed).

    Paragraphs are numbered from 0 by line. Null texts have none; a document may have several rows, repeated rows have theirs each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                b = whole.slice(lo, 2000)
                lists = pc.split_pattern(pc.fill_null(b.column(1).cast(pa.large_string()), ""), "\n")
                lines, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
                ends = ends - ends[0]
                got = _statements(lines, *shared.value.predict(lines))
                hit = np.array([x[0] for x in got], np.int64)
                doc = np.searchsorted(ends, hit, "right") - 1
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(doc)), pa.array(hit - ends[doc]), pa.array([FAMILIES[x[1]] for x in got], pa.string()), pa.array([x[2] for x in got], pa.float64()), pa.array([x[3] for x in got], pa.int32()),
                    pa.array([x[4] for x in got], pa.float64()), pa.array([x[4] >= CONFIRM for x in got], pa.bool_()),
                ], names=["doc_id", "paragraph", "family", "probability", "template", "similarity", "confirmed"])

    return rows.mapInArrow(run, "doc_id long, paragraph long, family string, probability double, template int, similarity double, confirmed boolean")
