"""Licence scans: a trained paragraph classifier, confirmed against templates.

A paragraph (lines up to one that ends a sentence, or up to one without words, so
wrapped text is one) is a bag of word uni- and bigrams, of which those made of
template words have weights. Multinomial logistic regression gives a licence family or
`unknown`; its scores are calibrated with a temperature fitted on paragraphs
held back from training. Where a paragraph is long, stretches of it that look like
a licence are found first (in windows of words, or lines, the calibrated probability
of `unknown` leaves `least_probability` or more) and then judged whole. What the
classifier finds likely there is confirmed by comparison with the families'
templates: the best aligned template must share `least_overlap` of its words in
order (or of the paragraph's, if that is the shorter one) with the stretch, but for
one word at most if it has ten or fewer. Its numbers, its name and the words that
tell it apart must be there, and none that tells another licence. Of families that
are confirmed by the same words the one with most of them stays.

It is trained on paragraphs made from the templates (words left out, replaced
and added, joined to other prose) and on others: prose made from hashed
syllables, near misses that use licence words, and a bounded sample of
`sample_docs` documents' lines that share no three words in a row with any template.

Defined results
* one row for each document row and family found in it, with the number of its
  paragraphs, the first one's place and the best probability and overlap;
  `families` gives one row for each document row;
* a null or empty text has no paragraphs and so no licences; an empty table gives no rows;
* a text of any length is judged whole, paragraph by paragraph;
* repeated rows each give theirs; further columns are ignored by `report`, kept by `families`.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import project, text_bytes

# Short forms of licence families as they stand in texts. Numbers are words of their own.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released under CC0 1.0 Universal.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
UNKNOWN = "unknown"
# Words that make another licence of the same sentence.
APART = {b"lesser", b"library", b"affero", b"noncommercial", b"nc", b"sharealike", b"sa", b"noderivatives", b"noderivs", b"nd"}
# Names without which a sentence is not that licence's.
NAMES = {b"apache", b"mit", b"bsd", b"isc", b"mozilla", b"mpl", b"cc", b"cc0", b"creative", b"commons", b"spdx"}
TELLING = APART | NAMES
#: A longer paragraph is searched in windows of so many words, each half over the next.
WINDOW = 24
#: Of a template of so many words or fewer one may be missing.
BRIEF = 10
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(paragraph: bytes) -> list[bytes]:
    return WORD.findall(paragraph.translate(LOWER))


class Classifier:
    """families, vocabulary of the words that matter, weights [features, families], and the temperature."""

    def __init__(self, families: list[str], vocab: dict[bytes, int], pairs: dict[int, int], weights: np.ndarray, bias: np.ndarray, temperature: float, templates: dict[str, list[list[bytes]]]):
        self.families, self.vocab, self.pairs, self.weights, self.bias = families, vocab, pairs, weights, bias
        self.temperature, self.templates = temperature, templates

    def features(self, words: list[bytes]) -> list[int]:
        """Known uni- and bigrams; others weigh nothing."""
        get, pair = self.vocab.get, self.pairs.get
        ids = [get(w, -1) for w in words]
        n = len(self.vocab)
        both = [p for a, b in zip(ids, ids[1:]) if a >= 0 and b >= 0 and (p := pair(a * n + b)) is not None]
        return [i for i in ids if i >= 0] + both

    def probabilities(self, words: list[bytes]) -> np.ndarray:
        f = self.features(words)
        z = self.bias + (self.weights[f].sum(axis=0) / np.sqrt(max(1, len(words))) if f else 0)
        z = z / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def edges(self) -> tuple[list[float], float]:
        """What each feature, and the bias, gives the best family over `unknown` at most."""
        u = self.families.index(UNKNOWN)
        others = [i for i in range(len(self.families)) if i != u]
        return (self.weights[:, others].max(axis=1) - self.weights[:, u]).tolist(), float(self.bias[others].max() - self.bias[u])

    def confirmed(self, family: str, words: list[bytes], least_overlap: float) -> tuple[float, int, int, int] | None:
        """What `placed` gives for the family's template with most shared words, of those that agree."""
        return max((m for t in self.templates[family] if (m := placed(t, words))[0] >= least_overlap and agrees(t, words, m)), key=lambda m: (m[1], m[0]), default=None)


def agrees(template: list[bytes], words: list[bytes], match: tuple[float, int, int, int]) -> bool:
    """Whether what is shared holds the template's numbers and TELLING words, in order, and no word of APART that the template has not."""
    _, n, begin, end = match
    if len(template) <= BRIEF and n < min(len(template), max(3, len(words))) - 1:
        return False
    part = words[begin:end]
    here = iter(part)
    return all(w in here for w in template if w.isdigit() or w in TELLING) and not any(w in APART and w not in template for w in part)


def aligned(template: list[bytes], words: list[bytes]) -> float:
    return placed(template, words)[0]


def placed(template: list[bytes], words: list[bytes]) -> tuple[float, int, int, int]:
    """Longest common subsequence over the shorter of template and paragraph, its length, and where it begins and ends.

    Other words between the shared ones lengthen what it is measured by, by half a word each.
    """
    shared = set(template)
    at = [i for i, w in enumerate(words) if w in shared]
    short = max(1, min(len(template), max(3, len(words))))
    best = (0.0, 0, 0, 0)
    # Repeats of the template in one paragraph each are a chance: look at windows of twice its length.
    for lo in range(0, len(at), max(1, len(template))):
        row = [(0, 0)] * (len(template) + 1)  # length and where it begins: of equal ones the latest, so the densest
        for i in at[lo : lo + 2 * len(template)]:
            last = (0, 0)
            for j, t in enumerate(template):
                here = row[j + 1]
                if words[i] == t:
                    row[j + 1] = max(here, (last[0] + 1, last[1] if last[0] else i))
                elif row[j] > here:
                    row[j + 1] = row[j]
                last = here
            n, begin = row[-1]
            if n:
                best = max(best, (n / max(short, n + (i - begin + 1 - n) / 2), n, begin, i + 1))
    return best


def made(seed: int, each: int) -> list[tuple[list[bytes], str]]:
    """Labelled paragraphs: altered templates of every family, and others."""
    rng = random.Random(seed)
    pool = sorted({w for ts in TEMPLATES.values() for t in ts for w in words_of(t.encode())})
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "nt", "ea", "ti", "to", "io", "le", "is", "ou", "ar", "as", "de", "rt", "ve", "que", "ch", "ei", "la", "os"]) for _ in range(rng.randint(1, 4))).encode()
    prose = lambda n: [word() for _ in range(n)]
    out: list[tuple[list[bytes], str]] = []
    for family, templates in TEMPLATES.items():
        for i in range(each):
            ws = words_of(templates[i % len(templates)].encode())
            if rng.random() < 0.5 and len(ws) > 6:
                # Without its number, its name or the word that tells it apart, it is not that licence.
                ws = [w for w in ws if rng.random() > 0.08 or w.isdigit() or w in TELLING]
                ws = [prose(1)[0] if rng.random() < 0.04 and not (w.isdigit() or w in TELLING) else w for w in ws]
            if rng.random() < 0.4:
                ws = prose(rng.randint(0, 16)) + ws + prose(rng.randint(0, 16))
            out.append((ws, family))
    for i in range(each * 6):
        kind = i % 4
        if kind == 0:
            ws = prose(rng.randint(1, 60))
        elif kind == 1:  # the words of licences, in no order
            ws = [rng.choice(pool) for _ in range(rng.randint(1, 12))]
        elif kind == 2:
            ws = prose(rng.randint(2, 20))
            for _ in range(rng.randint(1, 4)):
                ws.insert(rng.randrange(len(ws)), rng.choice(pool))
        else:
            ws = words_of(rng.choice([b"a driving license is required", b"the license plate was under the car", b"version 2.0 released today", b"the general public was not amused", b"under the terms of the agreement", b"licensed to operate a boat", b"copyright law and the public", b"permission was granted to enter the building", b"free software is discussed here", b"the mit campus", b"apache helicopters"])) + prose(rng.randint(0, 10))
        out.append((ws, UNKNOWN))
    rng.shuffle(out)
    return out


def trained(others: list[list[bytes]] | None = None, each: int = 60, epochs: int = 60, seed: int = 9) -> Classifier:
    """Logistic regression by AdaGrad; a fifth of the paragraphs is held back for the temperature."""
    templates = {k: [words_of(t.encode()) for t in ts] for k, ts in TEMPLATES.items()}
    data = made(seed, each) + [(w, UNKNOWN) for w in others or []]
    vocab = {w: i for i, w in enumerate(sorted({w for ts in templates.values() for t in ts for w in t}))}
    seen = sorted({vocab[a] * len(vocab) + vocab[b] for ws, _ in data for a, b in zip(ws, ws[1:]) if a in vocab and b in vocab})
    pairs = {p: len(vocab) + i for i, p in enumerate(seen)}
    families = [*sorted(TEMPLATES), UNKNOWN]
    c = Classifier(families, vocab, pairs, np.zeros((len(vocab) + len(pairs), len(families))), np.zeros(len(families)), 1.0, templates)
    x = np.zeros((len(data), c.weights.shape[0]))
    for i, (ws, _) in enumerate(data):
        for f in c.features(ws):
            x[i, f] += 1 / np.sqrt(max(1, len(ws)))
    y = np.array([families.index(f) for _, f in data])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(data))
    held, use = order[: len(order) // 5], order[len(order) // 5 :]
    gw, gb = np.full_like(c.weights, 1e-3), np.full_like(c.bias, 1e-3)
    for _ in range(epochs):
        z = x[use] @ c.weights + c.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(use)), y[use]] -= 1
        w, b = x[use].T @ p / len(use) + 1e-6 * c.weights, p.mean(axis=0)
        gw += w * w
        gb += b * b
        c.weights -= 0.5 * w / np.sqrt(gw)
        c.bias -= 0.5 * b / np.sqrt(gb)
    z = x[held] @ c.weights + c.bias

    def loss(t: float) -> float:
        s = z / t
        top = s.max(axis=1)
        return float((top + np.log(np.exp(s - top[:, None]).sum(axis=1)) - s[np.arange(len(held)), y[held]]).mean())

    c.temperature = min((0.25 * 1.1**k for k in range(40)), key=loss)
    return c


def other_lines(docs: DataFrame, sample_docs: int) -> list[list[bytes]]:
    """Lines of about sample_docs documents, eight of each at most, that are no template's."""
    n = docs.count()
    if not n:
        return []
    scale = 1 << 30
    picked = docs.withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit("lines"))).where(F.pmod("h", F.lit(scale)) < max(1, min(scale, scale * sample_docs // n)))
    short = F.filter(F.split("text", "\n"), lambda s: F.length(s).between(1, 600))
    dealt = F.array_sort(F.transform(short, lambda s: F.struct(F.xxhash64(s).alias("h"), s.alias("s"))))
    # Rows that repeat are chosen together: equal lines count once, and no more than twice the number asked for.
    lines = picked.select(F.explode(F.slice(dealt, 1, 8)).alias("e")).select(F.col("e.h").alias("h"), F.col("e.s").alias("line")).distinct().orderBy("h", "line").limit(16 * sample_docs)
    three = {tuple(w[i : i + 3]) for ts in TEMPLATES.values() for t in ts for w in [words_of(t.encode())] for i in range(len(w) - 2)}
    got = sorted({r["line"] for r in lines.collect()})
    return [w for w in (words_of(s.encode()) for s in got) if w and not any(tuple(w[i : i + 3]) in three for i in range(len(w) - 2))]


def paragraphs(text: bytes) -> Iterator[tuple[list[bytes], list[int]]]:
    """The words of each, and where its lines begin in them: lines up to one that ends a sentence or has no word."""
    held: list[bytes] = []
    begins: list[int] = []
    for line in text.split(b"\n"):
        words = words_of(line)
        if words:
            begins.append(len(held))
            held += words
        if held and (not words or line.rstrip(b" \t\r*/#>-\"')").endswith((b".", b"!", b"?", b":"))):
            yield held, begins
            held, begins = [], []
    if held:
        yield held, begins


def stretches(words: list[bytes], begins: list[int], own: Classifier, edge: list[float], base: float, least_probability: float) -> Iterator[tuple[list[bytes], set[str]]]:
    """Where windows, or lines within a window's length, look like a licence: the words there and half a window beside them.

    And the three likeliest families of each.
    """
    half = WINDOW // 2
    windows = {(lo, min(len(words), lo + WINDOW)) for lo in range(0, max(1, len(words) - half), half)}
    windows |= {(lo, hi) for lo, hi in zip(begins, [*begins[1:], len(words)]) if hi - lo <= WINDOW}
    unknown = own.families.index(UNKNOWN)
    begin, end, likely = 0, -1, set()
    for lo, hi in sorted(windows):
        f = own.features(words[lo:hi])
        # No family can beat `unknown` if not even the best one for each feature could.
        if not f or base + sum([edge[i] for i in f]) / (hi - lo) ** 0.5 <= 0:
            continue
        p = own.probabilities(words[lo:hi])
        if int(p.argmax()) == unknown or 1 - p[unknown] < least_probability:
            continue
        if lo > end:
            if likely:
                yield words[max(0, begin - half) : end + half], likely
            begin, end, likely = lo, -1, set()
        end = max(end, hi)
        likely |= {own.families[k] for k in np.argsort(-p, kind="stable")[:3].tolist()} - {UNKNOWN}
    if likely:
        yield words[max(0, begin - half) : end + half], likely


def judged(words: list[bytes], likely: set[str], own: Classifier, least_overlap: float) -> Iterator[tuple[str, float, float]]:
    """family, probability, overlap of what a stretch is confirmed to hold."""
    p = own.probabilities(words)
    # Beside what windows gave, what is most likely for the stretch as a whole.
    likely = likely | {own.families[k] for k in np.argsort(-p, kind="stable")[:3].tolist()} - {UNKNOWN}
    found = [(m, f) for f in sorted(likely) if (m := own.confirmed(f, words, least_overlap))]
    taken: list[tuple[int, int]] = []
    for (overlap, _, begin, end), family in sorted(found, key=lambda x: (-x[0][1], -x[0][0], x[1])):
        if all(end <= lo or begin >= hi for lo, hi in taken):
            taken.append((begin, end))
            yield family, float(own.probabilities(words[begin:end])[own.families.index(family)]), overlap


def found(text: bytes, own: Classifier, least_probability: float, least_overlap: float) -> dict[str, list]:
    """family: [paragraphs, place of the first, best probability, best overlap]."""
    out: dict[str, list] = {}
    edge, base = own.edges()
    for nth, (words, begins) in enumerate(paragraphs(text)):
        seen = set()
        for part, likely in stretches(words, begins, own, edge, base, least_probability):
            for family, probability, overlap in judged(part, likely, own, least_overlap):
                got = out.setdefault(family, [0, nth, 0.0, 0.0])
                got[0] += family not in seen
                seen.add(family)
                got[2], got[3] = max(got[2], probability), max(got[3], overlap)
    return out


def _model(docs: DataFrame, sample_docs: int):
    own = project(docs, ["doc_id", "text"])
    return docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(trained(other_lines(own, sample_docs))))


def report(docs: DataFrame, least_probability: float = 0.6, least_overlap: float = 0.75, sample_docs: int = 200) -> DataFrame:
    """doc_id, family, n_paragraphs, first_paragraph (from 0), probability, overlap of every licence found."""
    model = _model(docs, sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(model.value)
        for batch in batches:
            rows = [(i, k, *v) for i, t in enumerate(batch.column(1).to_pylist()) for k, v in found(t, own, least_probability, least_overlap).items()]
            at, family, n, first, p, o = ([r[j] for r in rows] for j in range(6))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(family, pa.string()), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(p, pa.float64()), pa.array(o, pa.float64())],
                names=["doc_id", "family", "n_paragraphs", "first_paragraph", "probability", "overlap"],
            )

    src = project(docs, ["doc_id", "text"]).select("doc_id", text_bytes().alias("body"))
    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, family string, n_paragraphs long, first_paragraph long, probability double, overlap double")


def families(docs: DataFrame, column: str = "licences", least_probability: float = 0.6, least_overlap: float = 0.75, sample_docs: int = 200) -> DataFrame:
    """docs, all columns, with a further one: the sorted families found in each text."""
    model = _model(docs, sample_docs)
    every = docs.columns
    use = [i for i, c in enumerate(every) if c != column]
    names, inner = [every[i] for i in use], [f"__c{i}" for i in use]
    src = docs.toDF(*[f"__c{i}" for i in range(len(every))]).select(*inner)
    src = src.withColumn("__body", F.coalesce(F.col(inner[names.index("text")]), F.lit("")).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(model.value)
        for batch in batches:
            got = [sorted(found(t, own, least_probability, least_overlap)) for t in batch.column(len(inner)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(inner))), pa.array(got, pa.list_(pa.string()))], names=[*inner, "__got"])

    schema = src.drop("__body").withColumn("__got", F.lit(None).cast("array<string>")).schema
    return src.mapInArrow(run, schema).toDF(*names, column)
