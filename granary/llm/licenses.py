"""Licence scan: a trained paragraph classifier with unknown and no-licence classes, confirmed by comparison with templates.

Lines become sparse vectors of word 1- and 2-grams; multinomial logistic regression, trained here on licence names in
sentences, on whole notices and pieces of them, and on texts that are no licence, gives a probability for each family, for
`unknown` (a licence of no family known) and for none. Features whose weights hardly tell classes apart are dropped, and a line
without any feature left is none for certain, so it needs no scoring. Neighbouring lines that a class speaks of are one
paragraph, so wrapped notices stay whole, unless lines for themselves are sure of different families. A temperature fitted on
names, sentences and notices that didn't train calibrates the probabilities. A predicted family stands only if the paragraph
holds one of its names or shares enough 3-grams with one of its notices; else the paragraph is `unknown`.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .bpe import by_bytes
from .common import col, documents, lean, trimmed

# Names of licence families; the last of each doesn't train. Fixed values.
NAMES = {
    "apache-2.0": ["Apache License, Version 2.0", "Apache-2.0", "Apache License 2.0", "Apache 2.0", "Apache Software License 2.0", "ASL 2.0", "Apache 2.0 License"],
    "mit": ["MIT License", "MIT", "the MIT licence", "MIT/X11 License", "Expat License", "MIT-style license", "MIT Licence"],
    "gpl-3.0": ["GNU General Public License, version 3", "GPL-3.0", "GPLv3", "GNU GPL v3", "GPL 3", "GPL version 3", "GPL-3.0-only", "GPL-3.0-or-later", "GNU General Public License v3.0", "GPL v3.0"],
    "gpl-2.0": ["GNU General Public License, version 2", "GPL-2.0", "GPLv2", "GNU GPL v2", "GPL 2", "GPL version 2", "GPL-2.0-only", "GPL-2.0-or-later", "GNU General Public License v2.0", "GPL v2.0"],
    "lgpl": ["GNU Lesser General Public License", "LGPL", "LGPL-2.1", "LGPLv3", "LGPL-3.0-only", "LGPL version 2.1", "GNU LGPL", "Lesser General Public License"],
    "agpl-3.0": ["GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3", "GNU AGPL v3", "AGPL", "AGPL-3.0-only", "Affero General Public License"],
    "bsd": ["BSD 3-Clause License", "BSD-3-Clause", "BSD License", "BSD-2-Clause", "BSD-style license", "New BSD License", "BSD 2-Clause License"],
    "mpl-2.0": ["Mozilla Public License, version 2.0", "MPL-2.0", "MPL 2.0", "Mozilla Public License, v. 2.0", "MPLv2", "Mozilla Public License 2.0"],
    "cc-by": ["CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License", "CC BY 3.0", "CC-BY", "Creative Commons Attribution 3.0"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 3.0", "CC-BY-SA", "Creative Commons Attribution-ShareAlike 3.0"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 3.0", "CC-BY-NC", "Creative Commons Attribution-NonCommercial 3.0"],
    "cc-by-nd": ["CC BY-ND 4.0", "CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 3.0", "CC-BY-ND", "Creative Commons Attribution-NoDerivatives 3.0"],
    "cc0": ["CC0 1.0 Universal", "CC0-1.0", "CC0", "CC0 1.0", "Creative Commons Zero", "CC0 Public Domain Dedication"],
    "unlicense": ["Unlicense", "The Unlicense", "Unlicense license"],
}
# Notices as files carry them. Fixed values.
NOTICES = {
    "apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "mit": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "gpl-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This file is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3, or (at your option) any later version.",
    ],
    "gpl-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "agpl-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-nd": ["This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal."],
    "unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose."],
}
UNKNOWN, NONE = "unknown", "none"
# Sentences that a licence's name stands in; the last four don't train. Fixed values.
SENTENCES = [
    "{}", "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "Released under {}.", "License: {}", "SPDX-License-Identifier: {}", "This work is licensed under the {}.", "This project is licensed under the {}.",
    "Distributed under the terms of the {}.", "Available under {}.", "The code is made available under the terms of the {}.", "Covered by the {}.", "See the {} for details.", "Copyright 2021 the authors, {}",
    "This package may be used under the {}.", "All content here is published under {}.", "Licence: {}", "You may use it under the terms of {}.",
]
# Names of licences of no family. Fixed values.
OTHER_NAMES = ["Frobnicate Licence", "Example Public Licence version 7", "Vendor Software License 3.1", "Acme Commercial License", "custom license of the company", "Zebra Public License 2.1", "Open Widget License", "Company Source License 1.0", "vendor agreement", "Internal Use License", "Sample Data License v2", "Blue Oak Model License 1.0.0", "Eclipse Public License 2.0", "European Union Public Licence 1.2"]
OTHER = [
    "All rights reserved.", "Copyright by the author, all rights reserved.", "This software is proprietary and may not be redistributed without permission.", "Use is subject to license terms.", "See the license agreement for details.",
    "The copyright holder grants no warranty of any kind.", "Redistribution is prohibited without written permission.", "Copyright (c) 2019 The Company. All rights reserved.", "Unauthorized copying of this file is strictly prohibited; proprietary and confidential.", "Released under a license of our own.",
]
# Texts that are no licence, many with words of licences. Fixed values.
PLAIN = [
    "You need a licence to drive this vehicle on public roads.", "The Apache helicopters flew over the valley at dawn.", "Students at MIT presented their work in version 2 of the report.", "A gnu is an antelope of the African plains.", "The house of commons met in general session.",
    "She asked for permission to use the general library.", "The public may visit the foundation free of charge.", "Open the file and read the notice about the following conditions.", "The driver showed his license and the copy of his insurance.", "Any person is free to copy the recipe and change it.",
    "Terms and conditions of the sale are on the other side.", "He sold copies of the book to the public.", "The new version of the program is faster than version 3.", "It was published by the foundation in 2001.", "The mozilla is a mascot that looks like a lizard.", "Creative people share what they have in common.",
    "Under the terms of the contract the work was finished in May.", "The software is free of errors, as far as we know.", "Without warranty the repair cost a lot.", "The domain of the function is the set of real numbers.", "To the extent possible, the garden was kept as it is.", "Attribution of the painting to the master is doubtful.",
    "The merchant may not use this road except in winter.", "The source of the river lies in the hills.", "All persons to whom the goods are furnished must sign.", "In binary form the number has eight digits.", "The international conference takes place every 4 years.", "Released prisoners returned to their homes.", "He worked under the law of the land.",
    "The following list is not complete.", "A later version of the story has another end.", "See the details in the next chapter.", "The bsd is a unit of the local measure.", "The expat lived in the city for 3 years.", "The author has lived by the sea since 1990.",
]
COMMON = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years much where your way down should because long each just state those people too mr how little good world make very year still see own work".split()
# The same of other languages.
FOREIGN = "der die das und zu den mit von für ist des sich auf ein eine dem nicht auch es an werden aus er hat dass nach wird bei le la les de un une et à en que qui dans pour pas sur au avec il est el los y una por con para se las del al lo su como más".split()
#: Pieces of each notice, and sentences of common words, that train.
PIECES = 24
SALADS = 600
#: Weights that differ less than this between classes are dropped, with their feature if all are.
TELLING = 0.35
#: 3-grams of the paragraph and a notice in common, as a share of the smaller set, that confirm a family.
CONFIRM = 0.6
#: Probability below which a paragraph is unknown, and from which a line is sure of its family.
LEAST = 0.5
SURE = 0.8
_COMMON = frozenset(COMMON) | frozenset(FOREIGN)
#: Names that are common words as well stand for the licence only after one of these.
LEADS = ("license", "licence", "under", "under the", "identifier", "terms of", "terms of the", "authors")
_TOKEN = re.compile(r"[^\W\d_]+|\d+")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def telling(word: str) -> bool:
    return not word.isdigit() and word not in _COMMON


def grams(words: list[str]) -> set[str]:
    """Words of three letters or more, and pairs of neighbours; none made of common words and numbers only."""
    return {*(w for w in words if len(w) > 2 and telling(w)), *(f"{a} {b}" for a, b in zip(words, words[1:]) if telling(a) or telling(b))}


def trigrams(words: list[str]) -> frozenset[tuple[str, ...]]:
    return frozenset(zip(words, words[1:], words[2:]))


def examples(rng: random.Random) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """(texts that train, texts that calibrate) with their classes."""
    train, held = [], []
    named = [*((f, names) for f, names in NAMES.items()), (UNKNOWN, OTHER_NAMES)]
    for family, names in named:
        for i, name in enumerate(names):
            for k, sentence in enumerate(SENTENCES):
                last = i >= len(names) - (3 if family == UNKNOWN else 1)
                if sentence != "{}" or telling(name.lower()):
                    (held if last or k >= len(SENTENCES) - 4 else train).append((sentence.format(name), family))
    for family, notices in NOTICES.items():
        for notice in notices:
            words = notice.split()
            train += [(notice, family)] * 4
            for n in range(PIECES):
                size = rng.randint(min(len(words), 8), len(words))
                at = rng.randint(0, len(words) - size)
                (train if n % 4 else held).append((" ".join(words[at : at + size]), family))
    for text in OTHER:
        train += [(text, UNKNOWN)] * 3
    for k, text in enumerate(PLAIN):
        (train if k % 5 else held).extend([(text, NONE)] * 6)
    some = [w for text in PLAIN for w in tokens(text)]
    for k in range(SALADS):
        words = [rng.choice((COMMON, FOREIGN)[k % 2] if rng.random() < 0.8 else some) for _ in range(rng.randint(1, 30))]
        (train if k % 5 else held).append((" ".join(words), NONE))
    return train, held


class Model(NamedTuple):
    families: list[str]
    vocabulary: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    notices: dict[str, list[frozenset]]
    names: dict[str, list[str]]
    #: Pieces of text without any of which a line has no feature, but pairs of short words.
    triggers: list[str]

    def probabilities(self, paragraphs: list[list[str]]) -> np.ndarray:
        return softmax((product(vectors(paragraphs, self.vocabulary), self.weights) + self.bias) / self.temperature)

    def similarity(self, family: str, words: list[str]) -> float:
        """1 if the family's name stands in the words, else the largest share of 3-grams in common with one of its notices."""
        line, have = f" {' '.join(words)} ", trigrams(words)
        if any(name in line for name in self.names.get(family, ())):
            return 1.0
        return max((len(have & t) / max(1, min(len(have), len(t))) for t in self.notices.get(family, ())), default=0.0)

    def label(self, paragraphs: list[list[str]]) -> list[tuple[str, float, float]]:
        """(class, its probability, similarity with the family's templates) of each paragraph's words."""
        out = []
        for words, p in zip(paragraphs, self.probabilities(paragraphs), strict=True):
            best = int(p.argmax())
            family = self.families[best]
            share = self.similarity(family, words)
            if family not in (UNKNOWN, NONE) and (p[best] < LEAST or share < CONFIRM):
                # what no template confirms is a licence of no family known, as sure as it is a licence
                family, chance = UNKNOWN, float(1 - p[self.families.index(NONE)])
            else:
                chance = float(p[best])
            out.append((family, min(1.0, chance), share))
        return out

    def find(self, text: str | None) -> list[tuple[int, str, str, float, float]]:
        """(first line, text, class, probability, similarity) of the licence paragraphs of a text."""
        if not text:
            return []
        low = text.lower()
        if not any(t in low for t in self.triggers):
            return []
        lines = text.split("\n")
        words = {}
        for k, line in enumerate(lines):
            lowered = line.lower()
            if any(t in lowered for t in self.triggers):
                w = tokens(line)
                n = sum(g in self.vocabulary for g in grams(w))
                if n:
                    words[k] = (w, n)
        if not words:
            return []
        at = sorted(words)
        alone = dict(zip(at, self.label([words[k][0] for k in at]), strict=True))
        # runs of neighbouring lines with features, of which one at least is a licence for itself
        runs: list[list[int]] = []
        for k in at:
            if runs and runs[-1][-1] == k - 1:
                runs[-1].append(k)
            else:
                runs.append([k])
        parts = []
        for run in runs:
            while run and alone[run[0]][0] == NONE and words[run[0]][1] < 3:
                run = run[1:]
            while run and alone[run[-1]][0] == NONE and words[run[-1]][1] < 3:
                run = run[:-1]
            sure = [k for k in run if alone[k][0] not in (NONE, UNKNOWN) and alone[k][1] >= SURE]
            if len({alone[k][0] for k in sure}) > 1:
                # each sure line begins a paragraph; the lines before the first go with it
                starts = [run[0], *sure[1:], run[-1] + 1]
                parts += [list(range(a, b)) for a, b in zip(starts, starts[1:])]
            elif run:
                parts.append(run)
        whole = ["\n".join(lines[part[0] : part[-1] + 1]) for part in parts]
        labels = self.label([tokens(t) for t in whole])
        return [(part[0], t, *label) for part, t, label in zip(parts, whole, labels, strict=True) if label[0] != NONE]


def vectors(paragraphs: list[list[str]], vocabulary: dict[str, int]) -> list[tuple[np.ndarray, float]]:
    """Sparse presence of known n-grams, scaled to length 1 over all of the paragraph's that are known."""
    out = []
    for words in paragraphs:
        ids = np.array(sorted(vocabulary[x] for x in grams(words) if x in vocabulary), dtype=np.int64)
        out.append((ids, 1 / np.sqrt(max(1, len(ids)))))
    return out


def product(x, weights: np.ndarray) -> np.ndarray:
    return np.array([weights[ids].sum(axis=0) * scale for ids, scale in x]) if x else np.zeros((0, weights.shape[1]))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
    return e / e.sum(axis=1, keepdims=True) if len(z) else z


def fit(x: np.ndarray, y: np.ndarray, steps: int, rate: float, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of multinomial logistic regression by accelerated gradient descent."""
    w, b = np.zeros((x.shape[1], y.shape[1])), np.zeros(y.shape[1])
    vw, vb = w.copy(), b.copy()
    share = y / y.sum(axis=0)  # classes count alike
    total = share.sum(axis=1, keepdims=True) / y.shape[1]
    for k in range(steps):
        d = (softmax(x @ vw + vb) - y) * total
        nw, nb = vw - rate * (x.T @ d + penalty * vw), vb - rate * d.sum(axis=0)
        vw, vb = nw + k / (k + 3) * (nw - w), nb + k / (k + 3) * (nb - b)
        w, b = nw, nb
    return w, b


@lru_cache(maxsize=4)
def train(seed: int = 7, steps: int = 300, rate: float = 4.0, penalty: float = 2e-4) -> Model:
    rows, held = examples(random.Random(seed))
    families = [*sorted(NAMES), UNKNOWN, NONE]
    index = {f: k for k, f in enumerate(families)}
    features = sorted(set().union(*(grams(tokens(t)) for t, f in rows if f != NONE)))
    y = np.eye(len(families))[[index[f] for _, f in rows]]

    def learn(features: list[str], steps: int) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
        vocabulary = {g: i for i, g in enumerate(features)}
        x = np.zeros((len(rows), len(vocabulary)), dtype=np.float32)
        for i, (ids, scale) in enumerate(vectors([tokens(t) for t, _ in rows], vocabulary)):
            x[i, ids] = scale
        return vocabulary, *fit(x, y, steps, rate, penalty)

    _, w, _ = learn(features, steps // 4)
    vocabulary, w, b = learn([g for g, weights in zip(features, w, strict=True) if (weights[:-1] - weights[-1]).max() > TELLING], steps)
    z = product(vectors([tokens(t) for t, _ in held], vocabulary), w) + b
    truth = np.array([index[f] for _, f in held])
    loss = lambda t: -np.log(softmax(z / t)[np.arange(len(held)), truth] + 1e-12).mean()
    temperature = min((0.25 * 1.1**k for k in range(30)), key=loss)
    # a feature is in a line only if its longest telling word is; pairs without one of three letters (by sa) count beside others
    words = {max((w for w in g.split() if telling(w)), key=len) for g in vocabulary}
    words = {w for w in words if len(w) > 2 or w == "cc"}
    triggers = sorted(w for w in words if not any(o != w and o in w for o in words))
    bare = lambda n: [n] if telling(n) else [f"{lead} {n}" for lead in LEADS]
    names = {f: [f" {x} " for n in names for x in bare(" ".join(tokens(n)))] for f, names in NAMES.items()}
    return Model(families, vocabulary, w, b, float(temperature), {f: [trigrams(tokens(t)) for t in ts] for f, ts in NOTICES.items()}, names, triggers)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """A row for each licence paragraph: key, paragraph (number of its first line, from 0), family, probability, similarity, paragraph_text.

    Null and empty texts have none. Whole texts are read, however long. Repeated rows give repeated results, a null key stays
    null; an empty table gives an empty table; other columns are ignored. probability is that of the class given; for a
    licence that no template confirms it is the probability of being a licence at all.
    """
    model = model or train()
    lean(df.sparkSession)
    base = df.select(col(key), col(text))
    schema = T.StructType([base.schema.fields[0], T.StructField("paragraph", T.LongType()), T.StructField("family", T.StringType()), T.StructField("probability", T.DoubleType()), T.StructField("similarity", T.DoubleType()), T.StructField("paragraph_text", T.StringType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            texts = whole.column(1).to_pylist()
            for start, n in by_bytes([len(t or "") for t in texts]):
                found = [(i, *p) for i, t in enumerate(texts[start : start + n]) for p in model.find(t)]
                kinds = (pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64())
                at, text_, family, chance, share = (pa.array([f[k + 1] for f in found], type=kind) for k, kind in enumerate(kinds))
                ids = whole.column(0).slice(start, n).take(pa.array([f[0] for f in found], type=pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, at, family, chance, share, text_], names=[f.name for f in schema.fields])

    return base.toDF("k", "t").mapInArrow(trimmed(run), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
