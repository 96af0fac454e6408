"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

Paragraphs are lines and, where a notice is wrapped over several lines, the lines
between two blank ones together.  A sparse multinomial logistic regression over word
1- to 3-grams tells the licence families, licence text of no known family and
ordinary text apart.  It is trained here, from the notices below, the short forms
that FRAMES make of names, versions and identifiers, and ORDINARY text; notices with their
words in another order are ordinary text too, so that words alone decide little.
No document is read for it, so it is the same for every corpus.  A temperature
calibrates its probabilities, fitted on whole notices and names that a first training
leaves out; the second one takes all.  Only n-grams of the training licences have weights, so most lines of a
corpus are settled by a look-up of word hashes.

A paragraph counts as a family's if the calibrated probability reaches SURE and
its n-grams confirm a template of that family; licence text that does not is
`unknown`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkloom.llm.common import PUNCTUATED, U64, ByteRule, buffers, mix, runs, word_hashes

SURE = 0.6
#: Least probability of being licence text, and a 3-gram of the training licences besides, for text of no known family.
SURE_UNKNOWN = 0.7
#: Share of a paragraph's or template's 2-grams, of whichever has fewer, that both must have.
CONFIRM = 0.6
#: Share of the notices and names that only calibrate.
HELD = 0.2
NONE, UNKNOWN = "none", "unknown"

#: How licences are named in short.
FRAMES = [
    "{}", "License: {}", "Licence: {}", "SPDX-License-Identifier: {}", "Licensed under the {}.", "Licensed under {}", "Released under the {}.", "Distributed under the {}.", "Distributed under the terms of the {}.",
    "This project is licensed under the {}.", "This work is licensed under the {}.", "This software is released under the terms of the {}.", "Available under the {}; see the file LICENSE for details.", "It is free software under the {}.",
    "The code in this repository is provided under the {}.", "All files are covered by the {} unless stated otherwise.", "Dual licensed under the {} and others.",
]
#: From here on they have words of their own.
BARE = 1
#: Least share of known 2- and 3-grams in a line that counts as part of a wrapped notice.
PART = 0.5
#: Names of public licences by family, with what follows a name as its version.
NAMES: dict[str, tuple[list[str], list[str]]] = {
    "MIT": (["MIT License", "MIT Licence", "MIT", "Expat License", "X11 License"], [""]),
    "Apache-2.0": (["Apache License", "Apache Licence", "Apache Software License", "Apache-2.0", "ASL"], ["", ", Version 2.0", " 2.0", " Version 2", " v2.0"]),
    "BSD": (["BSD 3-Clause License", "BSD 2-Clause License", "BSD License", "Modified BSD License", "New BSD License", "Simplified BSD License", "BSD-3-Clause", "BSD-2-Clause"], [""]),
    "GPL": (["GNU General Public License", "GNU GPL", "GPL", "GPL-3.0-or-later", "GPL-2.0-only"], ["", ", version 3", " v3", " version 2", " v2 or later", " 3.0"]),
    "LGPL": (["GNU Lesser General Public License", "GNU Library General Public License", "GNU LGPL", "LGPL", "LGPL-2.1-or-later"], ["", ", version 2.1", " v2.1", " version 3", " v3"]),
    "AGPL": (["GNU Affero General Public License", "GNU AGPL", "AGPL", "AGPL-3.0-only"], ["", ", version 3", " v3"]),
    "MPL-2.0": (["Mozilla Public License", "MPL", "MPL-2.0"], ["", ", version 2.0", " Version 2.0", ", v. 2.0", " 2.0"]),
    "ISC": (["ISC License", "ISC Licence", "ISC", "Internet Systems Consortium License"], [""]),
    "CC-BY": (["Creative Commons Attribution License", "Creative Commons Attribution 4.0 International License", "CC BY", "CC-BY-4.0", "CC BY 4.0"], [""]),
    "CC-BY-SA": (["Creative Commons Attribution-ShareAlike License", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA", "CC-BY-SA-4.0", "CC BY-SA 4.0"], [""]),
    "CC-BY-NC": (["Creative Commons Attribution-NonCommercial License", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial-NoDerivs License", "CC BY-NC", "CC-BY-NC-4.0", "CC BY-NC 4.0", "CC BY-NC-ND 4.0"], [""]),
    "public-domain": (["CC0 1.0 Universal", "CC0", "CC0-1.0", "Unlicense", "Public Domain Dedication"], [""]),
    UNKNOWN: (
        ["Artistic License", "Eclipse Public License", "Boost Software License", "European Union Public Licence", "zlib License", "Academic Free License", "Open Software License", "Common Development and Distribution License", "Microsoft Public License", "SIL Open Font License",
         "PostgreSQL License", "Python Software Foundation License", "University of Illinois Open Source License", "Educational Community License", "Open Data Commons License", "Community License", "Research License", "End User License Agreement", "EPL-2.0", "BSL-1.0", "EUPL-1.2", "CDDL-1.0"],
        ["", ", version 2", " 1.0", " v1.1"],
    ),
}
#: Notices of public licences by family, a paragraph each.
NOTICES: dict[str, list[str]] = {
    "MIT": [
        "This project is licensed under the MIT License - see the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership.",
    ],
    "BSD": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation.",
    ],
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ],
    "CC-BY": ["This is an open access article distributed under the terms of the Creative Commons Attribution License, which permits unrestricted use, distribution, and reproduction in any medium, provided the original work is properly cited."],
    "CC-BY-SA": ["Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply."],
    "CC-BY-NC": ["This is an open access article under the Creative Commons Attribution-NonCommercial License, which permits use for non-commercial purposes only."],
    "public-domain": [
        "This work is released into the public domain.", "Dedicated to the public domain under CC0 1.0 Universal.", "This is free and unencumbered software released into the public domain.", "This file is in the public domain and has no copyright.", "The author has placed this work in the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "proprietary": [
        "All rights reserved.", "Copyright 2020 the authors. All rights reserved.", "Copyright (c) the publisher. All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher.",
        "This software is proprietary and confidential; unauthorized copying of this file is strictly prohibited.", "Unauthorized reproduction or distribution of this material is prohibited.", "No part of this book may be reproduced, stored in a retrieval system or transmitted in any form without the permission of the publisher.",
    ],
    UNKNOWN: [
        "Use of this material is governed by a separate license agreement.", "This document is distributed under the terms of the accompanying license.", "Permission is granted to use this data for research purposes only under the license of the data provider.",
        "By using this software you agree to be bound by the terms of the end user license agreement.", "You may use, copy and distribute this material provided that this notice is kept in all copies.", "The license permits use and redistribution subject to the conditions in the license file.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:", "Licensed under the terms of the license that comes with the package.",
    ],
}
#: Ordinary text, much of it with words that licences use.
ORDINARY = [
    "The model was trained on the data of the second experiment.", "We use the results of the first section in this work.", "A copy of the letter was sent to the city in the same year.", "This file contains the notes of the meeting.", "The terms of the equation are listed below.",
    "The program runs on any computer with two processors and a version of the system that is not too old.", "All of the above is shown in the table, with or without the last column.", "You may find the source of the river in the hills to the north.", "The rights of the workers were the subject of the debate.",
    "He was granted a pension, free of charge, by the city in 1901.", "The license plate of the car was not found.", "A driving licence is required to rent a car in this country.", "She has a license to practise medicine in the state.", "The software was written by students in the summer of that year.",
    "In the public domain of physics there is no secret of any kind.", "The general public was invited to see the works in the museum.", "Apache helicopters were seen over the valley.", "The Mozilla browser was released in 2002 and the next version in 2004.", "MIT is a university in Cambridge, and the authors are from there.",
    "The commons were open to all the people of the village.", "The creative process has no rules, and the attribution of the painting is disputed.", "The permission of the mayor was needed to use the hall.", "The following conditions were observed in the patients of both groups.", "Copies of the book are in all large libraries.",
    "The warranty on the machine ends after two years.", "The distribution of the values is shown, and the mean is given below.", "The article was published under a different title.", "Products of this company are sold in all states.", "The contract was signed under the terms that both sides agreed on.", "Provided that the sum is finite, the limit exists and the proof is complete.",
    "The limitations of this study are discussed in the last section.", "No part of the island is more than ten miles from the sea.", "The author reserved a table for two at seven.", "All rights and duties of a citizen are named in the constitution.", "The name of the holder of the office was not on the list.", "It is hoped that this work will be useful to others in the field.",
    "To any person who asked, he gave the same answer.", "The code of the project was rewritten in another language.", "Use of the device in the rain is not a good idea.", "The open sea lay before them, and the source of the light was unknown.", "Version 2.0 of the paper corrects some errors of version 1.0.", "The library is open from nine to five.",
    "Die Lizenz wurde nicht gefunden.", "Das Programm und die Daten sind in der Datei.", "La licence de pêche est valable un an.", "Le code est dans le fichier de la section suivante.", "La licencia de conducir es necesaria para este trabajo.", "El programa se publica en la sección de arte.", "", "1 2 3", "a b c", "MIT und mit", "by the sea", "the",
]


class _Sparse:
    """A matrix of few values, for products with dense ones from the right."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, n: int, m: int):
        self.shape = n, m
        self.by_row, self.by_col = self._side(rows, cols, values), self._side(cols, rows, values)

    @staticmethod
    def _side(key: np.ndarray, other: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
        return key[order][first], first, other[order], values[order, None]

    def times(self, w: np.ndarray) -> np.ndarray:
        return self._product(self.by_row, w, self.shape[0])

    def turned_times(self, g: np.ndarray) -> np.ndarray:
        return self._product(self.by_col, g, self.shape[1])

    @staticmethod
    def _product(side: tuple[np.ndarray, ...], dense: np.ndarray, n: int) -> np.ndarray:
        key, first, other, values = side
        out = np.zeros((n, dense.shape[1]))
        out[key] = np.add.reduceat(dense[other] * values, first, axis=0)
        return out


class Scanner:
    """Weights of n-gram hashes by class, and the 2-gram sets of the templates."""

    def __init__(self, seed: int = 3):
        self.rule = ByteRule(PUNCTUATED)
        families = list(dict.fromkeys([*NAMES, *NOTICES]))
        self.classes = [NONE, *(f for f in families if f != UNKNOWN), UNKNOWN]
        rng = np.random.default_rng(seed)
        texts, marks, held = [], [], []

        def add(text: str, family: str, out: bool) -> None:
            texts.append(text)
            marks.append(family)
            held.append(out)

        self.templates: dict[str, list[frozenset]] = {}
        for family in self.classes[1:]:
            names, versions = NAMES.get(family, ([], []))
            named = [n + v for n in names for v in versions]
            notices = NOTICES.get(family, [])
            # a name of one word says nothing by itself
            self.templates[family] = [self._set(x) for n in named for x in ([n] if " " in n else [f.format(n) for f in FRAMES[BARE:]])] + [self._set(x) for x in notices]
            for name in named:
                out = rng.random() < HELD  # with all frames of it
                for frame in FRAMES[:1] * (" " in name) + [FRAMES[i] for i in rng.choice(np.arange(BARE, len(FRAMES)), 5, replace=False)]:
                    add(frame.format(name), family, out)
            for notice in notices:
                words, out = notice.split(), len(notices) > 3 and rng.random() < HELD
                add(notice, family, out)
                for _ in range(8):
                    n = int(rng.integers(max(2, int(0.5 * len(words))), len(words) + 1))
                    at = int(rng.integers(0, len(words) - n + 1))
                    add(" ".join(words[at : at + n]), family, out)
        licences = list(texts)
        for text in ORDINARY:
            add(text, NONE, rng.random() < HELD)
        bag = np.array(sorted({w for x in [*licences, *ORDINARY] for w in x.split()}))
        for text in licences[::4]:  # the same words in another order, alone and among others
            words = text.split()
            if len(words) > 4:
                add(" ".join(rng.permutation(words)), NONE, rng.random() < HELD)
            add(" ".join(rng.choice(bag, int(rng.integers(3, 30)))), NONE, rng.random() < HELD)
        lists = [self._grams(t) for t in texts]
        self.vocabulary = np.unique(np.concatenate([g for g, m in zip(lists, marks, strict=True) if m != NONE]))
        rows, cols, values = [], [], []
        for i, g in enumerate(lists):
            if len(g):
                at = np.minimum(np.searchsorted(self.vocabulary, g), len(self.vocabulary) - 1)
                at, n = np.unique(at[self.vocabulary[at] == g], return_counts=True)
                rows.append(np.full(len(at), i))
                cols.append(at)
                values.append(n / np.sqrt(len(g)))
        x = _Sparse(np.concatenate(rows), np.concatenate(cols), np.concatenate(values), len(texts), len(self.vocabulary))
        y, out = np.array([self.classes.index(m) for m in marks]), np.array(held)
        weight, bias = self._fit(x, y, ~out, 100)
        self.heat = self._temperature((x.times(weight) + bias)[out], y[out])
        self.weight, self.bias = self._fit(x, y, out | ~out, 200)

    def _grams(self, text: str) -> np.ndarray:
        data, offsets = buffers(pa.array([text]))
        hashes, _, _, at = word_hashes(data, offsets, self.rule)
        return np.concatenate([g for g, _ in self._levels(hashes, np.zeros(len(hashes), dtype=np.int64))])

    @staticmethod
    def _levels(hashes: np.ndarray, line: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """1-, 2- and 3-grams within lines, with the lines they are in."""
        yield hashes, line
        if len(hashes) > 1:
            two = mix(hashes[:-1] * U64(3) + mix(hashes[1:]))
            same = line[:-1] == line[1:]
            yield two[same], line[:-1][same]
            if len(hashes) > 2:
                three = mix(two[:-1] * U64(5) + mix(hashes[2:]))
                same = line[:-2] == line[2:]
                yield three[same], line[:-2][same]

    def _set(self, text: str) -> frozenset:
        data, offsets = buffers(pa.array([text]))
        h = word_hashes(data, offsets, self.rule)[0].tolist()
        return frozenset(zip(h, h[1:], strict=False)) or frozenset((x, 0) for x in h)

    @staticmethod
    def _alike(a: frozenset, b: frozenset) -> bool:
        return bool(a and b) and len(a & b) >= CONFIRM * min(len(a), len(b)) and min(len(a), len(b)) >= 1 and len(a & b) >= min(2, len(b))

    def _fit(self, x: _Sparse, y: np.ndarray, used: np.ndarray, steps: int, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
        """Softmax regression on the used rows, licence classes weighted alike, by gradient steps with momentum."""
        k = len(self.classes)
        target = np.eye(k)[y]
        share = 1 / np.maximum(np.bincount(y[used], minlength=k), 1)[y] * used
        share = np.where(y == 0, share * 8, share)
        share /= share.sum()
        w, b, vw, vb = np.zeros((x.shape[1], k)), np.zeros(k), 0.0, 0.0
        for _ in range(steps):
            z = x.times(w) + b
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - target) * share[:, None]
            vw, vb = 0.9 * vw - 30 * (x.turned_times(g) + ridge * w), 0.9 * vb - 3 * g.sum(axis=0)
            w, b = w + vw, b + vb
        return w, b

    @staticmethod
    def _temperature(z: np.ndarray, y: np.ndarray) -> float:
        """The factor on held-out logits with the least log loss."""

        def loss(t: float) -> float:
            s = z * t
            s = s - s.max(axis=1, keepdims=True)
            return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean()) if len(y) else 0.0

        return min(np.geomspace(0.1, 10, 41), key=loss)

    def _probabilities(self, hashes: np.ndarray, unit: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Units, numbered from 0 to n, with an n-gram of the vocabulary; the probabilities of the classes; whether a 3-gram is among them; the share of 2- and 3-grams that are known of every unit."""
        total, longer, known, phrase = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n, dtype=bool)
        at_all, unit_all = [], []
        for level, (g, of) in enumerate(self._levels(hashes, unit)):
            total += np.bincount(of, minlength=n)
            at = np.minimum(np.searchsorted(self.vocabulary, g), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == g
            at_all.append(at[hit])
            unit_all.append(of[hit])
            if level:
                longer += np.bincount(of, minlength=n)
                known += np.bincount(of[hit], minlength=n)
            if level == 2:
                phrase[of[hit]] = True
        at, of = np.concatenate(at_all), np.concatenate(unit_all)
        some, of = np.unique(of, return_inverse=True)
        score = np.zeros((len(some), len(self.classes)))
        for c in range(len(self.classes)):
            score[:, c] = np.bincount(of, weights=self.weight[at, c], minlength=len(some))
        z = (score / np.sqrt(np.maximum(total[some], 1))[:, None] + self.bias) * self.heat
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return some, p / p.sum(axis=1, keepdims=True), phrase[some], known / np.maximum(longer, 1)

    def _judged(self, p: np.ndarray, phrase: bool, text: bytes) -> tuple[str, float] | None:
        """Family and probability of a paragraph, None for ordinary text.  Of families that are equally likely the first one counts."""
        best = 1 + int(np.argmax(p[1:]))
        family, sure = self.classes[best], float(p[best])
        own = self._set(text.decode("utf-8", "replace"))
        if family != UNKNOWN and (sure < SURE or not any(self._alike(own, s) for s in self.templates[family])):
            family, sure = UNKNOWN, float(1 - p[0])
        elif family == UNKNOWN:
            sure = float(1 - p[0])
        return None if family == UNKNOWN and (sure < SURE_UNKNOWN or not phrase) else (family, sure)

    def lines(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Of rows of text: row of each licence line, its number and probability, lines of each row, and the families."""
        feeds = np.flatnonzero(data == 10) + 1
        heads = np.unique(np.concatenate([offsets[:-1], feeds[feeds < len(data)]])) if len(data) else np.zeros(0, dtype=np.int64)
        heads = heads[heads < len(data)]
        owner = np.searchsorted(offsets, heads, "right") - 1
        per_row = np.bincount(owner, minlength=len(offsets) - 1)[: len(offsets) - 1]
        none = np.zeros(0, dtype=np.int64)
        if not len(heads):
            return none, none, none.astype(float), per_row, []
        hashes, starts, _, _ = word_hashes(data, offsets, self.rule)
        line = np.searchsorted(heads, starts, "right") - 1
        ends = np.append(heads[1:], len(data))
        found: dict[int, tuple[str, float]] = {}
        some, p, phrase, known = self._probabilities(hashes, line, len(heads))
        part = known >= PART
        for i in np.flatnonzero(p[:, 0] < 0.5):
            k = int(some[i])
            if got := self._judged(p[i], bool(phrase[i]), data[heads[k] : ends[k]].tobytes()):
                found[k] = got
        # lines with words that follow each other in a row make a block; those of several lines are judged together too
        worded = np.bincount(line, minlength=len(heads)) > 0
        opens = worded & np.append(True, ~worded[:-1] | (owner[1:] != owner[:-1]))
        block = np.cumsum(opens) - 1
        size = np.bincount(block[worded], minlength=int(block[-1]) + 1 if len(block) else 0)
        several = size[block[line]] > 1 if len(line) else np.zeros(0, dtype=bool)
        if several.any():
            some, p, phrase, _ = self._probabilities(hashes[several], block[line[several]], len(size))
            for i in np.flatnonzero(p[:, 0] < 0.5):
                inside = np.flatnonzero((block == some[i]) & worded)
                if got := self._judged(p[i], bool(phrase[i]), data[heads[inside[0]] : ends[inside[-1]]].tobytes()):
                    for k in inside[part[inside]].tolist():
                        if k not in found or found[k][0] == UNKNOWN:
                            found[k] = got
        first = np.searchsorted(owner, np.arange(len(offsets) - 1))
        at = np.array(sorted(found), dtype=np.int64)
        return owner[at], at - first[owner[at]], np.array([found[k][1] for k in at.tolist()]), per_row, [found[k][0] for k in at.tolist()]


def scan(docs: DataFrame, scanner: Scanner | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_paragraphs, n_licence, licence, confidence, paragraphs array<struct<paragraph, licence, probability>>) of each row.

    Paragraphs are counted by lines; the lines of a wrapped notice all count as its family's.
    licence is the family of the surest paragraph of a known family, of equals the first;
    `unknown` if there is only licence text of none, `none` if there is none at all.
    A null or empty text has no paragraphs.  Repeated rows and null ids get a row
    each; other columns are not read.  One narrow pass, no shuffle.
    """

    scanner = Scanner() if scanner is None else scanner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for lo, hi in runs(offsets):
                rows, numbers, sure, per_row, names = scanner.lines(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                found: list[list[dict]] = [[] for _ in range(hi - lo)]
                for r, n, p, name in zip(rows.tolist(), numbers.tolist(), sure.tolist(), names, strict=True):
                    found[r].append({"paragraph": n, "licence": name, "probability": round(p, 6)})
                best = [max(f, key=lambda x: (x["licence"] != UNKNOWN, x["probability"], -x["paragraph"]), default=None) for f in found]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(per_row.astype(np.int64)),
                        pa.array([len(f) for f in found], pa.int64()),
                        pa.array([b["licence"] if b else NONE for b in best], pa.string()),
                        pa.array([b["probability"] if b else 0.0 for b in best], pa.float64()),
                        pa.array(found, pa.list_(pa.struct([("paragraph", pa.int64()), ("licence", pa.string()), ("probability", pa.float64())]))),
                    ],
                    names=[id_col, "n_paragraphs", "n_licence", "licence", "confidence", "paragraphs"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_paragraphs long, n_licence long, licence string, confidence double, paragraphs array<struct<paragraph:long,licence:string,probability:double>>"
    return docs.select(docs[id_col], docs[text_col].cast("string").alias("text")).mapInArrow(run, schema)
