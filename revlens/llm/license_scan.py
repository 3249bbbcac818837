"""License scan (native DataFrame code only): every line and every
template-sized window of words of a document is compared with license templates
by the Dice coefficient over word bigrams.

Normalised text is lower-cased, and its words are runs of letters and digits.
With sets of bigrams A and B the coefficient is 2|A n B| / (|A| + |B|); it can
reach t only if the smaller set has at least t / (2 - t) times the larger
one's size.  A line is compared only with templates whose size passes that
bound; a line that passes for none is dropped before its bigrams are built.

Windows run over the words of the whole text, across line breaks, and have as
many words as the template.  A document is searched for a template only if it
holds the least share of the template's bigrams that the bound asks for; the
windows start at the template's bigrams, as moving a window up to its first one
loses none, and a match ends with the last of them in its window.  Of overlapping matches of different licenses the better one counts,
of equally good ones the longer.  Long license bodies are told by passages of
their own, and identifier tags (one line) are templates too.

Templates are a fixed, small table, so they are folded into the expressions;
nothing is joined or shuffled and every document is one row throughout.  NULL
and empty texts have no line and no license.  Repeated rows are scanned one
by one.  Lines of one word have no bigram and match nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short notices by which texts state their license.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License."),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.",
                     "Use of this source code is governed by a BSD-style license."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
#: Standard headers and license bodies, found in windows across line breaks.
PASSAGES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
        "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    **{name: (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        f"{kind}General Public License as published by the Free Software Foundation, either version {version} of the "
        "License, or (at your option) any later version.",)
       for name, kind, version in (("GPL-3.0", "", 3), ("GPL-2.0", "", 2),
                                   ("LGPL-3.0", "Lesser ", 3), ("AGPL-3.0", "Affero ", 3))},
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",),
}
_FSF = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
#: Passages by which the long license bodies are told apart (their
#: opening or first grant), found in windows across line breaks.
BODIES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms "
        "and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. "
        "\"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the "
        "License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
        "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
        "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
        "Derivative Works in Source or Object form.",),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        "COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES",),
    "GPL-3.0": (
        f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. "
        f"<https://fsf.org/> {_FSF} Preamble The GNU General Public License is a free, copyleft license for software "
        "and other kinds of works.",),
    "AGPL-3.0": (
        f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, "
        f"Inc. <https://fsf.org/> {_FSF} Preamble The GNU Affero General Public License is a free, copyleft license "
        "for software and other kinds of works, specifically designed to ensure cooperation with the community in the "
        "case of network server software.",),
    "LGPL-3.0": (
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of "
        "the GNU General Public License, supplemented by the additional permissions listed below.",),
    "LGPL-2.1": (
        f"{_FSF} [This is the first released version of the Lesser GPL. It also counts as the successor of the GNU "
        "Library Public License, version 2, hence the version number 2.1.]",),
    "GPL-2.0": (
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, "
        "the GNU General Public License is intended to guarantee your freedom to share and change free software--to "
        "make sure the software is free for all its users.",),
    "MPL-2.0": (
        "\"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns "
        "Covered Software. 1.2. \"Contributor Version\" means the combination of the Contributions of others (if any) "
        "used by a Contributor and that particular Contributor's Contribution.",),
    "CC0-1.0": (
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related "
        "Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original "
        "work of authorship and/or a database (each, a \"Work\").",),
    **{f"CC-{short}-4.0": (
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and "
        f"conditions of this Creative Commons {name} 4.0 International Public License (\"Public License\").",)
       for short, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
                           ("BY-NC", "Attribution-NonCommercial"))},
}


def tags() -> dict[str, tuple[str, ...]]:
    """The one-line tag that names a license by its identifier."""
    names = dict.fromkeys([*TEMPLATES, *PASSAGES, *BODIES])
    return {name: (f"SPDX-License-Identifier: {name}",) for name in names}


#: Least coefficient of a match.
THRESHOLD = 0.9

WORD = "[^0-9a-z]+"


def _words(text: str) -> list[str]:
    return [w for w in re.split(WORD, text.lower()) if w]


def _bigrams(text: str) -> list[str]:
    words = _words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def templates() -> list[tuple[str, list[str]]]:
    return [(name, _bigrams(t)) for name, texts in TEMPLATES.items() for t in texts]


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Sizes of sets that can reach the threshold with a set of ``size``."""
    ratio = threshold / (2 - threshold)
    return -int(-size * ratio // 1), int(size / ratio)


def _line_words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), WORD), lambda w: w != "")


def _pairs(words: Column) -> Column:
    # Zipped with itself shifted by one, cut to equal lengths.
    first = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    second = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(first, second, lambda a, b: F.concat_ws(" ", a, b))


def _line_bigrams(words: Column) -> Column:
    return F.array_distinct(_pairs(words))


def _best(grams: Column, threshold: float) -> Column:
    """The best template of a line as (dice, license), NULL below the threshold."""
    found = []
    for name, template in templates():
        low, high = size_bounds(len(template), threshold)
        shared = F.size(F.array_intersect(grams, F.array(*map(F.lit, template))))
        dice = 2.0 * shared / (F.size(grams) + len(template))
        found.append(F.when(F.size(grams).between(low, high) & (dice >= threshold),
                            F.struct(dice.alias("dice"), F.lit(name).alias("license"))))
    return F.array_max(F.array(*found))


def passages() -> list[tuple[str, int, list[str]]]:
    """License, words and bigrams of every template that windows are compared with."""
    return [(name, len(_words(t)), _bigrams(t)) for table in (TEMPLATES, PASSAGES, BODIES, tags())
            for name, texts in table.items() for t in texts]


def trigger_words(threshold: float) -> list[str]:
    """Words of which any matching window holds at least one: of each template
    so many that the bigrams without them are too few for a match."""
    chosen: set[str] = set()
    common = {"a", "an", "and", "any", "as", "at", "be", "by", "for", "in", "is", "it", "of", "on", "or", "the", "this",
              "to", "under", "with", "work", "you", "all", "use", "that", "from", "not", "may", "can", "0", "2", "3", "4"}
    for _, _, grams in sorted(passages(), key=lambda p: len(p[2])):
        least, _ = size_bounds(len(grams), threshold)
        left = [g.split() for g in grams if not chosen & set(g.split())]
        while len(left) >= least:
            count = {w: sum(w in g for g in left) for g in left for w in g}
            word = max(count, key=lambda w: (w not in common, "licens" in w, count[w], len(w), w))
            chosen.add(word)
            left = [g for g in left if word not in g]
    return sorted(chosen)


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _windows(pairs: Column, name: str, words: int, template: list[str], threshold: float) -> Column:
    """Matches (dice, license, start, stop) of one template in the bigrams of a text."""
    least, _ = size_bounds(len(template), threshold)
    grams = F.array(*map(F.lit, template))
    numbered = F.transform(pairs, lambda g, i: F.struct(i.alias("i"), F.array_contains(grams, g).alias("hit")))
    places = F.transform(F.filter(numbered, lambda x: x["hit"]), lambda x: x["i"])

    def matched(at: Column) -> Column:
        starts = F.filter(at, lambda s: F.size(F.filter(at, lambda x: (x >= s) & (x < s + words - 1))) >= least)

        def judged(s: Column) -> Column:
            return _let(F.array_distinct(F.slice(pairs, s + 1, words - 1)), lambda window: F.struct(
                (2.0 * F.size(F.array_intersect(window, grams)) / (F.size(window) + len(template))).alias("dice"),
                F.lit(name).alias("license"), s.alias("start"),
                (F.array_max(F.filter(at, lambda x: (x >= s) & (x < s + words - 1))) + 2).alias("stop")))

        return F.filter(F.transform(starts, judged), lambda m: m["dice"] >= threshold)

    return _let(places, matched)


MATCHES = "array<struct<dice:double,license:string,start:int,stop:int>>"


def _passages(text: Column, threshold: float) -> Column:
    """All matches of windows of a text, without those that a better match of
    another license, or a longer one that is as good, overlaps."""
    none = F.array().cast(MATCHES)
    templates_ = passages()
    every = F.array(*map(F.lit, sorted({g for _, _, grams in templates_ for g in grams})))

    def found(pairs: Column) -> Column:
        def each(shared: Column) -> Column:
            parts = []
            for name, words, grams in templates_:
                held = F.size(F.array_intersect(shared, F.array(*map(F.lit, grams))))
                parts.append(F.when(held >= size_bounds(len(grams), threshold)[0],
                                    _windows(pairs, name, words, grams, threshold).cast(MATCHES)).otherwise(none))
            return F.concat(*parts)

        least = min(size_bounds(len(g), threshold)[0] for _, _, g in templates_)
        return _let(F.array_intersect(pairs, every), lambda shared: F.when(
            F.size(shared) >= least, each(shared)).otherwise(none))

    def best(matches: Column) -> Column:
        return F.filter(matches, lambda m: ~F.exists(matches, lambda o: (
            (o["license"] != m["license"]) & (o["start"] < m["stop"]) & (m["start"] < o["stop"]) & (
                (o["dice"] > m["dice"]) | ((o["dice"] == m["dice"]) & (o["stop"] - o["start"] > m["stop"] - m["start"]))))))

    trigger = "(?i)(?<![0-9a-z])(?:" + "|".join(trigger_words(threshold)) + ")(?![0-9a-z])"
    return F.when(text.rlike(trigger), _let(_let(_pairs(_line_words(text)), found), best)).otherwise(none)


def license_scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_lines, n_compared (lines within the
    size bounds of some template), licenses (sorted distinct names, of lines and
    windows), n_license_lines, best_dice (NULL without a match)."""
    bounds = [size_bounds(len(t), threshold) for _, t in templates()]
    low, high = min(a for a, _ in bounds), max(b for _, b in bounds)
    # A set of n bigrams needs n + 1 words; repeated bigrams can only make a
    # line longer, so the upper bound holds on the set, not on the line.
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lines.alias("lines"),
                        _passages(F.coalesce(F.col("text"), F.lit("")), threshold).alias("passages"))
    # The last character class test is cheap and drops lines before the split.
    least = f"(?s)(?:[0-9A-Za-z]+[^0-9A-Za-z]+){{{low}}}[0-9A-Za-z]"
    sets = F.transform(F.filter("lines", lambda x: x.rlike(least)), lambda x: _line_bigrams(_line_words(x)))
    near = split.select("doc_id", "passages", F.size("lines").cast("long").alias("n_lines"),
                        F.filter(sets, lambda g: F.size(g).between(low, high)).alias("sets"))
    hits = F.filter(F.transform("sets", lambda g: _best(g, threshold)), lambda x: x.isNotNull())
    return near.select(
        "doc_id", "n_lines", "passages", F.size("sets").cast("long").alias("n_compared"), hits.alias("hits"),
    ).select(
        "doc_id", "n_lines", "n_compared", F.size("hits").cast("long").alias("n_license_lines"),
        F.array_sort(F.array_union(F.col("hits.license"), F.col("passages.license"))).alias("licenses"),
        F.array_max(F.concat(F.col("hits.dice"), F.col("passages.dice"))).alias("best_dice"))
