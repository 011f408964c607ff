"""Licence scans: a trained paragraph classifier in DataFrame functions, confirmed by templates."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoferry.llm.common import columns_as

# The classes that are no family: a notice of some other licence, and what is no notice.
UNKNOWN, NONE = "unknown", "none"

# What licences of each family are called, and their SPDX names.
NAMES = {
    "MIT": (["MIT License", "MIT licence", "Expat License", "MIT/X11 license"], ["MIT"]),
    "Apache": (["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache Software License"], ["Apache-2.0", "Apache 2"]),
    "GPL": (
        ["GNU General Public License", "GNU General Public License, version 3", "GNU General Public License version 2 or later", "GNU GPL",
         "GPLv2", "GPLv3", "GPLv3 or later", "GPL version 3"],
        ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0"],
    ),
    "LGPL": (
        ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU Library General Public License", "LGPLv2.1", "LGPLv3"],
        ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    ),
    "AGPL": (["GNU Affero General Public License", "GNU Affero General Public License, version 3", "AGPLv3", "GNU AGPL"], ["AGPL-3.0-only", "AGPL-3.0-or-later"]),
    "BSD": (["BSD License", "BSD 3-Clause License", "3-clause BSD license", "2-clause BSD license", "Simplified BSD License", "Modified BSD License"],
            ["BSD-2-Clause", "BSD-3-Clause"]),
    "MPL": (["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License"], ["MPL-2.0", "MPL-1.1"]),
    "EPL": (["Eclipse Public License 2.0", "Eclipse Public License, version 1.0", "Eclipse Public License"], ["EPL-1.0", "EPL-2.0"]),
    "CDDL": (["Common Development and Distribution License"], ["CDDL-1.0", "CDDL-1.1"]),
    "EUPL": (["European Union Public Licence", "European Union Public License 1.2"], ["EUPL-1.2"]),
    "Artistic": (["Artistic License", "Artistic License 2.0", "Perl Artistic License"], ["Artistic-1.0", "Artistic-2.0"]),
    "Zlib": (["zlib license", "zlib/libpng license"], ["Zlib"]),
    "Boost": (["Boost Software License", "Boost Software License, Version 1.0"], ["BSL-1.0"]),
    "ISC": (["ISC License", "ISC licence"], ["ISC"]),
    "OFL": (["SIL Open Font License", "SIL Open Font License, Version 1.1", "Open Font License"], ["OFL-1.1"]),
    "Python": (["Python Software Foundation License", "PSF license"], ["PSF-2.0", "Python-2.0"]),
    "MS-PL": (["Microsoft Public License"], ["MS-PL"]),
    "ODbL": (["Open Database License", "Open Data Commons Open Database License"], ["ODbL-1.0"]),
    "WTFPL": (["WTFPL", "Do What The Fuck You Want To Public License"], ["WTFPL"]),
    "Unlicense": (["Unlicense"], ["Unlicense"]),
    "CC0": (["CC0 1.0 Universal", "Creative Commons Zero license", "CC0 public domain dedication"], ["CC0-1.0"]),
    "CC-BY": (["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution license"], ["CC-BY-4.0", "CC-BY-3.0"]),
    "CC-BY-SA": (["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"], ["CC-BY-SA-4.0", "CC-BY-SA-3.0"]),
    "CC-BY-NC": (["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"], ["CC-BY-NC-4.0", "CC-BY-NC-3.0"]),
    "CC-BY-ND": (["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"], ["CC-BY-ND-4.0", "CC-BY-ND-3.0"]),
    "CC-BY-NC-SA": (["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"], ["CC-BY-NC-SA-4.0"]),
    "CC-BY-NC-ND": (["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"], ["CC-BY-NC-ND-4.0"]),
    "MIT or GPL": (["MIT and GPL licenses", "MIT or GPL license", "MIT/GPL"], ["MIT OR GPL-2.0", "MIT OR GPL-3.0"]),
    "MIT or Apache": (["MIT or Apache 2.0 license", "MIT/Apache-2.0", "MIT and Apache licenses"], ["MIT OR Apache-2.0", "Apache-2.0 OR MIT"]),
}
# How a name is put, and how an SPDX name is.
NAME_FORMS = ["Licensed under the {}.", "Released under the {}.", "Distributed under the {}.", "This work is licensed under a {}.",
              "This project is licensed under the terms of the {}.", "Licensed under {}, see LICENSE for details.", "Dual licensed under the {}.",
              "Available under the {}.", "{}"]
ID_FORMS = ["SPDX-License-Identifier: {}", "License: {}", "Licensed under {}.", "Released under {}.", "{}"]
DUAL_FORMS = ["Dual {}", "Dual licensed {}."]

# Paragraphs of the licences themselves and of the notices that they ask for.
TEXTS = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("MIT", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("Apache", "See the License for the specific language governing permissions and limitations under the License."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("GPL", "See the GNU General Public License for more details."),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL", "You should have received a copy of the GNU Lesser General Public License along with this library."),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0."),
    ("CDDL", "The contents of this file are subject to the terms of the Common Development and Distribution License."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty."),
    ("Zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("Zlib", "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software."),
    ("Boost", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    ("Boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("OFL", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0", "Released into the public domain under CC0 1.0 Universal, no copyright is claimed."),
    ("All rights reserved", "All rights reserved."),
    ("All rights reserved", "Copyright (c) 2020 the authors. All rights reserved."),
    ("All rights reserved", "No part of this publication may be reproduced, distributed or transmitted in any form or by any means without the prior written permission of the publisher."),
    ("All rights reserved", "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited."),
]
# Sentences that speak of licences or like them without being a notice.
OTHERS = [
    "You need a driving license to rent a car in this country.",
    "The bar lost its liquor licence after the fire.",
    "The company sold a license for its patents to a competitor.",
    "Copyright law protects the works of authors and composers.",
    "He asked for permission to leave the room.",
    "She gave her permission to use the picture.",
    "The warranty covers parts and labour for two years.",
    "A search warrant was issued by the judge.",
    "The gnu grazes in herds on the open plain.",
    "The House of Commons votes on the bill tomorrow.",
    "This domain is for sale, contact the owner.",
    "The general public was asked to give its view of the fishing license.",
    "Public opinion of the new licence fee for television is divided.",
    "He is a licensed electrician with twenty years of work.",
    "Is this product licensed for children under the age of three?",
    "Version 2.0 of the program needs a license key.",
    "The redistribution of income was at the centre of the debate.",
    "The number plate is called a license plate in other places.",
    "The artist released a new album under a small label and kept the copyright.",
    "No permission is needed to walk here.",
    "The licence of the station was not renewed by the agency.",
    "Their creative work is shown in the commons room.",
    "Under the license agreement the fee is due each year.",
    "All seats are reserved for guests of the hotel.",
    "Human rights are the rights of all people.",
    "The eclipse of the sun was seen by the general public.",
    "The software is free of charge for schools.",
    "He works for a software company in Boston and likes the apache helicopter.",
    "The rocket boost was provided by a second engine.",
    "The library is open to the public and free of charge.",
    "Students of the institute may use the source of the river for any purpose.",
    "The author of the book wrote the original version in two years.",
    "A copy of the letter was distributed to all contributors.",
    "The program is available in the following languages.",
    "The font of the title is open and modern.",
    "The conditions of the contract were met, and the claim was settled without liability.",
    "Sie fährt mit dem Zug nach Hause und liest dabei.",
]
# Names of no licence that is known here, for notices that are of no family.
OTHER_NAMES = ["Acme License", "Foo Public License", "house license", "license of the company", "Example Software License, Version 4.1",
               "Open Gadget License 3.0", "terms of the vendor", "Server Side Public License", "PostgreSQL License", "Community Source License",
               "same license", "OpenSSL license", "Sleepycat License", "Nokia Open Source License", "general license of the city"]
# How people speak of a licence, with a thing in the place of {}.
OTHER_FORMS = ["He got a license for the {}.", "The license of the {} was lost.", "Please read the license before you use the {}.",
               "The {} is licensed.", "a license to use the {}", "The public {} was sold.", "Copyright (C) 2019 {}", "the {} license"]
OTHER_THINGS = ["software", "car", "program", "library", "domain", "source", "work", "file", "copy", "project"]
# Words that say nothing by themselves, in English or as words of other languages.
COMMON = frozenset(
    "a an and any all are as at be been being but by can do each either even event except for from he her him his i if in into is it its "
    "law long may me more must my name no not of on one only or other our own part place she should so some such than that the their "
    "them then there these they this those to two under up us via was we were what where which will with without you your "
    "here see rent s nd nc sa mit die der das dem und la le les des en et de du un une que el y".split()
)
LENGTHS = (1, 2, 3, 4)

CONFIDENCE = 0.5
# Paragraphs that are at least this likely to be a notice of any kind are shown, as unknown if of no family.
WORTH_SHOWING = 0.5
CONFIRMED = 0.6
STEPS = 300
RATE = 60.0
RIDGE = 1e-5
# How much likelier than all else together it is that a paragraph without evidence is no notice.
PRIOR = 10

# A paragraph ends at an empty line, and at a line's end where a sentence ends too; other line breaks are spaces.
_END = r"(?:\r\n|\r(?!\n)|(?<!\r)\n)"
PARAGRAPHS = rf"{_END}[ \t]*{_END}\s*|(?<=[.!?:;][\"')\]]?)[ \t]*{_END}\s*"
WORDS = r"[^\p{L}\p{N}]+"


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def is_telling(word: str) -> bool:
    """Whether a word by itself can be a sign of licence wording."""
    return word not in COMMON and not word.isdigit()


def grams_of(words: list[str]) -> set[str]:
    """The n-grams of up to four words that have a telling one."""
    telling = [is_telling(w) for w in words]
    return {
        " ".join(words[k : k + n])
        for n in LENGTHS
        for k in range(len(words) - n + 1)
        if any(telling[k : k + n])
    }


def templates() -> list[tuple[str, str]]:
    """All texts that stand for a family: what the licences say, and their names in the forms of notices."""
    made = list(TEXTS)
    for family, (names, ids) in NAMES.items():
        made += [(family, form.format(name)) for name in names for form in NAME_FORMS]
        # A short name stands by itself only if it can't be taken for a word.
        made += [(family, form.format(i)) for i in ids for form in ID_FORMS if form != "{}" or re.search(r"[-0-9]", i)]
        if " or " in family:
            made += [(family, form.format(name)) for name in names for form in DUAL_FORMS]
    return made


@dataclass(frozen=True)
class Classifier:
    families: list[str]  # the last are UNKNOWN and NONE
    weights: dict[str, list[float]]
    bias: list[float]
    telling: list[str]  # a paragraph without any of these words has no n-gram with a weight


def examples() -> list[tuple[str, set[str]]]:
    """Templates as they are, without one end or the other, and inside other words; other sentences likewise;
    and words of the templates out of their order, which are no notice."""
    out = []
    others = [(UNKNOWN, form.format(name)) for name in OTHER_NAMES for form in NAME_FORMS if form != "{}"]
    others += [(NONE, form.format(thing)) for thing in OTHER_THINGS for form in OTHER_FORMS]
    for family, text in [*templates(), *others, *((NONE, t) for t in OTHERS)]:
        words = words_of(text)
        cut = [words]
        if len(words) > 12:
            cut += [["lorem", *words, "ipsum"], words[3:], words[:-3], words[: len(words) * 2 // 3]]
        out += [(family, grams_of(w)) for w in cut]
    words = sorted({w for _, text in templates() for w in words_of(text) if is_telling(w)})
    rng = np.random.default_rng(0)
    out += [(NONE, {w}) for w in words]
    out += [(NONE, set(rng.choice(words, size).tolist())) for size in (2, 3, 5, 8, 12) for _ in range(60)]
    return [(family, grams) for family, grams in out if grams]


@lru_cache(1)
def trained() -> Classifier:
    """Softmax regression on the n-grams of the examples, by gradient descent, then one temperature that
    makes the chances right on every third example, which the weights of the first fit haven't seen.

    The steps are taken on one coefficient per example and class, of which the weights are sums.
    """
    rows = examples()
    families = [*sorted({f for f, _ in rows} - {UNKNOWN, NONE}), UNKNOWN, NONE]
    grams = sorted(set().union(*(g for _, g in rows)))
    place = {g: k for k, g in enumerate(grams)}
    x = np.zeros((len(rows), len(grams)), np.float32)
    for k, (_, own) in enumerate(rows):
        x[k, [place[g] for g in own]] = 1 / np.sqrt(len(own))
    y = np.eye(len(families), dtype=np.float32)[[families.index(f) for f, _ in rows]]
    alike = x @ x.T

    def fit(use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.zeros((len(use), y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
        own, wanted = alike[np.ix_(use, use)], y[use]
        # Families have as much say as they have classes, however many examples there are of them.
        share = 1 / wanted.sum(axis=0).clip(1)[wanted.argmax(axis=1)][:, None] / len(families)
        b[-1] = np.log(PRIOR * len(families))  # without any evidence a paragraph is no notice
        for _ in range(STEPS):
            slope = (softmax(own @ a + b) - wanted) * (0.5 / len(use) + 0.5 * share).astype(np.float32)
            a = a * (1 - RATE * RIDGE) - RATE * slope
        return a, b

    held = np.arange(len(rows)) % 3 == 2
    a, b = fit(np.flatnonzero(~held))
    scores = alike[np.ix_(held, ~held)] @ a + b
    loss = {t: -np.log(softmax(scores / t)[y[held] == 1]).mean() for t in np.linspace(0.2, 4, 77)}
    heat = min(loss, key=loss.get)
    a, b = fit(np.arange(len(rows)))
    w = x.T.astype(float) @ a / heat
    # What is the same for all families moves no prediction, and neither do n-grams without any leaning.
    keep = np.flatnonzero(np.abs(w - w.mean(axis=1, keepdims=True)).max(axis=1) > 1e-3)
    weights = {grams[k]: w[k].round(4).tolist() for k in keep.tolist()}
    # What has no word of any template can be nothing but NONE.
    telling = sorted({word for g in weights for word in g.split(" ")} & set(words_of(" ".join(t for _, t in templates()))) - COMMON)
    telling = [word for word in telling if is_telling(word)]
    return Classifier(families, weights, (b / heat).round(4).tolist(), telling)


def softmax(scores: np.ndarray) -> np.ndarray:
    out = np.exp(scores - scores.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def ngrams(words: Column) -> Column:
    """All different n-grams of an array of words."""

    def of_length(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
        starts = starts.otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda k: F.array_join(F.slice(words, k, n), " "))

    return F.array_distinct(F.concat(*map(of_length, LENGTHS)))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    confidence: float = CONFIDENCE,
    worth_showing: float = WORTH_SHOWING,
) -> DataFrame:
    """(id, paragraph, family, probability, similarity, confirmed, template, notice) for every paragraph that
    is likely to be licence wording.

    Paragraphs end at empty lines and at line ends that end a sentence; `paragraph` is the number from 0. All
    of a paragraph's n-grams are scored. Its family is the likeliest one if its probability is at least `confidence`;
    else it is `unknown`, with the probability of the class of notices of other licences, and shown if the
    chance of its being a notice at all is at least `worth_showing`. similarity is the largest share of a template's n-grams, of that
    family, that the paragraph has; from 0.6 on the prediction is confirmed. Paragraphs without any n-gram that the
    classifier has a weight for are no notices and not shown. Null and empty texts have no notices;
    repeated rows and rows without an id are scanned each on its own; other columns aren't read.
    """
    model = trained()
    spark = docs.sparkSession
    rows = columns_as(docs, id=id_col, text=text_col)
    parts = rows.select(
        "id", F.monotonically_increasing_id().alias("row"), F.posexplode(F.split("text", PARAGRAPHS)).alias("paragraph", "notice")
    )
    # A column of its own: inside the n-grams it would be made again for each of them.
    words = parts.withColumn("words", F.array_remove(F.split(F.lower("notice"), WORDS), ""))
    # Every n-gram with a weight has one of these words: the words of the templates, but for the commonest.
    told = words.where(F.arrays_overlap("words", F.array(*map(F.lit, model.telling))))
    # The notice travels once, beside a sign that is no n-gram, and not with each of them.
    sign = F.struct(F.lit("").alias("gram"), "notice")
    others = F.transform(ngrams(F.col("words")), lambda g: F.struct(g.alias("gram"), F.lit(None).cast("string").alias("notice")))
    marked = told.select("id", "row", "paragraph", F.inline(F.concat(F.array(sign), others)))
    nothing = {"": [0.0] * len(model.families)}
    table = json.dumps([{"gram": g, "w": w} for g, w in sorted((nothing | model.weights).items())])
    # The classifier's own n-grams: as many as the templates have.
    weights = spark.range(1).select(F.inline(F.from_json(F.lit(table), "array<struct<gram string, w array<double>>>")))
    count = F.sqrt(F.greatest(F.count_if(F.col("gram") != ""), F.lit(1)))
    sums = [(F.sum(F.col("w")[k]) / count).alias(f"s{k}") for k in range(len(model.families))]
    scored = (
        marked.join(F.broadcast(weights), "gram")
        .groupBy("row", "paragraph")
        .agg(F.first("id").alias("id"), F.max("notice").alias("notice"), F.collect_set("gram").alias("grams"), *sums)
        .where(F.size("grams") > 1)
    )
    scores = F.array(*[F.col(f"s{k}") + F.lit(bias) for k, bias in enumerate(model.bias)])
    scored = scored.select("row", "paragraph", "id", "notice", "grams", scores.alias("scores"))
    scored = scored.withColumn("powers", F.transform("scores", lambda s: F.exp(s - F.array_max("scores"))))
    total = F.aggregate("powers", F.lit(0.0), lambda a, p: a + p)
    scored = scored.withColumn("chances", F.transform("powers", lambda p: p / total))
    names = F.array(*map(F.lit, model.families[:-2]))
    named = F.zip_with(F.slice("chances", 1, len(model.families) - 2), names, lambda p, f: F.struct(p.alias("p"), f.alias("family")))
    scored = scored.withColumn("likeliest", F.array_max(named)).withColumn("none", F.element_at("chances", -1))
    scored = scored.withColumn("other", F.element_at("chances", -2))
    sure = F.col("likeliest.p") >= confidence
    best = scored.where(sure | (1 - F.col("none") >= worth_showing)).select(
        *["id", "paragraph", "notice", "grams"],
        F.when(sure, F.col("likeliest.family")).otherwise(UNKNOWN).alias("family"),
        F.when(sure, F.col("likeliest.p")).otherwise(F.col("other")).alias("p"),
    )
    texts = [
        {"family": f, "template": t, "grams": sorted(grams_of(words_of(t)) & model.weights.keys())} for f, t in templates()
    ]
    kind = "array<struct<family string, template string, grams array<string>>>"
    listed = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(texts)), kind))).where(F.size("grams") > 0)
    # One row for each family.
    known = listed.groupBy("family").agg(F.collect_list(F.struct("template", F.col("grams").alias("own"))).alias("templates"))
    likeness = F.transform(
        "templates",
        lambda t: F.struct((F.size(F.array_intersect(t["own"], F.col("grams"))) / F.size(t["own"])).alias("share"), t["template"].alias("template")),
    )
    # A generated column is computed once, where a projected one is repeated for every use of it.
    alike = best.join(F.broadcast(known), "family", "left").select("*", F.explode(F.array(F.array_max(likeness))).alias("alike"))
    return alike.select(
        "id",
        "paragraph",
        "family",
        F.col("p").alias("probability"),
        F.coalesce("alike.share", F.lit(0.0)).alias("similarity"),
        (F.coalesce("alike.share", F.lit(0.0)) >= CONFIRMED).alias("confirmed"),
        F.when(F.col("alike.share") >= CONFIRMED, F.col("alike.template")).alias("template"),
        "notice",
    )
