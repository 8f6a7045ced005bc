"""License scans: a trained paragraph classifier over sparse word n-grams, native throughout.

Paragraphs that hold a word of the license vocabulary are scored by a multinomial
logistic regression over one- and two-word features; class probabilities are tempered on
held-back rows, and below the calibrated cut a paragraph is of the unknown class.  A
predicted family counts only if one of its templates is found in the paragraph (share of the
template's n-grams), with the words that tell the family from its neighbours (``SIGNS``: version
numbers, "affero", "sharealike", ...), without those of another, and without a denial ("not licensed
under").  A paragraph is a line or, for wrapped notices, a run of neighbouring lines
without a line free of words between them: the shortest run from a candidate line on (or from
the lines without license words before it) that confirms a family, and the lines after it for as
long as they add to a template.  The other lines of such a run give no rows of their own.  Fitting and scoring use DataFrame, SQL and Spark ML functions only: no
Python runs on executors, and scoring is one pass over the texts without a shuffle.

The model is fitted on a bounded sample: every template with words left out by a rule, and
corpus lines, license-like ones among them unless a template stands around them, as the
unknown class.

Defined results: null or empty texts give no rows; a text without line breaks is one
paragraph, however long; repeated rows give repeated results; extra columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Corpus documents and paragraphs that stand for the unknown class in training, at most.
SAMPLE_DOCS, SAMPLE_PARAGRAPHS = 400, 1500
#: License-like lines (two or more words of the vocabulary) that join them, at most.
SAMPLE_ALIKE = 500
#: Copies of each template with words left out, and the share of words that stay (percent).
COPIES, STAY = 40, 85
#: Share of the held-back unknown paragraphs that must stay below the cut.
UNKNOWN_QUANTILE = 0.995
#: Share of a template's n-grams that confirms a prediction.
CONFIRM = 0.6
UNKNOWN = "unknown"

#: Notices of public licences, by family.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-1.1", "Licensed under the Apache Software License, Version 1.1."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
                "License, or (at your option) any later version."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                 "GNU Affero General Public License as published by the Free Software Foundation, either version 3 "
                 "of the License, or (at your option) any later version."),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                        "International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                        "International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("EPL-2.0", "This program is made available under the terms of the Eclipse Public License 2.0."),
    ("EPL-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Released under the Unlicense."),
    (UNKNOWN, "All rights reserved."),
    (UNKNOWN, "This software is proprietary and confidential."),
    (UNKNOWN, "Licensed under a commercial agreement with the publisher."),
    (UNKNOWN, "See the license of each file for details."),
    (UNKNOWN, "The terms of use apply to this version."),
    # near families without templates, and notices that deny a licence
    (UNKNOWN, "Licensed under the Apache License, Version 1.0."),
    (UNKNOWN, "This work is licensed under the GNU General Public License, version 1."),
    (UNKNOWN, "Licensed under the GNU Free Documentation License, version 1.3."),
    (UNKNOWN, "Licensed under CC BY 3.0."),
    (UNKNOWN, "Licensed under CC BY-SA 2.5."),
    (UNKNOWN, "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    (UNKNOWN, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1."),
    (UNKNOWN, "This project is not licensed under the MIT License."),
    (UNKNOWN, "This work is not licensed under the GNU General Public License."),
    (UNKNOWN, "It is no longer released under the Apache License."),
]
#: Words and pairs of words that tell a family from its neighbours: of each list of the first
#: part one must be there, and none of the second part.
_GNU3 = ["version 3", "v3", "gplv3", "gpl3", "gpl 3", "license 3", "agplv3", "agpl 3"]
_GNU2 = ["version 2", "v2", "gplv2", "gpl2", "gpl 2", "license 2"]
_NOT_GPL = ["lesser", "library", "lgpl", "lgplv2", "lgplv3", "affero", "agpl", "agplv3"]
_CC, _FOUR = ["cc by", "creative commons", "identifier cc"], ["4 0"]
_OLD = ["3 0", "2 5", "2 0", "1 0"]
_NC, _SA, _ND = (["noncommercial", "non commercial", "nc"], ["sharealike", "share alike", "sa"],
                 ["noderivatives", "noderivs", "no derivatives", "nd"])
SIGNS = {
    "MIT": ([["mit", "person obtaining"]], []),
    "ISC": ([["isc", "without fee"]], []),
    "Apache-2.0": ([["apache"], ["version 2", "2 0", "v2"]], ["version 1", "1 0", "1 1"]),
    "Apache-1.1": ([["apache"], ["1 1"]], ["version 2", "2 0"]),
    "GPL-3.0": ([["gnu general", "gpl", "gplv3", "gpl3"], _GNU3], [*_NOT_GPL, *_GNU2]),
    "GPL-2.0": ([["gnu general", "gpl", "gplv2", "gpl2"], _GNU2], [*_NOT_GPL, *_GNU3]),
    "AGPL-3.0": ([["affero", "agpl", "agplv3"], _GNU3], ["lesser", "lgpl"]),
    "LGPL": ([["lesser general", "lgpl", "lgplv2", "lgplv3"]], ["affero", "agpl"]),
    "CC-BY-4.0": ([_CC, _FOUR], [*_NC, *_SA, *_ND, *_OLD]),
    "CC-BY-SA-4.0": ([_CC, _FOUR, _SA], [*_NC, *_ND, *_OLD]),
    "CC-BY-ND-4.0": ([_CC, _FOUR, _ND], [*_NC, *_SA, *_OLD]),
    "CC-BY-NC-4.0": ([_CC, _FOUR, _NC], [*_SA, *_ND, *_OLD]),
    "CC-BY-NC-SA-4.0": ([_CC, _FOUR, _NC, _SA], [*_ND, *_OLD]),
    "CC-BY-NC-ND-4.0": ([_CC, _FOUR, _NC, _ND], [*_SA, *_OLD]),
    "BSD-3-Clause": ([["bsd"], ["3 clause"]], ["2 clause", "4 clause"]),
    "BSD-2-Clause": ([["bsd"], ["2 clause"]], ["3 clause", "4 clause"]),
    "BSD": ([["redistribution and"]], []),
    "MPL-2.0": ([["mozilla", "mpl"], ["2 0"]], ["1 0", "1 1"]),
    "EPL-2.0": ([["eclipse", "epl"], ["2 0"]], ["1 0"]),
    "Unlicense": ([["unlicense", "unencumbered"]], []),
}
#: Pairs of words that deny what follows.
DENIALS = [f"{a} {b}" for a in ("not", "t", "never", "nor") for b in ("licensed", "released", "distributed", "available",
                                                                      "covered", "under")] + ["no longer"]
FAMILIES = [UNKNOWN, *dict.fromkeys(f for f, _ in TEMPLATES if f != UNKNOWN)]
#: Words that don't make a paragraph a candidate on their own (common words, also of other languages).
COMMON = set("""a all and any apply are as at be by copy deal each following for form forms free from general
    in is it may met mit no not of on or person person project see source terms that the this to use v version
    whether with without work works you can except code binary file files provided program subject details
    conditions charge granted hereby above appear available copies domain either fee free into later longer made
    modify notice only option permission permitted published purpose redistribute released restriction rights
    reserved associated documentation agreement each clause international identifier publisher use can commercial
    obtaining forms confidential foundation attribution commons creative published compliance library
    share alike non sa nd nc by cc project unported""".split())


#: Words that settle a family: copies of a template for training keep them.
KEPT = sorted({w for needs, bars in SIGNS.values() for g in [*sum(needs, []), *bars] for w in g.split()}
              | {w for d in DENIALS for w in d.split()} | {str(k) for k in range(10)})


def _words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


GATE = sorted({w for f, t in TEMPLATES for w in _words(t)
               if w not in COMMON and not w.isdigit() and len(w) > 1})


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def let(value: Column, use) -> Column:
    """``use(value)``, the value computed once."""
    return F.transform(F.array(value), use)[0]


def grams_of(words: Column) -> Column:
    """Distinct one- and two-word features."""
    def of(w: Column) -> Column:
        pairs = F.zip_with(w, F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
        return F.array_distinct(F.concat(w, F.slice(pairs, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0)))))
    return let(words, of)


def fixed(words: list[str]) -> Column:
    """An array of fixed strings, which Spark folds into one literal."""
    return F.split(F.lit("\n".join(words)), "\n")


def gate_words() -> Column:
    return fixed(GATE)


#: Words that the lines of a run but its last may hold, so that any wrapped template fits whatever the width.
SPAN = 2 * max(len(_words(t)) for _, t in TEMPLATES)


def _grams(text: str) -> list[str]:
    w = _words(text)
    return sorted({*w, *map(" ".join, zip(w, w[1:]))})


def gated(words: Column) -> Column:
    return F.arrays_overlap(words, gate_words())


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, lines) of the documents with a license word; lines: the words of every line."""
    lines = F.transform(F.split(F.col("text").cast("string"), "\n"), words_of)
    return docs.select("doc_id", lines.alias("lines")).where(F.exists("lines", gated))


def _run(near: Column, stops) -> Column:
    """The first of the lines ``near``, up to one that ``stops``, or until SPAN words are passed."""
    stop = F.array_position(F.transform(near, stops), True)
    whole = F.when(stop > 0, F.slice(near, F.lit(1), (stop - 1).cast("int"))).otherwise(near)
    return let(whole, lambda run: F.filter(run, lambda _, k: n_words(F.slice(run, F.lit(1), k)) < SPAN))


def n_words(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0), lambda n, w: n + F.size(w))


def ahead(lines: Column, i: Column) -> Column:
    """Line i and those after it that a run may hold."""
    return _run(F.slice(lines, i + 1, F.lit(SPAN + 1)), lambda w: F.size(w) == 0)


def behind(lines: Column, i: Column) -> Column:
    """The lines before line i without license words."""
    first = F.greatest(i - SPAN, F.lit(0))
    near = F.reverse(F.slice(lines, first + 1, i - first))
    return F.reverse(_run(near, lambda w: (F.size(w) == 0) | gated(w)))


def similarity(grams: Column, families: list[str] | None = None) -> Column:
    """Largest share of a template's n-grams (of a known family) that ``grams`` hold."""
    known = [_grams(t) for f, t in TEMPLATES if f in (families or FAMILIES[1:])]
    return let(grams, lambda g: F.greatest(F.lit(0.0), *[F.size(F.array_intersect(g, fixed(t))) / len(t) for t in known]))


@dataclass
class Model:
    """Weights by n-gram (one per family), intercepts, temperature and cut."""
    weights: dict[str, list[float]]
    intercepts: list[float]
    temperature: float = 1.0
    cut: float = 0.5

    def logits(self, grams: Column) -> Column:
        table = F.from_json(F.lit(json.dumps(self.weights)), "map<string,array<double>>")
        start = F.array(*[F.lit(float(x)) for x in self.intercepts])
        return F.aggregate(grams, start, lambda acc, g: F.coalesce(
            F.zip_with(acc, F.element_at(table, g), lambda a, b: a + b), acc))


def template_grams(spark: SparkSession) -> DataFrame:
    rows = json.dumps([{"label": FAMILIES.index(f), "text": t} for f, t in TEMPLATES])
    fixed = spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<label int, text string>>")))
    return fixed.withColumn("words", words_of(F.col("text")))


def training_rows(docs: DataFrame) -> DataFrame:
    """(label, grams, held): templates with words left out, and corpus paragraphs as unknown."""
    spark = docs.sparkSession
    copies = template_grams(spark).select("label", "words", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("k"))
    stays = F.filter("words", lambda w, i: (F.col("k") == 0) | w.isin(KEPT)
                     | (F.pmod(F.xxhash64(w, i, F.col("k")), F.lit(100)) < STAY))
    known = copies.select("label", stays.alias("words"), (F.col("k") % 4 == 3).alias("held"))
    ids = (docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))
    picked = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    lines = picked.select(F.explode(F.split(F.col("text").cast("string"), "\n")).alias("line")).distinct()
    plain = (lines.withColumn("words", words_of(F.col("line"))).where(F.size("words") > 0)
             .where(F.size(F.array_intersect("words", gate_words())) < 2)
             .orderBy(F.xxhash64("line"), "line").limit(SAMPLE_PARAGRAPHS))
    at = F.filter(F.sequence(F.lit(0), F.size("lines") - 1),
                  lambda i: F.size(F.array_intersect(F.element_at("lines", i + 1), gate_words())) > 1)
    # what stands around a line, to the last word free of a blank line: a part of a wrapped notice is not unknown
    back = lambda i: F.reverse(_run(F.reverse(F.slice("lines", F.greatest(i - SPAN, F.lit(0)) + 1, F.least(i, F.lit(SPAN)))),
                                    lambda w: F.size(w) == 0))
    near = F.transform(at, lambda i: F.struct(F.element_at("lines", i + 1).alias("words"), F.flatten(
        F.concat(back(i), ahead(F.col("lines"), i))).alias("around")))
    alike = (lines_of(picked).select(F.inline(near)).where(similarity(grams_of(F.col("around"))) < CONFIRM)
             .select(F.concat_ws(" ", "words").alias("line"), "words").distinct()
             .orderBy(F.xxhash64("line"), "line").limit(SAMPLE_ALIKE))
    prose = plain.unionByName(alike).select(F.lit(0).alias("label"), "words", (F.pmod(F.xxhash64("line", F.lit(1)), F.lit(4)) == 3).alias("held"))
    return known.unionByName(prose).select(F.col("label").cast("double"), grams_of(F.col("words")).alias("grams"), "held")


def fit(docs: DataFrame) -> Model:
    """Logistic regression on the bounded training rows; temperature and cut from the held-back ones."""
    rows = training_rows(docs).repartition(1).persist()  # a bounded sample: one small task a step
    vocabulary = sorted({g for _, t in TEMPLATES for w in [_words(t)] for g in [*w, *map(" ".join, zip(w, w[1:]))]})
    counts = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features").setBinary(True)
    fitted = LogisticRegression(family="multinomial", maxIter=60, regParam=0.003, standardization=False).fit(
        counts.transform(rows.where("not held")).select("label", "features"))
    matrix, centre = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    model = Model({g: [round(float(x), 6) for x in matrix[:, k]] for k, g in enumerate(vocabulary)},
                  [float(x) for x in centre])
    held = rows.where("held").select("label", model.logits(F.col("grams")).alias("z")).collect()  # bounded
    rows.unpersist()

    def chances(z: list[float], t: float) -> list[float]:
        e = [math.exp((x - max(z)) / t) for x in z]
        return [x / sum(e) for x in e]

    model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=lambda t: sum(
        -math.log(max(chances(r.z, t)[int(r.label)], 1e-12)) for r in held))
    tops = sorted(max(chances(r.z, model.temperature)[1:]) for r in held if r.label == 0)
    if tops:
        model.cut = min(0.9, max(0.5, tops[min(len(tops) - 1, int(UNKNOWN_QUANTILE * len(tops)))]))
    return model


def verdict(words: Column, model: Model) -> Column:
    """(family, probability, similarity, predicted) of a paragraph."""
    def of(grams: Column) -> Column:
        return let(model.logits(grams), lambda z: let(
            F.transform(z, lambda x: F.exp((x - F.array_max(z)) / F.lit(model.temperature))), lambda e: chosen(grams, e)))

    def chosen(grams: Column, e: Column) -> Column:
        known = F.slice(e, 2, len(FAMILIES) - 1)
        name = F.element_at(fixed(FAMILIES[1:]), F.array_position(known, F.array_max(known)).cast("int"))
        chance = F.array_max(known) / F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
        return let(chance, lambda p: let(F.when(p >= model.cut, name).otherwise(F.lit(UNKNOWN)), lambda f: let(
            alike(grams, f), lambda share: F.struct(
                F.when((share >= CONFIRM) & signed(grams, f), f).otherwise(F.lit(UNKNOWN)).alias("family"),
                F.round(p, 6).alias("probability"), F.round(share, 6).alias("similarity"), f.alias("predicted")))))

    # other n-grams have no weight, are in no template and no sign
    return let(F.array_intersect(grams_of(words), fixed(sorted({*model.weights, *ALL_SIGNS}))), of)


ALL_SIGNS = sorted({g for needs, bars in SIGNS.values() for g in [*sum(needs, []), *bars]} | set(DENIALS))


def signed(grams: Column, family: Column) -> Column:
    """Whether the words that tell the family from its neighbours are there, none that tell of another, and
    nothing that denies the licence."""
    has = lambda signs: F.arrays_overlap(grams, fixed(sorted(signs)))
    out = F.when(has(DENIALS), F.lit(False))
    for f, (needs, bars) in SIGNS.items():
        good = F.lit(True)
        for signs in needs:
            good &= has(signs)
        out = out.when(family == f, good & ~has(bars) if bars else good)
    return out.otherwise(F.lit(False))


def alike(grams: Column, family: Column) -> Column:
    """``similarity`` to the templates of one family; 0 for the unknown one."""
    out = F.when(family == UNKNOWN, F.lit(0.0))
    for f in FAMILIES[1:]:
        out = out.when(family == f, similarity(grams, [f]))
    return out.otherwise(F.lit(0.0))


def held(grams: Column, family: Column, every: Column) -> Column:
    """Sum of the similarities to those templates of a family that ``every`` confirms."""
    return let(grams, lambda g: let(every, lambda e: _held(g, family, e)))


def _held(grams: Column, family: Column, every: Column) -> Column:
    out = F.when(family == UNKNOWN, F.lit(0.0))
    for f in FAMILIES[1:]:
        parts = F.lit(0.0)
        for t in (_grams(t) for g, t in TEMPLATES if g == f):
            share = lambda x, t=t: F.size(F.array_intersect(x, fixed(t))) / len(t)
            parts += F.when(share(every) >= CONFIRM, share(grams)).otherwise(0.0)
        out = out.when(family == f, parts)
    return out.otherwise(F.lit(0.0))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, paragraph, family, probability, similarity, predicted: one row per candidate paragraph
    (``paragraph`` is the number of its first line, from 0).
    ``family`` is the confirmed family, else ``unknown``; ``predicted`` is the classifier's own choice."""
    lines = F.col("lines")
    whole = lambda run, s: F.flatten(F.slice(run, F.lit(1), s))

    def runs(i: Column, before: Column, after: Column) -> Column:
        """(first, line, last, verdict) of line i alone or, where a template is wrapped, of the shortest run from it on."""
        alone = F.struct(i.alias("first"), i.alias("line"), i.alias("last"), verdict(F.element_at(lines, i + 1), model).alias("v"))

        def longer(before: Column, after: Column) -> Column:
            may = F.filter(F.sequence(F.lit(1), F.size(after)), lambda s: similarity(
                grams_of(F.concat(F.flatten(before), whole(after, s)))) >= CONFIRM)
            return F.filter(F.transform(may, lambda s: F.struct(
                (i - F.size(before)).alias("first"), i.alias("line"), (i + s - 1).alias("last"),
                verdict(F.concat(F.flatten(before), whole(after, s)), model).alias("v"))),
                lambda r: r["v"]["family"] != UNKNOWN)

        def tried(before: Column, after: Column) -> Column:
            # a longer run never holds less of a template: most lines need no more than this look
            hopeless = similarity(grams_of(F.concat(F.flatten(before), F.flatten(after)))) < CONFIRM
            none = F.slice(before, 1, 0)
            found = let(longer(none, after), lambda found: F.when(
                F.size(found) > 0, found).otherwise(F.concat(longer(before, after), F.array(alone))))
            return let(alone, lambda one: F.when(
                hopeless | (one["v"]["family"] != UNKNOWN), F.array(one)).otherwise(found))

        return tried(before, after)[0]

    def grown(r: Column, after: Column) -> Column:
        """A confirmed run with the lines after it that add to a template of its family; of another family only if
        its template is found better with the lines so far than without them."""
        before = F.slice(lines, r["first"] + 1, r["line"] - r["first"])
        text = lambda k: F.concat(F.flatten(before), whole(after, k))
        every = grams_of(text(F.size(after)))
        adds = lambda f, k: held(grams_of(text(k)), f, every) > held(grams_of(text(k - 1)), f, every)

        def step(now: Column, k: Column) -> Column:
            at = now["last"] - r["line"] + 1
            rest = lambda f: alike(grams_of(F.flatten(F.slice(after, at + 1, k - at))), f)
            turns = lambda v: (v["family"] != UNKNOWN) & (v["family"] != now["v"]["family"]) & (
                v["similarity"] > now["v"]["similarity"]) & (v["similarity"] > F.round(rest(v["family"]), 6))
            more = lambda v: F.when(turns(v), run_of(r["line"] + k - 1, v)).when(
                adds(now["v"]["family"], k), run_of(r["line"] + k - 1, F.when(
                    (v["family"] == now["v"]["family"]) & (v["similarity"] >= now["v"]["similarity"]), v).otherwise(now["v"]))
            ).otherwise(now)
            return F.when(at == k - 1, let(verdict(text(k), model), more)).otherwise(now)

        def run_of(last: Column, v: Column) -> Column:
            return F.struct(r["first"].alias("first"), r["line"].alias("line"), last.alias("last"), v.alias("v"))

        later = F.filter(F.sequence(F.lit(1), F.size(after)), lambda k: k > r["last"] - r["line"] + 1)
        return F.when(r["v"]["family"] == UNKNOWN, r).otherwise(F.aggregate(later, r, step))

    starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: gated(F.element_at(lines, i + 1)))

    def first_of_each(every: Column) -> Column:
        """Confirmed runs that don't start inside one of their family, and lines that no confirmed run holds."""
        sure = F.filter(every, lambda r: r["v"]["family"] != UNKNOWN)
        return let(sure, lambda sure: F.filter(every, lambda r: ~F.exists(sure, lambda o: (
            (o["first"] <= r["line"]) & (r["line"] <= o["last"]) & (o["line"] != r["line"])
            & ((r["v"]["family"] == UNKNOWN) | ((r["v"]["family"] == o["v"]["family"]) & (o["line"] < r["line"])))))))

    # one select after the other: the analyser gives up on deeper nesting
    rows = lines_of(docs).select("doc_id", "lines", F.transform(starts, lambda i: F.struct(
        i.alias("i"), behind(lines, i).alias("before"), ahead(lines, i).alias("after"))).alias("s"))
    rows = rows.select("*", F.transform("s", lambda x: runs(x["i"], x["before"], x["after"])).alias("r"))
    rows = rows.select("doc_id", F.zip_with("r", "s", lambda r, x: grown(r, x["after"])).alias("r"))
    rows = rows.select("doc_id", F.explode(first_of_each(F.col("r"))).alias("r"))
    return rows.select("doc_id", F.col("r.first").alias("paragraph"), "r.v.*")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs))
