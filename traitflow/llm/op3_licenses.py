"""Licence scans: a trained paragraph classifier confirmed by templates (DataFrame and MLlib code on the
JVM only).

Paragraphs are the blocks of a text between blank lines, and each line by itself. Their 1- and 2-grams of words (sparse binary counts over the vocabulary of
the licences' training paragraphs) go into a multinomial logistic regression over licence families and the class
``unknown``. A paragraph belongs to the family with the largest probability if that is at least the calibrated
threshold: the smallest at which at most ``FALSE`` of the paragraphs without a licence pass that were held out, template by template. The
template comparison then confirms: at least ``SHARED`` of the paragraph's word pairs, or of a template's, are shared.

Every paragraph is judged, most of them by arithmetic: n-grams of words that are common in the corpus's prose are no features, so a
paragraph of a family holds one of the other words of the vocabulary (``Classifier.marking``; the fitted intercepts are checked). A text, and then a
paragraph, with none of them is ``unknown`` whatever else it holds; only the others are cut into paragraphs, counted and scored.

Training paragraphs: the templates below (notices, and names as they are cited), whole, cut, with other names, years and surroundings, made by
rule from row numbers; and as ``unknown`` paragraphs without licence words from documents with the smallest hashes (a bounded
sample, ``MAX_UNKNOWN``) and sentences that use licence words otherwise.

All lines and blocks are classified in one scan, and only findings leave it: lines that belong to a family, ``unknown`` lines with a
licence word (``CUES``), and blocks of several lines that are confirmed for a family for which none of their lines is. Nothing is shuffled but the
corpus sample's candidates and the findings. Edge cases: null and empty texts have no paragraphs; a null id is reported as null; repeated rows
report the same findings each; very long paragraphs are classified whole; an empty table gives no findings; other
columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.llm import common as C

UNKNOWN = "unknown"
MAX_UNKNOWN = 2_000
COPIES = 60              # training paragraphs per template
FALSE = 0.005
COMMON = 0.01            # share of the prose paragraphs with a word that makes it common
SHARED = 0.5

# Notices and opening sentences of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work (CC0 1.0)."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright 2020 Example Inc. All rights reserved."),
    ("proprietary", "Copyright (c) 2020 The Authors. All rights reserved."),
    ("proprietary", "This document is confidential and proprietary and may not be copied or distributed without prior written permission."),
)
# Names under which licences are cited.
NAMES = (
    ("Apache-2.0", "Apache-2.0"), ("Apache-2.0", "Apache 2.0"), ("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "Apache License, Version 2.0"), ("MIT", "MIT"),
    ("GPL-3.0", "GPL-3.0-only"), ("GPL-3.0", "GPL-3.0-or-later"), ("GPL-3.0", "GPLv3"), ("GPL-3.0", "GNU GPL v3"), ("GPL-2.0", "GPL-2.0-only"), ("GPL-2.0", "GPL-2.0-or-later"),
    ("GPL-2.0", "GPLv2"), ("GPL-2.0", "GNU GPL v2"), ("LGPL", "LGPL-2.1-only"), ("LGPL", "LGPL-2.1-or-later"), ("LGPL", "LGPL-3.0-only"), ("LGPL", "LGPLv3"), ("LGPL", "GNU Lesser General Public License"),
    ("AGPL-3.0", "AGPL-3.0-only"), ("AGPL-3.0", "AGPL-3.0-or-later"), ("AGPL-3.0", "AGPLv3"), ("AGPL-3.0", "GNU Affero General Public License"), ("BSD", "BSD-3-Clause"), ("BSD", "BSD-2-Clause"),
    ("BSD", "3-Clause BSD"), ("MPL-2.0", "MPL-2.0"), ("MPL-2.0", "MPLv2"), ("MPL-2.0", "Mozilla Public License 2.0"), ("CC-BY", "CC-BY-4.0"), ("CC-BY", "CC BY 4.0"), ("CC-BY-SA", "CC-BY-SA-4.0"),
    ("CC-BY-SA", "CC BY-SA 4.0"), ("CC-BY-NC", "CC-BY-NC-4.0"), ("CC-BY-NC", "CC BY-NC 4.0"), ("CC0", "CC0-1.0"), ("CC0", "CC0 1.0 Universal"), ("Unlicense", "Unlicense"), ("ISC", "ISC"))
# How a name is cited; alone only with a figure in it, as other names are words of their own.
CITED = ("SPDX-License-Identifier: {}", "Released under {}.", "License: {}", "{} License", "{}")
TEMPLATES += tuple((family, form.format(name)) for form in CITED for family, name in NAMES
                   if not (form == "{}" and not any(c.isdigit() for c in name)) and not (form == "{} License" and "License" in name))
OTHER = (
    "She renewed her driving license at the public office last week.", "The court may grant permission to appeal the decision.",
    "The general manager of the public library opened the new source of funding.", "The software version was released in spring and sold under another name.",
    "A warranty of two years comes with the machine.", "The band released a free album under the terms of the contract.",
    "Copyright law protects authors and their heirs.", "The commons was open to the public for grazing.", "The fishing licence is issued under the act of 1923.",
    "The Apache nation lived in the southwest.", "Students at MIT published the work.", "Distribution of the harvest follows without restriction.",
    "All rights reserved to the king under the treaty.", "The rights of the tenants were reserved by the council.", "His license to drive was withdrawn in version two of the story.",
    "The library is free and open to the general public.", "The committee reserved all seats under the terms agreed.", "Permission to enter the park is granted free of charge.",
    "The source of the river lies in the public forest.", "The clause in the contract follows the general conditions.", "Creative writing is taught on the commons near MIT.",
    "A copy of the permission letter shall appear in the file.", "The Mozilla office moved to another street.", "Software engineers met without any warranty of success.",
)
# Words with which a line is reported even if it belongs to no family, and without which prose is taken for training
CUES = r"(?i)licen[cs]e|copyright|permission|warrant|redistribut|creative commons|public domain|free software|all rights reserved|proprietary|\bCC[ -](?:BY|0)|\bCC0|\bSPDX|\bGPL|\bBSD|\bMPL\b"


# lower-case substrings one of which stands in every text that holds a cue
CUE_PARTS = ("licen", "copyright", "permission", "warrant", "redistribut", "creative commons", "public domain", "free software", "all rights reserved", "proprietary",
             "cc by", "cc-by", "cc 0", "cc-0", "cc0", "spdx", "gpl", "bsd", "mpl")


PARTS = r"[^\p{L}\p{N}]+"


def part(word: str) -> str:
    """The longest part of a word between punctuation marks."""
    return max(re.findall(r"[^\W_]+", word), key=len)


def grams(paragraph: Column) -> Column:
    """Words (lower-case letters and digits) and pairs of neighbours."""
    def both(w):
        pairs = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.concat(w, pairs)
    return C.let(F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}.+-]+"), lambda x: F.regexp_replace(x, "[.+-]", "") != ""), lambda w: both(
        F.transform(w, lambda x: F.regexp_replace(x, r"[.+-]+$", ""))))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, h (of the text), line and last (numbers of the first and last line), paragraph: every line that is not blank, and every block
    of several lines between blank lines."""
    def struct(line, last, paragraph):
        return F.struct(line.cast("long").alias("line"), last.cast("long").alias("last"), paragraph.alias("paragraph"))

    def block(b):
        # every line of the numbered text starts with its number and \x01
        own = F.filter(F.split(b, "\n", -1), lambda x: ~x.rlike("^[0-9]+\x01\\s*$"))
        number = lambda x: F.substring_index(x, "\x01", 1)
        return C.let(own, lambda o: F.when(F.size(o) > 1, struct(number(F.element_at(o, 1)), number(F.element_at(o, -1)), F.array_join(F.transform(o, lambda x: F.regexp_replace(x, "^[0-9]+\x01", "")), "\n"))))

    def units(a):
        lines = F.filter(F.transform(a, lambda x, i: struct(i, i, x)), lambda u: u["paragraph"].rlike(r"\S"))
        numbered = F.array_join(F.transform(a, lambda x, i: F.concat(i.cast("string"), F.lit("\x01"), x)), "\n")
        blocks = F.transform(F.split(numbered, "\n(?=[0-9]+\x01\\s*(?:\n|$))", -1), block)
        return F.concat(lines, F.filter(blocks, lambda u: u.isNotNull()))

    return docs.select("doc_id", F.xxhash64("text").alias("h"), F.explode(C.let(F.split("text", "\n", -1), units)).alias("p")).select("doc_id", "h", "p.*")


def training(docs: DataFrame, max_unknown: int = MAX_UNKNOWN) -> DataFrame:
    """family, paragraph, template, held (all copies of a template that is held out for the calibration, and some prose)."""
    spark = docs.sparkSession
    i = F.col("copy")
    pick = lambda salt, *of: F.element_at(F.array(*[F.lit(x) for x in of]), (F.pmod(F.xxhash64(i, "paragraph", F.lit(salt)), F.lit(len(of))) + 1).cast("int"))
    rows = [(f, t) for f, t in TEMPLATES] + [(UNKNOWN, t) for t in OTHER]
    known = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("paragraph")) for f, t in rows])))
    known = known.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("family") == UNKNOWN, 3 * COPIES).otherwise(COPIES))))
    verb = pick("verb", "Released", "Distributed", "Licensed", "Published", "Available", "Code", "This software is", "Use")
    words = F.split(F.when(F.col("paragraph").rlike("^Released under (?!the)"), F.concat(verb, F.substring(F.col("paragraph"), 9, 1000))).otherwise(F.col("paragraph")), " ")
    size = F.size(words)
    cut = pick("cut", 1.0, 1.0, 0.9, 0.8)
    made = known.select(
        "family", "copy", "paragraph", F.array_join(F.slice(words, 1, F.greatest(F.when(F.col("paragraph").rlike("^Released under (?!the)"), size).otherwise(3), F.ceil(size * cut).cast("int"))), " ").alias("body"))
    text = F.concat(pick("before", "", "", "", "// ", "# ", "* ", "Copyright (c) 2021 The Authors. ", "Note: "), F.col("body"),
                    pick("after", "", "", "", " See the LICENSE file for details.", " Visit the web site.", " -->"))
    text = F.when(pick("upper", 0, 0, 0, 1) == 1, F.upper(text)).otherwise(text)
    some = docs.filter(C.smallest_hashes(F.xxhash64("text"), docs.count(), max_unknown))
    prose = (some.select(F.explode(F.split("text", "\n")).alias("paragraph")).filter(~F.col("paragraph").rlike(CUES) & (F.length("paragraph") > 0)).distinct()
             .select("paragraph", F.xxhash64("paragraph").alias("h")).orderBy("h", "paragraph").limit(max_unknown))
    # what a template confirms is not taken for prose
    prose = prose.filter(similarity(grams(F.col("paragraph")), None, template_items(spark)) < SHARED)
    prose = prose.select(F.lit(UNKNOWN).alias("family"), F.col("paragraph").alias("text"), F.col("paragraph").alias("template"))
    mixed = made.select("family", text.alias("text"), F.col("paragraph").alias("template")).unionByName(prose)
    return mixed.select("family", F.col("text").alias("paragraph"), "template", (F.pmod(F.xxhash64("template", F.lit("held")), F.lit(4)) == 0).alias("held"))


class Classifier:
    """Vocabulary, regression, threshold. The threshold is calibrated on held-out templates, the model then fitted on all."""

    def __init__(self, rows: DataFrame):
        data = C.written(rows.withColumn("grams", grams(F.col("paragraph"))), "licence-training")
        families = sorted({f for f, _ in TEMPLATES})
        self.names = [UNKNOWN, *families]
        data = data.withColumn("label", (F.array_position(F.array(*[F.lit(n) for n in self.names]), F.col("family")) - 1).cast("double")).coalesce(1)
        # words of licences that a share of the corpus's prose uses, too; as many at most as there are words in the templates
        known = F.array(*[F.lit(p) for p in sorted({p for _, t in TEMPLATES for p in re.findall(r"[^\W_]+", t.lower())})])
        prose = data.filter((F.col("family") == UNKNOWN) & ~F.col("template").isin(list(OTHER)))
        used = prose.select(F.explode(F.array_intersect(F.split(F.lower("paragraph"), PARTS), known)).alias("p")).groupBy("p").count()
        self.common = {r["p"] for r in used.filter(F.col("count") >= max(5, COMMON * prose.count())).collect()}
        self.fit(data.filter(~F.col("held")))
        # the smallest threshold that at most FALSE of the held-out paragraphs without a licence pass
        other = data.filter(F.col("held") & (F.col("family") == UNKNOWN)).dropDuplicates(["template"])
        passing = int(FALSE * other.count())
        worst = self.guessed(other).filter(F.col("guess") != UNKNOWN).orderBy(F.col("chance").desc()).select("chance").limit(passing + 1).collect()
        self.threshold = max(0.5, worst[-1]["chance"] + 1e-9) if len(worst) > passing else 0.5
        self.fit(data)

    def fit(self, rows: DataFrame) -> None:
        # n-grams of licences only, and not those of common words alone: they say nothing for a family
        seen = CountVectorizer(inputCol="grams", outputCol="x", minDF=2, binary=True, vocabSize=1 << 16).fit(rows.filter(F.col("family") != UNKNOWN)).vocabulary
        kept = [g for g in seen if any(part(w) not in self.common for w in g.split(" "))]
        self.counts = CountVectorizerModel.from_vocabulary(kept, inputCol="grams", outputCol="x").setBinary(True)
        self.model = LogisticRegression(featuresCol="x", labelCol="label", family="multinomial", regParam=1e-3, maxIter=60).fit(self.counts.transform(rows))

    def marking(self) -> list[str] | None:
        """Parts of words one of which stands in every paragraph that the model can give to a family; None if the model
        gives a paragraph without any n-gram of its vocabulary to a family. Every n-gram of the vocabulary has a word that is not common in
        prose, so a paragraph without these words has none, and its chances are those of the intercepts."""
        bias = self.model.interceptVector.toArray()
        if bias[1:].max() - bias[0] >= math.log(self.threshold / (1 - self.threshold)) - 1e-6:
            return None
        return sorted({p for gram in self.counts.vocabulary for p in map(part, gram.split(" ")) if p not in self.common})

    def candidate(self, text: Column) -> Column:
        """False only where no paragraph of ``text`` can be of a family or hold a cue."""
        known = self.marking()
        if known is None:
            return F.lit(True)
        low = F.lower(text)
        out = F.arrays_overlap(F.split(low, PARTS), F.array(*[F.lit(w) for w in known]))
        for cue in CUE_PARTS:
            out = out | F.contains(low, F.lit(cue))
        return out

    def guessed(self, rows: DataFrame) -> DataFrame:
        """``rows`` (grams) with guess and chance."""
        p = vector_to_array("probability")
        scored = self.model.transform(self.counts.transform(rows))
        return scored.withColumn("chance", F.array_max(p)).withColumn("guess", F.element_at(F.array(*[F.lit(n) for n in self.names]), (F.col("prediction") + 1).cast("int"))).drop("x", "probability", "rawPrediction", "prediction")


def items(grams_: Column) -> Column:
    """Distinct word pairs, or the words of a paragraph that has no pair."""
    pairs = F.filter(grams_, lambda g: F.instr(g, " ") > 0)
    return F.array_distinct(F.when(F.size(pairs) > 0, pairs).otherwise(grams_))


def template_items(spark: SparkSession) -> dict[str, list[list[str]]]:
    """Items of the templates of each family."""
    rows = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("t")) for f, t in TEMPLATES])))
    out: dict[str, list[list[str]]] = {}
    for r in rows.select("family", items(grams(F.col("t"))).alias("items")).collect():      # as many as there are templates
        out.setdefault(r["family"], []).append(r["items"])
    return out


def similarity(grams_: Column, family: Column | None, templates: dict[str, list[list[str]]]) -> Column:
    """Largest share of its word pairs that the paragraph has in common with a template of the family, or that a template has in
    common with it; a template of few pairs counts as one of five, so that a phrase alone does not confirm a long line. Without a
    family the largest over all."""
    def share(own):
        rows = []
        for f, known in sorted(templates.items()):
            of = F.array(*[F.array(*[F.lit(x) for x in t]) for t in known])
            each = F.transform(of, lambda t: C.let(F.size(F.array_intersect(own, t)), lambda same: F.greatest(
                same / F.greatest(F.size(own), F.lit(1)), same / F.greatest(F.size(t), F.lit(5)))))
            rows.append(F.array_max(each) if family is None else F.when(family == f, F.array_max(each)))
        return F.greatest(*rows) if family is None else F.coalesce(*rows, F.lit(0.0))
    return C.let(items(grams_), share)


def scanned(docs: DataFrame, exact_bound: bool = True) -> DataFrame:
    """doc_id, line (the first), family, probability, similarity, confirmed, paragraph for each line of a family or with a licence word, and for each
    block whose family none of its lines shows; family ``unknown`` where no family reaches the threshold. With ``exact_bound`` texts and
    paragraphs that the model's coefficients rule out are not scored; the result is the same without."""
    docs = docs.select("doc_id", "text")
    classifier = Classifier(training(docs))
    near = docs.filter(classifier.candidate(F.col("text"))) if exact_bound else docs
    units = paragraphs(near).filter(classifier.candidate(F.col("paragraph"))) if exact_bound else paragraphs(docs)
    out = classifier.guessed(units.withColumn("grams", grams(F.col("paragraph"))))
    out = out.withColumn("family", F.when(F.col("chance") >= classifier.threshold, F.col("guess")).otherwise(F.lit(UNKNOWN)))
    single = F.col("line") == F.col("last")
    out = C.written(out.filter((F.col("family") != UNKNOWN) | (single & F.col("paragraph").rlike(CUES))), "licence-paragraphs")
    out = out.withColumn("similarity", F.when(F.col("family") == UNKNOWN, F.lit(0.0)).otherwise(similarity(F.col("grams"), F.col("family"), template_items(docs.sparkSession))))
    out = out.withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("similarity") >= SHARED))
    out = C.written(out.drop("grams", "guess"), "licence-findings")
    shown = out.filter(single & F.col("confirmed")).select(F.col("doc_id").alias("d"), F.col("h").alias("t"), F.col("line").alias("at"), F.col("family").alias("f"))
    blocks = out.filter(~single & F.col("confirmed")).join(
        shown, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("t")) & (F.col("family") == F.col("f")) & F.col("at").between(F.col("line"), F.col("last")), "left_anti")
    return out.filter(single).unionByName(blocks).select("doc_id", "line", "family", F.col("chance").alias("probability"), "similarity", "confirmed", "paragraph")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(C.table(spark, sf_dir, "documents"))
